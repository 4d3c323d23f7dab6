"""Reading one large file in many tasks where lines are not records.

A JSON array or a CSV file with quoted line breaks can't be cut at any line
end: whether a byte ends a record depends on the strings, brackets and quotes
before it.  Here the file's byte ranges are scanned twice, each range by a
task of its own:

1. Every range is summed up as what it does to the state in which it might
   begin (inside a string or quote or not; brackets opened less closed).
2. A running sum over the ranges of each file, one narrow row a range, gives
   the state in which each really begins.
3. Every range is cut into records from that state on.  The ends and starts
   of records that cross a range border, at most two pieces a range, are put
   together by their order.

Spark's own text reader makes the ranges: it is told to end a line at the
byte that may end a record, so the ranges fall right for local and remote
files alike.  A compressed file, which can't be split, is one range.

A task takes many ranges, one after the other, if they are small: how many
tasks there are follows the session's scan split size, not the ranges'.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stopflow.session import materialize

# The states of all ranges (under 100 bytes each) are broadcast to the second
# scan, up to this many ranges.
MOST_RANGES = 1_000_000
_SUMMARY = "file string, at long, from_out int, from_in int, depth_out long, depth_in long"
_PIECES = "text string, file string, at long, place int, ended boolean"


@contextmanager
def split_size(spark: SparkSession, split_bytes: int):
    """While open, scans cut files into ranges of ``split_bytes`` at most."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys[:2]:
        spark.conf.set(k, str(split_bytes))
    spark.conf.unset(keys[2])
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def tasks_for(spark: SparkSession, size: int, split_bytes: int) -> int:
    """Tasks to read ``size`` bytes: of the session's scan split size each, but no fewer than two a core while ranges of ``split_bytes`` last."""
    usual = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return max(-(-size // max(usual, split_bytes)), min(-(-size // split_bytes), 2 * spark.sparkContext.defaultParallelism), 1)


def _segments(spark: SparkSession, files: list[str], end: str, tasks: int | None = None) -> DataFrame:
    rows = (spark.read.option("lineSep", end).text(files)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")))
    return rows if tasks is None else rows.coalesce(tasks)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The parts of the batches that come from one range each, in the order of the file."""
    for b in batches:
        if not b.num_rows:
            continue
        at = b.column("at").to_numpy()
        file = b.column("file").dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((np.diff(at) != 0) | (np.diff(file) != 0)) + 1
        for a, e in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
            yield b.column("file")[a].as_py(), int(at[a]), b.slice(a, e - a)


# --- JSON arrays: a segment ends at each closing brace --------------------------------

_QUOTE, _BACKSLASH = ord('"'), ord("\\")
_STEP = np.zeros(256, np.int8)
_STEP[[ord("["), ord("{")]] = 1
_STEP[[ord("]"), ord("}")]] = -1


def _bytes_of(rows: pa.RecordBatch) -> bytes:
    return b"".join(x + b"}" for x in rows.column("value").cast(pa.binary()).to_pylist())


def _quotes(data: np.ndarray) -> np.ndarray:
    """Places of the quotes that are not escaped.  A segment's end is never between a backslash and what it escapes."""
    quotes = np.flatnonzero(data == _QUOTE)
    if not len(quotes) or not (slashed := data == _BACKSLASH).any():
        return quotes
    plain = np.maximum.accumulate(np.where(slashed, -1, np.arange(len(data))))
    before = np.where(quotes > 0, plain[quotes - 1], -1)
    return quotes[(quotes - 1 - before) % 2 == 0]


def _steps(data: np.ndarray, quotes: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and steps of the brackets outside strings, if the first byte is ``inside`` one or not."""
    places = np.flatnonzero(_STEP[data])
    out = (np.searchsorted(quotes, places) + inside) % 2 == 0
    return places[out], _STEP[data[places[out]]].astype(np.int64)


def _sum_json(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[str, int], list[int]] = {}
    for file, at, rows in _runs(batches):
        data = np.frombuffer(_bytes_of(rows), np.uint8)
        quotes = _quotes(data)
        odd, deep = len(quotes) % 2, [int(_steps(data, quotes, s)[1].sum()) for s in (0, 1)]
        t = total.setdefault((file, at), [0, 0, 0])
        # what came before in the range may have turned inside and outside round
        deep = deep[::-1] if t[0] else deep
        total[file, at] = [t[0] ^ odd, t[1] + deep[0], t[2] + deep[1]]
    rows = [(f, a, odd, 1 - odd, x, y) for (f, a), (odd, x, y) in total.items()]
    yield _table(rows, _SUMMARY)


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [c.split() for c in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


def _record(text: bytes) -> str:
    """An element of an array as one line; what is no object is made unreadable, so that it fails and isn't lost."""
    line = text.lstrip(b"\xef\xbb\xbf \t\r\n,").replace(b"\n", b" ").replace(b"\r", b" ").decode("utf-8", "replace")
    return line if line.startswith("{") else "malformed: " + line


def _cut_json(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, inside, depth, left, ended_once = None, 0, 0, b"", False

    def rest() -> list[tuple]:
        return [(left.decode("utf-8", "replace"), *now, 1, False)] if now and left else []

    for file, at, rows in _runs(batches):
        out = []
        if (file, at) != now:
            out += rest()
            now, inside, depth, left, ended_once = (file, at), rows.column("state")[0].as_py(), rows.column("depth")[0].as_py(), b"", False
        raw = _bytes_of(rows)
        data = np.frombuffer(raw, np.uint8)
        quotes = _quotes(data)
        places, steps = _steps(data, quotes, inside)
        levels = depth + np.cumsum(steps)
        ends = places[(levels == 1) & (steps < 0)] + 1
        begin = 0
        opened = places[(levels == 1) & (steps > 0)]
        if len(opened):  # the array's own bracket
            begin = int(opened[0]) + 1
            if left.strip(b"\xef\xbb\xbf \t\r\n") or raw[:begin - 1].strip(b"\xef\xbb\xbf \t\r\n"):
                out.append((_record(left + raw[:begin]), None, None, None, None))
            left = b""
        for e in ends.tolist():
            text = left + raw[begin:e]
            # only a range's first record can have begun before it
            crosses = not ended_once and at > 0
            out.append((text.decode("utf-8", "replace"), file, at, 0, True) if crosses else (_record(text), None, None, None, None))
            begin, left, ended_once = e, b"", True
        left += raw[begin:]
        inside, depth = (inside + len(quotes)) % 2, int(levels[-1]) if len(levels) else depth
        yield _table(out, _PIECES)
    yield _table(rest(), _PIECES)


# --- CSV: a segment ends at each line feed --------------------------------------------


def ends_quoted(line: str, quoted: bool, comma: str = ",") -> bool:
    """Whether a line ends inside a quoted field, by whether it begins in one.

    A field is quoted only if a quote is its first character; doubled quotes
    stand for one; other quotes are plain characters.
    """
    at, n = 0, len(line)
    while True:
        if not quoted:
            if at >= n or line[at] != '"':
                at = line.find(comma, at)
                if at < 0:
                    return False
                at += 1
                continue
            at += 1
        while True:
            at = line.find('"', at)
            if at < 0:
                return True
            if line[at + 1:at + 2] != '"':
                break
            at += 2
        quoted = False
        at = line.find(comma, at + 1)
        if at < 0:
            return False
        at += 1


def _quoted_rows(rows: pa.RecordBatch) -> list[int]:
    """Rows with a quote: all others leave the state as it is."""
    values = rows.column("value").to_pylist()
    return [k for k, v in enumerate(values) if '"' in v]


def _sum_csv(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[str, int], list[bool]] = {}
    for file, at, rows in _runs(batches):
        state = total.setdefault((file, at), [False, True])
        values = rows.column("value")
        for k in _quoted_rows(rows):
            line = values[k].as_py()
            state[:] = [ends_quoted(line, s) for s in state]
    yield _table([(f, a, int(x), int(y), 0, 0) for (f, a), (x, y) in total.items()], _SUMMARY)


def _cut_csv(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, quoted, left, started, header = None, False, [], False, False

    def piece(lines: list[str], place: int, ended: bool) -> tuple:
        return ("\n".join(lines) + ("" if ended else "\n"), *now, place, ended)

    def rest() -> list[tuple]:
        if left and header:
            raise ValueError(f"the header of {now[0]} is longer than a range; give a larger split_bytes")
        return [piece(left, 1, False)] if left else []

    for file, at, rows in _runs(batches):
        out = []
        if (file, at) != now:
            out += rest()
            now, quoted, left = (file, at), bool(rows.column("state")[0].as_py()), []
            # a range that begins quoted begins with the end of a record from before
            started, header = not quoted, at == 0
        marked = set(_quoted_rows(rows))
        if marked or quoted or header:
            for k, line in enumerate(rows.column("value").to_pylist()):
                left.append(line)
                quoted = ends_quoted(line, quoted) if k in marked else quoted
                if not quoted:
                    if not header:
                        out.append(("\n".join(left), None, None, None, None) if started else piece(left, 0, True))
                    left, started, header = [], True, False
            yield _table(out, _PIECES)
        else:
            yield _table(out, _PIECES)
            none = [pa.nulls(rows.num_rows, kind) for kind in (pa.string(), pa.int64(), pa.int32(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([rows.column("value"), *none], names=["text", "file", "at", "place", "ended"])
    yield _table(rest(), _PIECES)


# --- both ------------------------------------------------------------------------------


def _states(summary: DataFrame) -> DataFrame:
    """file, at, state and depth in which each range begins: one narrow row a range, a window a file.

    A range that ends alike from both states sets it; one that ends
    differently keeps it or turns it round, and turns add up from the last
    range that sets it.
    """
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    until = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    sets = F.col("from_out") == F.col("from_in")
    turns = F.sum(F.when(~sets & (F.col("from_out") == 1), 1).otherwise(0))
    rows = summary.withColumn("turned", turns.over(until))
    last = lambda c: F.coalesce(F.last(F.when(sets, c), ignorenulls=True).over(before), F.lit(0))
    state = (last(F.col("from_out")) + F.coalesce(turns.over(before), F.lit(0)) - last(F.col("turned"))) % 2
    rows = rows.withColumn("state", state.cast("int"))
    own = F.when(F.col("state") == 0, F.col("depth_out")).otherwise(F.col("depth_in"))
    end = F.when(F.col("state") == 0, F.col("from_out")).otherwise(F.col("from_in"))
    rows = rows.withColumn("own", own).withColumn("ends", end)
    return rows.select("file", "at", "state", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("depth"), "own", "ends")


def _records(spark: SparkSession, files: list[str], end: str, split_bytes: int, summed: Callable, cut: Callable,
             check: Callable[[DataFrame], None], name: str, size: int | None) -> DataFrame:
    """One row, text, per record of the files; and the last rest of each file with ended false."""
    tasks = None if size is None else tasks_for(spark, size, split_bytes)
    with split_size(spark, split_bytes):
        segments = _segments(spark, files, end, tasks)
        states = materialize(_states(segments.mapInArrow(summed, _SUMMARY)), f"{name}-ranges")
        if (n := states.count()) > MOST_RANGES:
            raise ValueError(f"{n} ranges of {split_bytes} bytes; at most {MOST_RANGES} are read at once, so give a larger split_bytes")
        check(states)
        begins = states.select(F.col("file").alias("of"), F.col("at").alias("from"), "state", "depth")
        placed = segments.join(F.broadcast(begins), (F.col("file") == F.col("of")) & (F.col("at") == F.col("from"))).drop("of", "from")
        pieces = materialize(placed.mapInArrow(cut, _PIECES), f"{name}-pieces")
    order = Window.partitionBy("file").orderBy("at", "place").rowsBetween(Window.unboundedPreceding, -1)
    parts = pieces.filter("file is not null").withColumn("record", F.coalesce(F.count_if("ended").over(order), F.lit(0)))
    whole = (parts.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("at", "place", "text"))).alias("ps"), F.max("ended").alias("ended"))
             .select(F.array_join(F.col("ps.text"), "").alias("text"), "ended"))
    return pieces.filter("file is null").select("text", F.lit(True).alias("ended")).unionByName(whole)


def _closed(states: DataFrame) -> None:
    """Every array must end: after its bracket stands the one brace that cutting has added."""
    odd = (states.groupBy("file").agg(F.sum("own").alias("depth"), F.max_by("ends", "at").alias("state"))
           .filter("depth <> -1 or state <> 0").select("file").limit(3).collect())
    if odd:
        raise ValueError(f"malformed JSON array, not closed: {', '.join(r.file for r in odd)}")


def array_records(spark: SparkSession, files: list[str], split_bytes: int, size: int | None = None) -> DataFrame:
    """One row, value, with a JSON object as one line for each element of the arrays in ``files``.

    With ``size``, the files' bytes, tasks take many small ranges; else one each.
    An element that is no object and text outside the elements give a value
    that can't be parsed; an array that is not closed is an error.
    """
    rows = _records(spark, files, "}", split_bytes, _sum_json, _cut_json, _closed, "json", size)
    text = F.regexp_replace(F.col("text"), "^[\\uFEFF\\s,]+", "")
    ended = F.when(F.startswith(text, F.lit("{")), F.translate(text, "\n\r", "  ")).otherwise(F.concat(F.lit("malformed: "), text))
    closing = F.regexp_like("text", F.lit(r"^\s*\]\s*\}$"))
    return rows.filter("ended").select(ended.alias("value")).unionByName(
        rows.filter(~F.col("ended") & ~closing).select(F.concat(F.lit("malformed: "), F.col("text")).alias("value")))


def csv_records(spark: SparkSession, files: list[str], split_bytes: int, returns: bool = False, size: int | None = None) -> DataFrame:
    """One row, value, for each record of the CSV ``files`` but their header; a record may span lines.

    With ``size``, the files' bytes, tasks take many small ranges; else one each.
    With ``returns`` lines end in a carriage return and a line feed, and such
    ends inside quotes become line feeds, as in Spark's own reader.  A last
    record whose quotes are not closed comes as it stands.
    """
    rows = _records(spark, files, "\n", split_bytes, _sum_csv, _cut_csv, lambda states: None, "csv", size)
    text = F.regexp_replace(F.replace("text", F.lit("\r\n"), F.lit("\n")) if returns else F.col("text"), "\r$", "")
    return rows.select(text.alias("value")).filter(F.col("value") != "")


def text_dataset(rows: DataFrame):
    """The JVM's Dataset[String] of a frame of one text column."""
    return getattr(rows._jdf, "as")(rows.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING())


def parsed_json(rows: DataFrame, schema: T.StructType | None) -> DataFrame:
    """Rows of JSON text by Spark's JSON reader; text that can't be parsed fails."""
    reader = rows.sparkSession._jsparkSession.read().option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(rows.sparkSession._jsparkSession.parseDataType(schema.json()))
    return DataFrame(reader.json(text_dataset(rows)), rows.sparkSession)


def parsed_csv(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of CSV text, a whole record each, by Spark's CSV parser."""
    names = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "maxCharsPerColumn": "-1"}
    return rows.select(F.from_csv("value", names, options).alias("r")).select("r.*")
