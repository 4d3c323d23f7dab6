"""What the files of a folder are, found by tasks: one reads the beginning of each file."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.sources.paths import LONGEST_FIRST_LINE
from stopflow.sources.ranges import ends_quoted, split_size

# Larger than any file, so that each file is one task's.
_WHOLE = 1 << 62
# Lines in which a CSV header is looked for first.
HEADER_LINES = 64


@dataclass(frozen=True)
class FoundFile:
    path: str
    size: int
    kind: str  # lines, array or document; of CSV, the header


def _is_object(line: str) -> bool:
    try:
        return isinstance(json.loads(line), dict)
    except ValueError:
        return False


def json_layout(begin: str, ended: bool) -> str | None:
    """lines (a document a line), array or document (one, over lines) by the first non-blank line; None if more of the file is needed.

    ``begin`` is text up to a closing brace, which has been added at the end
    of the file too.
    """
    text = begin.lstrip("\ufeff \t\r\n")
    if text[:1] == "[":
        return "array"
    if text and text[0] != "{" and not (ended and text == "}"):
        return "document"
    line, feed, _ = text.partition("\n")
    if feed:
        return "lines" if _is_object(line) else "document"
    if len(line) >= LONGEST_FIRST_LINE:
        return "lines"
    if not ended:
        return None
    return "lines" if not line or line == "}" or _is_object(line) or _is_object(line[:-1]) else "document"


def csv_header(lines: list[str]) -> str | None:
    """The header's text, over several lines if quoted, with a carriage return if its line ends in one; None if more of the file is needed."""
    quoted = False
    for k, line in enumerate(lines):
        quoted = ends_quoted(line, quoted)
        if not quoted:
            return "\n".join(lines[:k + 1]).lstrip("\ufeff")
    return None


def header_names(header: str) -> tuple[str, ...]:
    return tuple(next(csv.reader(io.StringIO(header.rstrip("\r"), newline="")), ()))


def _first_rows(fmt: str, whole: bool = True):
    """Reads a file's rows until its kind is known; null if they are not the whole file and don't tell it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, text, lines = None, "", []

        def row(kind: str | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]], pa.int64()), pa.array([kind], pa.string())], names=["file", "size", "kind"])

        for b in batches:
            for at in range(0, b.num_rows, 64):
                some = b.slice(at, 64)
                last = (some.column("file")[0].as_py(), some.column("size")[0].as_py())
                values = some.column("value").to_pylist()
                if fmt == "json":
                    text += "".join(v + "}" for v in values)
                    kind = json_layout(text, False)
                else:
                    lines += values
                    kind = csv_header(lines)
                if kind is not None:
                    yield row(kind)
                    return
        if last is not None:
            yield row(None if not whole else json_layout(text, True) if fmt == "json" else "\n".join(lines))
    return run


def sniffed(spark: SparkSession, path: str | list[str], fmt: str, lines: int | None = None) -> DataFrame:
    """file, size, kind of each non-empty data file that a reader of ``path`` reads; with ``lines``, kind is null where so many don't tell it."""
    rows = (spark.read.option("lineSep", "}" if fmt == "json" else "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")))
    if lines is not None:  # a partition is a file; the low 33 bits number its rows
        rows = rows.filter(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) < lines)
    return rows.mapInArrow(_first_rows(fmt, lines is None), "file string, size long, kind string")


def found_files(spark: SparkSession, path: str, fmt: str) -> list[FoundFile]:
    """The files of ``path`` with their kinds, in order of their paths: a row per file, as the readers' own listing keeps on the driver.

    A CSV file hands over its first lines only; one whose header is longer
    is read again.
    """
    with split_size(spark, _WHOLE):
        rows = sniffed(spark, path, fmt, HEADER_LINES if fmt == "csv" else None).collect()
        if longer := [unquote(r.file) for r in rows if r.kind is None]:
            rows = [r for r in rows if r.kind is not None] + sniffed(spark, longer, fmt).collect()
    return sorted((FoundFile(unquote(r.file), r.size, r.kind) for r in rows), key=lambda f: f.path)
