"""Large array and CSV files are cut into ranges, and give the same records as one task would read."""

import csv
import gzip
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from stopflow.schema import RAW_STOPS_JSON
from stopflow.sources import files as R
from stopflow.sources import paths as S
from stopflow.sources import ranges as G
from stopflow.sources import sniff as N

from tests.test_whole_inputs import put, stops

NASTY = ['}', '{"a":1}', '"', '\\', '\\"', '[', ']', '},{', '\\\\', 'é日😀', 'line\nfeed', '\t', ' ', '', '"}]', "x" * 300]


def objects(n, seed):
    rnd = random.Random(seed)
    text = lambda: "".join(rnd.choice(NASTY) for _ in range(rnd.randrange(4)))
    return [{"k": i, "s": text(), "o": {"p": [text(), {"q": text()}], "e": {}}, **({text() + "x": [[], [1, {"z": "}"}]]} if i % 3 == 0 else {})} for i in range(n)]


def values(df):
    return [json.loads(r.value) for r in df.collect()]


def same(got, want):
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, want))


STYLES = {"compact": lambda o: json.dumps(o, separators=(",", ":")), "plain": json.dumps, "letters": lambda o: json.dumps(o, ensure_ascii=False),
          "pretty": lambda o: "﻿\n " + json.dumps(o, indent=3) + " \n\n", "windows": lambda o: json.dumps(o, indent=1).replace("\n", "\r\n")}


@pytest.mark.parametrize("style", STYLES)
@pytest.mark.parametrize("split", [17, 300])
def test_array_ranges(spark, tmp_dir, style, split):
    """Braces, quotes and escapes in strings, nested values, records longer than several ranges."""
    want = objects(10 if split < 100 else 60, split)
    path = put(f"{tmp_dir}/a b%20c.json", STYLES[style](want))
    with G.split_size(spark, split):
        assert G._segments(spark, [path], "}").rdd.getNumPartitions() > 5
    same(values(G.array_records(spark, [path], split)), want)


def test_several_array_files(spark, tmp_dir):
    """Ranges of several files don't mix; empty arrays, one element, a file that can't be split."""
    parts = [objects(40, 1), [], objects(1, 2), objects(25, 3)]
    files = [put(f"{tmp_dir}/f/{k}.json", json.dumps(o)) for k, o in enumerate(parts)]
    files += [put(f"{tmp_dir}/f/{k}.json", t) for k, t in (("e", "[ \n ]\n"), ("p", "[\n]"))]
    with gzip.open(f"{tmp_dir}/f/z.json.gz", "wt") as fh:
        json.dump(parts[0], fh)
    same(values(G.array_records(spark, [*files, f"{tmp_dir}/f/z.json.gz"], 50)), [*sum(parts, []), *parts[0]])


@pytest.mark.parametrize("text", ['[{"a":1},{"a":2}', '[{"a":1},{"a":"2}]', '[{"a":1},{"a":{"b":2}]', '[{"a":1},', '[{"a":1}', '[', '[{"a":1},{"a":[2}]'])
def test_open_arrays_fail(spark, tmp_dir, text):
    with pytest.raises(ValueError, match="malformed"):
        G.array_records(spark, [put(f"{tmp_dir}/a.json", text)], 10)


@pytest.mark.parametrize("text", ['[{"a":1}, 5, {"a":2}]', '[1]', '[null]', '[{"a":1} x {"a":2}]', '[{"a":1}] {"a":2}]', '[[{"a":1}]]', '[{"a":1}, "t"]', '[{"a" 1}]'])
@pytest.mark.parametrize("split", [5, 1000])
def test_unreadable_elements_fail(spark, tmp_dir, text, split):
    path = put(f"{tmp_dir}/a.json", text)
    with pytest.raises(Exception, match="(?i)malformed"):
        df = G.parsed_json(G.array_records(spark, [path], split), R.T.StructType().add("a", "long"))
        df.collect()


def test_read_json_by_ranges(spark, tmp_dir, monkeypatch):
    """A folder of large and small arrays, lines and a document; every file is sniffed by a task, none by the driver."""
    def refused(*_):
        raise AssertionError("a file was read by the driver")
    monkeypatch.setattr(S, "first_line", refused)
    monkeypatch.setattr(R, "first_line", refused)
    rows = stops(0, 400)
    put(f"{tmp_dir}/feed/a.json", json.dumps(rows[:200]))
    put(f"{tmp_dir}/feed/b.json", json.dumps(rows[200:210], indent=1))
    put(f"{tmp_dir}/feed/c.json", "\n".join(map(json.dumps, rows[210:300])))
    put(f"{tmp_dir}/feed/d.json", json.dumps(rows[300], indent=2))
    put(f"{tmp_dir}/feed/e.json", json.dumps(rows[301:], indent=4))
    put(f"{tmp_dir}/feed/empty.json", "")
    for schema in (RAW_STOPS_JSON, None):
        df = R.read_json(spark, f"{tmp_dir}/feed", schema, split_bytes=4000)
        assert sorted(int(r.number) for r in df.collect()) == list(range(400))
        assert df.count() == 400 and set(df.columns) == set(RAW_STOPS_JSON.names)
    lines = put(f"{tmp_dir}/lines.json", "\n".join(map(json.dumps, rows)))
    key = lambda r: str(r)
    assert sorted(df.select(*sorted(df.columns)).collect(), key=key) == sorted(R.read_json(spark, lines).select(*sorted(df.columns)).collect(), key=key)


@pytest.mark.parametrize("text,kind", [('{"a":1}', "lines"), ('{"a":1}\n', "lines"), ('\n\n {"a":"}"}\n{"a":2}', "lines"), ('[{"a":1}]', "array"), ("﻿ [\n", "array"),
                                       ('{\n"a":1}', "document"), ('{"a":{"b":1},\n"c":2}', "document"), ('{"a":1}{"a":2}\n', "document"), ('"x"', "document"), ('{"a":1} ', "lines"),
                                       ('{"a":{"b":{}}}', "lines"), ('{"a":"}}}{{', "document")])
def test_layouts(spark, tmp_dir, text, kind):
    put(f"{tmp_dir}/f/x.json", text)
    assert [f.kind for f in N.found_files(spark, f"{tmp_dir}/f", "json")] == [kind]


def test_only_beginnings_are_sniffed(spark, tmp_dir):
    """Of a long file a task takes a first batch, not the rest."""
    put(f"{tmp_dir}/f/a.json", "\n".join(json.dumps({"k": i}) for i in range(200_000)))
    seen = spark.sparkContext.accumulator(0)
    run = N._first_rows("json")

    def counted(batches):
        def each():
            for b in batches:
                seen.add(b.num_rows)
                yield b
        yield from run(each())
    with G.split_size(spark, N._WHOLE):
        rows = (spark.read.option("lineSep", "}").text(f"{tmp_dir}/f")
                .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")))
        assert rows.rdd.getNumPartitions() == 1
        assert [r.kind for r in rows.mapInArrow(counted, "file string, size long, kind string").collect()] == ["lines"]
    assert 0 < seen.value <= 20_000


# --- CSV

FIELDS = ["plain", "", 'say "hi"', "two\nlines", "a,b", '"', "crlf\r\ninside", "\n", "é日😀", " padded ", "x" * 200, '""\n"']


def table(n, seed):
    rnd = random.Random(seed)
    return [(str(i), *("".join(rnd.choice(FIELDS) for _ in range(rnd.randrange(3))) for _ in range(3))) for i in range(n)]


def as_csv(rows, end, quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end, quoting=quoting)
    w.writerow(["n", "a", "b b", "c.d"])
    w.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [40, 1000])
@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_csv_ranges(spark, tmp_dir, end, split, quoting):
    """Quoted line breaks at and over the borders of ranges, doubled quotes, quoted fields longer than a range."""
    rows = table(20 if split < 100 else 80, split)
    path = put(f"{tmp_dir}/a b.csv", as_csv(rows, end, quoting))
    got = R.read_csv(spark, path, split_bytes=split)
    assert got.columns == ["n", "a", "b b", "c.d"]
    one = R.read_csv(spark, path, multi_line=True)
    key = lambda r: int(r[0])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((tuple(r) for r in one.collect()), key=key)
    want = [tuple(x.replace("\r\n", "\n") for x in r) for r in rows] if end == "\r\n" else rows
    assert sorted((tuple(x or "" for x in r) for r in got.collect()), key=key) == want


def test_stray_quotes_and_blank_lines(spark, tmp_dir):
    """A quote inside an unquoted field is a plain character and opens nothing."""
    lines = ["n,a", '1,5" pipe', "", '2,"q"', '3,x"y"z', '4,"open', 'still "" open', 'end"', '5,', '6,"a"b', "7,last"]
    path = put(f"{tmp_dir}/a.csv", "\n".join(lines))
    want = sorted(map(tuple, R.read_csv(spark, path, multi_line=True).collect()))
    for split in (9, 1000):
        assert sorted(map(tuple, G.parsed_csv(G.csv_records(spark, [path], split), R.T.StructType().add("n", "string").add("a", "string")).collect())) == want
    assert len(want) == 7


def test_csv_folder_by_ranges(spark, tmp_dir):
    """Large and small files with columns in other orders, one with a header over two lines."""
    rows = table(60, 5)
    put(f"{tmp_dir}/f/a.csv", as_csv(rows[:40], "\n"))
    put(f"{tmp_dir}/f/b.csv", "c.d,n\nz,100\n")
    put(f"{tmp_dir}/f/c.csv", 'n,"two\nlines"\n200,y\n')
    put(f"{tmp_dir}/f/e.csv", as_csv(rows[40:], "\r\n"))
    got = R.read_csv(spark, f"{tmp_dir}/f", split_bytes=300)
    assert set(got.columns) == {"n", "a", "b b", "c.d", "two\nlines"}
    assert sorted(int(r.n) for r in got.collect()) == [*range(60), 100, 200]
    two = R.read_csv(spark, f"{tmp_dir}/f", columns=["c.d", "n"], split_bytes=300)
    want = {int(r[0]): r[3] if k < 40 else r[3].replace("\r\n", "\n") for k, r in enumerate(rows)}
    assert {int(r.n): r["c.d"] or "" for r in two.collect()} == {**want, 100: "z", 200: ""}


def test_header_longer_than_a_range(spark, tmp_dir):
    path = put(f"{tmp_dir}/a.csv", '"n\n' + "\n" * 50 + '",a\n1,2\n')
    with pytest.raises(Exception, match="longer than a range"):
        G.csv_records(spark, [path], 10).collect()


@pytest.mark.parametrize("line,out,inside", [("a,b", False, True), ('"a', True, False), ('a"', False, False), ('"a""', True, False), ('x,"y"', False, False), ('""', False, True),
                                             ('","', False, True), ('a,"', True, False), ('"a"b",c', False, False), ("", False, True), ('"""', True, False)])
def test_ends_quoted(line, out, inside):
    assert (N.ends_quoted(line, False), N.ends_quoted(line, True)) == (out, inside)


def test_range_states(spark):
    """States by composition over many ranges equal a walk from one to the next."""
    rnd = random.Random(2)
    rows = [(f"f{k % 3}", 10 * k, rnd.randrange(2), rnd.randrange(2), rnd.randrange(-2, 3), rnd.randrange(-2, 3)) for k in range(300)]
    got = {(r.file, r["at"]): (r.state, r.depth) for r in G._states(spark.createDataFrame(rows, G._SUMMARY)).collect()}
    now = {}
    for f, at, x, y, dx, dy in rows:
        state, depth = now.get(f, (0, 0))
        assert got[f, at] == (state, depth)
        now[f] = (y, depth + dy) if state else (x, depth + dx)
