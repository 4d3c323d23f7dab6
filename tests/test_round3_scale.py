"""What grows with the tables: tasks of small ranges, rows carried through shuffles, steps done once."""

import json

import pytest
from pyspark.sql import functions as F

from stopflow.functions import times as T
from stopflow.operators import analytics as A
from stopflow.operators import clean as C
from stopflow.operators import enrich as E
from stopflow.operators import joins as J
from stopflow.operators import ledger as G
from stopflow.operators import lookup as L
from stopflow.operators import slicers as S
from stopflow.operators.ranking import number_within_groups
from stopflow.plans import fixture as X
from stopflow.plans.queries import QUERIES
from stopflow.sinks import versions as V
from stopflow.sources import files as R
from stopflow.sources import ranges, sniff

from tests.conftest import SF_SMALL
from tests.test_whole_inputs import put


def lines_of(df, kind):
    return [x.strip(" +-:!*()0123456789") for x in getattr(df._jdf.queryExecution(), kind)().toString().splitlines()]


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_small_ranges_share_tasks(spark, tmp_dir, monkeypatch, fmt):
    """Hundreds of ranges, two tasks a core; all rows come back."""
    seen = {}
    real = ranges.materialize

    def spy(df, name):
        seen[name] = df.rdd.getNumPartitions()
        return real(df, name)

    monkeypatch.setattr(ranges, "materialize", spy)
    rows = [{"a": str(k), "b": 'x,"\n{' * (k % 4)} for k in range(2000)]
    if fmt == "json":
        path = put(f"{tmp_dir}/t.json", json.dumps(rows))
        got = R.read_json(spark, path, split_bytes=200).select("a", "b").collect()
    else:
        quoted = ['"{}","{}"'.format(r["a"], r["b"].replace('"', '""')) for r in rows]
        got = R.read_csv(spark, put(f"{tmp_dir}/t.csv", "a,b\n" + "\n".join(quoted) + "\n"), split_bytes=200).collect()
    assert sorted((r.a, r.b or "") for r in got) == sorted((r["a"], r["b"]) for r in rows)
    assert seen[f"{fmt}-pieces"] <= 2 * spark.sparkContext.defaultParallelism


def test_versions_compute_the_table_once(spark, monkeypatch):
    plans = []
    real = V.publish_version
    monkeypatch.setattr(V, "publish_version", lambda df, *a, **k: (plans.append(lines_of(df, "executedPlan")), real(df, *a, **k))[1])
    QUERIES["publish_versions"](spark, SF_SMALL)
    assert len(plans) == 2 and not any("Exchange" in x for p in plans for x in p)


def test_join_carries_only_what_is_read(spark):
    """In a shuffle join no column goes along that nothing reads afterwards."""
    stops = spark.range(50).selectExpr("cast(id % 9 as string) as train_number", "id as stop_sequence", "'S1' as station_code",
                                       "repeat('x', 50) as train_name", "cast(id as string) as arrival").repartition(3)
    dim = E.train_dimension(spark.createDataFrame([("1", "EXP"), ("2", "SLOW")], "number string, type string"))
    joined = E.enrich_train(stops.union(stops.withColumn("train_number", F.lit(None).cast("string"))), dim, max_broadcast_bytes=0)
    assert not any("train_name" in x for x in lines_of(joined.select("arrival", "train_type"), "optimizedPlan") if x.startswith("Join"))
    plan = "\n".join(lines_of(joined.select("arrival", "train_type"), "optimizedPlan"))
    assert "train_name" not in plan
    assert joined.count() == 100 and joined.filter("train_type is not null").count() == 12


def test_numbers_go_on_over_partitions(spark):
    """A hot group, nulls and copies over several sorted partitions; ends are met by one row a partition."""
    rows = [("hot", k % 700) for k in range(2000)] + [(None, k) for k in range(90)] + [(str(k % 7), k) for k in range(60)]
    df = spark.createDataFrame(rows, "g string, k int").repartition(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps the sorted partitions small
    try:
        got = number_within_groups(df, "g", [F.col("k").asc()], "n").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want, last = [], {}
    for g, k in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        last[g] = last.get(g, 0) + 1
        want.append((g, k, last[g]))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_ledger_holds_only_rows_and_buckets(spark, tmp_dir):
    """Rows are met by their columns: no hash is stored or shuffled with them."""
    a = spark.createDataFrame([(1, None), (1, None), (None, "x")], "k int, t string")
    assert G.new_rows(a, f"{tmp_dir}/l", "a", buckets=3).count() == 2
    b = spark.createDataFrame([(1, None), (None, "x"), (None, None), (2, "x"), (2, "x")], "k int, t string")
    assert sorted(map(str, map(tuple, G.new_rows(b, f"{tmp_dir}/l", "b", buckets=3).collect()))) == ["(2, 'x')", "(None, None)"]
    assert sorted(spark.read.parquet(f"{tmp_dir}/l/b").columns) == ["_bucket", "k", "t"]


def test_hours_are_not_filtered_below_the_cleaning(spark):
    """A window over the hours works out no row's hour before the copies are removed."""
    hours = S.hour_preset(A.hourly_traffic(C.clean_stops(X.raw_stops(spark, SF_SMALL))), "all")
    assert not any("split(" in x for x in lines_of(hours, "optimizedPlan") if x.startswith("Filter"))
    odd = spark.createDataFrame([("08:10",), ("8.5",), ("bad",), (None,), (None,)], "arrival string")
    assert sorted(map(str, map(tuple, A.hourly_traffic(odd).collect()))) == ["(8, 2)", "(None, 1)"]
    assert A.hourly_traffic(odd.filter("arrival is null")).count() == 0


def test_report_reads_the_feed_once(spark, monkeypatch):
    calls = []
    real = X.raw_stops
    monkeypatch.setattr(X, "raw_stops", lambda *a: (calls.append(1), real(*a))[1])
    assert all(r.ok is not None for r in QUERIES["dq_report"](spark, SF_SMALL).collect()) and len(calls) == 1


def test_station_profiles_group_by_train_without_further_buffers(spark):
    """Trains are counted apart from codes and categories; null stations, nameless codes and blank categories stay right."""
    rows = [("A", "S2", "1", "EXP", 5), ("A", "S1", "1", "", None), ("A", None, "2", "SLOW", 6), ("A", "S1", None, "EXP", 6),
            (None, "S9", "3", None, None), (None, None, "3", "EXP", 3), ("B", None, None, None, None)]
    df = spark.createDataFrame(rows, "station_name string, station_code string, train_number string, train_type string, stop_duration_mins int")
    out = L.station_profiles(df)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [
        ("A", "S1", 4, 5.7, 2, "EXP,SLOW"), (None, "S9", 2, 3.0, 1, "EXP"), ("B", None, 1, None, 0, "")]))
    by_train = [x for x in lines_of(out, "optimizedPlan") if x.startswith("Aggregate") and "train_number" in x.split("]")[0]]
    assert by_train and not any("collect_set" in x or "min(" in x for x in by_train)
    assert L.station_profiles(df.limit(0)).count() == 0
    bare = L.station_profiles(df.drop("station_code", "train_type")).collect()
    assert sorted((str(r.station_name), r.station_code, r.services, r.train_types) for r in bare) == [("A", None, 4, ""), ("B", None, 1, ""), ("None", None, 2, "")]


def test_large_dimension_is_hashed_by_partition(spark):
    """Beyond a broadcast, the fact table isn't sorted while a partition's part of the dimension is small; else it is."""
    dim = E.train_dimension(spark.range(3000).selectExpr("cast(id as string) as number", "concat('T', id % 7) as type"))
    stops = spark.range(4000).selectExpr("case when id % 11 > 0 then cast(id as string) end as train_number", "id as stop_sequence", "'S1' as station_code")
    size = J.byte_size(dim)
    hashed, ordered = (E.enrich_train(stops, dim, max_broadcast_bytes=m) for m in (size // 4, size // 100))
    assert any("ShuffledHashJoin" in x for x in lines_of(hashed, "executedPlan"))
    assert not any("ShuffledHashJoin" in x for x in lines_of(ordered, "executedPlan"))
    want = sorted(map(str, E.enrich_train(stops, dim).collect()))
    assert sorted(map(str, hashed.collect())) == want == sorted(map(str, ordered.collect()))


def test_hashed_dimension_leaves_the_hot_key_to_be_split(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        dim = E.train_dimension(spark.range(4000).selectExpr("cast(id as string) as number", "'EXP' as type"))
        stops = spark.range(60000).selectExpr("case when id % 3 = 0 then '7' else cast(id % 4000 as string) end as train_number", "sha2(cast(id as string), 256) as payload")
        joined = E.enrich_train(stops, dim, max_broadcast_bytes=J.byte_size(dim) // 2)
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 60000 and all(r.train_type == "EXP" for r in rows)
    assert "ShuffledHashJoin(skew=true)" in plan


def test_dwell_minutes_are_worked_out_once_a_row(spark):
    """The minutes of each time stand once in the plan of the cleaned stops, and no text is split into arrays."""
    plan = "\n".join(lines_of(C.clean_stops(X.raw_stops(spark, SF_SMALL)), "optimizedPlan"))
    assert "split(" not in plan and plan.count("AS _arr") == plan.count("AS _dep") == 1
    odd = [("08:10:59", "8.5:3.9"), ("9", "9:"), (":5", "1:2"), ("::", "3"), (" 7 : 8 ", "7:08"), ("", "a:b"), (None, "23:59"), ("-1:10", "99:99:99")]
    df = spark.createDataFrame(odd, "arrival string, departure string")
    for k in (0, 1, 2):
        got = df.select(*(T.clock_part(c, k).alias(c) for c in df.columns)).collect()
        assert got == df.select(*(T.to_int_truncating(F.get(F.split(c, ":"), k)).alias(c) for c in df.columns)).collect()
    a, d = (T.to_int_truncating(F.get(F.split(c, ":"), 0)) * 60 + T.to_int_truncating(F.get(F.split(c, ":"), 1)) for c in df.columns)
    want = df.select(F.when(d >= a, d - a).otherwise(d + 1440 - a).alias("m")).collect()
    assert [r.stop_duration_mins for r in C.add_duration(df).collect()] == [r.m for r in want]


def test_headers_are_found_in_the_first_lines(spark, tmp_dir, monkeypatch):
    """A file hands over its first lines; one whose header goes on beyond them is read again, and no row is lost."""
    monkeypatch.setattr(sniff, "HEADER_LINES", 2)
    put(f"{tmp_dir}/in/a.csv", "k,t\n" + "".join(f"{i},x\n" for i in range(500)))
    put(f"{tmp_dir}/in/b b.csv", '"k\n1\n2\n3",t\n7,"y\nz"\n')
    lists = []
    real = sniff._first_rows

    def spy(fmt, whole=True):
        lists.append(whole)
        return real(fmt, whole)

    monkeypatch.setattr(sniff, "_first_rows", spy)
    found = {f.path.rsplit("/", 1)[1]: f.kind for f in sniff.found_files(spark, f"{tmp_dir}/in", "csv")}
    assert found == {"a.csv": "k,t", "b b.csv": '"k\n1\n2\n3",t'} and lists == [False, True]
    got = R.read_csv(spark, f"{tmp_dir}/in")
    assert got.count() == 501 and got.filter("t = 'y\nz'").count() == 1
    first = sniff.sniffed(spark, f"{tmp_dir}/in/a.csv", "csv", 1).collect()
    assert [r.kind for r in first] == ["k,t"]


def test_station_attributes_do_not_go_through_the_train_join(spark):
    """The trains' join, which may shuffle, stands below the stations'; columns and rows are as before."""
    sm, tm, st = X.station_meta(spark, SF_SMALL), X.train_meta(spark, SF_SMALL), C.clean_stops(X.raw_stops(spark, SF_SMALL))
    both = E.enrich(st, E.station_dimension(sm), E.train_dimension(tm))
    joins = [x for x in lines_of(both, "optimizedPlan") if x.startswith("Join LeftOuter")]
    assert len(joins) == 2 and "_station_key" in joins[0] and "_train_key" in joins[1]
    other = E.enrich_train(E.enrich_station(st, E.station_dimension(sm)), E.train_dimension(tm))
    assert both.columns == other.columns and sorted(map(str, both.collect())) == sorted(map(str, other.collect()))
