import random

import duckdb
import pytest

from stopflow.llm.common import importable

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASH = ("copy", "shuffle_key", "n_lines", "n_removed", "part", "key", "block", "x", "c", "k", "h", "id", "rank", "n", "blob", "kinds",
         "of", "cs", "_id", "_x", "_n", "_cdf", "to_id", "head", "sequence_id", "length", "start", "piece", "at", "l_id", "lost", "bad_id")


@pytest.fixture(scope="session", autouse=True)
def _workers(spark):
    importable(spark)


def edge_rows():
    """Nulls in every column, empty and blank texts, one long text, repeated rows and ids, ties."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    line = lambda n: " ".join(rnd.choice(words) for _ in range(n)).capitalize() + "."
    a, b, c = ("\n".join(line(9) for _ in range(12)) for _ in range(3))
    long = "\n".join(line(11) for _ in range(1500)) + " " + "z" * 5000
    rows = [(1, a, "en", "s1", len(a)), (2, a, "en", "s1", None), (3, b, None, "s2", 5), (4, None, "en", None, None), (5, "", "de", "s2", 0),
            (6, " \n\t ", None, None, 4), (7, "one two", "en", "s1", 7), (8, c + "\n" + a, "en", "s1", 1), (9, long, "fr", "s3", len(long)),
            (10, "naïve Ünï ÇÀ 日本 \U0001f600 x", "ja", "s2", 3), (11, a + " extra", "en", "s1", 2), (12, a.upper(), "en", "s1", 2),
            (13, "token = abcdefgh12 AKIA1234567890ABCD " + "0123456789abcdef" * 3, "en", "s1", 2)]
    return [*rows, rows[0], rows[0], (3, c, "en", "s2", 5), (None, b, "en", "s1", 4), (None, None, None, None, None), (None, "lone words of no id here", "en", "s9", 1)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(edge):
    """The edge rows with columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return edge.withColumns({c: F.lit("theirs") for c in CLASH})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts():
    return dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())


def components(ids, links):
    """The smallest id reachable from each id."""
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for u, v in links:
        a, b = top(u), top(v)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}
