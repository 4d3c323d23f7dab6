"""Property tests: random inputs, checked in one Spark job per property."""

from hypothesis import given, settings
from hypothesis import strategies as st

from stopflow.functions import text as X
from stopflow.functions import times as T

clock = st.tuples(st.integers(0, 23), st.integers(0, 59), st.integers(0, 59))


def _fmt(hms, seconds: bool, pad: str) -> str:
    h, m, s = hms
    core = f"{h:02d}:{m:02d}" + (f":{s:02d}" if seconds else "")
    return pad + core + pad


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(clock, clock, st.booleans(), st.sampled_from(["", " ", "  "])), min_size=1, max_size=300))
def test_dwell_is_forward_difference_mod_a_day(spark, cases):
    rows = [(_fmt(a, sec, pad), _fmt(d, sec, pad)) for a, d, sec, pad in cases]
    df = spark.createDataFrame(rows, "a string, d string")
    got = [r[0] for r in df.select(T.dwell_minutes(T.null_placeholder("a"), T.null_placeholder("d"))).collect()]
    want = [((d[0] * 60 + d[1]) - (a[0] * 60 + a[1])) % 1440 for a, d, _, _ in cases]
    assert got == want
    assert all(0 <= g <= 1439 for g in got)


placeholder = st.sampled_from(["", " ", "none", "NONE", " None ", "nan", "NaN", "null", "NULL", " null "])
word = st.text(alphabet="abcxyz0123456789:", min_size=1, max_size=8)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(placeholder, word, st.none()), min_size=1, max_size=300))
def test_placeholders_are_exactly_the_listed_words(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(T.null_placeholder("v")).collect()]
    for v, g in zip(values, got):
        if v is None or v.strip(" ").lower() in ("", "none", "nan", "null"):
            assert g is None
        else:
            assert g == v.strip(" ")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(word, st.none()), st.one_of(word, st.none())), min_size=1, max_size=200),
       st.text(alphabet="abcxyz0123456789", min_size=1, max_size=3))
def test_literal_search_matches_python_substring(spark, rows, term):
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(X.search_match(["a", "b"], term, literal=True)).collect()]
    want = [any(c is not None and term.lower() in c.lower() for c in row) for row in rows]
    assert got == want
