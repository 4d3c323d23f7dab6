"""The whole cleaning pipeline against a plain-Python model on random feeds."""

from hypothesis import given, settings
from hypothesis import strategies as st

from stopflow.operators import clean as C

TIME_NULLS = {"", "none", "nan", "null"}
NAME_NULLS = {"", "none"}


def _clean(v, nulls):
    if v is None:
        return None
    t = v.strip(" ")
    return None if t.lower() in nulls else t


def _minutes(t):
    if t is None:
        return None
    parts = t.split(":")
    try:
        h = int(parts[0]) if parts[0].strip() and parts[0].strip().lstrip("+-").isdigit() else None
        m = int(parts[1]) if len(parts) > 1 and parts[1].strip().lstrip("+-").isdigit() else None
    except ValueError:
        return None
    return None if h is None or m is None else h * 60 + m


def model(rows):
    out = set()
    for number, name, station, sname, arr, dep, day, seq in rows:
        r = (number, _clean(name, NAME_NULLS), _clean(station, NAME_NULLS), _clean(sname, NAME_NULLS),
             _clean(arr, TIME_NULLS), _clean(dep, TIME_NULLS), day, seq)
        if r[0] is None or r[2] is None:
            continue
        out.add(r)
    result = []
    for number, name, station, sname, arr, dep, day, seq in out:
        a, d = _minutes(arr), _minutes(dep)
        dur = None if a is None or d is None else (d - a if d >= a else d + 1440 - a)
        result.append((number, name, station, sname, arr[:5] if arr else arr, dep[:5] if dep else dep, day, seq, dur))
    return sorted(result, key=repr)


clock = st.builds(lambda h, m, s, pad: f"{pad}{h:02d}:{m:02d}" + (":00" if s else "") + pad,
                  st.integers(0, 23), st.integers(0, 59), st.booleans(), st.sampled_from(["", " "]))
time_text = st.one_of(clock, st.sampled_from(["", " ", "None", " NaN ", "null", "bad", "8"]), st.none())
name_text = st.one_of(st.sampled_from(["A", " B ", "none", "", "None", "x y"]), st.none())
row = st.tuples(st.one_of(st.sampled_from(["1", "2", "03"]), st.none()), name_text,
                st.one_of(st.sampled_from(["S1", "S2 ", " none", ""]), st.none()), name_text,
                time_text, time_text, st.one_of(st.integers(1, 3), st.none()), st.integers(1, 4))


@settings(max_examples=6, deadline=None)
@given(st.lists(row, min_size=1, max_size=120))
def test_clean_stops_matches_model(spark, rows):
    rows = rows + rows[: len(rows) // 3]  # planted exact duplicates
    df = spark.createDataFrame(rows, "number string, trainName string, station string, station_name string, "
                                     "arrival string, departure string, day int, id long")
    got = sorted((tuple(r) for r in C.clean_stops(df).collect()), key=repr)
    assert got == model(rows)
    stats = C.clean_stats_frame(df).first()
    kept = [r for r in rows if r[0] is not None and _clean(r[2], NAME_NULLS) is not None]
    assert (stats.raw_rows, stats.removed_missing) == (len(rows), len(rows) - len(kept))
    assert stats.cleaned_rows == len(got)
