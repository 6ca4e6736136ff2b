"""Property tests: the interval filters and search against plain Python on
random frames."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from prodlake.operators import filters as Fl

ROW = st.tuples(st.sampled_from(["W-1", "W-12", "A%9", "x_99", "W-7"]), st.integers(1994, 2002), st.integers(1, 12))
BOUND_Y = st.one_of(st.none(), st.integers(1994, 2002))
BOUND_M = st.one_of(st.none(), st.integers(1, 12))
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    data = [(i, w, y, m, Decimal(1)) for i, (w, y, m) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, wellbore string, year int, month int, oil decimal(15,5)")


def got_ids(df):
    return sorted(r.id for r in df.select("id").collect())


@SETTINGS
@given(rows=st.lists(ROW, max_size=30), fy=BOUND_Y, ty=BOUND_Y, fm=BOUND_M, tm=BOUND_M)
def test_independent_matches_python(spark, rows, fy, ty, fm, tm):
    want = [
        i
        for i, (_, y, m) in enumerate(rows)
        if (fy is None or y >= fy) and (ty is None or y <= ty) and (fm is None or m >= fm) and (tm is None or m <= tm)
    ]
    assert got_ids(Fl.between(frame(spark, rows), fy, ty, fm, tm)) == want


@SETTINGS
@given(rows=st.lists(ROW, max_size=30), fy=BOUND_Y, ty=BOUND_Y, fm=BOUND_M, tm=BOUND_M)
def test_chronological_matches_python(spark, rows, fy, ty, fm, tm):
    fm = fm if fy is not None else None
    tm = tm if ty is not None else None
    lo = None if fy is None else (fy, fm or 1)
    hi = None if ty is None else (ty, tm or 12)
    want = [i for i, (_, y, m) in enumerate(rows) if (lo is None or (y, m) >= lo) and (hi is None or (y, m) <= hi)]
    assert got_ids(Fl.between(frame(spark, rows), fy, ty, fm, tm, mode="chronological")) == want


@SETTINGS
@given(rows=st.lists(ROW, max_size=30), text=st.sampled_from([None, "", "%", "_", "9", "99", "W-1", "w-1", "199", "2002"]))
def test_search_matches_python(spark, rows, text):
    want = [i for i, (w, y, _) in enumerate(rows) if not text or text in w or text in str(y)]
    assert got_ids(Fl.search(frame(spark, rows), text)) == want
