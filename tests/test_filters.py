from decimal import Decimal

import pytest

from prodlake.operators import filters as Fl

ROWS = [
    (1, "W-1", 1996, 10, Decimal("1.00000"), Decimal("2.00000")),
    (2, "W-1", 1996, 12, Decimal("3.00000"), Decimal("4.00000")),
    (3, "W-2", 1997, 6, Decimal("5.00000"), Decimal("6.00000")),
    (4, "W-2", 1998, 1, Decimal("7.00000"), Decimal("8.00000")),
    (5, "W-%", 1998, 3, Decimal("9.00000"), Decimal("1.00000")),
    (6, "X99", 1999, 5, Decimal("1.00000"), Decimal("1.00000")),
]
SCHEMA = "id long, wellbore string, year int, month int, oil decimal(15,5), gas decimal(15,5)"


@pytest.fixture()
def prod(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_no_bounds_is_all_rows(prod):
    assert ids(Fl.between(prod)) == [1, 2, 3, 4, 5, 6]
    assert ids(Fl.between(prod, mode="chronological")) == [1, 2, 3, 4, 5, 6]


def test_independent_bounds_cross_year_is_empty(prod):
    # 1996-11 .. 1998-02: month >= 11 and month <= 2 never holds
    assert ids(Fl.between(prod, 1996, 1998, 11, 2)) == []


def test_chronological_bounds_cross_year(prod):
    assert ids(Fl.between(prod, 1996, 1998, 11, 2, mode="chronological")) == [2, 3, 4]


def test_bounds_inclusive(prod):
    assert ids(Fl.between(prod, 1996, 1996, 10, 12)) == [1, 2]
    assert ids(Fl.between(prod, 1996, 1998, 10, 12, mode="chronological")) == [1, 2, 3, 4, 5]


def test_each_bound_optional(prod):
    assert ids(Fl.between(prod, from_year=1998)) == [4, 5, 6]
    assert ids(Fl.between(prod, to_month=3)) == [4, 5]
    assert ids(Fl.between(prod, to_year=1997, mode="chronological")) == [1, 2, 3]


def test_chronological_month_without_year_is_error(prod):
    with pytest.raises(ValueError):
        Fl.between(prod, from_month=3, mode="chronological")


def test_search_empty_means_all(prod):
    assert ids(Fl.search(prod, None)) == ids(prod)
    assert ids(Fl.search(prod, "")) == ids(prod)


def test_search_percent_is_literal(prod):
    assert ids(Fl.search(prod, "%")) == [5]
    assert ids(Fl.search(prod, "W-_")) == []


def test_search_matches_year_text(prod):
    # '99' is in "X99" and in the year 1999 (and 1996..1998 text)
    assert ids(Fl.search(prod, "99")) == [1, 2, 3, 4, 5, 6]
    assert ids(Fl.search(prod, "1997")) == [3]


def test_search_case(prod):
    assert ids(Fl.search(prod, "w-2")) == []
    assert ids(Fl.search(prod, "w-2", ignore_case=True)) == [3, 4]


def test_lookup_reports_missing(spark, prod):
    req = spark.createDataFrame([(3,), (999,)], "id long")
    out = {r.id: (r.found, r.wellbore) for r in Fl.lookup(req, prod).collect()}
    assert out == {3: (True, "W-2"), 999: (False, None)}


def test_exists_and_semi_anti(spark, prod):
    req = spark.createDataFrame([(1,), (1,), (42,)], "id long")
    flags = sorted((r.id, r.present) for r in Fl.exists_flag(req, prod).collect())
    assert flags == [(1, True), (1, True), (42, False)]
    assert Fl.existing(req, prod).count() == 2
    assert [r.id for r in Fl.missing(req, prod).collect()] == [42]


def test_filter_equal(prod):
    assert ids(Fl.filter_equal(prod, "wellbore", "W-2")) == [3, 4]


def test_lookup_never_hides_columns(spark, prod):
    import pytest

    req = spark.createDataFrame([(1, 1999)], "id long, year int")
    with pytest.raises(ValueError, match="year"):
        Fl.lookup(req, prod)
