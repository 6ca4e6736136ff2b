from decimal import Decimal
from pathlib import Path

from prodlake.operators import quality as Q
from prodlake.operators.load import checked_rows, copy_lake_to_table
from prodlake.schemas import PRODUCTION_RULES
from prodlake.sources.files import scan_csv_checked
from prodlake.sources.tables import Target, read_target

HEADER = "Wellbore,Year,Month,Oil,Gas"
MAPPING = {"Wellbore": "wellbore", "Year": "year", "Month": "month", "Oil": "oil", "Gas": "gas"}
LINES = [
    "W-1,2012,1,1.5,2.5",  # good
    "W-2,bad,2,1.0,1.0",  # year not an int
    "",  # blank line: not a record
    ",,,,",  # empty record
    "W-3,2012",  # short row
    "W-4,2012,0,1,1",  # month 0
    "W-5,2012,13,1,1",  # month 13
    "W-6,2012,5,,7",  # oil missing: default 0
    "Y" * 51 + ",2012,5,1,1",  # too long
    "   ,2012,5,1,1",  # blank wellbore
]


def write_csv(tmp, lines, name="src.csv"):
    p = Path(tmp) / name
    p.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(p)


def by_wellbore(rows):
    return {r.wellbore: r for r in rows}


def test_split_keeps_every_record(spark, tmp):
    checked = checked_rows(spark, write_csv(tmp, LINES), MAPPING)
    good, bad = Q.split(checked)
    good_rows, bad_rows = good.collect(), bad.collect()
    assert len(good_rows) + len(bad_rows) == len(LINES) - 1  # the blank line is no record
    ok = by_wellbore(good_rows)
    assert set(ok) == {"W-1", "W-6"}
    assert ok["W-6"].oil == Decimal("0.00000") and ok["W-6"].gas == Decimal("7.00000")
    reasons = {(r.wellbore or "").strip() or repr(r.wellbore): r.reason for r in bad_rows}
    assert reasons["W-2"] == "year: not int"
    assert reasons["None"].startswith("wellbore: required")
    assert "malformed record" in reasons["W-3"]
    assert reasons["W-4"] == "month: outside 1..12"
    assert reasons["W-5"] == "month: outside 1..12"
    assert reasons["Y" * 51] == "wellbore: longer than 50"
    assert reasons[repr("   ")] == "wellbore: required"


def test_short_row_is_kept_with_its_line(spark, tmp):
    raw = scan_csv_checked(spark, write_csv(tmp, ["W-3,2012"]))
    row = raw.collect()[0]
    assert row["_corrupt_record"] == "W-3,2012"
    assert row["Month"] is None


def test_validate_schema_length_and_null(spark):
    df = spark.createDataFrame([("W-1", 1, 1), (None, 1, 1), ("Z" * 60, 1, 1)], "wellbore string, year int, month int")
    rules = [r for r in PRODUCTION_RULES if r.name in ("wellbore", "year", "month")]
    out = {r.wellbore: r[Q.REASONS] for r in Q.validate_schema(df, rules).collect()}
    assert out["W-1"] == ""
    assert out[None] == "wellbore: required"
    assert out["Z" * 60] == "wellbore: longer than 50"


def test_apply_defaults(spark):
    df = spark.createDataFrame([("W", None, Decimal(2))], "wellbore string, oil decimal(15,5), gas decimal(15,5)")
    r = Q.apply_defaults(df, PRODUCTION_RULES).first()
    assert r.oil == Decimal("0.00000") and r.gas == Decimal("2.00000")


def test_quality_stamp(spark, tmp):
    stamped = Q.quality_stamp(checked_rows(spark, write_csv(tmp, LINES[:2]), MAPPING))
    assert sorted((r.wellbore, r.quality) for r in stamped.collect()) == [("W-1", "passed"), ("W-2", "failed")]


def test_copy_lake_to_table_appends_with_ids(spark, tmp):
    target = Target.parquet(str(Path(tmp) / "table"))
    src = write_csv(tmp, LINES)
    first = copy_lake_to_table(spark, src, target, MAPPING, order_by=["wellbore"])
    assert first.rejected.count() == 7
    again = copy_lake_to_table(spark, src, target, MAPPING, order_by=["wellbore"])
    assert again.rejected.count() == 7
    rows = sorted((r.id, r.wellbore) for r in read_target(spark, target).collect())
    # append is not idempotent: the two good rows twice, ids continue
    assert rows == [(1, "W-1"), (2, "W-6"), (3, "W-1"), (4, "W-6")]


def test_added_reasons_are_not_repeated(spark):
    df = spark.createDataFrame([("", 13), ("W", 5), (None, 0)], "wellbore string, month int")
    once = Q.add_reasons(df, Q.production_checks())
    twice = Q.add_reasons(once, Q.production_checks() + [(Q.F.col("month") > 12, "month: above 12")])
    got = {(r.wellbore, r.month): r[Q.REASONS] for r in twice.collect()}
    assert got == {
        ("", 13): "wellbore: required; month: outside 1..12; month: above 12",
        ("W", 5): "",
        (None, 0): "wellbore: required; month: outside 1..12",
    }
    flags = {(r.wellbore, r.month): r.bad for r in df.select("*", Q.failed(Q.production_checks()).alias("bad")).collect()}
    assert flags == {("", 13): True, ("W", 5): False, (None, 0): True}
