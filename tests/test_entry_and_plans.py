from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from prodlake.operators import changes as M
from prodlake.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["wellbore", "oil_sum"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 60


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(SF) / (t + '.parquet')}')")
    return con


@pytest.mark.parametrize(
    "name",
    ["oil_sum_between", "gas_avg_between_chronological", "records_between", "search", "oil_pivot", "lookup_id", "first_match"],
)
def test_matches_duckdb_small(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = sorted(tuple(str(v) for v in r) for r in df.collect())
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in df.columns]
    want = sorted(tuple(str(r[i]) for i in order) for r in res.fetchall())
    assert got == want


def test_lake_scan_prunes_and_pushes(spark):
    plan = plan_text(catalog.queries()["oil_sum_between_lake"](spark, SF))
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan
    assert "PushedFilters: [IsNotNull(month), GreaterThanOrEqual(month,3), LessThanOrEqual(month,9)]" in plan


def test_aggregate_is_partial_and_pruned(spark):
    plan = plan_text(catalog.queries()["oil_sum_between"](spark, SF))
    assert "partial_sum" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_quality_checks_stay_in_codegen(spark):
    from prodlake.plans.ingest import dirty_checked

    df = dirty_checked(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan


def test_pivot_is_one_shuffle(spark):
    plan = plan_text(catalog.queries()["oil_pivot"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1


def test_assign_ids_has_no_global_window_over_rows(spark):
    df = spark.range(100).selectExpr("id AS v")
    plan = plan_text(M.assign_ids(df, 0, order_by=["v"]))
    # two windows, neither over rows: over file groups, and over the files of each group
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert len(windows) == 2 and sum("_group" in x and "_part" in x for x in windows) == 1 and "HashAggregate" in plan
    assert "localCheckpoint" not in plan


def test_scale_settings_for_100_tb():
    from prodlake.session import scale_settings

    big = scale_settings(100 * 10**12, total_cores=8000)
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert int(big["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    small = scale_settings(10 << 20, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
