"""Plans as the planner makes them for big inputs: with broadcasts off (no
side is small at 100 TB), count the shuffles of the main operators."""

import pytest

from prodlake.operators import aggregates as A
from prodlake.operators import changes as M
from prodlake.operators import filters as Fl
from prodlake.plans import changes as PC
from prodlake.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


def test_aggregate_one_shuffle_after_partial(no_broadcast):
    plan = A.oil_sum_between(fx.production(no_broadcast, SF), 1996, 1999, 3, 9)
    assert shuffles(plan) == 1
    assert "partial_sum" in plan._jdf.queryExecution().executedPlan().toString()


def test_lookup_shuffles_both_sides_once(no_broadcast):
    from prodlake.plans.endpoints import lookup_requests

    out = Fl.lookup(lookup_requests(no_broadcast, SF), fx.production_keyed(no_broadcast, SF))
    assert shuffles(out) == 2


def test_change_batches_shuffle_the_table_once(no_broadcast):
    table = fx.production_keyed(no_broadcast, SF)
    upd = M.apply_updates(table, PC.update_changes(no_broadcast, SF)).table
    dels = M.apply_deletes(table, PC.delete_requests(no_broadcast, SF)).table
    # the table and the batch, each once; no extra pass over the table's keys
    assert shuffles(upd) == 2
    assert shuffles(dels) == 2


def test_bucketed_table_changes_shuffle_only_the_batch(no_broadcast, tmp):
    from prodlake.sinks.writers import full_refresh
    from prodlake.sources.tables import Target

    n = int(no_broadcast.conf.get("spark.sql.shuffle.partitions"))
    target = Target.catalog("keyed_at_scale", path=f"{tmp}/kb", bucket_by=("id",), buckets=n)
    full_refresh(fx.production_keyed(no_broadcast, SF), target)
    table = no_broadcast.table("keyed_at_scale")
    assert shuffles(M.apply_updates(table, PC.update_changes(no_broadcast, SF)).table) == 1
    assert shuffles(M.apply_deletes(table, PC.delete_requests(no_broadcast, SF)).table) == 1
