"""Hot keys: one wellbore, one change key or one sort value holding a third
(or all) of the rows must give whole, exact results, reduce map-side before
a shuffle, and not pile into one task."""

from decimal import Decimal

from pyspark.sql import functions as F

from prodlake.operators import aggregates as A
from prodlake.operators import changes as M
from prodlake.operators import filters as Fl


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_production(spark, n=3000):
    """A third of the rows belong to wellbore W-HOT, the rest to 100 others."""
    ids = spark.range(0, n, numPartitions=6)
    wellbore = F.when(F.col("id") % 3 == 0, F.lit("W-HOT")).otherwise(F.concat(F.lit("W-"), (F.col("id") % 100).cast("string")))
    return ids.select(
        F.col("id"),
        wellbore.alias("wellbore"),
        (F.lit(1996) + F.col("id") % 5).cast("int").alias("year"),
        (F.lit(1) + F.col("id") % 12).cast("int").alias("month"),
        (F.col("id") / 100).cast("decimal(15,5)").alias("oil"),
        F.lit(1).cast("decimal(15,5)").alias("gas"),
    )


def test_hot_wellbore_sums_whole_and_partial(spark):
    df = hot_production(spark)
    out = A.oil_sum_between(df)
    got = {r.wellbore: r.oil_sum for r in out.collect()}
    want = sum(Decimal(i) / 100 for i in range(0, 3000, 3))
    assert got["W-HOT"] == want
    n = {r.wellbore: r.records for r in A.records_between(df).collect()}
    assert n["W-HOT"] == 1000 and sum(n.values()) == 3000
    assert "partial_sum" in plan_text(out)


def test_hot_key_in_change_batch(spark):
    table = hot_production(spark, 30).select("id", "wellbore", "year", "month", "oil", "gas")
    # key 0 gets a third of all changes; the highest seq must win
    changes = spark.range(0, 300, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 30).cast("long").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 30).cast("long").alias("path_id"),
        F.col("id").cast("int").alias("seq"),
        F.concat(F.lit("U-"), F.col("id").cast("string")).alias("wellbore"),
        F.lit(2001).alias("year"),
        F.lit(1).alias("month"),
        F.lit(1).cast("decimal(15,5)").alias("oil"),
        F.lit(1).cast("decimal(15,5)").alias("gas"),
    )
    res = M.apply_updates(table, changes)
    new = {r.id: r.wellbore for r in res.table.collect()}
    assert new[0] == "U-297"  # largest seq sent to key 0
    statuses = [r.status for r in res.report.filter("id = 0").collect()]
    assert len(statuses) == 100 and statuses.count("applied") == 1
    dels = M.apply_deletes(table, changes.select("id", "seq"))
    # deleted keys: 0 and the 20 keys in 1..29 that are not multiples of 3
    assert dels.table.count() == 9 and dels.removed.count() == 21
    assert [r.status for r in dels.report.filter("id = 0").collect()].count("applied") == 1


def test_sort_ties_spread_over_partitions(spark):
    """Every row equal on the sort key: the tie-breaker still spreads the
    range shuffle, and ids stay dense."""
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        df = spark.range(0, 4000, numPartitions=4).select(F.lit("same").alias("k"), F.col("id").alias("v"))
        out = M.assign_ids(df, 10, order_by=["k"])
        rows = sorted(r.id for r in out.collect())
        assert rows == list(range(11, 4011))
        spread = df.withColumn("_tie", F.monotonically_increasing_id()).orderBy("k", "_tie")
        assert spread.rdd.glom().map(len).filter(lambda n: n > 0).count() > 1
    finally:
        spark.conf.set(coalesce, before)


def test_search_and_interval_filters_reach_scan(spark, tmp):
    path = f"{tmp}/lake"
    hot_production(spark).write.partitionBy("year").parquet(path)
    df = spark.read.parquet(path)
    plan = plan_text(A.gas_sum_between(df, 1997, 1998, 2, 4))
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThanOrEqual(month,2)" in plan
    found = Fl.search(df, "HOT").count()
    assert found == 1000


def test_hot_request_keys_are_split(spark, tmp):
    """Over stored Parquet, a third of the batch on one key, no broadcasts:
    the joins of the reports and of the key check split the hot partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    hot_production(spark, 3000).write.parquet(f"{tmp}/table")
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 3000).cast("long")
    spark.range(0, 60000, numPartitions=8).select(
        key.alias("id"),
        key.alias("path_id"),
        F.col("id").cast("int").alias("seq"),
        F.sha2(F.col("id").cast("string"), 256).substr(1, 40).alias("wellbore"),
        F.lit(2001).alias("year"),
        F.lit(1).alias("month"),
        F.lit(1).cast("decimal(15,5)").alias("oil"),
        F.lit(1).cast("decimal(15,5)").alias("gas"),
    ).write.parquet(f"{tmp}/batch")
    table, batch = spark.read.parquet(f"{tmp}/table"), spark.read.parquet(f"{tmp}/batch")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for df in (
            M.apply_updates(table, batch).report,
            M.apply_deletes(table, batch.select("id", "seq", "wellbore")).report,
            Fl.exists_flag(batch.select("id", "wellbore"), table),
        ):
            assert len(df.collect()) == 60000
            assert "skew=true" in plan_text(df)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
