"""Views over the driver tables that have the reference's shapes.

Every view reads only the columns it needs, so Catalyst prunes the Parquet
scan. Nothing is collected; the views grow with the driver tables.

* ``production``: one row per lineitem, wellbore = supplier.
* ``production_keyed``: one row per order, unique ``id``.
* ``carrier_year``: six double measures by return flag and year.
* ``field_csv_frame``: the field production CSV shape, all text.
* ``part_strings``: the part table as a wide all-text table.
* ``events``: the event table, used for raw landing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prodlake.schemas import FIELD_CARRIER, FIELD_MEASURES, FIELD_YEAR, OIL_GAS_TYPE


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read once per session: the file listing and the
    footer read (a small Spark job) are not repeated by every query. Rows
    are not cached; each query still scans the files it needs."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _wellbore(key: Column) -> Column:
    return F.concat(F.lit("W-"), key.cast("string"))


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _wellbore(F.col("l_suppkey")).alias("wellbore"),
        F.year("l_shipdate").cast("int").alias("year"),
        F.month("l_shipdate").cast("int").alias("month"),
        F.col("l_quantity").cast(OIL_GAS_TYPE).alias("oil"),
        F.col("l_extendedprice").cast(OIL_GAS_TYPE).alias("gas"),
    )


def production_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``production`` with the return flag as wellbore (few, fixed values)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("wellbore"),
        F.year("l_shipdate").cast("int").alias("year"),
        F.month("l_shipdate").cast("int").alias("month"),
        F.col("l_quantity").cast(OIL_GAS_TYPE).alias("oil"),
        F.col("l_extendedprice").cast(OIL_GAS_TYPE).alias("gas"),
    )


def production_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        _wellbore(F.col("o_custkey")).alias("wellbore"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.month("o_orderdate").cast("int").alias("month"),
        F.col("o_totalprice").cast(OIL_GAS_TYPE).alias("oil"),
        (F.col("o_totalprice") / 10).cast(OIL_GAS_TYPE).alias("gas"),
    )


def carrier_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("carrier"),
        F.year("l_shipdate").cast("int").alias("year"),
        F.col("l_quantity").alias("oil"),
        F.col("l_extendedprice").alias("gas"),
        F.col("l_discount").alias("ngl"),
        F.col("l_tax").alias("condensate"),
        (F.col("l_quantity") * F.col("l_discount")).alias("oe"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("water"),
    )


def _text4(c: Column) -> Column:
    """``%.4f``. Positive values take their decimal's text, which is the same
    (both round the shortest digits half up) and costs far less; the rest,
    -0.0, NULL and what isn't finite among them, are formatted."""
    quick = (c > 0) & (c < 1e13)
    return F.when(quick, c.cast("decimal(18,4)").cast("string")).otherwise(F.format_string("%.4f", c))


def field_csv_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """carrier_year as the source system writes it: text, four decimals."""
    cy = carrier_year(spark, sf_dir)
    measures = ["oil", "gas", "ngl", "condensate", "oe", "water"]
    return cy.select(
        F.col("carrier").alias(FIELD_CARRIER),
        F.col("year").cast("string").alias(FIELD_YEAR),
        *[_text4(F.col(m)).alias(name) for m, name in zip(measures, FIELD_MEASURES)],
    )


def production_csv_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """production as monthly lake text: carrier, year, month, oil, gas."""
    p = production(spark, sf_dir)
    return p.select(
        F.col("wellbore").alias(FIELD_CARRIER),
        F.col("year").cast("string").alias(FIELD_YEAR),
        F.col("month").cast("string").alias("prfMonth"),
        F.col("oil").cast("string").alias(FIELD_MEASURES[0]),
        F.col("gas").cast("string").alias(FIELD_MEASURES[1]),
    )


def part_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select([F.col(c).cast("string").alias(c) for c in part.columns])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
