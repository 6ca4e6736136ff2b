"""Tables: a Parquet / ORC / JSON / CSV folder, a catalog table or a JDBC
table behind one small description, so the sinks and the change operators
can read and write any of them the same way."""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from prodlake.sources.jdbc import jdbc_options


@dataclass(frozen=True)
class Target:
    """Where a table lives. ``kind`` is a file format (parquet, orc, json,
    csv), ``catalog`` (a name in the session catalog) or ``jdbc``."""

    kind: str
    location: str
    options: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int | None = None
    bloom: tuple[str, ...] = ()

    @staticmethod
    def parquet(path: str, partition_by: tuple[str, ...] = (), bloom: tuple[str, ...] = ()) -> "Target":
        """A Parquet folder. ``bloom`` names the columns that are looked up by
        value: each row group stores a Bloom filter of them, and a scan for a
        value that lies between a group's least and greatest but isn't there
        skips the group."""
        return Target("parquet", path, {}, tuple(partition_by), bloom=tuple(bloom))

    @staticmethod
    def jdbc(url: str, table: str, **options) -> "Target":
        return Target("jdbc", table, jdbc_options(url, table, **options))

    @staticmethod
    def catalog(
        name: str,
        path: str | None = None,
        bucket_by: tuple[str, ...] = (),
        buckets: int | None = None,
        bloom: tuple[str, ...] = (),
    ) -> "Target":
        """A session-catalog table; with ``path`` its files live there (an
        external table in the shared folder). With ``bucket_by`` the rows are
        stored hash-bucketed on those columns, so a later join or aggregate
        on them reads the table without shuffling it."""
        if bool(bucket_by) != bool(buckets):
            raise ValueError("bucket_by and buckets go together")
        return Target("catalog", name, {"path": path} if path else {}, (), tuple(bucket_by), buckets, tuple(bloom))


def read_target(spark: SparkSession, target: Target, schema=None) -> DataFrame:
    """The stored rows. A JDBC target is read through several connections
    when its options name ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions`` (``Target.jdbc(url, table, partitionColumn=...)``)."""
    if target.kind == "jdbc":
        return spark.read.format("jdbc").options(**target.options).load()
    if target.kind == "catalog":
        return spark.table(target.location)
    reader = spark.read.options(**target.options)
    if schema is not None:
        reader = reader.schema(schema)
    if target.kind == "csv":
        reader = reader.option("header", True)
    return reader.format(target.kind).load(target.location)


def scan_table(spark: SparkSession, name_or_target: str | Target) -> DataFrame:
    """The whole table or view (``SELECT *``)."""
    if isinstance(name_or_target, Target):
        return read_target(spark, name_or_target)
    return spark.table(name_or_target)


def footer_max_query(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``max(column)`` of a Parquet folder planned to read only the files'
    footer statistics (``PushedAggregation``), in a separate session (same
    cluster, its own SQL settings) so the caller's session is unchanged."""
    from pyspark.sql import functions as F

    iso = spark.newSession()
    v1 = iso.conf.get("spark.sql.sources.useV1SourceList")
    # the footer read needs the Parquet source of Spark's newer data source API
    iso.conf.set("spark.sql.sources.useV1SourceList", ",".join(f for f in v1.split(",") if f.strip() != "parquet"))
    iso.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return iso.read.parquet(path).agg(F.max(column).alias(column))


def stored_max(spark: SparkSession, path: str, column: str):
    """``max(column)`` of a Parquet folder from its footers: one value per
    file, no scan of the column (on a 100 TB table the id column alone is
    terabytes). A file without statistics makes the footer read fail; then
    the column is scanned."""
    from pyspark.sql import functions as F

    try:
        return footer_max_query(spark, path, column).first()[0]
    except (PySparkException, Py4JJavaError) as e:
        if "statistics" not in str(e).lower():
            raise
        # some footer has none for the column
        return spark.read.parquet(path).agg(F.max(column)).first()[0]
