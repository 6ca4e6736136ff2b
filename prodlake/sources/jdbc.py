"""Database tables through Spark's JDBC data source.

The read is split into ``num_partitions`` ranges of ``partition_column`` so
that many executors read at once; predicates and column lists written after
the scan are pushed into the database query by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    **extra,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items() if v is not None})
    return opts


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    **options,
) -> DataFrame:
    """Read one table (or a parenthesised query aliased as a table)."""
    opts = jdbc_options(url, table, fetchsize=fetch_size, **options)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partition column needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return spark.read.format("jdbc").options(**opts).load()
