"""prodlake: well production data on Spark.

Land raw CSV / JSON / binary files, type and validate them against declared
schemas while keeping rejected rows, store them as Parquet or JDBC tables,
and query them with composable DataFrame operators.
"""

__version__ = "0.1.0"
