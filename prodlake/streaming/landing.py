"""Raw landing for files as they arrive: Structured Streaming file source,
the same tags as the batch landing, exactly-once into a Parquet folder.

``availableNow`` processes what is there and stops, so the same job serves
scheduled (batch-like) and continuous runs; the checkpoint remembers which
files were taken, so a rerun lands only new files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from prodlake.operators.layers import SOURCE_PATH, SOURCE_TIME


MAX_FILE_AGE = "100000d"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def raw_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    fmt: str = "parquet",
    classification: str = "internal",
    owner: str = "production-data",
    country: str | None = None,
    max_files_per_trigger: int | None = None,
    **reader_options,
):
    """Streaming DataFrame of newly arrived files, tagged like ``land_raw``."""
    # Spark's default drops, for good and without an error, a new file dated
    # over a week before the newest one taken (copies that keep their times,
    # backfills). Never by age: the price is that the checkpoint's file log
    # keeps the name of every file ever taken.
    reader = spark.readStream.format(fmt).schema(schema).options(**{"maxFileAge": MAX_FILE_AGE, **reader_options})
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(source)
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_PATH),
        F.col("_metadata.file_modification_time").alias(SOURCE_TIME),
        F.lit(classification).alias("classification"),
        F.lit(owner).alias("owner"),
        F.lit(country).cast("string").alias("country"),
    )


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same cluster whose streams keep their state in RocksDB;
    the caller's settings stay as they are."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return own


def land_raw_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    output: str,
    checkpoint: str,
    fmt: str = "parquet",
    timeout_s: float | None = None,
    partition_by: tuple[str, ...] = (),
    max_files_per_trigger: int | None = None,
    distinct: Sequence[str] | None = None,
    event_time: str | None = None,
    within: str | None = None,
    **tags,
) -> StreamingQuery:
    """Land every file not landed before into ``output`` and stop.

    With ``distinct``, rows that agree in those columns land once, however many
    files and runs bring them: the first to arrive stays, with its source. What has
    landed is kept in the checkpoint's state store, by key and on the executors'
    disks (RocksDB), so it may outgrow memory. It grows with the distinct rows; with
    ``event_time`` and ``within`` (such as "90 days") a row is remembered for that
    long by its event time, and the state is bounded. Once a checkpoint is made, its
    number of state partitions stays (``spark.sql.shuffle.partitions`` of the first
    run) and so must ``distinct``.

    ``max_files_per_trigger`` bounds each micro-batch; ``availableNow``
    still takes every waiting file, in as many batches as needed, so a large
    backlog is landed in steps that each fit the cluster, each committed to
    the checkpoint. Runs until all is landed; with ``timeout_s`` it stops
    and raises after that time (what is committed stays, a rerun goes on).
    Raises when the query fails.
    """
    if (event_time is None) != (within is None) or (within and not distinct):
        raise ValueError("event_time and within go together, and with distinct")
    if distinct:
        spark = state_session(spark)
    stream = raw_stream(spark, source, schema, fmt, max_files_per_trigger=max_files_per_trigger, **tags)
    if within:
        stream = stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(distinct))
    elif distinct:
        stream = stream.dropDuplicates(list(distinct))
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start(output)
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"raw landing did not finish in {timeout_s} s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
