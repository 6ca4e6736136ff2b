"""Raw / transformed layer rules as table operators: land rows unchanged
with their source, source time and tags; no duplicates in raw; lineage
columns carried through a job. (The quality stamp is in ``quality``.)"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.schemas import RAW_METADATA_COLUMNS

SOURCE_PATH, SOURCE_TIME = RAW_METADATA_COLUMNS[0], RAW_METADATA_COLUMNS[1]


def land_raw(
    df: DataFrame,
    classification: str,
    owner: str,
    country: str | None = None,
) -> DataFrame:
    """Rows as read from a file source, plus where and when they came from
    (Spark's hidden ``_metadata`` column, no extra pass) and the layer tags
    (security classification, owner, country for restricted data)."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_PATH),
        F.col("_metadata.file_modification_time").alias(SOURCE_TIME),
        F.lit(classification).alias("classification"),
        F.lit(owner).alias("owner"),
        F.lit(country).cast("string").alias("country"),
    )


def dedup_raw(df: DataFrame, metadata: Sequence[str] = ()) -> DataFrame:
    """No duplicates: one row per distinct record.

    Without ``metadata`` this is ``dropDuplicates()`` over all columns.
    With it, the record columns are the key and the metadata of the
    earliest landing is kept (``min`` over a struct led by the source time).
    Both are partial aggregates: a record repeated in a third of the input is
    collapsed map-side, not in one task.
    """
    if not metadata:
        return df.dropDuplicates()
    meta = list(metadata)
    record = [c for c in df.columns if c not in meta]
    first = F.min(F.struct(*[F.col(c) for c in meta])).alias("_first")
    return df.groupBy(*record).agg(first).select(*record, *[F.col(f"_first.{c}").alias(c) for c in meta])


def lineage_columns(df: DataFrame, job: str, source: str = SOURCE_PATH) -> DataFrame:
    """Carry the source path, the job name and the load time with every
    transformed row, so it can be traced back to its raw file."""
    src = F.col(source) if source in df.columns else F.col("_metadata.file_path")
    return df.select(
        *[c for c in df.columns if c != source],
        src.alias(SOURCE_PATH),
        F.lit(job).alias("job"),
        F.current_timestamp().alias("load_time"),
    )
