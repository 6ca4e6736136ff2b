"""Vectors of whole numbers, for the operators on embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HELD = 1 << 25


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int, *more: Column) -> DataFrame:
    """``vec_id``, ``v`` (components scaled, floored, held within ``HELD``) and
    ``more`` of the rows whose vector has neither null nor non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    most = float(HELD)
    held = F.transform(vector, lambda x: F.greatest(F.lit(-most), F.least(F.lit(most), F.lit(float(scale)) * x.cast("double"))))
    return rows.filter(F.col(vector).isNotNull() & finite).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(held, lambda x: F.floor(x).cast("int")).alias("v"), *more
    )
