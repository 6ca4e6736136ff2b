"""Quality classification by importance resampling (operator 10).

Two bag-of-hashed-n-grams models (1- and 2-grams of A-Z lower-cased words, hashed
into ``buckets``) are learned: one of the target texts (labelled good), one of all
raw texts. A document's log weight is the sum over its n-grams of
log(target share / raw share). Adding a Gumbel number to each log weight and
keeping the k largest draws k documents without replacement with probabilities
in proportion to their weights.

Raw counts cover every document. The target model is fitted on a bounded sample of
the labelled rows: those with the ``max_labels`` smallest id hashes; their ids
alone are broadcast. Counts are added up in the tasks first; what reaches the
driver is two numbers a bucket. The k-th largest key is found by zooming into a
histogram of the keys until the cell that holds it has few rows; only that cell is
ordered row by row.

Defined results. Null or empty text: no n-gram, log weight 0. No usable label:
both models agree, all weights 0, the draw is uniform. Labels that repeat or name
no document change nothing. The Gumbel number comes from a hash of id and text:
reruns agree, rows that repeat share their number and a tie is broken by id, then
arbitrarily between rows that are the same. k is ``keep`` of the rows, rounded.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodlake.llm.common import hash_words, ngram_hashes, row_of, row_slices, stage
from prodlake.llm.mixing import uniform

FEW = 10_000  # rows of one cell that may be ordered in one task
MERGED_TASKS = 8  # a task's first rows go to the driver
CELLS = 1024


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every 1- and 2-gram."""
    h, off = hash_words(texts)
    row = row_of(off)
    pair = ngram_hashes(h, 2)
    inside = row[1:] == row[:-1]
    rows = np.concatenate([row, row[1:][inside]])
    return rows, (np.concatenate([h, pair[inside]]) % np.uint64(buckets)).astype(np.int64)


def bucket_counts(flagged: DataFrame, buckets: int) -> DataFrame:
    """``bucket, raw, target`` of ``text, is_target``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for whole in batches:
            for b in row_slices(whole, 0):
                row, at = features(b.column(0), buckets)
                good = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
                raw += np.bincount(at, minlength=buckets)
                target += np.bincount(at[good[row]], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"])

    counted = flagged.mapInArrow(run, "bucket bigint, raw bigint, target bigint")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int, smoothing: float) -> np.ndarray:
    """log(target share / raw share) of every bucket, with ``smoothing`` n-grams
    added to both counts: a bucket with little evidence says little."""
    raw, target = np.zeros(buckets), np.zeros(buckets)
    got = counts.toArrow()
    at = got.column("bucket").to_numpy()
    raw[at], target[at] = got.column("raw").to_numpy(), got.column("target").to_numpy()
    # what the target would count if it were like the raw texts
    expected = raw * (target.sum() / max(1.0, raw.sum()))
    return np.log((target + smoothing) / (expected + smoothing))


def cut_largest(keyed: DataFrame, key: str, k: int, ties: list[Column]) -> DataFrame:
    """``keyed`` (staged) with ``selected``: whether the row is among the ``k``
    largest keys."""
    low, high, n = keyed.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    if k <= 0 or not n:
        return keyed.withColumn("selected", F.lit(False))
    if k >= n:
        return keyed.withColumn("selected", F.lit(True))
    above = 0  # rows above the cell [low, high]
    while n > FEW and high > low:
        width = (high - low) / CELLS
        if low + width == low or high - width == high:
            break  # cells as narrow as a double allows
        cell = F.least(F.floor((F.col(key) - F.lit(low)) / F.lit(width)), F.lit(CELLS - 1))
        inside = keyed.filter(F.col(key).between(low, high))
        seen = above
        for r in inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("a"), F.max(key).alias("b")).orderBy(
            F.desc("cell")
        ).collect():  # CELLS rows at most
            if seen + r["n"] >= k:
                above, n, was = seen, r["n"], n
                low, high = r["a"], r["b"]
                break
            seen += r["n"]
        if n == was and high - low >= width * CELLS:
            break
    rank = F.row_number().over(Window.orderBy(F.desc(key), *ties))
    at_cut = keyed.filter(F.col(key).between(low, high)).withColumn("selected", rank <= k - above)
    clear = keyed.filter(~F.col(key).between(low, high)).withColumn("selected", F.col(key) > high)
    return clear.unionByName(at_cut)


def resample(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    good: Column | None = None,
    keep: float = 0.75,
    buckets: int = 1 << 19,
    max_labels: int = 50_000,
    smoothing: float = 10.0,
    temperature: float = 1.0,
    seed: int = 29,
) -> DataFrame:
    """One row per document: ``doc_id, n_grams, log_weight, mean_weight`` (per
    n-gram), ``key`` (Gumbel key) and ``selected``. ``good`` says which label
    rows are targets."""
    good = good if good is not None else (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    target = labels.filter(good & labels[id_col].isNotNull()).select(labels[id_col].alias("label_id")).distinct()
    target = stage(target.withColumn("place", F.xxhash64("label_id")), "target-ids")
    # about twice as many ids as wanted, by their hash, so that few are ordered
    n = target.count()
    share = min(1 << 64, 2 * max_labels * (1 << 64) // max(1, n))
    few = target.filter(F.col("place") <= F.lit(share - (1 << 63) - 1))
    target = target if n <= max_labels or few.count() < max_labels else few
    target = target.coalesce(MERGED_TASKS).orderBy("place", "label_id").limit(max_labels).select("label_id")
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    # at most max_labels ids
    flagged = rows.join(F.broadcast(target), F.col("doc_id") == F.col("label_id"), "left")
    counts = bucket_counts(flagged.select("text", F.col("label_id").isNotNull().alias("is_target")), buckets)
    ratios = rows.sparkSession.sparkContext.broadcast(log_ratios(counts, buckets, smoothing))

    @F.arrow_udf("struct<n:bigint,w:double>")
    def weigh(texts: pa.Array) -> pa.Array:
        n, w = [], []
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        for b in row_slices(batch, 0):
            row, at = features(b.column(0), len(ratios.value))
            n.append(np.bincount(row, minlength=b.num_rows))
            w.append(np.bincount(row, ratios.value[at], b.num_rows))
        size = np.concatenate(n) if n else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays([pa.array(size, pa.int64()), pa.array(np.concatenate(w) if w else np.zeros(0))], names=["n", "w"])

    u = uniform(F.col("doc_id").cast("string"), F.xxhash64("text"), seed=seed)
    scored = rows.select("doc_id", weigh("text").alias("s"), u.alias("u"), F.xxhash64("text").alias("tie"))
    gumbel = -F.log(-F.log(F.col("u")))
    scored = scored.select(
        "doc_id",
        F.col("s.n").alias("n_grams"),
        F.col("s.w").alias("log_weight"),
        F.when(F.col("s.n") > 0, F.col("s.w") / F.col("s.n")).otherwise(0.0).alias("mean_weight"),
        (F.col("s.w") / F.lit(float(temperature)) + gumbel).alias("key"),
        "tie",
    )
    scored = stage(scored, "weighted")
    k = int(round(keep * scored.count()))
    return cut_largest(scored, "key", k, [F.col("doc_id").asc_nulls_last(), F.col("tie")]).drop("tie")
