"""Mix sources to target weights by Pareto order sampling (operator 5).

Every source gets a word target: its weight's share of the budget, stopped at
``max_copies`` times its own size, what is left over shared out again by weight
(water filling). A document of a source with ratio ``r = target / size`` is
taken ``floor(r)`` times for certain; the fraction left is a Pareto order
sample: documents are ranked by ``odds(u) / odds(p)``, ``u`` a uniform number
drawn from a hash of the row and ``p`` the inclusion probability, and the lowest
ranks are taken until the source's words are used up. Probabilities differ inside a
source: a document's inclusion odds are those of ``r`` times its size to the power
``by_size`` times its preference (a column, if named), over the mean of that product
by words in its source, so that a source's expected words stay near its target.

Only DataFrame functions run. The cut of a ranked source is found on two
levels: words are summed per source and rank bin (about the square root of the
row count in bins, so both levels grow alike), and only the one bin that holds
the cut is ordered row by row. No source is ever sorted as a whole, so one that
holds a third of all rows costs no more in any task.

Defined results. Null text: size 0. Null source: a source of its own, last in
order. Null, missing or repeated ids: every row is decided by itself, from a
hash of id, source and text; rows alike in all three share a rank and are
ordered arbitrarily among themselves (which of them is taken can't be told
apart). Empty table: empty result. A source without words: target 0, nothing
taken. Ties in rank: by id, then text hash. Columns other than those named are
ignored, or returned unchanged if listed in ``carry``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodlake.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 from a hash of ``parts``."""
    h = F.xxhash64(F.lit(seed), *parts)
    return (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def source_targets(sized: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_copies: float = 2.0) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    ``sized`` has ``source`` and ``size``. The summary has a row per source,
    16 bytes of numbers each; it alone is ordered in one task."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
        .withColumn("stop", F.col("source_size") * F.lit(float(max_copies)))
    )
    order = [F.col("stop") / F.col("w"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))
    s = s.withColumn("level", left / F.sum("w").over(onward))
    free = F.when(F.col("stop") / F.col("w") > F.col("level"), F.col("level"))
    s = s.withColumn("level", F.first(free, ignorenulls=True).over(everything))
    target = F.when(F.col("level").isNull(), F.col("stop")).otherwise(F.least("stop", F.col("level") * F.col("w")))
    return s.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=(3, 1, 2),
    share: float = 1.5,
    max_copies: float = 2.0,
    by_size: float = 0.5,
    preference_col: str | None = None,
    carry: tuple[str, ...] = (),
    seed: int = 17,
) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target,
    copies, taken`` (``taken = copies * size``), and the ``carry`` columns in a
    struct ``row``."""
    text, key, src = docs[text_col], docs[id_col], docs[source_col]
    prefer = docs[preference_col].cast("double") if preference_col else F.lit(1.0)
    sized_by = F.pow(F.greatest(word_count(text), F.lit(1)).cast("double"), F.lit(by_size))
    cols = [
        key.alias("doc_id"),
        src.alias("source"),
        word_count(text).alias("size"),
        F.xxhash64(text).alias("tie"),
        (sized_by * F.greatest(F.coalesce(prefer, F.lit(1.0)), F.lit(1e-12))).alias("prefer"),
    ]
    if carry:
        cols.append(F.struct(*[docs[c].alias(c) for c in carry]).alias("row"))
    sized = docs.select(*cols).withColumn("u", uniform(F.col("doc_id").cast("string"), F.col("source"), F.col("tie"), seed=seed))
    sized = stage(sized, "mix-sized")
    bins = max(1, math.isqrt(sized.count()))

    targets = source_targets(sized, weights, share, max_copies)
    mean = sized.groupBy("source").agg((F.sum(F.col("size") * F.col("prefer")) / F.sum("size")).alias("mean"))
    mean = mean.withColumnRenamed("source", "s")
    targets = targets.join(mean, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("whole", F.floor(ratio)).withColumn("p", ratio - F.col("whole"))
    targets = stage(targets.withColumn("extra", F.col("p") * F.col("source_size")), "mix-targets")

    joined = sized.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # a source of empty documents only has no mean, and nothing to take
    odds_in = F.col("p") / (1 - F.col("p")) * F.col("prefer") / F.coalesce("mean", F.lit(1.0))
    rank = F.when(F.col("p") > 0, F.col("u") / (1 - F.col("u")) / odds_in)
    # rank / (1 + rank) is the rank on a scale from 0 to 1
    joined = joined.withColumn("rank", rank).withColumn(
        "bin", F.floor(F.col("rank") / (1 + F.col("rank")) * F.lit(float(bins))).cast("long")
    )

    run = Window.partitionBy("source").orderBy("bin")
    filled = (
        joined.filter(F.col("p") > 0)
        .groupBy("source", "bin", "extra")
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.sum("words").over(run))
    )
    cuts = filled.filter(F.col("upto") >= F.col("extra")).groupBy("source").agg(
        F.min("bin").alias("cut"), F.min_by(F.col("upto") - F.col("words"), F.col("bin")).alias("used")
    )
    cuts = stage(cuts, "mix-cuts")
    marked = joined.join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")

    inside = Window.partitionBy("source").orderBy("rank", F.col("doc_id").asc_nulls_last(), "tie")
    upto = F.col("used") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    # the row that crosses the target is taken if that ends nearer to it
    nearer = upto - F.col("size") / 2 <= F.col("extra")
    at_cut = marked.filter(F.col("bin") == F.col("cut")).withColumn("more", nearer.cast("int"))
    clear = marked.filter(~F.coalesce(F.col("bin") == F.col("cut"), F.lit(False))).withColumn(
        "more", F.coalesce((F.col("bin") < F.col("cut")).cast("int"), F.lit(0))
    )
    out = clear.unionByName(at_cut).withColumn("copies", (F.col("whole") + F.col("more")).cast("long"))
    return out.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        *(["row"] if carry else []),
    )
