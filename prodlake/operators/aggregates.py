"""Aggregates: the per-wellbore interval endpoints, the notebook's
carrier/year sums, year/wellbore sums and the oil pivot, plus the ordering
and top-k helpers.

All of them aggregate in two steps, partial (map-side) then final, so a hot
wellbore holding a third of the rows is reduced to one row per input
partition before the shuffle; no group is ever gathered into one task.
Sums, means and counts are hash aggregates; picking a whole row per key
(``min_by`` / ``max_by`` over a struct) is planned as a sort aggregate,
which spills instead of failing when a partition is large.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.functions import INDEPENDENT, decimal_mean, decimal_sum, from_limbs, limbs
from prodlake.functions.expressions import EXACT_BELOW, LIMBS
from prodlake.operators.filters import between
from prodlake.schemas import SUM_TYPE

MEASURES = ("oil", "gas")


def _measure_agg(measure: str, how: str) -> Column:
    if how == "sum":
        return decimal_sum(measure).alias(f"{measure}_sum")
    if how == "avg":
        return decimal_mean(measure).alias(f"{measure}_avg")
    raise ValueError(f"unknown aggregate {how!r}")


def per_wellbore(
    df: DataFrame,
    measure: str | None,
    how: str,
    from_year: int | None = None,
    to_year: int | None = None,
    from_month: int | None = None,
    to_month: int | None = None,
    mode: str = INDEPENDENT,
    ordered: bool = False,
    key: str = "wellbore",
) -> DataFrame:
    """Interval filter, then one aggregate per wellbore.

    ``how`` is ``sum`` / ``avg`` of ``measure`` or ``count`` of rows. Only
    the key and the measure are read (Catalyst prunes the rest).
    """
    rows = between(df, from_year, to_year, from_month, to_month, mode=mode)
    if how == "count":
        out = rows.groupBy(key).agg(F.count(F.lit(1)).alias("records"))
    else:
        if measure not in MEASURES:
            raise ValueError(f"measure must be one of {MEASURES}")
        out = rows.groupBy(key).agg(_measure_agg(measure, how))
    return ordered_by(out, key) if ordered else out


def oil_sum_between(df: DataFrame, *bounds, **kw) -> DataFrame:
    return per_wellbore(df, "oil", "sum", *bounds, **kw)


def oil_avg_between(df: DataFrame, *bounds, **kw) -> DataFrame:
    return per_wellbore(df, "oil", "avg", *bounds, **kw)


def gas_sum_between(df: DataFrame, *bounds, **kw) -> DataFrame:
    return per_wellbore(df, "gas", "sum", *bounds, **kw)


def gas_avg_between(df: DataFrame, *bounds, **kw) -> DataFrame:
    return per_wellbore(df, "gas", "avg", *bounds, **kw)


def records_between(df: DataFrame, *bounds, **kw) -> DataFrame:
    return per_wellbore(df, None, "count", *bounds, **kw)


def exact_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Sums of double columns (output name: column) by the keys, with the same bits
    whatever the order of the rows.

    Each value is cut, without error, into seven whole numbers of 20 bits, which are
    added as longs (enough for 2**43 rows a group): a hash aggregate with plain
    partial sums. A group's seven sums are put together once, within one unit in the
    last place of the true sum. Bits below 2**-60 are rounded away value by value.
    NaN, infinities and values of 2**80 or more are added as doubles; the order can
    show in finite sums of the latter only. NULLs don't count; no values: NULL."""
    cols = [f"cast(`{c}` AS double)" for c in sums.values()]
    inside = [f"abs({c}) < {EXACT_BELOW!r}D" for c in cols]  # NaN is above all numbers
    cut = df.selectExpr(
        *[f"`{k}`" for k in keys],
        *[f"if({i}, {c}, NULL) AS _x{k}" for k, (c, i) in enumerate(zip(cols, inside, strict=True))],
        *[f"if({i}, NULL, {c}) AS _l{k}" for k, (c, i) in enumerate(zip(cols, inside, strict=True))],
    )
    parts = [f"sum({n}) AS _{k}_{j}" for k in range(len(cols)) for j, n in enumerate(limbs(f"_x{k}"))]
    added = cut.groupBy(*keys).agg(*[F.expr(x) for x in [*parts, *[f"sum(_l{k}) AS _l{k}" for k in range(len(cols))]]])
    out = []
    for k, name in enumerate(sums):
        small = from_limbs([f"_{k}_{j}" for j in range(len(LIMBS))])
        out.append(f"coalesce({small} + coalesce(_l{k}, 0D), _l{k}) AS `{name}`")
    return added.selectExpr(*[f"`{k}`" for k in keys], *out)


def group_sums(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], digits: int | None = None, prefix: str = "sum_"
) -> DataFrame:
    """Sum of each measure by the keys, every output aliased ``prefix+name``.

    Doubles are added exactly (``exact_sums``), so the order in which rows and
    partial sums meet does not show in the result, rounded to ``digits`` or not.
    All measures must be doubles, or none."""
    doubles = [isinstance(df.schema[m].dataType, (T.DoubleType, T.FloatType)) for m in measures]
    if not all(doubles):
        if any(doubles):
            raise ValueError("sum doubles and other measures apart")
        return df.groupBy(*keys).agg(*[F.sum(m).alias(f"{prefix}{m}") for m in measures])
    out = exact_sums(df, keys, {f"{prefix}{m}": m for m in measures})
    if digits is None:
        return out
    return out.select(*keys, *[F.round(f"{prefix}{m}", digits).alias(f"{prefix}{m}") for m in measures])


def year_wellbore_sums(df: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Sum of every measure by (year, wellbore), long form (chart data).

    Sums of the id and the month would mean nothing and are not made.
    """
    return df.groupBy("year", "wellbore").agg(*[decimal_sum(m).alias(m) for m in measures])


def measure_pivot(
    df: DataFrame,
    values: Sequence[str] | None,
    measure: str = "oil",
    row: str = "year",
    column: str = "wellbore",
) -> DataFrame:
    """One row per ``row`` value, one column per ``column`` value holding the
    sum of ``measure``; a missing combination is NULL.

    With ``values`` given this is one hash aggregate of conditional sums
    (one shuffle; Spark's ``pivot`` plans two). Without them Spark's
    ``pivot`` runs an extra job to find the distinct values (capped by
    ``spark.sql.pivotMaxValues``). For many wellbores use
    :func:`year_wellbore_sums` (long form) instead.
    """
    if values is None:
        return df.groupBy(row).pivot(column).agg(F.sum(measure).cast(SUM_TYPE))
    sums = [
        F.sum(F.when(F.col(column) == F.lit(v), F.col(measure))).cast(SUM_TYPE).alias(str(v)) for v in values
    ]
    return df.groupBy(row).agg(*sums)


def measure_map(df: DataFrame, measure: str = "oil", row: str = "year", column: str = "wellbore") -> DataFrame:
    """The pivot without a list of values: one row per ``row`` value with a map
    from every ``column`` value to the sum of ``measure``, in key order.

    No job looks for the distinct values first, and no column limit applies: the
    sums are made per pair (partial, then final), and only one entry per pair goes
    into a map. NULL is no key of a map; its rows are left out, as a pivot's
    consumer does."""
    sums = df.filter(F.col(column).isNotNull()).groupBy(row, column).agg(decimal_sum(measure).alias("_sum"))
    entries = F.sort_array(F.collect_list(F.struct(F.col(column).alias("key"), F.col("_sum").alias("value"))))
    return sums.groupBy(row).agg(F.map_from_entries(entries).alias(f"{measure}_by_{column}"))


def ordered_by(df: DataFrame, *cols: str) -> DataFrame:
    """Listing order as the prose asks ("sorted by wellbores"): a range
    shuffle after the aggregate, never a sort before it."""
    return df.orderBy(*cols)


def head_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows under a total order (a distributed top-k:
    each partition keeps ``n`` rows, the driver merges them)."""
    return df.orderBy(*order).limit(n)


def first_per_key(df: DataFrame, key: str = "wellbore", order: str = "id") -> DataFrame:
    """For every key, the row with the smallest ``order`` value.

    ``min_by`` is a partial aggregate: a hot key is reduced map-side, no
    window has to gather a whole group into one task.
    """
    others = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.min_by(F.struct(*others), F.col(order)).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def first_match(df: DataFrame, value, key: str = "wellbore", order: str = "id") -> DataFrame:
    """The first row (smallest ``order``) for one key value."""
    return df.filter(F.col(key) == F.lit(value)).orderBy(order).limit(1)


def last_inserted(df: DataFrame, order: str = "id") -> DataFrame:
    """The newest row: the one with the largest id (top-1)."""
    return df.orderBy(F.col(order).desc()).limit(1)


def last_per_key(df: DataFrame, key: str = "wellbore", order: str = "id") -> DataFrame:
    """For every key, the row with the largest ``order`` value."""
    others = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)
