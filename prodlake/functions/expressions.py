"""Column expressions shared by the operators. All are built-in Spark
expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.schemas import MEAN_TYPE, SUM_TYPE

INDEPENDENT = "independent"
CHRONOLOGICAL = "chronological"


def all_of(preds: list[Column]) -> Column | None:
    """AND of the given predicates; None when the list is empty."""
    return reduce(lambda a, b: a & b, preds) if preds else None


def independent_bounds(
    from_year: int | None,
    to_year: int | None,
    from_month: int | None,
    to_month: int | None,
    year: str = "year",
    month: str = "month",
) -> list[Column]:
    """Four inclusive bounds, each left out when its value is None.

    Year and month are compared on their own: from 1996-11 to 1998-02 means
    ``month >= 11 AND month <= 2``, which no row meets.
    """
    preds = []
    if from_year is not None:
        preds.append(F.col(year) >= F.lit(from_year))
    if to_year is not None:
        preds.append(F.col(year) <= F.lit(to_year))
    if from_month is not None:
        preds.append(F.col(month) >= F.lit(from_month))
    if to_month is not None:
        preds.append(F.col(month) <= F.lit(to_month))
    return preds


def chronological_bounds(
    from_year: int | None,
    to_year: int | None,
    from_month: int | None,
    to_month: int | None,
    year: str = "year",
    month: str = "month",
) -> list[Column]:
    """The year-month pairs read as one inclusive interval of months.

    A missing from-month is January, a missing to-month is December; a
    month without its year is an error. The plain year bounds are added as
    well: they are implied by the interval and, unlike ``year*12+month``,
    prune partitions and reach the Parquet reader.
    """
    if from_month is not None and from_year is None:
        raise ValueError("from_month needs from_year in chronological mode")
    if to_month is not None and to_year is None:
        raise ValueError("to_month needs to_year in chronological mode")
    ym = F.col(year) * 12 + F.col(month)
    preds = []
    if from_year is not None:
        preds.append(F.col(year) >= F.lit(from_year))
        preds.append(ym >= F.lit(from_year * 12 + (from_month or 1)))
    if to_year is not None:
        preds.append(F.col(year) <= F.lit(to_year))
        preds.append(ym <= F.lit(to_year * 12 + (to_month or 12)))
    return preds


def interval_bounds(mode: str, *args, **kwargs) -> list[Column]:
    if mode == INDEPENDENT:
        return independent_bounds(*args, **kwargs)
    if mode == CHRONOLOGICAL:
        return chronological_bounds(*args, **kwargs)
    raise ValueError(f"unknown interval mode {mode!r}")


def text_contains(c: Column, needle: str, ignore_case: bool = False) -> Column:
    """Literal substring test (``%`` and ``_`` are plain characters)."""
    if ignore_case:
        return F.lower(c).contains(needle.lower())
    return c.contains(needle)


def search_predicate(
    needle: str | None, wellbore: str = "wellbore", year: str = "year", ignore_case: bool = False
) -> Column | None:
    """Wellbore contains the text, or the year written as text does.
    None or empty text means no predicate at all."""
    if not needle:
        return None
    return text_contains(F.col(wellbore), needle, ignore_case) | text_contains(
        F.col(year).cast("string"), needle, ignore_case
    )


def decimal_sum(c: str | Column, dtype: T.DecimalType = SUM_TYPE) -> Column:
    """Sum pinned to one decimal type (Spark widens by 10 digits)."""
    return F.sum(c).cast(dtype)


def decimal_mean(c: str | Column, dtype: T.DecimalType = MEAN_TYPE) -> Column:
    """Mean rounded once, half up, to ``dtype``'s scale.

    ``avg`` on a decimal rounds to scale + 4 first; dividing the exact sum by
    the count avoids rounding twice. Both parts are partial aggregates.
    """
    col = F.col(c) if isinstance(c, str) else c
    return (F.sum(col) / F.count(col)).cast(dtype)


# a double is cut into limbs of so many bits, the least one ending at 2**-60
LIMB_BITS = 20
LIMBS = range(-60, 80, LIMB_BITS)
EXACT_BELOW = 2.0**80


def _power(exponent: int) -> str:
    return f"{2.0**exponent!r}D"


def limbs(x: str) -> list[str]:
    """A double column below ``EXACT_BELOW`` as small whole numbers (SQL text), one
    for each exponent of ``LIMBS``. Scaling by a power of two, rounding to a whole
    number and the difference of two such numbers are exact, so the limbs times
    their powers add up to the double rounded to a multiple of ``2**-60``."""
    whole = [f"rint({x} * {_power(-e)})" for e in LIMBS]
    low = [f"{a} - {b} * {_power(LIMB_BITS)}" for a, b in zip(whole, whole[1:], strict=False)]
    return [f"cast({n} AS bigint)" for n in [*low, whole[-1]]]


def from_limbs(sums: list[str]) -> str:
    """The double that sums of limbs stand for (SQL text over their columns). They
    are carried first, so that none is above half a unit of the next: then the first
    that isn't 0 outweighs all below it, and one addition rounds each time."""
    carry, parts = "0L", []
    for s, e in zip(sums, LIMBS, strict=True):
        total = f"({s} + {carry})"
        if e != LIMBS[-1]:
            carry = f"shiftright({total} + {1 << (LIMB_BITS - 1)}L, {LIMB_BITS})"
            total = f"({total} - {carry} * {1 << LIMB_BITS}L)"
        parts.append(f"cast({total} AS double) * {_power(e)}")
    return "(" + " + ".join(parts) + ")"
