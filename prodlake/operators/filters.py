"""Row filters and key lookups (list, search, interval, by key).

Every function is ``DataFrame -> DataFrame`` and adds only built-in
predicates, so they reach the Parquet / JDBC scan as pushed filters where the
columns are stored ones. Absent parameters add no predicate at all; there is
no ``(p IS NULL OR ...)`` left for the optimizer to see through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.functions import INDEPENDENT, all_of, interval_bounds, search_predicate
from prodlake.session import scratch_path


def between(
    df: DataFrame,
    from_year: int | None = None,
    to_year: int | None = None,
    from_month: int | None = None,
    to_month: int | None = None,
    mode: str = INDEPENDENT,
    year: str = "year",
    month: str = "month",
) -> DataFrame:
    """Rows inside a year/month interval.

    ``mode="independent"`` applies the four inclusive bounds separately (the
    API's behaviour); ``mode="chronological"`` reads the pairs as dates.
    """
    pred = all_of(interval_bounds(mode, from_year, to_year, from_month, to_month, year=year, month=month))
    return df if pred is None else df.filter(pred)


def search(
    df: DataFrame, text: str | None, wellbore: str = "wellbore", year: str = "year", ignore_case: bool = False
) -> DataFrame:
    """Rows whose wellbore, or whose year as text, contains ``text``."""
    pred = search_predicate(text, wellbore=wellbore, year=year, ignore_case=ignore_case)
    return df if pred is None else df.filter(pred)


def filter_equal(df: DataFrame, column: str, value) -> DataFrame:
    """All rows with ``column == value`` (a null value matches nulls)."""
    if value is None:
        return df.filter(F.col(column).isNull())
    return df.filter(F.col(column) == F.lit(value))


def lookup(requests: DataFrame, table: DataFrame, key: str = "id", found: str = "found") -> DataFrame:
    """Each request row with the table row of its key, or nulls and
    ``found = false`` when the key is missing.

    An equi-join on the key: AQE broadcasts a side whose runtime size is
    under the threshold and otherwise sort-merges both sides on the key.
    The table's key must be unique (it is the primary key). A request column
    named like a stored one (or like ``found``) raises: neither may hide the
    other.
    """
    taken = {c.lower() for c in requests.columns if c != key}
    clash = [c for c in [*table.columns, found] if c != key and c.lower() in taken]
    if clash:
        raise ValueError(f"request columns named like stored ones: {clash}; rename them")
    payload = [c for c in table.columns if c != key]
    right = table.select(key, *payload, F.lit(True).alias(found))
    out = requests.join(right, on=key, how="left")
    return out.withColumn(found, F.coalesce(F.col(found), F.lit(False)))


def existing(requests: DataFrame, table: DataFrame, key: str = "id") -> DataFrame:
    """Requests whose key is in the table (``EXISTS``)."""
    return requests.join(table.select(key), on=key, how="left_semi")


def missing(requests: DataFrame, table: DataFrame, key: str = "id") -> DataFrame:
    """Requests whose key is not in the table (``NOT EXISTS``)."""
    return requests.join(table.select(key), on=key, how="left_anti")


def exists_flag(
    requests: DataFrame, table: DataFrame, key: str = "id", flag: str = "present", unique: bool = True
) -> DataFrame:
    """Every request with a boolean telling whether its key is present.

    A primary key is joined as it is: with a scan on both sides AQE can split
    a request key that holds a third of the rows (an aggregate between the
    shuffle and the join would rule that out). For a column that repeats,
    ``unique=False`` writes the distinct keys to the shared folder first and
    joins those.
    """
    keys = table.select(key)
    if not unique:
        path = scratch_path(requests.sparkSession, "distinct-keys")
        keys.distinct().write.parquet(path)
        keys = requests.sparkSession.read.schema(keys.schema).parquet(path)
    keys = keys.withColumn(flag, F.lit(True))
    out = requests.join(keys, on=key, how="left")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
