"""Lake to table: read landed CSV, map it to the table's columns, type and
check it, keep the rejected rows, give the accepted ones ids and append
them to the target.

The CSV is parsed once: the checked rows are written to the shared folder
partitioned by status, which also cuts the lineage (a lost executor re-reads
Parquet, not the CSV). Accepted and rejected rows are then read back by
partition pruning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from prodlake.operators import changes as M
from prodlake.operators import quality as Q
from prodlake.operators.transform import map_columns
from prodlake.schemas import PRODUCTION_RULES, ColumnRule
from prodlake.session import path_exists, scratch_path
from prodlake.sinks.writers import append
from prodlake.sources.files import CORRUPT, scan_csv_checked
from prodlake.sources.tables import Target, read_target, stored_max

STATUS = "_status"


@dataclass
class LoadResult:
    loaded: DataFrame
    rejected: DataFrame
    staged: str
    counts: LoadCounts


@dataclass(frozen=True)
class LoadCounts:
    """Rows read, accepted and rejected, counted while they were staged."""

    read: int
    accepted: int
    rejected: int

    def reconciled(self) -> bool:
        return self.read == self.accepted + self.rejected


class LoadRefused(RuntimeError):
    """A load whose counts don't agree, or that rejects more than is allowed."""


def require_reconciled(counts: LoadCounts, most_rejected: float = 1.0) -> LoadCounts:
    """The counts, or ``LoadRefused``: what a second step asks before it runs.
    ``most_rejected`` is the share of rows that may be rejected."""
    if not counts.reconciled():
        raise LoadRefused(f"{counts.read} rows read, {counts.accepted} accepted and {counts.rejected} rejected")
    if counts.rejected > most_rejected * counts.read:
        raise LoadRefused(f"{counts.rejected} of {counts.read} rows are rejected")
    return counts


def checked_rows(
    spark: SparkSession,
    src: str | list[str],
    mapping: Mapping[str, str],
    rules: Sequence[ColumnRule] = PRODUCTION_RULES,
    model_checks: bool = True,
    columns: list[str] | None = None,
    header: bool = True,
) -> DataFrame:
    raw = scan_csv_checked(spark, src, columns=columns, header=header)
    mapped = map_columns(raw, {**mapping, CORRUPT: CORRUPT})
    extra = Q.production_checks() if model_checks else ()
    return Q.type_and_check(mapped, rules, extra=extra)


def stage_counted(checked: DataFrame, path: str) -> tuple[DataFrame, LoadCounts]:
    """``stage_checked``, and how many rows were read, accepted and rejected:
    the rows read are counted by the pass that writes them, the others from the
    written files' footers, so that rows lost on the way show."""
    seen = Observation()
    staged = stage_checked(checked.observe(seen, F.count(F.lit(1)).alias("read")), path)
    of = {r[STATUS]: r["count"] for r in staged.groupBy(STATUS).count().collect()}
    return staged, LoadCounts(seen.get["read"], of.get("accepted", 0), of.get("rejected", 0))


def stage_checked(checked: DataFrame, path: str) -> DataFrame:
    """Write checked rows once, split into status folders; return the read.

    An accepted row keeps only its typed values and a rejected row only its
    text as read (plus the reasons), so the staged copy is not twice the
    input."""
    ok = Q.passed()
    status = F.when(ok, F.lit("accepted")).otherwise(F.lit("rejected"))

    def kept(c: str):
        if c == Q.REASONS:
            return F.col(c)
        if c == Q.RAW:
            return F.when(~ok, F.col(c)).alias(c)  # the text only where it is rejected
        return F.when(ok, F.col(c)).alias(c)  # typed values only where accepted

    out = checked.select(*[kept(c) for c in checked.columns], status.alias(STATUS))
    out.write.partitionBy(STATUS).parquet(path)
    # the written schema, so that a batch without rows reads as no rows
    return checked.sparkSession.read.schema(out.schema).parquet(path)


def copy_lake_to_table(
    spark: SparkSession,
    src: str | list[str],
    target: Target,
    mapping: Mapping[str, str],
    rules: Sequence[ColumnRule] = PRODUCTION_RULES,
    key: str = "id",
    order_by: Sequence[str] | None = None,
    columns: list[str] | None = None,
    header: bool = True,
    most_rejected: float = 1.0,
) -> LoadResult:
    """K3: S2 + P3 + V1 + M5 + K1 in one load. Returns the appended rows
    (with their ids), the rejected rows with reasons, the staging path and the
    reconciled counts. Nothing is appended if the counts don't agree or a
    greater share than ``most_rejected`` is rejected (``LoadRefused``)."""
    staged_path = scratch_path(spark, "staged-load")
    checked = checked_rows(spark, src, mapping, rules, columns=columns, header=header)
    staged, counts = stage_counted(checked, staged_path)
    require_reconciled(counts, most_rejected)
    names = [r.name for r in rules]
    bad = Q.rejected(staged.filter(F.col(STATUS) == "rejected").drop(STATUS))
    exists = target.kind in ("jdbc", "catalog") or path_exists(spark, target.location)
    if not exists:
        start = 0
    elif target.kind == "parquet":
        start = int(stored_max(spark, target.location, key) or 0)  # from footers, no id scan
    else:
        start = M.current_max_id(read_target(spark, target), key)
    accepted_path = f"{staged_path}/{STATUS}=accepted"
    if order_by:
        good = staged.filter(F.col(STATUS) == "accepted").select(*names)
        with_ids = M.assign_ids(good, start, key=key, order_by=order_by)
    elif path_exists(spark, accepted_path):
        # the staged accepted files are already a stored order: number them
        with_ids = M.number_stored(spark, accepted_path, start, key=key, schema=staged.drop(STATUS).schema)
    else:
        with_ids = staged.filter(F.lit(False)).select(F.lit(None).cast("long").alias(key), *names)
    with_ids = with_ids.select(key, *names)
    append(with_ids, target)
    return LoadResult(with_ids, bad, staged_path, counts)
