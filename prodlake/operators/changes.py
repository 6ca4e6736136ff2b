"""Batches of inserts, updates and deletes applied to a keyed table.

The API changes one row per call; here each verb takes a whole batch and
returns the new table plus a report with one status per change. Everything
is joins and aggregates on the key: AQE broadcasts a side only when its
runtime size is under the threshold and sort-merges otherwise. Duplicate
changes to one key are resolved with ``max`` over a struct, a partial
aggregate, so a hot key never gathers into one task.

Plain Parquet has no ``MERGE``; write the returned table to a new folder
(``sinks.writers.full_refresh`` on a fresh target), never over its input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.operators.quality import apply_defaults, default_checks, failed, production_checks
from prodlake.schemas import PRODUCTION_RULES
from prodlake.session import scratch_path
from prodlake.session import stored as stored_frame

# --- fixed values: change statuses ------------------------------------------
APPLIED = "applied"
BAD_REQUEST = "bad_request"
NOT_FOUND = "not_found"
SUPERSEDED = "superseded"
CONFLICT = "conflict"

# a part file's place in its folder: its task's partition, then its chunk
# ("part-00003-<job uuid>-c000..." or, in a partition folder, "....c000...")
_PART_FILE = r"^part-(\d+)-[0-9a-f-]{36}[-.]c(\d+)"
GROUP_FILES = 1000
# 16 bytes a file: offsets of more files than this (16 MB) are shuffle-joined
MOST_BROADCAST_FILES = 1_000_000
_BAD, _ROW = "_bad", "_row"


@dataclass
class ChangeResult:
    """A batch applied to a table: the new table, the removed rows (deletes) and
    ``changed``: the keys whose stored row the batch may have added, replaced or
    removed, with the new values where there are any (what a partition-wise write
    needs, see ``sinks.writers.write_changed_partitions``; a key without a stored
    row touches nothing).

    ``report``, one row per change, is made when it is first asked for: only it
    needs to know which of the batch's keys are stored. ``on`` applies the batch,
    which is staged once, to another table."""

    table: DataFrame
    make_report: Callable[[], DataFrame]
    removed: DataFrame | None = None
    changed: DataFrame | None = None
    on: Callable[[DataFrame], ChangeResult] | None = None

    @cached_property
    def report(self) -> DataFrame:
        return self.make_report()


def current_max_id(table: DataFrame, key: str = "id") -> int:
    """Largest id in the table, 0 when empty (one number to the driver)."""
    value = table.agg(F.max(key)).first()[0]
    return int(value) if value is not None else 0


def number_stored(
    spark: SparkSession, path: str, start_after: int, key: str = "id", schema: T.StructType | None = None
) -> DataFrame:
    """Ids ``start_after + 1, + 2, ...`` for every row stored under ``path``
    (a Parquet folder), in file order and, inside a file, in row order.

    A row's id depends only on where it is stored: its file's offset (the
    running count of the files before it, by part and chunk number) plus its
    ``_metadata.row_index``. It does not depend on how files are split into
    tasks, on AQE or on a retried task, so every pass over the folder gives
    the same ids.

    Offsets are counted on two levels: per group of ``GROUP_FILES`` part
    numbers, then inside each group, so no task orders all files. An offset
    is 16 bytes a file (a hash of its path, its offset): 6 MB for 100 TB in
    files of 256 MiB. Up to ``MOST_BROADCAST_FILES`` they are broadcast, and
    rows are not shuffled; beyond, Spark picks the join. Two paths with one
    hash raise. ``schema`` (the written one) lets an empty folder
    read as no rows.
    """
    stored = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    cols = [c for c in stored.columns if c != key]
    # files are told apart by their full path (one task writes equal names
    # into different partition folders) and ordered by their name
    fpath = F.col("_metadata.file_path")
    fname = F.col("_metadata.file_name")
    part, chunk = (F.regexp_extract("_name", _PART_FILE, i).try_cast("long") for i in (1, 2))
    # names Spark did not write sort first, by name and then path
    group = F.coalesce(F.floor(part / F.lit(GROUP_FILES)), F.lit(-1)).cast("long")
    counts = (
        stored.select(fpath.alias("_file"), fname.alias("_name"))
        .groupBy("_file", "_name")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_file", "_name", "_n", part.alias("_part"), chunk.alias("_chunk"), group.alias("_group"))
    )
    counts = stored_frame(counts, "file-counts")
    # one row per GROUP_FILES files
    groups = counts.groupBy("_group").agg(F.sum("_n").alias("_sum"))
    ahead = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("_group", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_group").orderBy("_part", "_chunk", "_name", "_file")
    before = F.coalesce(F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_group", F.xxhash64("_file").alias("_hash"), before.alias("_before")).join(groups, "_group")
    twice = F.count(F.lit(1)) > 1
    offsets = offsets.groupBy("_hash").agg(
        F.when(twice, F.raise_error(F.lit("two files share a path hash"))).otherwise(F.max(F.col("_base") + F.col("_before"))).alias("_off")
    )
    rows = stored.select(*cols, F.xxhash64(fpath).alias("_hash"), F.col("_metadata.row_index").alias("_row"))
    new_id = (F.lit(start_after) + F.col("_off") + F.col("_row") + F.lit(1)).cast("long")
    if counts.count() <= MOST_BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    return rows.join(offsets, "_hash").select(new_id.alias(key), *cols)


def assign_ids(
    df: DataFrame,
    start_after: int,
    key: str = "id",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Ids ``start_after + 1, + 2, ...`` in ``order_by`` order (or in the
    input's partition order when ``order_by`` is None).

    No global ``row_number`` window (one task). The rows are sorted (a range
    shuffle) and written once to a new folder in the shared folder named by
    ``spark.checkpoint.dir``; part files come out in sort order, and
    :func:`number_stored` numbers them. The written copy also cuts the
    lineage: a lost executor re-reads files, never re-sorts.

    Rows equal on ``order_by`` get a tie-breaker, so that a value held by a
    third of the rows is spread over many range partitions instead of being
    sorted by one task.
    """
    spark = df.sparkSession
    base = df.select(*[c for c in df.columns if c != key])
    if order_by:
        tie = "_tie"
        base = base.withColumn(tie, F.monotonically_increasing_id()).orderBy(*order_by, tie).drop(tie)
    path = scratch_path(spark, "ids")
    base.write.parquet(path)
    return number_stored(spark, path, start_after, key, schema=base.schema)


def insert_checks() -> list[tuple[Column, str]]:
    """What a new production row must meet: the model (wellbore, month) and
    the table (NOT NULL, length)."""
    return production_checks() + default_checks(PRODUCTION_RULES)


def staged_batch(batch: DataFrame, name: str) -> DataFrame:
    """The batch written once to the shared folder with a number per row
    (``_row``), so that equal rows can be told apart and every later join
    reads it from storage."""
    return stored_frame(batch.withColumn(_ROW, F.monotonically_increasing_id()), name)


def with_defaults(batch: DataFrame) -> DataFrame:
    """The table's defaults (oil and gas 0) for values a request leaves out."""
    return apply_defaults(batch, PRODUCTION_RULES)


def apply_inserts(
    table: DataFrame,
    requests: DataFrame,
    key: str = "id",
    order_by: Sequence[str] | None = None,
    reject_existing_on: Sequence[str] | None = None,
    start_after: int | None = None,
) -> ChangeResult:
    """M1: valid requests become rows with new ids after the table's
    largest; invalid ones are reported ``bad_request``. A missing oil or gas
    takes the table's default. With ``reject_existing_on``, a request equal
    to a stored row on those columns is reported ``conflict`` (the prose's
    "can't create an existing entry"), and so are all but the first of
    several requests equal to each other on them; NULLs count as equal.

    ``start_after`` is the largest id in use when the caller knows it (e.g.
    ``sources.tables.stored_max`` of a stored table, which reads footers);
    otherwise the id column is scanned for it.

    The checked batch is landed once in the shared folder, split by status:
    the id sort (which reads its input twice, to sample and to shuffle) and
    the report then read Parquet, not the batch's source again.
    """
    cols = [c for c in table.columns if c != key]
    spark = requests.sparkSession
    checked = with_defaults(requests).select(*cols, failed(insert_checks()).alias(_BAD))
    checked = checked.withColumn(_ROW, F.monotonically_increasing_id())
    path = scratch_path(spark, "insert-batch")
    checked.write.partitionBy(_BAD).parquet(path)
    staged = spark.read.schema(checked.schema).parquet(path)
    valid = staged.filter(~F.col(_BAD)).drop(_BAD)
    invalid = staged.filter(F.col(_BAD)).drop(_BAD)
    report_parts = [invalid.select(*cols, F.lit(None).cast("long").alias(key), F.lit(BAD_REQUEST).alias("status"))]
    if reject_existing_on:
        on = list(reject_existing_on)
        # the first request of every combination, written before it is joined:
        # both sides of the join then come from storage and a hot combination
        # can be split; the table's side is joined as it is
        first = valid.groupBy(*on).agg(F.min(_ROW).alias(_ROW))
        first = stored_frame(first, "first-requests")
        a, b = first.alias("a"), table.select(*on).alias("b")
        same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on])
        new = stored_frame(a.join(b, same, "left_anti").select(F.col(f"a.{_ROW}")), "new-requests")
        conflicts = valid.join(new, _ROW, "left_anti")
        valid = valid.join(new, _ROW, "left_semi")
        report_parts.append(conflicts.select(*cols, F.lit(None).cast("long").alias(key), F.lit(CONFLICT).alias("status")))
    start = current_max_id(table, key) if start_after is None else start_after
    inserted = assign_ids(valid.drop(_ROW), start, key=key, order_by=order_by)
    new_table = table.unionByName(inserted.select(*table.columns))

    def report() -> DataFrame:
        return reduce(DataFrame.unionByName, report_parts, inserted.select(*cols, key, F.lit(APPLIED).alias("status")))

    return ChangeResult(new_table, report, changed=inserted.select(key, *cols))


def apply_updates(
    table: DataFrame,
    changes: DataFrame,
    key: str = "id",
    path_key: str = "path_id",
    seq: str = "seq",
) -> ChangeResult:
    """M2 + M4: replace whole rows by key.

    Per change: ``bad_request`` when the path key differs from the body key
    (a missing one differs from any) or the row is invalid after defaults,
    ``not_found`` when the key is not stored, ``superseded`` when another
    change to the same key wins, else ``applied``: exactly one per stored
    key. The highest ``seq`` wins (NULL is the lowest), then the greatest
    values, then one of the equal changes.
    """
    cols = [c for c in table.columns if c != key]
    # ties on seq go to the greatest values, compared in the change batch's
    # column order: the table's order depends on its layout (a partitioned
    # folder lists its partition columns last)
    wanted = set(cols)
    ranked = [c for c in changes.columns if c in wanted]
    mismatch = ~F.col(path_key).eqNullSafe(F.col(key)) | F.col(key).isNull()
    bad = mismatch | failed(insert_checks())
    checked = staged_batch(with_defaults(changes).withColumn(_BAD, bad), "update-batch")
    candidate = F.struct(F.col(seq), *[F.col(c) for c in ranked], F.col(_ROW))
    # the winning valid change per key, whether or not the key is stored: the
    # table's left join drops the keys it lacks, so the new table needs no
    # pass over the table's keys (only the report asks which keys exist)
    winners = checked.filter(~F.col(_BAD)).groupBy(key).agg(F.max(candidate).alias("_win"))
    winners = stored_frame(winners, "winning-updates")
    changed = winners.select(key, *[F.col(f"_win.{c}").alias(c) for c in cols])

    def on(table: DataFrame) -> ChangeResult:
        def report() -> DataFrame:
            # one row per requested key that is stored, with its winner's row: written
            # before the batch is joined to it once, so a hot key can be split
            known = winners.select(key, F.col(f"_win.{_ROW}").alias("_applied")).join(table.select(key), key, "left_semi")
            known = stored_frame(known, "stored-updates")
            status = (
                F.when(F.col(_BAD), F.lit(BAD_REQUEST))
                .when(F.col("_applied").isNull(), F.lit(NOT_FOUND))
                .when(F.col("_applied") == F.col(_ROW), F.lit(APPLIED))
                .otherwise(F.lit(SUPERSEDED))
            )
            return checked.join(known, key, "left").select(key, path_key, seq, *cols, status.alias("status"))

        updated = table.join(winners, key, "left").select(
            key,
            *[F.when(F.col("_win").isNotNull(), F.col(f"_win.{c}")).otherwise(F.col(c)).alias(c) for c in cols],
        )
        return ChangeResult(updated, report, changed=changed, on=on)

    return on(table)


def apply_deletes(table: DataFrame, deletes: DataFrame, key: str = "id", seq: str = "seq") -> ChangeResult:
    """M3 + M4: remove rows by key, return the removed rows.

    Per request: the first delete of a stored key is ``applied``, exactly
    one: the lowest ``seq`` (NULL comes last), then one of the equal
    requests. A repeat, or a key that is not stored, is ``not_found`` (as a
    second DELETE call would be).
    """
    batch = staged_batch(deletes, "delete-batch")
    # one row per requested key (a partial aggregate); found or not does not
    # matter to the new table, so it needs no pass over the table's keys
    first = batch.groupBy(key).agg(F.min(F.struct(F.col(seq).isNull(), F.col(seq), F.col(_ROW))).alias("_f"))
    first = stored_frame(first.select(key, F.col(f"_f.{_ROW}").alias("_applied")), "first-deletes")
    keys = first.select(key)

    def on(table: DataFrame) -> ChangeResult:
        def report() -> DataFrame:
            known = stored_frame(first.join(table.select(key), key, "left_semi"), "stored-deletes")
            status = F.when(F.col("_applied") == F.col(_ROW), F.lit(APPLIED)).otherwise(F.lit(NOT_FOUND))
            return batch.join(known, key, "left").select(*deletes.columns, status.alias("status"))

        kept = table.join(keys, key, "left_anti")
        removed = table.join(keys, key, "left_semi")
        return ChangeResult(kept, report, removed, changed=keys, on=on)

    return on(table)
