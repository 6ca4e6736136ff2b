"""Sinks and load patterns: append, full refresh, lake files, CSV to JSON,
and two steps where the second runs only after the first succeeded.

Writes never target the path they read from: Spark would delete the input
before reading it. Snapshots go to a new folder instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prodlake.operators.changes import ChangeResult
from prodlake.session import delete_path, path_exists, scratch_path, stored
from prodlake.sources.files import CORRUPT, scan_csv_checked
from prodlake.sources.tables import Target, read_target


def _writer(df: DataFrame, target: Target, mode: str):
    if target.bucket_by:
        # one task per bucket (the same hash as the buckets), so each bucket
        # is one file instead of one file per task and bucket
        df = df.repartition(target.buckets, *target.bucket_by)
    w = df.write.mode(mode)
    if target.kind == "jdbc":
        return w.format("jdbc").options(**target.options)
    w = w.options(**target.options)
    for c in target.bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{c}", "true")
    if target.partition_by:
        w = w.partitionBy(*target.partition_by)
    if target.bucket_by:
        w = w.bucketBy(target.buckets, *target.bucket_by).sortBy(*target.bucket_by)
    if target.kind == "csv":
        w = w.option("header", True)
    return w


def _save(w, target: Target) -> None:
    if target.kind == "jdbc":
        w.save()
    elif target.kind == "catalog":
        w.saveAsTable(target.location)
    else:
        w.format(target.kind).save(target.location)


def append(df: DataFrame, target: Target, batch_size: int | None = None, num_partitions: int | None = None) -> None:
    """Add the rows to the target, creating it when absent. Not idempotent:
    running it twice stores the rows twice.

    For JDBC, ``batch_size`` rows go per round trip and ``num_partitions``
    caps the open connections (Spark coalesces to it before writing).
    """
    w = _writer(df, target, "append")
    if target.kind == "jdbc":
        w = _batched(w, batch_size, num_partitions)
    _save(w, target)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch_size: int | None = 10_000,
    num_partitions: int | None = None,
    **options,
) -> None:
    """K1 in the notebook's shape: append (or, with ``mode="overwrite"``,
    truncate and load) a frame into a database table, creating it when
    absent."""
    target = Target.jdbc(url, table, **options)
    if mode == "append":
        append(df, target, batch_size=batch_size, num_partitions=num_partitions)
    elif mode == "overwrite":
        full_refresh(df, target, batch_size=batch_size, num_partitions=num_partitions)
    else:
        raise ValueError(f"unsupported mode {mode!r}")


def _batched(w, batch_size: int | None, num_partitions: int | None):
    if batch_size:
        w = w.option("batchsize", str(batch_size))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    return w


def full_refresh(
    df: DataFrame, target: Target, batch_size: int | None = None, num_partitions: int | None = None
) -> None:
    """Empty the target, then load the rows (idempotent). For JDBC,
    ``batch_size`` and ``num_partitions`` as in :func:`append`.

    JDBC keeps the table and its definition (``TRUNCATE`` then insert); a
    folder is overwritten whole, partitioned or not (static overwrite,
    whatever the session's default).
    """
    w = _writer(df, target, "overwrite")
    if target.kind == "jdbc":
        w = _batched(w.option("truncate", "true"), batch_size, num_partitions)
    else:
        w = w.option("partitionOverwriteMode", "static")
    _save(w, target)


def replace_partitions(df: DataFrame, target: Target) -> None:
    """Overwrite only the partitions present in ``df`` (e.g. reload one
    year) and keep the others (dynamic partition overwrite)."""
    if not target.partition_by:
        raise ValueError("replace_partitions needs a partitioned target")
    w = _writer(df, target, "overwrite").option("partitionOverwriteMode", "dynamic")
    _save(w, target)


def _null_safe(left: str, right: str, columns: Sequence[str]):
    return reduce(lambda x, y: x & y, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


_TOUCHED = "_touched"


def staged_partitions(parts: DataFrame, path: str) -> DataFrame:
    """Distinct partitions written to a folder, with a mark (see ``stored_slice``)."""
    marked = parts.distinct().withColumn(_TOUCHED, F.lit(1))
    marked.write.parquet(path)
    return parts.sparkSession.read.schema(marked.schema).parquet(path)


def stored_slice(stored: DataFrame, touched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The stored rows of the ``touched`` partitions (from ``staged_partitions``;
    NULL is a partition as well).

    The list is joined, not collected. While Spark finds it small enough to be
    broadcast, it prunes the scan's folders by the list's values when the query
    runs (dynamic partition pruning, which it considers only where the other side
    has a filter: the mark); a longer list is joined all the same."""
    whole = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns])
    named = touched.filter((F.col(_TOUCHED) == 1) & whole).alias("t")
    equal = reduce(lambda x, y: x & y, [F.col(f"s.{c}") == F.col(f"t.{c}") for c in columns])
    out = stored.alias("s").join(named, equal, "left_semi").select(*stored.columns)
    unnamed = touched.filter(~whole)
    if not unnamed.isEmpty():
        s, t = stored.filter(~whole).alias("s"), unnamed.alias("t")
        out = out.unionByName(s.join(t, _null_safe("s", "t", columns), "left_semi").select(*stored.columns))
    return out


def write_changed_partitions(
    spark: SparkSession,
    target: Target,
    change: Callable[[DataFrame], ChangeResult],
    key: str = "id",
) -> DataFrame:
    """Write a changed table back to its partitioned folder, rewriting only
    the partitions a batch of updates or deletes touched; the others keep
    their files. ``change`` applies the batch to a table, e.g. ``lambda t:
    apply_updates(t, batch)``.

    A partition is touched when a changed key has a row in it, or (an update
    can move a row to another year) will have. Finding them is one pass over
    the key and partition columns; the batch, staged once, is then applied to
    the stored rows of those partitions alone. Their new content is staged in
    the shared folder, and ``commit_partitions`` swaps it in. If the driver is
    lost during the swap, call ``commit_partitions`` on the staged folder
    again: it does the same once more, whatever was done before. Returns the
    touched partitions, one row each.
    """
    parts = list(target.partition_by)
    if not parts or target.kind in ("jdbc", "catalog"):
        raise ValueError("write_changed_partitions needs a partitioned file target")
    stored_rows = read_target(spark, target)
    place = scratch_path(spark, "changed-partitions")
    result = change(stored_rows)
    moves = set(parts) <= set(result.changed.columns)
    new = [F.col(c).alias(f"_new_{c}") for c in parts] if moves else []
    # a key without a stored row touches nothing
    hits = stored_rows.select(key, *parts).join(result.changed.select(key, *new), key)
    places = [F.struct(*parts)] + ([F.struct(*[F.col(f"_new_{c}").alias(c) for c in parts])] if moves else [])
    touched = hits.select(F.explode(F.array(*places)).alias("_p")).select("_p.*")
    touched = staged_partitions(touched, f"{place}/touched")
    if touched.isEmpty():
        delete_path(spark, place)
        return spark.createDataFrame([], touched.drop(_TOUCHED).schema)
    changed = stored_slice(stored_rows, touched, parts)
    content = (result.on(changed) if result.on else change(changed)).table.select(*stored_rows.columns)
    # full-size files, large partitions split over several
    content.hint("rebalance", *parts).write.partitionBy(*parts).format(target.kind).save(f"{place}/content")
    found = stored(touched.drop(_TOUCHED), "touched-partitions")
    commit_partitions(spark, target, place)
    return found


def commit_partitions(spark: SparkSession, target: Target, place: str) -> None:
    """Swap staged partitions in (see ``write_changed_partitions``): the ones
    with rows by dynamic overwrite, then the folders of the emptied ones are
    removed, the staged copy last. Safe to run again after a crash."""
    parts = list(target.partition_by)
    if not path_exists(spark, f"{place}/content"):
        raise ValueError(f"nothing staged in {place}")
    schema = read_target(spark, target).schema
    staged = spark.read.schema(schema).format(target.kind).load(f"{place}/content")
    touched = spark.read.parquet(f"{place}/touched")
    filled = staged.select(*parts).distinct()
    emptied = touched.alias("t").join(filled.alias("f"), _null_safe("t", "f", parts), "left_anti")
    # found by Spark's own listing before anything is changed
    listed = spark.read.schema(schema).format(target.kind).load(target.location)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1)
    with_folder = listed.select(*parts, folder.alias("_folder")).alias("s")
    gone = with_folder.join(emptied.alias("e"), _null_safe("s", "e", parts), "left_semi").select("_folder").distinct()
    if not path_exists(spark, f"{place}/gone"):
        gone.write.parquet(f"{place}/gone")
    replace_partitions(staged, target)
    for r in spark.read.schema(gone.schema).parquet(f"{place}/gone").toLocalIterator():
        delete_path(spark, r["_folder"])
    delete_path(spark, place)


def sink_lake(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("year",)) -> str:
    """Write a frame to the lake, partitioned so year filters prune folders.
    Rows are dealt by partition first (full-size files, a large year split
    over several), not written as a file per task and year."""
    full_refresh(df.hint("rebalance", *partition_by), Target(fmt, path, {}, tuple(partition_by)))
    return path


def csv_to_json(spark: SparkSession, src: str, dst: str, **csv_options) -> str:
    """Convert CSV (header row) to JSON Lines, one file per task. Lines with
    too many or too few fields are not converted: they go, as read, to
    ``<dst>_rejected`` (text)."""
    rows = scan_csv_checked(spark, src, **csv_options)
    # parsed once, with every column (a line's field count is only checked then)
    place = scratch_path(spark, "checked-csv")
    rows.write.parquet(place)
    checked = spark.read.schema(rows.schema).parquet(place)
    good = F.col(CORRUPT).isNull()
    checked.filter(good).drop(CORRUPT).write.mode("overwrite").json(dst)
    checked.filter(~good).select(F.col(CORRUPT).alias("value")).write.mode("overwrite").text(f"{dst}_rejected")
    delete_path(spark, place)
    return dst


def in_order(*steps: Callable[[], object]) -> list[object]:
    """Run the steps one after the other; an exception in one stops the
    rest (the second activity starts only on the first one's success)."""
    return [step() for step in steps]
