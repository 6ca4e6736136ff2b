"""Straight copies: files land byte for byte, without being parsed.

A file is copied in ranges by several tasks, each of which writes its range at the
same place of the new file and reads it back. The copy bears another name until all
of its ranges are there and equal; then it is renamed, and a reader never sees a file
in part. Running the copy again, or a task twice, writes the same bytes to the same
places.

Writing at a place is what a mounted folder can do (a ``file:`` target that all
executors see); object stores can't, and are refused.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prodlake.session import stored
from prodlake.sources.ranged import file_ranges, local_path, open_input, read_range

CHUNK_BYTES = 64 << 20


def _sha256(f, start: int, end: int) -> str:
    h = hashlib.sha256()
    for piece in read_range(f, start, end):
        h.update(piece)
    return h.hexdigest()


def _copy_range(f, out: int, start: int, end: int) -> str:
    """Checksum of a range as read."""
    h, at = hashlib.sha256(), start
    for piece in read_range(f, start, end):
        h.update(piece)
        view = memoryview(piece)
        while view:
            n = os.pwrite(out, view, at)
            view, at = view[n:], at + n
    return h.hexdigest()


def _copy_ranges(source: str, target: str, ranges: list[tuple[int, int]]) -> list[tuple[str, str]]:
    """Checksums of a file's ranges as read and as found in the copy, which is
    flushed once for all of them."""
    os.makedirs(os.path.dirname(target), exist_ok=True)
    out = os.open(target, os.O_RDWR | os.O_CREAT, 0o644)
    try:
        with open_input(source) as f:
            read = [_copy_range(f, out, start, end) for start, end in ranges]
        os.fsync(out)
    finally:
        os.close(out)
    with open(target, "rb") as f:
        return [(x, _sha256(f, start, end)) for x, (start, end) in zip(read, ranges)]


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        files: dict[tuple[str, str], list[int]] = {}
        for i, r in enumerate(rows):
            files.setdefault((r["path"], r["partial"]), []).append(i)
        sums = [("", "")] * len(rows)
        for (path, partial), places in files.items():
            found = _copy_ranges(path, partial, [(rows[i]["start"], rows[i]["end"]) for i in places])
            for i, x in zip(places, found):
                sums[i] = x
        columns = [pa.array([x[i] for x in sums], pa.string()) for i in range(2)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "read_sum", "copy_sum"])


def _renames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            if os.path.exists(r["partial"]):
                os.replace(r["partial"], r["copy"])
            elif not os.path.exists(r["copy"]):
                raise FileNotFoundError(r["partial"])
            if os.path.getsize(r["copy"]) != r["length"]:
                raise OSError(f"{r['copy']} does not have {r['length']} bytes")
        yield batch


def copy_files(
    spark: SparkSession,
    source: str,
    target: str,
    glob: str | None = None,
    recursive: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Copy all files under the folder ``source`` (or one file) to the folder
    ``target``, keeping their places below ``source``. Returns a row for each:
    ``path, copy, length, ranges, checksum`` (SHA-256 of its ranges' SHA-256, in
    order). A range that reads back differently fails the whole copy before any
    file gets its name; files already in ``target`` under such a name are replaced."""
    folder = local_path(target)
    if folder is None:
        raise ValueError(f"{target}: a copy is written at places in a file, which needs a file: target")
    folder = os.path.abspath(folder)
    mark = f".partial-{uuid.uuid4().hex[:12]}"
    ranges, tasks = file_ranges(spark, source, chunk_bytes, glob, recursive, empty=True)
    root = (local_path(source) or source).rstrip("/")
    # the place below the folder given; for one file, its name
    below = F.expr(f"substring(path, locate({_literal(root)}, path) + {len(root) + 1})")
    name = F.when(below == "", F.regexp_extract("path", r"[^/]*$", 0)).otherwise(below)
    copy = F.concat(F.lit(folder + "/"), name)
    named = ranges.withColumn("copy", copy).withColumn("partial", F.concat("copy", F.lit(mark)))
    schema = "path string, length long, ranges int, range int, start long, end long, copy string, partial string, read_sum string, copy_sum string"
    # written once: the copying must not run again for every use of its report
    done = stored(named.mapInArrow(_copies, schema), "copied-ranges")
    differ = done.filter(~F.col("read_sum").eqNullSafe(F.col("copy_sum")))
    if not differ.isEmpty():
        raise OSError(f"a copied range reads back differently: {differ.first()['path']}")
    in_order = F.array_sort(F.collect_list(F.struct("range", "read_sum")))
    files = done.groupBy("path", "copy", "partial", "length", "ranges").agg(
        F.sha2(F.concat_ws("", F.transform(in_order, lambda x: x["read_sum"])), 256).alias("checksum"),
        F.count(F.lit(1)).alias("found"),
    )
    files = files.select(
        "path", "copy", "partial", "length", "ranges",
        F.when(F.col("found") == F.col("ranges"), F.col("checksum")).otherwise(F.raise_error(F.lit("a range is missing"))).alias("checksum"),
    )
    # a task a file at most; names are given where the files are
    files = files.repartition(tasks, "path")
    report = stored(files.mapInArrow(_renames, files.schema), "copied-files")
    return report.drop("partial")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
