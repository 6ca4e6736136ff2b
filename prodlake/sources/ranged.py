"""Files in byte ranges: a large file is read by several tasks.

Spark lists the files (any store it can read); the ranges are rows, dealt over
tasks, and a task opens its file and reads its range piece by piece. ``file:``
paths are opened directly (a folder that all executors mount), other schemes by
pyarrow's file systems, which must be set up on the executors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prodlake.session import ship
from prodlake.sources.files import scan_binary

PIECE = 1 << 20
MOST_TASKS = 1 << 16
# up to so many ranges have a task each; more share tasks of about TASK_BYTES
FEW_TASKS = 64
TASK_BYTES = 16 << 20
_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):")


def local_path(uri: str) -> str | None:
    """The path behind a ``file:`` URI or a plain path, None for other stores."""
    found = _SCHEME.match(uri)
    if not found:
        return uri
    return re.sub(r"^file:/*", "/", uri) if found[1] == "file" else None


def open_input(uri: str) -> BinaryIO:
    """A file for reading at any place."""
    path = local_path(uri)
    if path is not None:
        return open(path, "rb")
    fs, inner = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(inner)


def read_range(f: BinaryIO, start: int, end: int) -> Iterator[bytes]:
    """The bytes of a range, a piece at a time (fewer where the file ends)."""
    f.seek(start)
    while start < end and (piece := f.read(min(PIECE, end - start))):
        start += len(piece)
        yield bytes(piece)


def file_ranges(
    spark: SparkSession,
    path: str | list[str],
    chunk_bytes: int,
    glob: str | None = None,
    recursive: bool = False,
    empty: bool = False,
) -> tuple[DataFrame, int]:
    """``path, length, ranges, range, start, end`` of all files under a path, a row
    for every ``chunk_bytes``, and the number of tasks that they are dealt over: it
    follows the bytes, however small the ranges, and neighbours share a task.
    Only the listing is read. Spark's reader passes over files without a byte;
    with ``empty`` they are a range as well."""
    if chunk_bytes < 1:
        raise ValueError("chunk_bytes must be positive")
    ship(spark)
    found = scan_binary(spark, path, glob, recursive)
    files = found.select("path", "length")
    if empty:
        # names as the listing on the driver has them, escaped
        names = [(re.sub(r"^file:/+", "file:/", unquote(f)),) for f in found.inputFiles()]
        none = spark.createDataFrame(names, "path string").join(files, "path", "left_anti")
        files = files.unionByName(none.withColumn("length", F.lit(0).cast("long")))
    n = F.greatest(F.lit(1), F.ceil(F.col("length") / F.lit(chunk_bytes))).cast("int")
    files = files.select("path", "length", n.alias("ranges"))
    total = files.agg(F.sum("ranges").alias("ranges"), F.sum("length").alias("bytes")).first()
    wanted = max(FEW_TASKS, -(-(total["bytes"] or 0) // TASK_BYTES))
    tasks = min(total["ranges"] or 1, wanted, MOST_TASKS)
    run = -(-(total["ranges"] or 1) // tasks)
    each = files.withColumn("range", F.explode(F.sequence(F.lit(0), F.col("ranges") - 1)))
    start = F.col("range").cast("long") * F.lit(chunk_bytes)
    end = F.least(start + F.lit(chunk_bytes), F.col("length"))
    rows = each.select("path", "length", "ranges", "range", start.alias("start"), end.alias("end"))
    return rows.repartition(tasks, F.col("path"), F.floor(F.col("range") / F.lit(run))), tasks


def _next_start(f: BinaryIO, at: int, before: int, end: bytes) -> int | None:
    """The first place from ``at`` on, and before ``before``, that follows an
    ``end`` byte (the file's own start counts as one); None if there is none."""
    if at == 0:
        return 0
    place = at - 1
    for piece in read_range(f, place, before - 1):
        found = piece.find(end)
        if found >= 0:
            return place + found + 1
        place += len(piece)
    return None


def _pieces(end: bytes):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with open_input(r["path"]) as f:
                    begin = _next_start(f, r["start"], r["end"], end)
                    if begin is None:  # inside one line that begins further up
                        continue
                    stop = None if r["end"] == r["length"] else _next_start(f, r["end"], r["length"], end)
                    content = b"".join(read_range(f, begin, r["length"] if stop is None else stop))
                columns = [[r["path"]], [r["length"]], [begin], [content]]
                types = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["path", "length", "start", "content"]
                )

    return pieces


def scan_pieces(
    spark: SparkSession, path: str | list[str], piece_bytes: int, end: bytes, glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """``path, length, start, content``: the files' bytes in pieces of about
    ``piece_bytes``, each cut right behind an ``end`` byte. A line belongs to the
    piece in whose range it begins, so a piece holds at most a range and a line."""
    if len(end) != 1:
        raise ValueError("end must be one byte")
    ranges, _ = file_ranges(spark, path, piece_bytes, glob, recursive)
    return ranges.mapInArrow(_pieces(end), "path string, length long, start long, content binary")
