"""Shared helpers of the training-data operators.

``stage`` writes an intermediate table to the cluster's shared folder and reads
it back, so that the lineage is cut at a place every executor can read again.
The array helpers work on Arrow string columns inside tasks: they hash every
word of a batch of whole texts with vector arithmetic, one slice of about 128 KB
at a time, so it stays in the cache and memory follows the slice and not the
longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prodlake.session import delete_path, scratch_path, ship

ROWS_PER_FILE = 50_000
BATCH_BYTES = 1 << 21
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Let rows go to Python in batches of about BATCH_BYTES (a wider row alone).
    Spark's own bounds are 10000 rows and 64 MB: tens of megabytes of whole texts or
    of list rows, which a task holds both in the JVM, outside the heap, and in
    Python. A bound the caller has set stays."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (removed when the
    driver ends). ``rows``, about how many there are, keeps a table of a few
    rows from being written as a file per shuffle partition."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if rows is not None:
        df = df.coalesce(1 + rows // ROWS_PER_FILE)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_staged(df: DataFrame) -> None:
    """Remove the files of a frame that ``stage`` returned and nothing reads any more."""
    files = df.inputFiles()
    if files:
        delete_path(df.sparkSession, files[0].rpartition("/")[0])


def row_key(id_col: Column, text: Column) -> Column:
    """A number by which rows that agree in id and text agree."""
    return F.xxhash64(id_col.cast("string"), F.lit("\x00"), F.coalesce(text, F.lit("")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# ---------------------------------------------------------------- hashing

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
SLICE_BYTES = 1 << 17


def mix64(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        full = []
        for step in (_BASE, _INVERSE):
            p = np.full(n, _U(step), np.uint64)
            p[0] = 1
            full.append(np.cumprod(p))
        _powers = full[0], full[1]
    return _powers[0][:n], _powers[1][:n]


def _class(excluded: list[tuple[int, int]]) -> np.ndarray:
    out = np.ones(256, bool)
    for a, b in excluded:
        out[a : b + 1] = False
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: word bytes of ``[^\x20\x09-\x0D]+`` and of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
#: (bytes of a multi-byte character are all above 0x7F, so bytes decide)
NOT_SPACE = _class([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = _class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets (null: empty)."""
    arr = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64, len(arr) + 1 + arr.offset)[arr.offset :] if len(arr) else np.zeros(1, np.int64)
    if data is None or not len(arr):
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def row_slices(batch: pa.RecordBatch, column: int, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows whose texts have about ``most`` bytes."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _cuts(raw: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices of about SLICE_BYTES that end at a row's end or, inside a long
    row, behind a byte that belongs to no word."""
    at, n = 0, len(raw)
    while at < n:
        end = min(n, at + SLICE_BYTES)
        if end < n:
            row_end = offsets[np.searchsorted(offsets, end, "right") - 1]
            if row_end > at:
                end = int(row_end)
            else:
                gap = np.flatnonzero(~word[raw[at:end]])
                if len(gap):
                    end = at + int(gap[-1]) + 1
                else:  # one word longer than a slice
                    row = int(offsets[np.searchsorted(offsets, at, "right")])
                    while end < row and word[raw[end]]:
                        end += 1
        yield at, end
        at = end


def word_spans(raw: np.ndarray, offsets: np.ndarray, word: np.ndarray, lower: bool = True):
    """Hashes, starts and ends (byte positions) of all words, in order, and the
    row offsets into them. Words never cross rows."""
    hashes, starts, ends = [], [], []
    for a, b in _cuts(raw, offsets, word):
        part = LOWER[raw[a:b]] if lower else raw[a:b]
        inside = word[part]
        edge = offsets[np.searchsorted(offsets, a, "left") : np.searchsorted(offsets, b, "left")] - a
        before = np.empty(len(part), bool)
        before[0] = False
        before[1:] = inside[:-1]
        before[edge] = False
        after = np.empty(len(part), bool)
        after[-1] = False
        after[:-1] = inside[1:]
        after[edge[edge > 0] - 1] = False
        s = np.flatnonzero(inside & ~before)
        e = np.flatnonzero(inside & ~after) + 1
        up, down = powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(BYTE_CODE[part] * up[:-1], out=total[1:])
        hashes.append(mix64((total[e] - total[s]) * down[s]))
        starts.append(s + a)
        ends.append(e + a)
    if not hashes:
        zero = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), zero, zero, np.zeros(len(offsets), np.int64)
    start = np.concatenate(starts)
    return np.concatenate(hashes), start, np.concatenate(ends), np.searchsorted(start, offsets, "left")


def hash_words(texts: pa.Array, word: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, A-Z lower-cased, and the row offsets."""
    raw, offsets = text_bytes(texts)
    h, _, _, rows = word_spans(raw, offsets, word)
    return h, rows


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` word hashes (runs over row ends included;
    the caller masks them)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = out * _U(_BASE) + h[i : len(h) - n + 1 + i]
    return mix64(out + _U(n * int(_GOLD) % (1 << 64)))


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row number of every element that ``offsets`` lays out."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def packed_numbers(x: np.ndarray) -> bytes:
    """Numbers of one type, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize) if len(x) else np.zeros((0, 1), np.uint8)
    return zstandard.compress(np.ascontiguousarray(planes.T).tobytes(), 1)


def unpacked_numbers(packed: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()
