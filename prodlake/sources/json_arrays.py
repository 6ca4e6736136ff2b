"""JSON arrays read by several tasks a file.

A ``multiLine`` reader parses a file whole in one task. Here a file is cut into byte
ranges, and the borders of its records are found in two passes:

1. each range is summed up without knowing where it begins: how many quotes it has,
   and by how much the nesting changes if it begins outside a string and if it
   begins inside one. Running sums over a file's ranges (a window, one row a range)
   then tell each range whether it begins inside a string and how deep;
2. each range yields the text of the records that begin in it, reading on behind its
   end for the last one. Spark's own JSON parser turns the texts into rows.

A file that breaks off, or a record that doesn't parse, costs only itself: the
records before it are kept, and the broken text is a row of its own with the text in
``_corrupt_record``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodlake.sources.files import CORRUPT
from prodlake.sources.ranged import file_ranges, open_input, read_range

CHUNK_BYTES = 32 << 20
ROWS_PER_BATCH = 4096
_QUOTE, _BACKSLASH = 34, 92
_TURN = np.zeros(256, np.int8)
_TURN[[ord("["), ord("{")]] = 1
_TURN[[ord("]"), ord("}")]] = -1
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 13, ord(",")]] = True
_BOM = b"\xef\xbb\xbf"


def quotes_and_brackets(buf: np.ndarray, escaped: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of the quotes that open or close a string and of all brackets, and
    whether the byte behind the buffer is escaped. ``escaped``: the first byte is."""
    quotes = np.flatnonzero(buf == _QUOTE)
    back = buf == _BACKSLASH
    after = False
    if escaped or back.any():
        # the last byte that is no backslash, at or before each place
        other = np.maximum.accumulate(np.where(back, -1, np.arange(len(buf))))
        run_at = lambda p: p - other[p] + np.where(other[p] < 0, int(escaped), 0)
        before = quotes - 1
        run = np.where(before >= 0, run_at(np.maximum(before, 0)), int(escaped))
        quotes = quotes[run % 2 == 0]
        after = bool(len(buf)) and bool(run_at(np.array([len(buf) - 1]))[0] % 2)
    return quotes, np.flatnonzero(_TURN[buf]), after


def starts_escaped(f, start: int) -> bool:
    """Whether an odd run of backslashes ends right before a place."""
    run, at = 0, start
    while at > 0:
        begin = max(0, at - 4096)
        f.seek(begin)
        piece = f.read(at - begin)
        kept = len(piece.rstrip(b"\\"))
        run += len(piece) - kept
        if kept:
            break
        at = begin
    return run % 2 == 1


def summary(f, start: int, end: int) -> tuple[int, int, int]:
    """Quotes of a range, and how the nesting changes over it if it begins
    outside a string, and inside one."""
    escaped, quotes, change = starts_escaped(f, start), 0, [0, 0]
    for piece in read_range(f, start, end):
        buf = np.frombuffer(piece, np.uint8)
        q, brackets, escaped = quotes_and_brackets(buf, escaped)
        inside = (np.searchsorted(q, brackets) + quotes) % 2
        turn = _TURN[buf[brackets]].astype(np.int64)
        change[0] += int(turn[inside == 0].sum())
        change[1] += int(turn[inside == 1].sum())
        quotes += len(q)
    return quotes, change[0], change[1]


def records(f, start: int, end: int, in_string: bool, depth: int, array: bool) -> Iterator[bytes]:
    """The texts of the elements that begin in a range: of the file's arrays, or,
    in a file without one, its top-level values."""
    top = 1 if array else 0
    escaped, open_text, loose, at = starts_escaped(f, start), None, b"", start
    skipping = depth > top or in_string  # in an element that began before this range
    f.seek(start)
    while piece := f.read(max(1, min(1 << 20, end - at)) if at < end else 1 << 16):
        piece = bytes(piece)
        buf = np.frombuffer(piece, np.uint8)
        last = max(0, min(len(buf), end - at))  # elements begin before this place only
        quotes, brackets, escaped = quotes_and_brackets(buf, escaped)
        outside = (np.searchsorted(quotes, brackets) + int(in_string)) % 2 == 0
        brackets = brackets[outside]
        turn = _TURN[buf[brackets]].astype(np.int64)
        after = depth + np.cumsum(turn)
        opens = brackets[(turn > 0) & (after == top + 1)]
        closes = brackets[(turn < 0) & (after == top)]
        # elements in this piece, and the loose bytes between them
        place, cursor = 0, 0
        closing = iter(closes.tolist())
        next_close = next(closing, None)
        begins = opens.tolist()
        if open_text is not None or skipping:
            if next_close is not None and (not begins or next_close < begins[0]):
                if open_text is not None:
                    open_text += piece[: next_close + 1]
                    yield bytes(open_text)
                    open_text = None
                skipping, place = False, next_close + 1
                next_close = next(closing, None)
            elif open_text is not None:
                open_text += piece
                place = len(piece)
            elif depth > top:
                place = len(piece)
        while cursor < len(begins) and begins[cursor] < place:
            cursor += 1
        while cursor < len(begins) and begins[cursor] < last and open_text is None:
            b = begins[cursor]
            loose = yield from _loose(loose + _between(buf, place, b, array), done=True)
            while next_close is not None and next_close < b:
                next_close = next(closing, None)
            if next_close is None:
                open_text, place = bytearray(piece[b:]), len(piece)
            else:
                yield piece[b : next_close + 1]
                place = next_close + 1
                next_close = next(closing, None)
            cursor += 1
        if open_text is None and not (skipping and depth > top) and place < last:
            # bytes behind the last element that is closed here, up to the next one
            stop = min(last, begins[cursor]) if cursor < len(begins) else last
            loose = yield from _loose(loose + _between(buf, place, stop, array), done=False)
        depth = int(after[-1]) if len(after) else depth
        if skipping and depth <= top:
            skipping = False
        in_string = bool((int(in_string) + len(quotes)) % 2)
        at += len(piece)
        if at >= end and open_text is None:
            break
    if open_text is not None:
        yield bytes(open_text)  # the file breaks off inside it
    yield from _loose(loose, done=True)


def _between(buf: np.ndarray, a: int, b: int, array: bool) -> bytes:
    """Bytes that belong to no element; the arrays' own brackets are left out."""
    if a >= b:
        return b""
    part = buf[a:b]
    blank = _BLANK[part]
    if array:
        blank = blank | (_TURN[part] != 0) & ((part == ord("[")) | (part == ord("]")))
    return np.where(blank, 32, part).astype(np.uint8).tobytes()


def _loose(text: bytes, done: bool) -> Iterator[bytes]:
    """Elements that are no objects or arrays: rejected texts. A text that may
    go on in the next piece is handed back."""
    parts = text.replace(_BOM, b"").split()
    kept = b""
    if parts and not done and not text.endswith(b" "):
        kept = parts.pop()
    yield from parts
    return kept


def _begins_with_array(f) -> bool:
    f.seek(0)
    while piece := f.read(4096):
        text = bytes(piece).removeprefix(_BOM).lstrip(b" \t\r\n")
        if text:
            return text[:1] == b"["
    return False


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        found = []
        for r in rows:
            with open_input(r["path"]) as f:
                found.append(summary(f, r["start"], r["end"]))
        columns = [pa.array([x[i] for x in found], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "quotes", "outside", "inside"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["record"])

    for batch in batches:
        for r in batch.to_pylist():
            held, size = [], 0
            with open_input(r["path"]) as f:
                array = _begins_with_array(f)
                for text in records(f, r["start"], r["end"], r["in_string"], r["depth"], array):
                    held.append(text)
                    size += len(text)
                    if len(held) >= ROWS_PER_BATCH or size >= 1 << 22:
                        yield rows(held)
                        held, size = [], 0
            if held:
                yield rows(held)


def record_texts(spark: SparkSession, path: str | list[str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``record``: the text of every element of the files' arrays."""
    ranges, tasks = file_ranges(spark, path, chunk_bytes)
    summed = ranges.filter("ranges > 1").mapInArrow(
        _summaries, "path string, length long, ranges int, range int, start long, end long, quotes long, outside long, inside long"
    )
    before = Window.partitionBy("path").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    started = summed.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    change = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    started = started.withColumn("depth", F.coalesce(F.sum(change).over(before), F.lit(0)))
    columns = ["path", "range", "start", "end", "in_string", "depth"]
    whole = ranges.filter("ranges = 1").withColumns({"in_string": F.lit(False), "depth": F.lit(0).cast("long")})
    every = started.select(*columns).unionByName(whole.select(*columns))
    return every.repartition(tasks, "path", "range").mapInArrow(_texts, "record binary")


def scan_json_array_split(
    spark: SparkSession, path: str | list[str], schema: T.StructType, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """The files' records as rows of ``schema`` and ``_corrupt_record``, NULL in
    good rows. Memory follows the longest record, not the file."""
    texts = record_texts(spark, path, chunk_bytes).select(F.col("record").cast("string").alias("record"))
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    parsed = F.from_json("record", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # a text that is no object at all parses to NULL
    row = texts.select("record", parsed.alias("row"))
    broken = F.when(F.col("row").isNull(), F.col("record")).otherwise(F.col(f"row.{CORRUPT}"))
    good = [F.when(broken.isNull(), F.col("row")[f.name]).alias(f.name) for f in schema.fields]
    return row.select(*good, broken.alias(CORRUPT))
