"""Exact substring deduplication with a logarithmic family of suffix arrays
(operator 6).

Every byte that a string of ``length`` bytes covers which also starts anywhere
else (in another document or the same one) is removed; matches are judged on the
input and never cross documents.

Sampled suffixes. Of all suffixes only those are indexed that begin with the
smallest ``core``-byte hash of some window of ``length`` bytes. Which one that is
depends on the window's bytes alone, so two equal windows choose the same place,
and every window start belongs to one sampled suffix (its run). A suffix entry
holds the hash of its first ``core`` bytes, the hash of its whole run (all bytes
that the run's windows cover) and where it stands. About one suffix in 170 bytes
is kept. Entries are ordered by their hashes instead of their bytes.

Levels. Documents come in batches. A batch's entries are sorted into an array,
entries that agree are counted together; the array is merge-scanned against
itself and every existing level for hashes that occur again; then it becomes a
level, and levels of equal size merge into one of double size. An entry is thus
rewritten at most log2(batches) times.

Matches. Entries whose first hash occurs once can't match. If a whole run occurs
again, all its windows do. What is left (the ends of repeated passages) is
compared exactly: one context per distinct run is fetched, cut into blocks of
``BLOCK`` windows, of which most are decided by the bytes that all windows of the
block share (unique: no match) or together cover (repeated: all match); for the
rest, single windows are hashed and counted. All counts are combined in the tasks
first; a passage that stands in a third of all documents is one entry per distinct
run, and joins read staged tables on both sides, so hot hashes are split.

Bytes are compared by 64-bit hashes. Defined results. Null text: empty. Texts
below ``length`` bytes: nothing removed. Rows that repeat are documents of their
own and match one another. Null and repeated ids do no harm. Empty table: empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.llm.common import BYTE_CODE, drop_staged, mix64, powers, stage, text_bytes

_U = np.uint64
CORE = 64
BLOCK = 16
PLACE_BITS = 20  # positions of a slice
SLICE = (1 << PLACE_BITS) - 1024
FILTER_BITS = 24


class Hashes:
    """Hashes of any byte range of one buffer."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw) + 1)
        self.total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTE_CODE[raw] * up[:-1], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(np.uint64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima of blocks."""
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(x) - width + 1], ahead[width - 1 : len(x)])


def sample(raw: np.ndarray, offsets: np.ndarray, length: int):
    """The sampled suffixes of one slice: row, place of the suffix, first and
    last window start of its run, hash of its core, hash of its run."""
    n, width = len(raw), length - CORE + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    hashes = Hashes(raw)
    place = np.arange(n - CORE + 1)
    core = hashes.of(place, place + CORE)
    low = _U((1 << PLACE_BITS) - 1)
    # of equal hashes the first place is the least
    least = sliding_min((core & ~low) | place.astype(np.uint64), width)
    start = np.arange(len(least))
    row = np.searchsorted(offsets, start, "right") - 1
    inside = start + length <= offsets[row + 1]
    start, row = start[inside], row[inside]
    if not len(start):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    at = (least[inside] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = np.concatenate([first[1:], [len(start)]]) - 1
    a, lo, hi = at[first], start[first], start[last]
    run = mix64(hashes.of(lo, hi + length) + (a - lo).astype(np.uint64) * _U(0x9E3779B97F4A7C15) + (hi - lo).astype(np.uint64))
    return row[first], a, lo, hi, core[a], run


def _slices(raw: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """``bytes, row offsets, first row, place of the bytes in that row``: rows
    together up to SLICE bytes, a longer row in overlapping pieces."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1)
        size = int(offsets[end] - offsets[row])
        if size <= SLICE:
            yield raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], row, 0
        else:
            step = SLICE - length + 1
            for at in range(0, size - length + 1, step):
                part = raw[offsets[row] + at : min(offsets[row] + at + SLICE, offsets[end])]
                yield part, np.array([0, len(part)]), row, at
        row = end


def pack(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A run's place as one number."""
    return (lo << 20) | ((hi - lo) << 10) | (a - lo)


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start, and the suffix's place."""
    lo = place >> 20
    return lo, lo + ((place >> 10) & 1023), lo + (place & 1023)


def suffix_entries(rows: DataFrame, length: int) -> DataFrame:
    """``core, run, doc, place`` of all sampled suffixes of ``doc, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc = b.column(0).to_numpy()
            raw, offsets = text_bytes(b.column(1))
            for part, off, first, shift in _slices(raw, offsets, length):
                row, a, lo, hi, core, whole = sample(part, off, length)
                begin = off[row] - shift
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        pa.array(doc[first + row]),
                        pa.array(pack(a - begin, lo - begin, hi - begin)),
                    ],
                    names=["core", "run", "doc", "place"],
                )

    return rows.mapInArrow(run, "core bigint, run bigint, doc bigint, place bigint")


def _array(entries: DataFrame) -> DataFrame:
    """Entries that agree in core and run counted together, in order."""
    merged = entries.groupBy("core", "run").agg(
        F.sum("n").alias("n"), F.min("doc").alias("doc"), F.min_by("place", "doc").alias("place")
    )
    return stage(merged.sortWithinPartitions("core", "run"), "suffix-array")


@dataclass
class SuffixLevels:
    """Suffix arrays whose sizes (in batches) are different powers of two."""

    levels: list[tuple[int, DataFrame]] = field(default_factory=list)

    def add(self, entries: DataFrame) -> DataFrame:
        """Take a batch's ``core, run, doc, place``; the answer is the table of
        core hashes in it that occur again, in the batch or in a level."""
        array = _array(entries.withColumn("n", F.lit(1).cast("long")))
        found = array.groupBy("core").agg(F.sum("n").alias("n")).filter("n > 1").select("core")
        for _, level in self.levels:
            found = found.union(array.select("core").distinct().join(level.select("core"), "core", "left_semi"))
        found = stage(found.distinct(), "cores-again")
        size = 1
        while self.levels and self.levels[-1][0] == size:
            _, other = self.levels.pop()
            merged = _array(array.unionByName(other))
            drop_staged(array)
            drop_staged(other)
            array, size = merged, 2 * size
        self.levels.append((size, array))
        return found

    def entries(self, cores: DataFrame) -> DataFrame:
        """All entries with one of the core hashes, counted over the levels."""
        picked = None
        for _, level in self.levels:
            part = level.join(cores, "core", "left_semi")
            picked = part if picked is None else picked.unionByName(part)
        return _array(picked)


def _key_filter(keys: DataFrame):
    """A broadcast bitmap of 2**FILTER_BITS slots over a column ``doc``: which
    rows needn't be sent to a join. Others may pass; the join drops them."""
    slots = F.shiftrightunsigned(F.xxhash64("doc"), 64 - FILTER_BITS)
    bits = np.zeros(1 << FILTER_BITS, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << FILTER_BITS, bool)
        for b in batches:
            own[b.column(0).to_numpy()] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(own, bitorder="little").tobytes()])], names=["bits"])

    packed = np.zeros(len(bits) // 8, np.uint8)
    for r in keys.select(slots.alias("slot")).coalesce(4).mapInArrow(run, "bits binary").collect():
        packed |= np.frombuffer(r["bits"], np.uint8)
    sent = keys.sparkSession.sparkContext.broadcast(packed)

    @F.arrow_udf("boolean")
    def may_hold(slot: pa.Array) -> pa.Array:
        at = slot.to_numpy()
        return pa.array(((sent.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool))

    return may_hold(slots)


def contexts(rows: DataFrame, entries: DataFrame, length: int) -> DataFrame:
    """``run, n, place, bytes``: the bytes of each entry's run."""
    asked = entries.groupBy("doc").agg(F.collect_list(F.struct("run", "n", "place")).alias("asked"))
    asked = stage(asked, "asked-runs")
    texts = rows.filter(_key_filter(asked.select("doc"))).join(asked, "doc").select("text", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = text_bytes(b.column(0))
            asked = b.column(1)
            flat, ends = asked.flatten(), np.concatenate([[0], np.cumsum(asked.value_lengths().to_numpy())])
            row = np.repeat(np.arange(len(asked)), np.diff(ends))
            lo, hi, _ = unpack(flat.field(2).to_numpy())
            begin = offsets[row]
            parts = [raw[s + a : s + z + length].tobytes() for s, a, z in zip(begin, lo, hi, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [flat.field(0), flat.field(1), flat.field(2), pa.array(parts, pa.binary())], names=["run", "n", "place", "bytes"]
            )

    # rows that repeat hold the same bytes
    return stage(texts.mapInArrow(run, "run bigint, n bigint, place bigint, bytes binary").dropDuplicates(["run"]), "contexts")


def _blocks(found: DataFrame, length: int) -> DataFrame:
    """Blocks of windows of every context: ``run, n, lo, hi`` (window starts
    within the run), ``shared`` (hash of the bytes common to the block's
    windows) and ``cover`` (hash of all bytes they cover)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = text_bytes(b.column(3))
            lo0, hi0, a0 = unpack(b.column(2).to_numpy())
            # distance of a window start from the suffix's place
            near, far = a0 - hi0, a0 - lo0
            count = far // BLOCK - near // BLOCK + 1
            row = np.repeat(np.arange(b.num_rows), count)
            number = near[row] // BLOCK + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            place = offsets[row] + far[row]  # of the suffix in the buffer
            d0, d1 = np.maximum(near[row], number * BLOCK), np.minimum(far[row], number * BLOCK + BLOCK - 1)
            hashes = Hashes(raw)
            salt = number.astype(np.uint64) * _U(0x9E3779B97F4A7C15)
            common = mix64(hashes.of(place - number * BLOCK, place - (number * BLOCK + BLOCK - 1) + length) + salt)
            cover = mix64(hashes.of(place - d1, place - d0 + length) + d0.astype(np.uint64) * _U(1025) + d1.astype(np.uint64))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(take),
                    b.column(1).take(take),
                    pa.array(far[row] - d1),
                    pa.array(far[row] - d0),
                    pa.array(common.view(np.int64)),
                    pa.array(cover.view(np.int64)),
                ],
                names=["run", "n", "lo", "hi", "shared", "cover"],
            )

    return stage(found.mapInArrow(run, "run bigint, n bigint, lo bigint, hi bigint, shared bigint, cover bigint"), "blocks")


def _windows(blocks: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """Single windows of some blocks ``run, n, lo, hi``: ``run, n, at, window``."""
    asked = blocks.groupBy("run").agg(F.collect_list(F.struct("lo", "hi", "n")).alias("asked"))
    rows = found.select("run", "bytes").join(stage(asked, "open-blocks"), "run")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = text_bytes(b.column(1))
            asked = b.column(2)
            flat, lengths = asked.flatten(), asked.value_lengths().to_numpy()
            lo, hi, n = (flat.field(i).to_numpy() for i in range(3))
            row = np.repeat(np.repeat(np.arange(b.num_rows), lengths), hi - lo + 1)
            step = np.arange(len(row)) - np.repeat(np.cumsum(hi - lo + 1) - (hi - lo + 1), hi - lo + 1)
            at = np.repeat(lo, hi - lo + 1) + step
            start = offsets[row] + at
            window = Hashes(raw).of(start, start + length)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), pa.array(np.repeat(n, hi - lo + 1)), pa.array(at), pa.array(window.view(np.int64))],
                names=["run", "n", "at", "window"],
            )

    return stage(rows.mapInArrow(run, "run bigint, n bigint, at bigint, window bigint"), "windows")


def _again(rows: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` whose rows' counts reach two."""
    counted = rows.groupBy(column).agg(F.sum("n").alias("n")).filter("n > 1").select(column)
    return stage(counted, f"{column}-again")


def repeated_runs(found: DataFrame, length: int) -> DataFrame:
    """``run, lo, hi``: window starts (within the run) that occur elsewhere."""
    blocks = _blocks(found, length)
    # blocks that cover the same bytes are one entry, standing for all of them
    place = F.col("lo") * 1024 + F.col("hi")
    entries = blocks.groupBy("shared", "cover").agg(
        F.sum("n").alias("n"), F.min("run").alias("run"), F.min_by(place, F.col("run")).alias("place")
    )
    entries = stage(entries.select("shared", "cover", "n", "run", F.floor(F.col("place") / 1024).alias("lo"), (F.col("place") % 1024).alias("hi")), "block-entries")
    covers = stage(entries.filter("n > 1").select("cover"), "covers-again")
    whole = blocks.join(covers, "cover", "left_semi").select("run", "lo", "hi")
    # open: an entry of one block, next to others with the same shared bytes;
    # a block that is covered again asks nothing, but answers
    some = entries.groupBy("shared").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).filter("k > 1 and least = 1")
    rest = entries.join(stage(some.select("shared"), "open-shared"), "shared", "left_semi").select("run", "n", "lo", "hi")
    windows = _windows(rest, found, length)
    single = windows.filter("n = 1").join(_again(windows, "window"), "window", "left_semi")
    single = single.select("run", F.col("at").alias("lo"), F.col("at").alias("hi"))
    return stage(whole.unionByName(single), "repeated-windows")


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 400, batches: int = 4
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, spans``
    (byte ranges removed), ``kept`` (the bytes left) and ``kept_sha256``."""
    text = F.coalesce(docs[text_col], F.lit(""))
    key = F.xxhash64(docs[id_col].cast("string"), F.lit("\x00"), text)
    rows = docs.select(docs[id_col].alias("doc_id"), key.alias("doc"), text.alias("text"))
    entries = stage(suffix_entries(rows.select("doc", "text"), length), "suffixes")

    index, cores = SuffixLevels(), None
    for i in range(batches):
        again = index.add(entries.filter(F.pmod("doc", F.lit(batches)) == i))
        cores = again if cores is None else cores.union(again)
    shared = index.entries(stage(cores.distinct(), "shared-cores"))

    # runs of which all windows occur again: the run itself does
    whole = shared.filter("n > 1").select("run")
    # suffixes with several runs: their windows may match across runs
    mixed = shared.groupBy("core").agg(F.count(F.lit(1)).alias("runs")).filter("runs > 1").select("core")
    partly = shared.join(stage(mixed, "mixed-cores"), "core", "left_semi")
    found = contexts(rows, partly, length)
    pieces = repeated_runs(found, length)

    pieces = pieces.groupBy("run").agg(F.collect_list(F.struct("lo", "hi")).alias("pieces"))
    known = stage(
        pieces.join(whole.withColumn("whole", F.lit(True)), "run", "full_outer").select(
            "run", F.coalesce("whole", F.lit(False)).alias("whole"), "pieces"
        ),
        "matches",
    )
    matched = entries.select("run", "doc", "place").join(known, "run")
    lo, hi = F.shiftright("place", 20), F.shiftright("place", 20) + F.shiftright("place", 10).bitwiseAND(F.lit(1023))
    ranges = F.when(F.col("whole"), F.array(F.struct(lo.alias("lo"), hi.alias("hi")))).otherwise(
        F.transform("pieces", lambda p: F.struct((p["lo"] + lo).alias("lo"), (p["hi"] + lo).alias("hi")))
    )
    # rows that repeat share a key and ask for the same ranges: a set holds each once
    per_doc = matched.select("doc", ranges.alias("r")).groupBy("doc").agg(F.flatten(F.collect_set("r")).alias("ranges"))
    return _cut(rows, stage(per_doc, "document-matches"), length)


def _cut(rows: DataFrame, per_doc: DataFrame, length: int) -> DataFrame:
    id_type = rows.schema["doc_id"].dataType.simpleString()
    joined = rows.join(per_doc, "doc", "left").select("doc_id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = text_bytes(b.column(1))
            out = {k: [] for k in ("n_bytes", "n_removed", "spans", "kept", "sha")}
            for i, found in enumerate(b.column(2)):
                own = raw[offsets[i] : offsets[i + 1]]
                edge = np.zeros(len(own) + 1, np.int32)
                if found.is_valid:
                    lo, hi = found.values.field(0).to_numpy(), found.values.field(1).to_numpy()
                    np.add.at(edge, lo, 1)
                    np.add.at(edge, hi + length, -1)
                gone = np.zeros(len(own) + 2, np.int8)
                gone[1:-1] = np.cumsum(edge)[:-1] > 0
                turn = np.diff(gone)
                start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
                kept = own[gone[1:-1] == 0].tobytes()
                out["n_bytes"].append(len(own))
                out["n_removed"].append(len(own) - len(kept))
                out["spans"].append([{"start": int(s), "end": int(e)} for s, e in zip(start, end, strict=True)])
                out["kept"].append(kept)
                out["sha"].append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(out["n_bytes"], pa.int64()),
                    pa.array(out["n_removed"], pa.int64()),
                    pa.array([len(s) for s in out["spans"]], pa.int64()),
                    pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(out["kept"], pa.binary()),
                    pa.array(out["sha"], pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept", "kept_sha256"],
            )

    schema = (
        f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint,"
        " spans array<struct<start:bigint,end:bigint>>, kept binary, kept_sha256 string"
    )
    return joined.mapInArrow(run, schema)
