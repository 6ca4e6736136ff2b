"""Vector code compression: product codes from box shortlists (operator 13).

A vector of whole numbers is cut into equal consecutive parts; a part's code is the
number of the nearest entry of its codebook. Codebooks start as the parts of the
rows with the smallest ids and are improved in rounds: assign every part to its
nearest entry, then put the floored mean of its parts in an entry's place.

The parts of each position lie in flat blocks in the order of a Hilbert curve, so
that a block holds neighbours. A block stores the least and greatest value of every
component (its box) and the components' sums. In a round the entries' least and
greatest possible distances to the box leave a short list per block: an entry whose
least distance is more than the smallest greatest distance is nearest to none of
its vectors. A list of one settles the whole block by its stored sums; otherwise the
listed entries are compared exactly, in whole numbers.

Blocks are written once, to the shared folder, and read in every round; a task adds
up its blocks and reports a row per entry it met, so a round shuffles and collects
no more than ``parts * entries`` rows a task and in all.

Bounds: ``parts * entries`` entries are on the driver and with every task; a block
holds ``BLOCK`` parts at most. Rows with the same part values are spread over blocks
by their row number.

Defined results. Rows whose vector is null or holds a null or non-finite component
are left out. Fewer rows than entries: that many entries. Ids that repeat, or are
null (last), are ordered by the vector too when the first entries are chosen; rows
that repeat count each. Vectors of several lengths, or of one that ``parts`` doesn't
divide, count as filled up with zeros. Scaled components beyond 2**25 count as
2**25. Ties between entries: the lower number. Unused entries stay as they are. No
rows: no result. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prodlake.llm.common import drop_staged, stage
from prodlake.llm.vectors import whole_vectors

BLOCK = 128
BLOCKS_A_TASK = 512
_EXACT = float(1 << 53)


# ---------------------------------------------------------------- Hilbert order


def hilbert_keys(x: np.ndarray, low: float, high: float) -> list[bytes]:
    """The place of each row along a Hilbert curve, as bytes that sort alike.
    Components are cut to ``low`` .. ``high`` and to a few bits each."""
    n, dims = x.shape
    if not dims:
        return [b""] * n
    bits = min(16, max(1, 64 // dims))
    cells = 1 << bits
    step = max(high - low, 1e-9) / cells
    axes = np.clip(np.floor((x - low) / step), 0, cells - 1).astype(np.uint32)
    # Gray code and rotations, bit plane by bit plane from the top
    q = np.uint32(cells >> 1)
    while q > 1:
        p = q - np.uint32(1)
        for i in range(dims):
            set_ = (axes[:, i] & q) != 0
            swap = np.where(set_, 0, (axes[:, 0] ^ axes[:, i]) & p).astype(np.uint32)
            axes[:, 0] ^= np.where(set_, p, swap).astype(np.uint32)
            axes[:, i] ^= swap
        q >>= np.uint32(1)
    for i in range(1, dims):
        axes[:, i] ^= axes[:, i - 1]
    turn = np.zeros(n, np.uint32)
    q = np.uint32(cells >> 1)
    while q > 1:
        turn ^= np.where((axes[:, -1] & q) != 0, q - np.uint32(1), 0).astype(np.uint32)
        q >>= np.uint32(1)
    axes ^= turn[:, None]
    planes = (axes[:, None, :] >> np.arange(bits - 1, -1, -1, dtype=np.uint32)[None, :, None]) & np.uint32(1)
    return [row.tobytes() for row in np.packbits(planes.reshape(n, -1).astype(np.uint8), axis=1)]


# ---------------------------------------------------------------- blocks


def _part_rows(parts: int, sub: int, low: float, high: float):
    """Rows ``rid, v`` to a row per part: ``part, place, rid, x``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            m = np.zeros((len(vectors), parts * sub), np.int32)
            for i, v in enumerate(vectors):
                m[i, : len(v)] = v
            for p in range(parts):
                x = np.ascontiguousarray(m[:, p * sub : (p + 1) * sub])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(x), p, np.int32)),
                        pa.array(hilbert_keys(x, low, high), pa.binary()),
                        batch.column(0),
                        pa.array([r.tobytes() for r in x], pa.binary()),
                    ],
                    ["part", "place", "rid", "x"],
                )

    return rows


def _flat(sub: int):
    """Sorted rows ``part, place, rid, x`` to blocks with boxes and sums."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(part: int, rids: list, x: list) -> pa.RecordBatch:
            m = np.frombuffer(b"".join(x), np.int32).reshape(len(x), sub).astype(np.int64)
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "rids": pa.array([rids], pa.list_(pa.int64())),
                    "x": pa.array([b"".join(x)], pa.binary()),
                    "least": pa.array([m.min(0).tobytes()], pa.binary()),
                    "most": pa.array([m.max(0).tobytes()], pa.binary()),
                    "sums": pa.array([m.sum(0).tobytes()], pa.binary()),
                }
            )

        part, rids, x = -1, [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "rid", "x")]
            for p, rid, row in zip(*columns, strict=True):
                if x and (p != part or len(x) == BLOCK):
                    yield block(part, rids, x)
                    rids, x = [], []
                part = p
                rids.append(rid)
                x.append(row)
        if x:
            yield block(part, rids, x)

    return blocks


def flat_blocks(kept: DataFrame, parts: int, sub: int, n: int) -> DataFrame:
    """``part, rids, x, least, most, sums`` of all parts of ``kept`` (``rid, v``)."""
    reach = kept.agg(F.avg(F.array_min("v")), F.avg(F.array_max("v"))).first()
    rows = kept.select("rid", "v").mapInArrow(
        _part_rows(parts, sub, float(reach[0] or 0), float(reach[1] or 0)), "part int, place binary, rid long, x binary"
    )
    tasks = max(parts, -(-n * parts // (BLOCK * BLOCKS_A_TASK)))
    order = ["part", "place", "rid"]
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    schema = "part int, rids array<bigint>, x binary, least binary, most binary, sums binary"
    return stage(dealt.mapInArrow(_flat(sub), schema), "flat-blocks")


# ---------------------------------------------------------------- assignment


def shortlist(least: np.ndarray, most: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The entries that may be nearest to a vector inside the box, ascending."""
    below, above = least - entries, entries - most
    nearest = np.maximum(np.maximum(below, above), 0)
    farthest = np.maximum(np.abs(below), np.abs(above))
    return np.flatnonzero((nearest * nearest).sum(1) <= (farthest * farthest).sum(1).min())


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest entry, the lower of equals."""
    largest = float(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * largest * largest * max(1, x.shape[1]) < _EXACT else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    d = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at].astype(np.int64)


class _Flat:
    """The blocks of a batch, one after another."""

    def __init__(self, row: dict, sub: int):
        self.part, self.rids = row["part"], row["rids"]
        n = len(self.rids)
        self.x = np.frombuffer(row["x"], np.int32).reshape(n, sub).astype(np.int64)
        self.least, self.most, self.sums = (np.frombuffer(row[c], np.int64) for c in ("least", "most", "sums"))


def _read(batches: Iterator[pa.RecordBatch], sub: int) -> Iterator[_Flat]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Flat(batch.slice(i, 1).to_pylist()[0], sub)


def _totals(books: np.ndarray):
    """Blocks to a row per entry met: ``part, entry, n, sums``."""
    parts, k, sub = books.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, sub), np.int64)
        for b in _read(batches, sub):
            entries = books[b.part]
            near = shortlist(b.least, b.most, entries)
            if len(near) == 1:
                counts[b.part, near[0]] += len(b.x)
                sums[b.part, near[0]] += b.sums
                continue
            at, _ = nearest(b.x, entries[near])
            np.add.at(sums[b.part], near[at], b.x)
            counts[b.part] += np.bincount(near[at], minlength=k)
        p, e = np.nonzero(counts)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(p.astype(np.int32)),
                    pa.array(e.astype(np.int32)),
                    pa.array(counts[p, e]),
                    pa.array(list(sums[p, e]), pa.list_(pa.int64())),
                ],
                ["part", "entry", "n", "sums"],
            )

    return totals


def train(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks ``[part, entry, component]`` after some rounds."""
    sub = books.shape[2]
    for _ in range(rounds):
        rows = blocks.mapInArrow(_totals(books), "part int, entry int, n long, sums array<bigint>")
        added = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(sub)]
        books = books.copy()
        for r in rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect():
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(sub)]
    return books


def assign(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``rid, part, code, distance`` of every part of every row."""
    sub = books.shape[2]

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _read(batches, sub):
            near = shortlist(b.least, b.most, books[b.part])
            at, distance = nearest(b.x, books[b.part][near])
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.rids, pa.int64()), pa.array(np.full(len(at), b.part, np.int32)), pa.array(near[at].astype(np.int64)), pa.array(distance)],
                ["rid", "part", "code", "distance"],
            )

    return blocks.mapInArrow(codes, "rid long, part int, code long, distance long")


# ---------------------------------------------------------------- operator


def first_rows(kept: DataFrame, n: int) -> list:
    """The vectors of the ``n`` smallest ids. Each task's own first rows are merged
    in 64 groups before the driver sees any."""
    order = Window.partitionBy("group").orderBy(F.asc_nulls_last("vec_id"), F.asc("v"))
    task = F.shiftright("rid", 33)  # the upper bits of a row number are its task's
    some = kept.withColumn("group", F.pmod(task, F.lit(64))).withColumn("row", F.row_number().over(order))
    some = stage(some.filter(F.col("row") <= n).select("vec_id", "v"), "first-rows", rows=1)
    return [r["v"] for r in some.orderBy(F.asc_nulls_last("vec_id"), F.asc("v")).limit(n).collect()]


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    rows: DataFrame,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: int = 1024,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, codes`` (a list of entry numbers, part by part), ``code``
    (the same in two hex digits each), ``error`` and ``label_error`` of every row
    kept, and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    kept = whole_vectors(rows, vec_id, vector, scale, F.col(label).alias("label"), F.monotonically_increasing_id().alias("rid"))
    kept = stage(kept, "vectors")
    n, width = kept.agg(F.count("*"), F.max(F.size("v"))).first()
    sub = -(-(width or 0) // parts)
    first = first_rows(kept, entries)
    books = np.zeros((parts, len(first), sub), np.int64)
    for e, v in enumerate(first):
        books[:, e] = np.pad(np.array(v, np.int64), (0, parts * sub - len(v))).reshape(parts, sub)
    blocks = flat_blocks(kept, parts, sub, n)
    books = train(blocks, books, rounds)

    # a row's parts meet again, with its id and label as one more row
    nothing = F.lit(None)
    own = kept.select("rid", nothing.cast("int").alias("part"), nothing.cast("long").alias("code"), nothing.cast("long").alias("distance"), "vec_id", "label")
    coded = assign(blocks, books).withColumns({"vec_id": nothing.cast("long"), "label": nothing.cast(kept.schema["label"].dataType)})
    each = [F.max(F.when(F.col("part") == p, F.col("code"))).cast("int") for p in range(parts)]
    met = own.unionByName(coded).groupBy("rid").agg(
        F.max("vec_id").alias("vec_id"), F.max("label").alias("label"), F.array(*each).alias("codes"), F.sum("distance").alias("error")
    )
    met = stage(met.drop("rid"), "codes")
    drop_staged(blocks)
    drop_staged(kept)
    by_label = stage(met.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    total = by_label.withColumnRenamed("label", "same")
    out = met.join(total, met["label"].eqNullSafe(total["same"])).drop("same")
    digits = [F.lpad(F.lower(F.hex(F.col("codes")[p].cast("long"))), 2, "0") for p in range(parts)]
    return out.withColumn("code", F.concat(*digits)), books
