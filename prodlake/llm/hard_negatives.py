"""Hard negatives by anchor spanning-tree bounds (operator 12).

Anchors are asked against all rows, block by block. The anchors of a block are
linked by a minimum spanning tree. The root is scored against every row of a row
block; for any other anchor, the score of its parent plus or minus the edge's
length times the row's norm bounds its own score (Cauchy-Schwarz), and so does the
root's score with the distance to the root; the tighter of both counts. Only rows
whose interval still meets a wanted window are scored exactly, which makes their
interval a point for the anchors below.

Two passes over the block pairs:

1. positives: the anchor's ``positives`` best rows of its own label. The window is
   all above the last of the best lower bounds. Only blocks that share a label meet.
2. negatives: for every positive score ``p``, rows of other labels within
   ``low * p <= 100 * score <= 100 * p``; the window of a positive begins at the
   last of the best lower bounds of rows that are surely inside.

Each pair of blocks reports at most its own best rows, which a window with a row
limit per group merges. Anchor blocks hold ``ANCHORS`` and row blocks ``ROWS``
vectors at most, sorted by label; anchors, the smaller side, are sent to the row
blocks. Nothing is broadcast by force or collected; the driver sees four counts.

Scores are exact: products of whole numbers, in floating point only where every
sum stays below 2**53, else in 64-bit integers.

Defined results. Rows with a null label or vector, or a null or non-finite
component, take no part. A row without an id is never an anchor; it may be a
positive or negative and comes after all ids on ties. Rows that repeat count each,
but rows with the anchor's id are not "other" rows; if an anchor's id repeats, the
row least by label and vector is the anchor. Shorter vectors count as filled up
with zeros. Scaled components beyond 2**25 count as 2**25, so that scores of up to
4096 components fit a long. No anchors or no rows: no result. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodlake.llm.common import drop_staged, stage
from prodlake.llm.vectors import whole_vectors

ANCHORS = 256
ROWS = 16384
_EXACT = float(1 << 53)
_NO_ID = np.int64(np.iinfo(np.int64).max)


# ---------------------------------------------------------------- blocks


class Block:
    """Some vectors of one width with their ids (null: last) and labels."""

    def __init__(self, ids, labels, vectors: bytes, width: int):
        self.null = np.array([i is None for i in ids], bool)
        self.ids = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        self.labels = np.array(labels, np.int64)
        self.v = np.frombuffer(vectors, np.int32).reshape(len(self.ids), width)

    def widened(self, width: int) -> np.ndarray:
        return np.pad(self.v, ((0, 0), (0, width - self.v.shape[1])))


def _pack(most: int, extra: bool):
    """Rows ``vec_id, label, v[, scores]`` to blocks of at most ``most`` rows;
    ``part`` is the number of the task, so blocks of one part may be several."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0

        def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            vectors = t.column("v").to_pylist()
            width = max(map(len, vectors))
            m = np.zeros((len(vectors), width), np.int32)
            for i, v in enumerate(vectors):
                m[i, : len(v)] = v
            out = {
                "part": pa.array([part], pa.int32()),
                "block": pa.array([(part << 32) + made], pa.int64()),
                "ids": pa.array([t.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                "labels": pa.array([t.column("label").to_pylist()], pa.list_(pa.int64())),
                "vectors": pa.array([m.tobytes()], pa.binary()),
                "width": pa.array([width], pa.int32()),
            }
            if extra:
                out["scores"] = pa.array([t.column("scores").to_pylist()], pa.list_(pa.list_(pa.int64())))
            return pa.RecordBatch.from_pydict(out)

        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                take = min(most - n, batch.num_rows)
                held.append(batch.slice(0, take))
                n += take
                batch = batch.slice(take)
                if n == most:
                    yield block(held)
                    held, n, made = [], 0, made + 1
        if n:
            yield block(held)

    return pack


_BLOCK = "part int, block long, ids array<bigint>, labels array<bigint>, vectors binary, width int"


def packed(rows: DataFrame, most: int, n: int, name: str) -> DataFrame:
    """Blocks of neighbouring labels. Rows equal in label and id are spread by
    their place in the stored table, so a large group fills several parts."""
    extra = "scores" in rows.columns
    place = F.monotonically_increasing_id()
    ranged = rows.withColumn("place", place).repartitionByRange(max(1, -(-n // most)), "label", "vec_id", "place")
    schema = _BLOCK + (", scores array<array<bigint>>" if extra else "")
    return stage(ranged.drop("place").mapInArrow(_pack(most, extra), schema), name)


# ---------------------------------------------------------------- bounds


def spanning_tree(v: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Parents of a minimum spanning tree rooted at 0 (the root's is -1), and the
    nodes in an order where each follows its parent and smaller subtrees come
    first, so that few parents are open at once."""
    n = len(v)
    x = v.astype(np.float64)
    square = (x * x).sum(1)
    parent, near, best = [-1] * n, np.zeros(n, np.int64), np.full(n, np.inf)
    outside = np.ones(n, bool)
    at, children = 0, [[] for _ in range(n)]
    for _ in range(n - 1):
        outside[at] = False
        d = np.maximum(square + square[at] - 2 * (x @ x[at]), 0)
        closer = outside & (d < best)
        best[closer], near[closer] = d[closer], at
        at = int(np.argmin(np.where(outside, best, np.inf)))
        parent[at] = int(near[at])
        children[parent[at]].append(at)
    order, stack = [], [0]
    while stack:
        order.append(node := stack.pop())
        stack += children[node]
    size = np.ones(n, np.int64)
    for node in reversed(order):
        if parent[node] >= 0:
            size[parent[node]] += size[node]
    order, stack = [], [0]
    while stack:
        order.append(node := stack.pop())
        stack += sorted(children[node], key=lambda c: -size[c])
    return parent, np.array(order)


def tree_scores(anchors: np.ndarray, rows: np.ndarray, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """``anchor, places, scores, scored`` for every anchor: the rows that
    ``wanted(anchor, low, high)`` asks for by their bounds, with exact scores."""
    if not len(anchors) or not len(rows):
        return
    width = max(1, rows.shape[1])
    largest = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * width
    kind = np.float64 if largest < _EXACT else np.int64
    a, c = anchors.astype(kind), rows.astype(kind)
    parent, order = spanning_tree(anchors)
    x = anchors.astype(np.float64)
    norms = np.sqrt((rows.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
    slack = 1 + largest * 1e-12  # rounding of the bounds; scores themselves are exact
    left = np.zeros(len(anchors), np.int64)
    for p in parent:
        if p >= 0:
            left[p] += 1
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    root = (c @ a[0]).astype(np.float64)
    for node in order.tolist():
        up = parent[node]
        if up < 0:
            low = high = root
        else:
            edge = float(np.sqrt(((x[node] - x[up]) ** 2).sum())) * norms + slack
            whole = float(np.sqrt(((x[node] - x[0]) ** 2).sum())) * norms + slack
            low = np.maximum(bounds[up][0] - edge, root - whole)
            high = np.minimum(bounds[up][1] + edge, root + whole)
            left[up] -= 1
            if not left[up]:
                del bounds[up]
        places = np.flatnonzero(wanted(node, low, high))
        scores = c[places] @ a[node]
        if left[node]:
            low, high = low.copy(), high.copy()
            low[places] = high[places] = scores
            bounds[node] = low, high
        yield node, places, scores.astype(np.int64), len(places)


def _last_of_best(values: np.ndarray, n: int) -> float:
    """The n-th largest value, below all numbers if there are fewer."""
    return float(np.partition(values, len(values) - n)[len(values) - n]) if len(values) >= n else -np.inf


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:n]


def find_positives(a: Block, b: Block, n: int) -> Iterator[tuple[int, list, list]]:
    """``anchor id, ids, scores`` of the best rows of the anchor's own label."""
    width = max(a.v.shape[1], b.v.shape[1])
    for label in np.intersect1d(a.labels, b.labels):
        mine, theirs = np.flatnonzero(a.labels == label), np.flatnonzero(b.labels == label)
        ids, null = b.ids[theirs], b.null[theirs]
        own = a.ids[mine]

        def wanted(node, low, high, ids=ids, null=null, own=own):
            other = null | (ids != own[node])
            return other & (high >= _last_of_best(low[other], n))

        for node, places, scores, _ in tree_scores(a.widened(width)[mine], b.widened(width)[theirs], wanted):
            best = _best(scores, ids[places], n)
            at = places[best]
            yield int(own[node]), [None if null[i] else int(ids[i]) for i in at], scores[best].tolist()


def find_negatives(a: Block, asked: list[list[int]], b: Block, n: int, low_share: int) -> Iterator[tuple[int, int, list, list]]:
    """``anchor id, positive score, ids, scores`` of the best rows of other labels
    in each asked positive's window."""
    width = max(a.v.shape[1], b.v.shape[1])
    windows = [[(-(-low_share * p // 100), p) for p in sorted(set(scores)) if p >= 0] for scores in asked]
    use = np.array([bool(w) for w in windows], bool)
    if not use.any():
        return
    mine = np.flatnonzero(use)

    def wanted(node, low, high):
        k = mine[node]
        other = b.labels != a.labels[k]
        need = np.zeros(len(low), bool)
        for least, most in windows[k]:
            surely = other & (low >= least) & (high <= most)
            from_here = max(least, _last_of_best(low[surely], n))
            need |= other & (high >= from_here) & (low <= most)
        return need

    for node, places, scores, _ in tree_scores(a.widened(width)[mine], b.widened(width), wanted):
        k = mine[node]
        for least, most in windows[k]:
            inside = (scores >= least) & (scores <= most)
            at, s = places[inside], scores[inside]
            best = _best(s, b.ids[at], n)
            if len(best):
                yield int(a.ids[k]), most, [None if b.null[i] else int(b.ids[i]) for i in at[best]], s[best].tolist()


def _side(row: dict, prefix: str) -> Block:
    return Block(row[f"{prefix}ids"], row[f"{prefix}labels"], row[f"{prefix}vectors"], row[f"{prefix}width"])


def _run(find):
    """A pair of blocks a row to rows ``anchor_id, positive_score, other_id, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                out: list[list] = [[], [], [], []]
                for anchor, positive, ids, scores in find(row):
                    out[0] += [anchor] * len(ids)
                    out[1] += [positive] * len(ids)
                    out[2] += ids
                    out[3] += scores
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in out], ["anchor_id", "positive_score", "other_id", "score"]
                )

    return run


_FOUND = "anchor_id long, positive_score long, other_id long, score long"


def _meet(anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """Anchor blocks that bear their row block's ``to`` beside those row blocks."""
    names = [c for c in anchors.columns if c not in ("part", "to")]
    a = anchors.select("to", *[F.col(c).alias(f"a_{c}") for c in names])
    return a.join(rows.withColumnRenamed("part", "to"), "to")


# ---------------------------------------------------------------- operator


def mine(
    rows: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
) -> DataFrame:
    """``anchor_id, positive_id, positive_rank, rank, negative_id, positive_score,
    negative_score``: for every anchor and each of its first ``positives`` rows of
    the same label, the first ``negatives`` rows of another label that score at
    least ``low`` percent of the positive and no more than it. ``is_anchor`` is a
    condition on ``vec_id``, ``label`` and ``v`` (the scaled vector)."""
    whole = whole_vectors(rows.filter(F.col(label).isNotNull()), vec_id, vector, scale, F.col(label).cast("long").alias("label"))
    kept = stage(whole, "vectors")
    row_blocks = packed(kept, ROWS, kept.count(), "row-blocks")
    parts = 1 + (row_blocks.agg(F.max("part")).first()[0] or 0)
    least = F.min(F.struct("label", "v")).alias("least")
    chosen = kept.filter(is_anchor & F.col("vec_id").isNotNull()).groupBy("vec_id").agg(least)
    anchors = stage(chosen.select("vec_id", "least.label", "least.v"), "anchors")
    n_anchors = anchors.count()

    # pass 1: blocks that share a label
    blocks = packed(anchors, ANCHORS, n_anchors, "anchor-blocks")
    a_labels = blocks.select("block", F.explode(F.array_distinct("labels")).alias("label"))
    b_labels = row_blocks.select(F.col("part").alias("to"), F.explode(F.array_distinct("labels")).alias("label")).distinct()
    sent = blocks.join(a_labels.join(b_labels, "label").select("block", "to").distinct(), "block")

    def positive_rows(row: dict):
        for anchor, ids, scores in find_positives(_side(row, "a_"), _side(row, ""), positives):
            yield anchor, None, ids, scores

    found = _meet(sent, row_blocks).mapInArrow(_run(positive_rows), _FOUND)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), F.asc_nulls_last("other_id"))
    best = found.withColumn("positive_rank", F.row_number().over(order)).filter(F.col("positive_rank") <= positives)
    pairs = stage(
        best.select("anchor_id", F.col("other_id").alias("positive_id"), "positive_rank", F.col("score").alias("positive_score")),
        "positives",
    )

    # pass 2: every block of anchors that have a positive, and every block of rows
    asked = pairs.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("scores"))  # of `positives` rows at most
    asked = stage(anchors.join(asked, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), "asked")
    blocks = packed(asked, ANCHORS, n_anchors, "asking-blocks")
    sent = blocks.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def negative_rows(row: dict):
        yield from find_negatives(_side(row, "a_"), row["a_scores"], _side(row, ""), negatives, low)

    found = _meet(sent, row_blocks).mapInArrow(_run(negative_rows), _FOUND)
    order = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("score"), F.asc_nulls_last("other_id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    drop_staged(kept)
    return pairs.join(best, ["anchor_id", "positive_score"]).select(
        "anchor_id",
        "positive_id",
        "positive_rank",
        "rank",
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
