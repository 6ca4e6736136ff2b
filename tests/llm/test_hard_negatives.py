"""Hard negatives against all pairs in plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from prodlake.llm import hard_negatives as hn
from prodlake.llm.common import ship
from prodlake.llm.vectors import HELD
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed: int, n: int, dims: int = 8, labels: int = 3, ties: bool = False) -> list[tuple]:
    r = random.Random(seed)
    grid = [-0.5, 0.0, 0.25] if ties else None
    return [(i, [r.choice(grid) if grid else r.gauss(0.2, 0.4) for _ in range(dims)], r.randrange(labels)) for i in range(n)]


HARD = [
    (1000, None, 1),
    (1001, [1.0, None], 1),
    (1002, [float("nan")] * 8, 1),
    (1003, [float("inf")] * 8, 1),
    (1004, [0.1] * 8, None),
    (1005, [], 2),
    (1006, [0.5, 0.5], 0),
    (None, [0.3] * 8, 1),
    (None, [0.3] * 8, 0),
    (1007, [3.0e38, -3.0e38] * 4, 2),
    (1010, [0.0] * 8, 1),
    (1011, [0.4] * 8, 0),
    (1011, [0.4] * 8, 0),
    (1020, [0.2] * 8, 2),
    (1020, [0.2] * 8, 2),
]


def expected(rows: list[tuple], every: int, n_pos: int = 5, n_neg: int = 5) -> list[tuple]:
    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        kept.append((i, [math.floor(max(-HELD, min(HELD, 256 * x))) for x in v], label))

    def best(scored):
        return sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0))

    anchors = {}
    for i, v, label in kept:
        if i is not None and i % every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in anchors.items():
        score = [(sum(x * y for x, y in zip(v, w, strict=False)), i, same) for i, w, same in kept if i != a]
        for place, (p, pid, _) in enumerate(best([s for s in score if s[2] == label])[:n_pos], 1):
            found = best([s for s in score if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p])[:n_neg]
            out += [(a, pid, place, k, i, p, s) for k, (s, i, _) in enumerate(found, 1)]
    return sorted(out, key=str)


def mined(spark, rows, every=10, schema=SCHEMA):
    ship(spark)
    df = spark.createDataFrame(rows, schema).repartition(3)
    out = hn.mine(df, F.col("vec_id") % every == 0)
    assert out.columns == ["anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("ties", [False, True])
def test_as_all_pairs(spark, ties):
    rows = vectors(1, 400, ties=ties) + HARD
    found = mined(spark, rows)
    assert found == expected(rows, 10) and len(found) > 200


def test_one_hot_label_and_equal_vectors(spark):
    rows = [(i, [0.5, 0.25], 0 if i % 3 else i) for i in range(300)]
    assert mined(spark, rows) == expected(rows, 10)


def test_labels_all_different(spark):
    rows = [(i, v, i) for i, v, _ in vectors(2, 120)]
    assert mined(spark, rows) == []  # no anchor has a positive


def test_empty_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(3, [1.0], 0), (4, [1.0], 1)]) == []


def test_clashing_names(spark):
    rows = vectors(4, 60)
    names = "v part block to ids labels scores score rank place other_id anchor_id".split()
    clash = [(*r, *["x"] * len(names)) for r in rows]
    assert mined(spark, clash, schema=SCHEMA + "".join(f", {n} string" for n in names)) == expected(rows, 10)


def _block(rows):
    v = np.array([r[1] for r in rows], np.int32)
    return hn.Block([r[0] for r in rows], [r[2] for r in rows], v.tobytes(), v.shape[1])


def test_bounds_hold_and_spare_rows():
    r = np.random.default_rng(5)
    centres = r.normal(0, 200, (6, 32))
    rows = (centres[r.integers(0, 6, 3000)] + r.normal(0, 15, (3000, 32))).astype(np.int32)
    anchors = (centres[r.integers(0, 6, 60)] + r.normal(0, 15, (60, 32))).astype(np.int32)
    scored = 0
    for node, places, scores, n in hn.tree_scores(anchors, rows, lambda _, low, high: high >= hn._last_of_best(low, 5)):
        exact = rows.astype(np.int64) @ anchors[node].astype(np.int64)
        assert (exact[places] == scores).all()
        assert sorted(exact)[-5:] == sorted(scores)[-5:]
        scored += n
    assert scored < 0.5 * 60 * 3000  # most pairs are settled by their bounds


def test_large_numbers_stay_exact():
    r = np.random.default_rng(6)
    rows = r.integers(-HELD, HELD, (200, 16)).astype(np.int32)
    for node, places, scores, _ in hn.tree_scores(rows[:20], rows, lambda _, low, high: high >= hn._last_of_best(low, 5)):
        exact = [sum(int(x) * int(y) for x, y in zip(rows[node], w, strict=True)) for w in rows]
        assert [exact[p] for p in places] == scores.tolist()
        assert sorted(exact)[-5:] == sorted(scores.tolist())[-5:]


def test_blocks_of_any_size_agree(spark, monkeypatch):
    rows = vectors(7, 300)
    monkeypatch.setattr(hn, "ANCHORS", 4)
    monkeypatch.setattr(hn, "ROWS", 16)
    assert mined(spark, rows) == expected(rows, 10)


def test_tree_is_rooted_and_ordered():
    v = np.random.default_rng(8).integers(-50, 50, (40, 3))
    parent, order = hn.spanning_tree(v)
    seen = set()
    for node in order.tolist():
        assert parent[node] == -1 or parent[node] in seen
        seen.add(node)
    assert seen == set(range(40)) and parent.count(-1) == 1
