"""Vector codes against plain whole-number arithmetic."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from prodlake.llm import vector_codes as vc
from prodlake.llm.common import ship
from prodlake.llm.vectors import HELD

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, entries=256, rounds=4, parts=4):
    kept = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            v = [float(np.float32(x)) for x in v]
            kept.append((i, [math.floor(max(-HELD, min(HELD, 1024 * x))) for x in v], label))
    width = max((len(v) for _, v, _ in kept), default=0)
    sub = -(-width // parts)
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    kept = [(i, v + [0] * (parts * sub - len(v)), label) for i, v, label in kept]
    first = [v + [0] * (parts * sub - len(v)) for _, v, _ in first]
    books = [[v[p * sub : (p + 1) * sub] for v in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                x = v[p * sub : (p + 1) * sub]
                members.setdefault(near(x, books[p])[1], []).append(x)
            books[p] = [
                [sum(c) // len(members[e]) for c in zip(*members[e], strict=True)] if e in members else old
                for e, old in enumerate(books[p])
            ]
    out, by_label = [], {}
    for i, v, label in kept:
        found = [near(v[p * sub : (p + 1) * sub], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label]) for i, code, error, label in out), key=str), digest


def coded(spark, rows, schema=SCHEMA, **more):
    ship(spark)
    out, books = vc.compress(spark.createDataFrame(rows, schema).repartition(3), **more)
    found = out.select("vec_id", "code", "error", "label_error").collect()
    return sorted((tuple(r) for r in found), key=str), vc.digest(books)


def vectors(seed, n, dims=8):
    r = random.Random(seed)
    return [(i, [r.gauss(0, 0.3) for _ in range(dims)], r.choice([0, 1, None])) for i in r.sample(range(10 * n), n)]


HARD = [
    (7001, None, 1),
    (7002, [0.1, None] * 4, 1),
    (7003, [float("-inf")] * 8, 0),
    (7004, [float("nan")] * 8, 0),
    (None, [0.2] * 8, 5),
    (7005, [0.3] * 3, 5),
    (7006, [], 5),
    (-1, [0.3] * 8, 2),
    (-1, [0.3] * 8, 2),
    (-1, [-0.1] * 8, 2),
]


def test_as_plain_arithmetic(spark):
    rows = vectors(1, 400) + HARD
    assert coded(spark, rows) == expected(rows)


def test_few_entries_and_width_that_parts_do_not_divide(spark):
    rows = vectors(2, 150, dims=10)
    assert coded(spark, rows, entries=5) == expected(rows, entries=5)


def test_fewer_rows_than_entries_and_huge_numbers(spark):
    rows = [(i, [3e38 * (i - 3), 1e6, -1e30, 0.0], 0) for i in range(6) if i != 3] + [(9, [0.0] * 4, 1)]
    rows = [(i, [min(max(x, -3e38), 3e38) for x in v], label) for i, v, label in rows]
    assert coded(spark, rows) == expected(rows)


def test_many_equal_vectors(spark):
    rows = vectors(3, 100) + [(5, [0.25] * 8, 1)] * 300 + [(10_000 + i, [0.25] * 8, 1) for i in range(300)]
    assert coded(spark, rows) == expected(rows)


def test_empty_and_clashing_names(spark):
    assert coded(spark, [])[0] == []
    rows = vectors(4, 60)
    names = "rid part place x code distance v same codes error".split()
    clash = [(*r, *["x"] * len(names)) for r in rows]
    assert coded(spark, clash, schema=SCHEMA + "".join(f", {n} string" for n in names)) == expected(rows)


def test_too_many_entries(spark):
    with pytest.raises(ValueError):
        vc.compress(spark.createDataFrame([], SCHEMA), entries=300)


def test_shortlists_keep_every_nearest_entry():
    r = np.random.default_rng(5)
    entries = r.integers(-1000, 1000, (256, 4))
    settled, listed = 0, []
    for _ in range(200):
        x = r.integers(-1000, 1000, 4) + r.integers(-40, 40, (50, 4))
        near = vc.shortlist(x.min(0), x.max(0), entries)
        at, d = vc.nearest(x, entries[near])
        whole, dw = vc.nearest(x, entries)
        assert (near[at] == whole).all() and (d == dw).all()
        listed.append(len(near))
    assert np.mean(listed) < 64


def test_hilbert_neighbours():
    # in two dimensions all cells of the curve: each step goes to a touching cell
    bits = 16
    x = np.array([(i, j) for i in range(16) for j in range(16)])
    keys = vc.hilbert_keys(x * (1 << (bits - 4)), 0, 1 << bits)
    order = sorted(range(256), key=lambda i: keys[i])
    steps = [np.abs(x[a] - x[b]).sum() for a, b in zip(order, order[1:], strict=False)]
    assert len(set(keys)) == 256 and max(steps) == 1
    assert vc.hilbert_keys(np.zeros((2, 0), np.int64), 0, 1) == [b"", b""]


def test_ties_go_to_the_lower_entry():
    at, d = vc.nearest(np.array([[0, 0]]), np.array([[1, 0], [0, 1], [-1, 0]]))
    assert at.tolist() == [0] and d.tolist() == [1]
