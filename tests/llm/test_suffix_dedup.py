"""Substring deduplication against counting every window."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from prodlake.llm import suffix_dedup

LENGTH = 100


def expected(rows, length=LENGTH) -> Counter:
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[a : a + length] for _, b in data for a in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if count[b[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not h for g, h in zip(gone, bytes([0]) + bytes(gone), strict=False))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def corpus(seed: int) -> list[tuple]:
    r = random.Random(seed)
    text = lambda n: "".join(r.choice("abcdé ") for _ in range(n))
    passages = [text(n) for n in (90, 99, 101, 130, 250, 900)]
    rows = []
    for _ in range(40):
        parts = [text(r.randint(0, 200))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randrange(0, len(p) // 2)
            parts += [p[a : a + r.randint(50, 900)], text(r.randint(0, 150))]
        rows.append("".join(parts))
    rows += [rows[0], rows[0], "", None, "z" * 700, "z" * 99, "z" * 100, "ab" * 300, passages[5] * 2, text(3000)]
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,batches", [(1, 4), (2, 1)])
def test_random_corpora(spark, monkeypatch, seed, batches):
    monkeypatch.setattr(suffix_dedup, "SLICE", 1500)  # long rows come in pieces
    rows = corpus(seed)
    rows += [rows[3], (None, rows[4][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as doc", "1 as place", "2 as run").repartition(3)
    got = suffix_dedup.remove_repeats(docs, length=LENGTH, batches=batches)
    kept = got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, kept)) == expected(rows)


def test_odd_rows_at_full_length(spark, clashing, doc_rows, no_docs):
    got = suffix_dedup.remove_repeats(clashing).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == expected([(r[0], r[1]) for r in doc_rows], 400)
    assert suffix_dedup.remove_repeats(no_docs).collect() == []


def test_every_window_belongs_to_one_sampled_suffix():
    r = np.random.default_rng(1)
    raw = r.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 700, 750, 3000, 5000])
    row, a, lo, hi, core, run = suffix_dedup.sample(raw, offsets, LENGTH)
    starts = np.concatenate([np.arange(x, y + 1) for x, y in zip(lo, hi, strict=True)])
    want = np.concatenate([np.arange(s, e - LENGTH + 1) for s, e in zip(offsets[:-1], offsets[1:], strict=True) if e - s >= LENGTH])
    assert (starts == want).all() and (a >= hi).all() and (a + suffix_dedup.CORE <= lo + LENGTH).all()
    x = r.integers(0, 1000, 300).astype(np.uint64)
    assert suffix_dedup.sliding_min(x, 7).tolist() == [int(x[i : i + 7].min()) for i in range(294)]


def test_levels_are_powers_of_two(spark):
    index = suffix_dedup.SuffixLevels()
    sizes = []
    for i in range(5):
        rows = [(j, 10 * j + i % 2, i, j) for j in range(i + 1)]
        again = index.add(spark.createDataFrame(rows, "core long, run long, doc long, place long"))
        assert {r["core"] for r in again.collect()} == (set(range(i)) if i else set())
        sizes.append([n for n, _ in index.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]
    found = {(r["core"], r["run"]): r["n"] for r in index.entries(spark.createDataFrame([(1,)], "core long")).collect()}
    assert found == {(1, 11): 2, (1, 10): 2}
