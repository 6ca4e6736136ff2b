"""Language-model scores: exact base scores, and a filter that never forgets."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from prodlake.llm import lm_score
from prodlake.llm.common import stage


def expected(rows) -> list[tuple]:
    out_of = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    count = Counter(x for (i, _), w in zip(rows, tokens, strict=True) if not out_of(i) for x in w)
    total, scale = sum(count.values()), sum(count.values()) + 0.5 * (len(count) + 1)
    return [
        (i, out_of(i), len(w), sum(count[x] > 0 for x in w), total, round(sum(math.log10((count[x] + 0.5) / scale) for x in w), 6))
        for (i, _), w in zip(rows, tokens, strict=True)
    ]


def test_base_scores(spark, clashing, doc_rows):
    got = lm_score.score_documents(clashing).collect()
    found = Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in got)
    assert found == Counter(expected([(r[0], r[1]) for r in doc_rows]))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_model_prefers_what_it_has_read(spark):
    good = [(i, "the cat sat on the mat and the dog sat on the rug") for i in range(40)]
    rows = [*good, (1001, "the cat sat on the rug"), (1002, "rug the on sat cat the")]
    got = lm_score.score_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    s = {r["doc_id"]: r["score"] for r in got.collect()}
    assert s[1001] > s[1002]


def test_empty_and_untaught(spark, no_docs):
    assert lm_score.score_documents(no_docs).collect() == []
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    got = lm_score.score_documents(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == pytest.approx(0) for r in got)


def test_filter_holds_quantised_counts():
    r = np.random.default_rng(3)
    gram = np.unique(r.integers(0, 2**63, 20000).astype(np.uint64))
    count = np.minimum(1 + r.pareto(0.8, len(gram)).astype(np.int64), 10**9)
    f = lm_score.LogFrequencyFilter.fill(gram, count, 1.5, 4, 12)
    level, got = f.level(count, 1.5), f.levels(gram)
    # never below the count's own level, and seldom above it
    assert (got >= level).all() and (got == level).mean() > 0.95
    unknown = f.levels(r.integers(2**63, 2**64, 20000, dtype=np.uint64) | np.uint64(1))
    assert (unknown > 0).mean() < 0.06
    none = lm_score.LogFrequencyFilter.fill(gram[:0], count[:0], 1.5, 4, 12)
    assert (none.levels(gram) == 0).all()


def test_levels_stand_for_the_middle_of_their_counts():
    level = np.arange(0, 30)
    got = lm_score.middle(level, 1.5)
    assert got[0] == 0 and got[1] == 1 and (np.diff(got) > 0).all()
    assert ((got[1:] >= 1.5 ** (level[1:] - 1.0)) & (got[1:] <= 1.5 ** level[1:])).all()


def test_a_changed_block_fails(spark):
    rows = pa.table({"doc_id": [1], "held_out": [False], "block": ["0-0"], "n_words": [2], "n_pairs": [1], "end_no": [0], "seq": [lm_score.packed_numbers(np.zeros(1, np.int32))]})
    answers = pa.table({c: pa.array([], pa.binary()) for c in lm_score._ANSWERED[:6]})
    with pytest.raises(RuntimeError, match="input changed"):
        lm_score._scores(1.5, 50.0, 10.0)(rows, answers)


@pytest.mark.parametrize("slices", [1, 2, 7, 70_000])
def test_every_gram_has_one_slice(slices):
    h = np.random.default_rng(4).integers(0, 2**64, 3000, dtype=np.uint64)
    found = lm_score._by_slice(h, slices)
    assert sorted(np.concatenate(list(found.values())).tolist()) == list(range(3000)) and max(found) < slices


@pytest.mark.parametrize("partitions", [1, 4])
def test_scores_hold_all_ngrams(spark, doc_rows, partitions):
    """Against plain Python; at this size the filter has hardly a false answer."""
    rows = [(i, t) for i, t, *_ in doc_rows]
    tokens = [[None, *(t or "").encode().lower().split(), None] for _, t in rows]
    single, double = Counter(), Counter()
    for (i, _), w in zip(rows, tokens, strict=True):
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            single.update(w[1:])
            double.update(zip(w[:-1], w[1:], strict=True))
    bottom = sum(single.values()) + 0.5 * (len(single) + 1)

    def f(c):
        least = 1.5 ** math.floor(math.log(c) / math.log(1.5) + 1e-9) if c else 0.0
        return (least + max(1.5 * least - 1, least)) / 2

    def p(v, w):
        fv, fw = f(single[v]), f(single[w])
        return (min(f(double[v, w]), fv, fw) + 50 * (fw + 0.5) / bottom) / (fv + 50)

    want = sorted((str(i), sum(math.log10(p(v, w)) for v, w in zip(t[:-1], t[1:], strict=True))) for (i, _), t in zip(rows, tokens, strict=True))
    docs = stage(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "lm-test")
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        # with many bits a level the filter has hardly a false answer; by default a few in a hundred
        got, few = (sorted((str(r["doc_id"]), r["score"]) for r in lm_score.score_documents(docs, **more).collect()) for more in ({"bits_per_level": 256.0}, {}))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert [g[0] for g in got] == [x[0] for x in want]
    assert [g[1] for g in got] == pytest.approx([x[1] for x in want], rel=1e-3)
    assert [g[1] for g in few] == pytest.approx([x[1] for x in want], rel=0.02)
