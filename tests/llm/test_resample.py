"""Importance resampling: the k largest keys, and what a good draw prefers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from prodlake.llm import resample


def test_cut_is_the_k_largest(spark, monkeypatch):
    monkeypatch.setattr(resample, "FEW", 10)
    r = np.random.default_rng(2)
    keys = np.concatenate([r.normal(size=800), np.full(150, 0.25), [1e9, -1e9], r.normal(size=50) * 1e-9])
    frame = spark.createDataFrame([(i, float(k)) for i, k in enumerate(keys)], "id long, key double").cache()
    for k in (0, 1, 2, 300, 400, 450, 1001, 1002, 5000):
        got = {x["id"] for x in resample.cut_largest(frame, "key", k, [F.col("id")]).filter("selected").collect()}
        want = sorted(range(len(keys)), key=lambda i: (-keys[i], i))[:k]
        assert got == set(want)


def test_good_texts_are_drawn(spark):
    rows = [(i, f"fine words about the weather number {i % 7}" if i % 2 else f"BUY NOW!!! cheap pills offer {i % 5}") for i in range(600)]
    labels = [(i, i % 2, 0) for i in range(0, 600, 3)] + [(3, 1, 0), (None, 1, 0), (10**6, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = resample.resample(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), keep=0.5, buckets=1 << 12).cache()
    assert out.count() == 600 and out.filter("selected").count() == 300
    assert out.filter("selected and doc_id % 2 = 1").count() > 290
    got = dict(out.select("doc_id", "key").collect())
    again = resample.resample(docs.repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), keep=0.5, buckets=1 << 12)
    assert dict(again.select("doc_id", "key").collect()) == pytest.approx(got)


def test_weights_against_plain_counts(spark):
    """log_weight: the sum over a text's 1- and 2-grams of the log ratio of the
    target's and the raw texts' smoothed counts."""
    import math
    import random
    from collections import Counter

    import pyarrow as pa

    r = random.Random(4)
    rows = [(i, " ".join(r.choice("aa bb cc dd ee ff".split()) for _ in range(r.randint(0, 12)))) for i in range(80)] + [(80, None)]
    good = {i for i in range(0, 80, 3)}
    labels = [(i, 1 if i in good else 0, 0) for i in range(0, 60)] + [(1, 1, 1)]
    good = {i for i in good if i < 60}
    buckets = 1 << 12
    grams = {i: Counter(resample.features(pa.array([t]), buckets)[1].tolist()) for i, t in rows}
    raw, target = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in good:
            target.update(g)
    share = sum(target.values()) / sum(raw.values())
    docs, marked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for x in resample.resample(docs.repartition(3), marked, buckets=buckets).collect():
        g = grams[x["doc_id"]]
        want = sum(n * math.log((target[b] + 10) / (raw[b] * share + 10)) for b, n in g.items())
        assert x["n_grams"] == sum(g.values()) and x["log_weight"] == pytest.approx(want, abs=1e-9)
    few = resample.resample(docs, marked, buckets=buckets, max_labels=5).collect()
    assert len(few) == 81 and any(x["log_weight"] for x in few)


def test_draws_follow_the_weights(spark):
    u = np.random.default_rng(0).random(20000)
    keys = np.where(np.arange(20000) < 10000, np.log(3.0), 0.0) - np.log(-np.log(u))
    frame = spark.createDataFrame([(i, float(k)) for i, k in enumerate(keys)], "id long, key double")
    got = resample.cut_largest(frame, "key", 1000, [F.col("id")]).filter("selected and id < 10000").count()
    assert 680 < got < 820  # three in four, less a little for drawing without replacement


def test_odd_rows(spark, clashing, doc_rows, no_docs):
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = resample.resample(clashing, no_labels, keep=0.5).collect()
    assert len(got) == len(doc_rows) and sum(r["selected"] for r in got) == round(len(doc_rows) / 2)
    assert all(r["log_weight"] == 0 for r in got)
    assert resample.resample(no_docs, no_labels).collect() == []
