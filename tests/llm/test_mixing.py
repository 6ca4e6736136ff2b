"""Mixing against a plain water filling, and what every mix must keep to."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from prodlake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes: dict, weights, share, most) -> dict:
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize("weights,share", [((3, 1, 2), 1.5), ((1, 9), 0.3), ((5, 1, 1), 2.0)])
def test_targets_and_words_taken(spark, docs, doc_rows, weights, share):
    got = mixing.mix_sources(docs, weights=weights, share=share).collect()
    size = lambda t: len(WORD.findall(t or ""))
    sizes: dict = {}
    for r in doc_rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    want = fill(sizes, weights, share, 2)
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"]) for r in got) == sorted((r[0] is None, r[0], size(r[1])) for r in doc_rows)
    taken: dict = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    biggest = max(size(r[1]) for r in doc_rows)
    assert all(abs(taken[s] - want[s]) <= biggest for s in want)
    assert sorted(map(str, mixing.mix_sources(docs.repartition(7), weights=weights, share=share).collect())) == sorted(map(str, got))


def test_many_rows_come_close_to_their_targets(spark):
    rows = spark.range(20000).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('w ', cast(1 + id % 17 as int))").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 10)).alias("source"),
    )
    got = mixing.mix_sources(rows).groupBy("source", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r["t"] - r["target"]) <= 17 for r in got)


def test_inclusion_odds_follow_the_preference(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("w w").alias("text"), F.lit("s").alias("source"), (1 + 8 * (F.col("id") % 2)).alias("like")
    )
    got = mixing.mix_sources(rows, share=0.5, preference_col="like").groupBy(F.col("doc_id") % 2).agg(F.avg("copies")).collect()
    low, high = (dict(map(tuple, got))[k] for k in (0, 1))
    # p / (1 - p) is nine times as large
    assert high > 0.7 and low < 0.3 and low + high == pytest.approx(1, abs=0.01)


def test_inclusion_odds_follow_the_size(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', 1 + 15 * cast(id % 2 as int))").alias("text"), F.lit("s").alias("source"))
    for by_size, ratio in ((0.5, 4.0), (0.0, 1.0)):
        got = mixing.mix_sources(rows, share=0.5, by_size=by_size)
        low, high = (dict(map(tuple, got.groupBy("size").agg(F.avg("copies")).collect()))[k] for k in (1, 16))
        assert high / (1 - high) / (low / (1 - low)) == pytest.approx(ratio, rel=0.2)
        taken, target = got.agg(F.sum("taken"), F.first("target")).first()
        assert abs(taken - target) <= 16


def test_extra_columns_empty_tables_and_no_python(spark, clashing, no_docs):
    out = mixing.mix_sources(clashing, carry=("doc_id", "copies"))
    assert out.filter("row.copies <> 'clash'").count() == 0 and out.count() == clashing.count()
    assert mixing.mix_sources(no_docs).collect() == []
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
