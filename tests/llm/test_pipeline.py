"""The pipeline against its stages done by plain Python, on a small table."""

from __future__ import annotations

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from prodlake.llm import registry
from prodlake.llm.common import BATCH_BYTES, BATCH_SETTING, bounded_batches
from prodlake.llm.jaccard_join import similarity_classes
from tests.llm.conftest import SCHEMA, words
from tests.llm.test_decontaminate import expected as hits
from tests.llm.test_jaccard_join import expected as classes
from tests.llm.test_mixing import fill
from tests.llm.test_secrets import base

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEMS = [(1, words(900, 14)), (2, "tiny item")]


def rows() -> list[tuple]:
    texts = [words(i, 80) for i in range(30)]
    near = texts[0].split()
    near[40] = "other"
    texts += [texts[0], " ".join(near), texts[1], words(40, 50) + " " + ITEMS[0][1], "see the tiny, ITEM here " + words(41, 20)]
    texts += [words(42, 20) + " password = hunter2hunter2 " + words(43, 20), "", None, "1234 !!", words(44, 3000)]
    out = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return [*out, out[5], out[5]]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_against_plain_python(spark, folder):
    left = [r for r in rows() if any(c.isalpha() for c in r[1] or "")]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = iter(corpus_pipeline.STAGES)

    def step():
        nonlocal docs
        _, apply = next(stages)
        docs = corpus_pipeline.stage(apply(spark, docs, folder), "test-stage")
        return docs

    assert sorted(map(tuple, step().collect())) == sorted(left)

    least = {group for _, _, group in classes(left)}
    left = sorted({r for r in left if r[0] in least})
    assert sorted(map(tuple, step().collect())) == left

    clean = {doc for doc, _, n, _ in hits([(r[0], r[1]) for r in left], ITEMS) if not n}
    assert len(clean) < len(left)
    left = [r for r in left if r[0] in clean]
    assert sorted(map(tuple, step().collect())) == left

    assert sum(bool(base(r[1])) for r in left) == 1
    left = [(i, t := text.replace("hunter2hunter2", "[SECRET]"), lang, source, len(t)) for i, text, lang, source, _ in left]
    assert step().schema.names == [f.split()[0] for f in SCHEMA.split(", ")]
    assert sorted(map(tuple, docs.collect())) == left

    got = step().collect()
    sizes: dict = {}
    for r in left:
        sizes[r[3]] = sizes.get(r[3], 0) + len(WORD.findall(r[1]))
    want = fill(sizes, (3, 1, 2), 1.5, 2)
    assert {tuple(r)[:5] for r in got} <= set(left) and len({r["doc_id"] for r in got}) == len(got)
    for s, target in want.items():
        assert abs(sum(r["copies"] * len(r["text"].split()) for r in got if r["source"] == s) - target) <= 3000
        assert all(r["target"] == pytest.approx(target) and 1 <= r["copies"] <= 2 for r in got if r["source"] == s)


def test_run_is_the_stages_one_after_another(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, apply in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(apply(spark, docs, folder), "test-stage")
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_rows(spark, folder, clashing, no_docs, k):
    _, apply = corpus_pipeline.STAGES[k]
    out = apply(spark, clashing, folder)
    assert out.schema.names[: len(clashing.columns)] == clashing.columns and out.count() > 0
    assert apply(spark, no_docs, folder).count() == 0


def test_registered_queries():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and set(registry.queries()) <= set(names)


@pytest.fixture()
def no_bound(spark):
    was = spark.conf.get(BATCH_SETTING, None)
    spark.conf.unset(BATCH_SETTING)
    yield
    spark.conf.unset(BATCH_SETTING) if was is None else spark.conf.set(BATCH_SETTING, was)


def batch_bytes(spark) -> list[int]:
    """Bytes of each batch in which 3000 rows of 3000 characters reach Python."""
    wide = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 3000).alias("text"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    return [r["n"] for r in wide.mapInArrow(run, "n bigint").collect()]


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_rows_of_a_stage_reach_python_in_bounded_batches(spark, folder, no_bound, k):
    corpus_pipeline.STAGES[k][1](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    sizes = batch_bytes(spark)
    assert sum(sizes) >= 3000 * 3000 and max(sizes) <= BATCH_BYTES + 10_000


def test_the_join_alone_bounds_its_batches(spark, folder, no_bound):
    similarity_classes(spark.read.parquet(f"{folder}/documents.parquet"))
    assert max(batch_bytes(spark)) <= BATCH_BYTES + 10_000


def test_a_bound_of_the_caller_stays(spark, no_bound):
    spark.conf.set(BATCH_SETTING, "1m")
    bounded_batches(spark)
    assert spark.conf.get(BATCH_SETTING) == "1m" and max(batch_bytes(spark)) <= (1 << 20) + 10_000
