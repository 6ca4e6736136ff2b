"""Language ID: held-out accuracy, and texts that have no language."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prodlake.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.98 and 0 <= right[1] <= right[2] <= 1


def test_prediction_looks_at_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    a = dict(langid.identify(docs).select("doc_id", "lang_pred").filter("doc_id < 300").collect())
    # held-out rows' own labels change nothing
    wrong = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    b = langid.identify(wrong).filter("held_out and doc_id < 300").collect()
    assert b and all(r["lang_pred"] == a[r["doc_id"]] for r in b)


def test_no_language(spark, clashing, no_docs, doc_rows):
    got = langid.identify(clashing).collect()
    assert len(got) == len(doc_rows)
    und = sorted(r["doc_id"] for r in got if r["lang_pred"] == "und" and r["doc_id"] is not None)
    assert und == [r[0] for r in doc_rows if r[0] is not None and not any(c.isalpha() for c in r[1] or "")]
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    assert langid.identify(no_docs).collect() == []
    untaught = clashing.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(untaught).collect()} == {"und"}


def test_filter_answers_all_languages_of_a_gram():
    r = np.random.default_rng(1)
    languages = [f"l{i:02d}" for i in range(20)]
    gram = r.integers(0, 2**63, 5000).astype(np.uint64)
    lang = r.integers(0, 20, 5000)
    f = langid.LanguageFilter.build(languages, np.concatenate([gram, gram]), np.concatenate([lang, (lang + 1) % 20]))
    bits = f.containing(gram)
    rows = np.arange(5000)
    assert bits[rows, lang].all() and bits[rows, (lang + 1) % 20].all()
    other = f.containing(r.integers(0, 2**63, 20000).astype(np.uint64)).mean(axis=0)
    assert np.allclose(other, f.false_rate, atol=0.01)


def test_long_texts_count_every_gram_once(monkeypatch):
    import pyarrow as pa

    text = "der die das und ÄÖ 12 \U0001f600 x" * 40
    texts = pa.array([text, None, "a", "", "bc" * 30])

    def all_grams():
        got = [langid.grams(*x) for x in langid._batches(texts)]
        return sorted(zip(*[np.concatenate(x).tolist() for x in zip(*got, strict=True)], strict=True))

    whole = all_grams()
    for size in (1, 2, 3, 7, 100):
        monkeypatch.setattr(langid, "SLICE_CHARS", size)
        assert all_grams() == whole


def test_learned_filter_holds_every_gram(spark, docs, doc_rows):
    import pyarrow as pa

    model = langid.learn(docs.select("text", "lang"))
    assert model.languages == sorted({r[2] for r in doc_rows if r[2] and r[1]})
    for _, text, lang, *_ in doc_rows:
        if text and lang and any(c.isalpha() for c in text):
            for x in langid._batches(pa.array([text])):
                assert model.containing(langid.grams(*x)[1])[:, model.languages.index(lang)].all()
    # as filled in one place
    gram, code = [], []
    for _, text, lang, *_ in doc_rows:
        for x in langid._batches(pa.array([text])) if text and lang else ():
            h = np.unique(langid.grams(*x)[1])
            gram.append(h)
            code.append(np.full(len(h), model.languages.index(lang)))
    both = np.unique(np.stack([np.concatenate(code).astype(np.uint64), np.concatenate(gram)]), axis=1)
    other = langid.LanguageFilter.build(model.languages, both[1], both[0].astype(np.int64))
    assert (other.slots == model.slots).all()


def test_a_full_filter_still_answers(monkeypatch):
    monkeypatch.setattr(langid, "MOST_BYTES", 1 << 12)
    r = np.random.default_rng(2)
    gram, lang = r.integers(0, 2**63, 3000).astype(np.uint64), r.integers(0, 3, 3000)
    f = langid.LanguageFilter.build(["a", "b", "c"], gram, lang)
    assert f.slots.nbytes == 1 << 12 and f.containing(gram)[np.arange(3000), lang].all() and (f.false_rate > 0.05).all()


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    rows = spark.createDataFrame([("abc", x) for x in "pqr"], "text string, lang string")
    with pytest.raises(ValueError, match="more than 2 languages"):
        langid.learn(rows)


def test_memory_of_a_batch_follows_the_slice():
    """Eight million characters in one batch, read in slices."""
    import tracemalloc

    model = langid.LanguageFilter.of(["de", "en"], np.zeros((1 << 12, 1), np.uint8))
    texts = pa.array(["some words of a text " * 2000] * 200)
    assert texts.nbytes > 8_000_000
    model.detect(texts.slice(0, 1))
    tracemalloc.start()
    langs, _ = model.detect(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(langs) == 200
    assert peak < 32 << 20
