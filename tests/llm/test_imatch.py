"""Fingerprints: neighbours, edited texts, and what likeness must keep to."""

from __future__ import annotations

import hashlib
import random
import re

from prodlake.llm import imatch
from tests.llm.conftest import words


def edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_neighbours_and_edited_texts(spark):
    rows = [(i * i * 7919 % 100003, words(i, i % 40)) for i in range(150)] + [(5, "é😀 x"), (10**12, "far away"), (200000, None), (-3, "")]
    rows = list(dict(rows).items())
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as tie", "'c' as range").repartition(4)
    out = imatch.fingerprints(docs)
    order = sorted((i, t or "") for i, t in rows)
    want = {i: (len(t), sha(edited(t, order[(k + 1) % len(order)][1]))) for k, (i, t) in enumerate(order)}
    got = out.collect()
    assert len(got) == len(rows) and {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())


def test_equal_and_near_texts(spark):
    base = [words(i, 400) for i in range(60)]
    near = base[0].split()
    near[100] = "elsewhere"
    rows = [(i, t) for i, t in enumerate([*base, base[0], " ".join(near), base[1].upper()])]
    rows += [(70, base[2]), (71, base[2]), (71, base[2]), (None, base[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = imatch.fingerprints(docs, lowest=0.01, highest=0.3).collect()
    prints: dict = {}
    for r, t in ((r, dict(rows).get(r["doc_id"])) for r in got):
        prints.setdefault(t, set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert len(got) == len(rows) and all(len(p) == 1 for p in prints.values())
    same = {r["doc_id"]: r["near_next"] for r in got}
    assert same[70] == 1.0
    split = lambda t: next(iter(prints[t])).split("-")
    alike = lambda a, b: sum(x == y != "0" for x, y in zip(split(a), split(b), strict=True)) / sum(x != "0" or y != "0" for x, y in zip(split(a), split(b), strict=True))
    assert alike(base[0], " ".join(near)) > 0.8 > 0.2 > alike(base[0], base[5])


def test_odd_rows(spark, clashing, doc_rows, no_docs):
    got = imatch.fingerprints(clashing).collect()
    assert len(got) == len(doc_rows) and all(r["fingerprint"] for r in got)
    assert imatch.fingerprints(no_docs).collect() == []
    one = imatch.fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == sha(edited("abcd", "abcd")) and one["near_next"] == 1.0


def test_term_rows_hold_no_text(spark):
    """A text is hashed, sorted and measured before its terms are laid out, each in
    a row; a row for each term with the whole text in it is quadratic."""
    docs = spark.createDataFrame([(i, words(i, 50)) for i in range(20)], "doc_id long, text string")
    plan = imatch.fingerprints(docs)._jdf.queryExecution().optimizedPlan()
    found, open_ = [], [plan]
    while open_:
        node = open_.pop()
        below = node.children()
        open_ += [below.apply(i) for i in range(below.size())]
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        if node.nodeName() == "Generate" and "term" in names:
            found.append(names)
    assert found and not any({"text", "next_text", "words"} & set(names) for names in found)
    # a sort by a lambda function keeps the rows of terms out of generated code
    assert "lambdafunction(if" not in plan.toString()


def test_subset_hashes(spark):
    r = random.Random(3)
    any_mask = lambda: sum(1 << k for k, rate in enumerate(imatch.RATES) if r.randrange(rate) == 0)
    lists = [(i, sorted((r.getrandbits(63), any_mask()) for _ in range(i * 7 % 90))) for i in range(60)]
    df = spark.createDataFrame(lists, "id long, kept array<struct<code: long, subsets: long>>")
    got = {row["id"]: row["hashes"] for row in imatch.subset_hashes(df).collect()}
    codes = [(i, k, [c for c, m in kept if m >> k & 1]) for i, kept in lists for k in range(len(imatch.RATES))]
    want = spark.createDataFrame(codes, "id long, k int, codes array<long>").selectExpr("id", "k", "if(size(codes) > 0, xxhash64(codes), 0) as h")
    assert all(got[row["id"]][row["k"]] == row["h"] for row in want.collect()) and len(got) == len(lists)
    assert len({h for hashes in got.values() for h in hashes}) > 500
