"""Decontamination against a plain search of all windows."""

from __future__ import annotations

import random
import re
from collections import Counter

from prodlake.llm import decontaminate
from tests.llm.conftest import words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text) -> list[str]:
    return WORD.findall((text or "").encode().lower().decode())


def expected(docs, items, window=10):
    found: dict = {}
    for item, text in items:
        w = split(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            found.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, names = split(text), set(), set()
        for n in {len(k) for k in found}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in found:
                    hit |= set(range(i, i + n))
                    names |= found[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), tuple(sorted(names))))
    return Counter(out)


def corpus() -> tuple[list, list]:
    r = random.Random(3)
    items = [(i, words(100 + i, r.randint(8, 40))) for i in range(12)]
    items += [(12, items[0][1]), (13, "Short item, HERE!"), (14, ""), (15, None), (None, words(99, 15)), (16, "a a a a a a a a a a a a"), (0, "other text of item zero with a few more words than ten in")]
    docs = []
    for i in range(40):
        w = words(200 + i, 60).split()
        if i % 3 == 0:
            part = items[r.randrange(12)][1].split()
            a = r.randrange(max(1, len(part) - 12))
            w[30:30] = part[a : a + r.randint(8, 20)]
        docs.append((i, " ".join(w)))
    docs += [(40, "x short ITEM here y short, item: here"), (41, "a " * 30), (42, None), (43, ""), (44, items[3][1] + "..." + items[3][1])]
    docs += [docs[0], docs[0], (None, items[1][1]), (45, words(99, 15)), (46, items[2][1].upper().replace(" ", "-"))]
    return docs, items


def test_whole_windows_and_short_items(spark):
    docs, items = corpus()
    got = decontaminate.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as key", "1 as pos", "2 as n_hit").repartition(3),
        spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as cls", "'y' as terms"),
    ).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got) == expected(docs, items)
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["spans"] or []) == r["n_hit"]


def test_proximity_is_told_from_phrases(spark):
    item = "zero one two rare four five six seldom eight nine"
    docs = [(1, item), (2, item.replace("rare", "rare and")), (3, "rare " + "w " * 30 + " seldom")]
    common = [(10 + i, "zero one two four five six eight nine") for i in range(5)]
    got = decontaminate.decontaminate(
        spark.createDataFrame(docs + common, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    )
    assert {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in got.filter("doc_id < 10").collect()} == {1: (10, 0), 2: (0, 1), 3: (0, 0)}


def test_empty_tables(spark, no_docs, docs):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(no_docs, no_items).collect() == []
    assert decontaminate.decontaminate(docs, no_items).filter("n_hit > 0").count() == 0
