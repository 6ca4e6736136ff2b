"""The Jaccard join against all pairs."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from prodlake.llm import graph, jaccard_join
from tests.llm.conftest import words


def shingles(text, n=4) -> frozenset:
    w = (text or "").encode().lower().split()
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def components(ids, links) -> dict:
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def expected(rows, percent=85) -> dict:
    sets = {i: shingles(r[1]) for i, r in enumerate(rows)}
    links = []
    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links.append((i, j))
    group = components(sets, links)
    least: dict = {}
    for i, g in group.items():
        if rows[i][0] is not None:
            least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    return Counter((rows[i][0], len(sets[i]), least.get(group[i])) for i in sets)


def corpus(seed: int) -> list[tuple]:
    """Chains and stars of near copies, shared passages, tiny texts."""
    r = random.Random(seed)
    rows = []
    for g in range(12):
        text = words(1000 * seed + g, r.randint(3, 90)).split()
        for _ in range(r.randint(1, 9)):
            text = list(text)
            for _ in range(r.randint(0, 3)):
                text[r.randrange(len(text))] = f"new{r.randrange(10**6)}"
            rows.append(" ".join(text))
    common = words(7, 25)
    rows += [words(500 + i, 30) + " " + common for i in range(15)]
    rows += ["a", "A", "a b c", "a b c d", "a  b\tc d", "b", "", None, rows[0], rows[0].upper()]
    r.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed,rounds", [(1, 3), (2, 0)])
def test_components_of_random_corpora(spark, monkeypatch, seed, rounds):
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", 3)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 100)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_join.similarity_classes(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == expected(rows)


def test_extended_and_cut_texts(spark):
    """A copy's new shingles are the rarest and fill its prefix, the original's
    prefix holds shingles that the copy has behind its own."""
    rows = []
    for g in range(8):
        text, more = words(9000 + g, 103 + 20 * g).split(), words(9500 + g, 10 + 2 * g).split()
        rows += [" ".join(text), " ".join([text + more, more + text, text[: -len(more)], text[len(more) :]][g % 4])]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.similarity_classes(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == expected(rows)
    assert all(r["component_id"] == r["doc_id"] // 2 * 2 for r in got)


def test_search_counts_lists_of_both_main_components(spark):
    """Classes 1 (of 1, 2) and 3 (of 3, 4) share six lists, and each is in the
    largest component of three of them."""
    comp = {1: 1, 2: 1, 3: 3, 4: 3}
    lists = {t: (1, 2, 3) if t < 3 else (1, 3, 4) for t in range(6)}
    rows = [(t, c, 30, 30, comp[c]) for t, members in lists.items() for c in members]
    opened = spark.createDataFrame(rows, "token long, cls long, n int, most int, comp long")
    homes = spark.createDataFrame([(c, 10 * (c > 2)) for c in comp], "cls long, home long")
    got = jaccard_join._candidates(opened, homes, 85, len(rows)).collect()
    assert {(r["a"], r["b"], u, v) for r in got for u, v in zip(r["u"], r["v"], strict=True)} == {(0, 10, 1, 3)}


def near_misses(seed: int) -> list[tuple]:
    """Texts around one, of which most nearly link and some do."""
    r = random.Random(seed)
    base, rows = words(300 + seed, 300).split(), []
    for i in range(60):
        text = list(base)
        for at in r.sample(range(300), r.choice([2, 3, 4, 5, 6])):
            text[at] = f"own{i}x{at}"
        rows.append(" ".join(text))
    rows += [words(700 + i, 40) for i in range(5)]
    return list(enumerate(rows))


@pytest.mark.parametrize("dense,rounds", [(0.25, 3), (0.0, 0), (100.0, 0), (0.25, 0)])
def test_groups_of_near_misses(spark, monkeypatch, dense, rounds):
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "DENSE", dense)
    monkeypatch.setattr(jaccard_join, "BLOCK_CLASSES", 16)
    rows = near_misses(rounds)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_join.similarity_classes(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == expected(rows)
    assert 1 < len({r["component_id"] for r in got}) < len(rows)


def test_search_inside_blocks_against_all_pairs():
    r = np.random.default_rng(8)
    for trial in range(10):
        pool = np.unique(r.integers(0, 2**63, 70).astype(np.uint64))
        sets = [np.unique(r.choice(pool, r.integers(1, 60))) for _ in range(25)]
        cls = r.permutation(1000)[:25].astype(np.int64)
        u, v = r.integers(0, 25, (2, 80))
        u, v = u[u != v], v[u != v]
        got = set(jaccard_join.links_between([(cls[u], cls[v])], cls, sets, 60))
        both = lambda i, j: len(np.intersect1d(sets[i], sets[j]))
        true = {(int(cls[i]), int(cls[j])) for i, j in zip(u, v, strict=True) if 100 * both(i, j) >= 60 * (len(sets[i]) + len(sets[j]) - both(i, j))}
        assert got == true


@pytest.mark.parametrize("least", [1, 3, 8])
def test_overlaps_count_members_of_enough_lists(least):
    r = np.random.default_rng(least)
    for _ in range(30):
        lists = [np.unique(r.integers(0, 40, r.integers(0, 30))) for _ in range(r.integers(0, 12))]
        want = np.bincount(np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64), minlength=40)
        got = jaccard_join.overlaps(lists, least, 40)
        assert (got[want >= least] == want[want >= least]).all() and (got[want < least] < least).all()


def test_short_lists_are_counted_not_probed(monkeypatch):
    r = np.random.default_rng(4)
    lists = [np.unique(r.integers(0, 300, 280)) for _ in range(400)]
    want = np.bincount(np.concatenate(lists), minlength=300)
    calls, probe = [], np.searchsorted
    monkeypatch.setattr(jaccard_join.np, "searchsorted", lambda *a, **k: calls.append(1) or probe(*a, **k))
    assert (jaccard_join.overlaps(lists, 100, 300) == want).all() and not calls
    monkeypatch.setattr(jaccard_join, "PROBED", 100)
    assert (jaccard_join.overlaps(lists, 100, 300) == want).all() and calls


def asked_lists(seed: int) -> tuple[list[dict], set]:
    """Lists of members that queries ask, sorted, and the candidate pairs."""
    r = np.random.default_rng(seed)
    rows, true = [], set()
    for q in range(1000, 1040):
        for block in range(2):
            count: Counter = Counter()
            for _ in range(r.integers(1, 12)):
                cls = np.sort(r.choice(np.arange(block, 30, 2), r.integers(1, 9), replace=False)).tolist()
                count.update(cls)
                member = {"m_cls": cls, "m_n": [30] * len(cls), "m_comp": [c % 5 for c in cls], "m_most": [30] * len(cls), "m_home": [c % 3 for c in cls]}
                rows.append({"q": q, "block": block, "qn": 30, "qcomp": q % 5, "qmost": 30, "qhome": 1} | member)
            # 4 of the lists, and with the 22 behind a prefix an overlap of 28
            true |= {frozenset((q, c)) for c, k in count.items() if k >= 6 and c % 5 != q % 5}
    return rows, true


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_queries_searched_in_a_stream(size):
    import pyarrow as pa

    rows, true = asked_lists(size)
    kinds = {"m_cls": pa.int64(), "m_n": pa.int32(), "m_comp": pa.int64(), "m_most": pa.int32(), "m_home": pa.int64()}
    ask = {"q": pa.int64(), "block": pa.int32(), "qn": pa.int32(), "qcomp": pa.int64(), "qmost": pa.int32(), "qhome": pa.int64()}
    schema = pa.schema([*ask.items(), *[(c, pa.list_(k)) for c, k in kinds.items()]])
    batches = pa.Table.from_pylist(rows, schema).to_batches(max_chunksize=size)
    found = [x for b in jaccard_join._searched(iter(batches), 85) for x in b.to_pylist()]
    pairs = [frozenset(p) for x in found for p in zip(x["u"], x["v"], strict=True)]
    assert set(pairs) == true and len(pairs) == len(true) and true
    assert all(x["a"] <= x["b"] for x in found)


def test_shingle_rows_of_short_and_empty_texts():
    import pyarrow as pa

    texts = ["a b c d a b c d a b", None, "a", "", "a b c d e", " ", "a b c", "A b C"]
    flat, off = jaccard_join.shingle_rows(pa.array(texts))
    assert np.diff(off).tolist() == [len(shingles(t)) for t in texts]
    for a, e in zip(off[:-1], off[1:], strict=True):
        assert (np.diff(flat[a:e]) > 0).all()
    cls = jaccard_join.classes_of(flat, off)
    assert cls[6] == cls[7] and cls[1] == cls[3] == cls[5] and len(set(cls.tolist())) == 5


def test_odd_rows(clashing, doc_rows, no_docs):
    got = jaccard_join.similarity_classes(clashing).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == expected(doc_rows)
    assert jaccard_join.similarity_classes(no_docs).collect() == []


@pytest.mark.parametrize("least", [1, 2, 5, 9])
def test_divide_skip_counts_occurrences(least):
    r = np.random.default_rng(least)
    for _ in range(30):
        lists = [np.unique(r.integers(0, 60, r.integers(0, 50))) for _ in range(r.integers(1, 12))]
        count = Counter(int(x) for part in lists for x in part)
        assert set(jaccard_join.divide_skip(lists, least).tolist()) == {x for x, k in count.items() if k >= least}


def test_needed_overlap_is_exact():
    for a in range(1, 60):
        for b in range(1, 60):
            need = jaccard_join.overlap_needed(a, b, 85)
            ok = [i for i in range(min(a, b) + 1) if 100 * i >= 85 * (a + b - i)]
            assert need == (ok[0] if ok else need) and (ok or need > min(a, b))


def test_components_against_union_find(spark):
    r = random.Random(5)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(links, "u long, v long")).collect()))
    ids = {x for a, b in links if a != b for x in (a, b)}
    assert got == components(ids, links_in(links))
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


def links_in(links):
    return [(a, b) for a, b in links if a != b]
