"""Word hashes of whole columns against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from prodlake.llm import common
from prodlake.llm.common import ALNUM, NOT_SPACE, hash_words, ngram_hashes, row_slices, text_bytes

TEXTS = ["Ab  c\tD", None, "", " x", "y ", "é É a", "a" * 50 + " b", "one\x0btwo\x0cthree", "q-w_e r.t 12é"]
PATTERNS = {"space": (NOT_SPACE, r"[^\x20\x09-\x0D]+"), "alnum": (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")}


def low(text: str) -> str:
    return (text or "").encode().lower().decode()


@pytest.mark.parametrize("kind", PATTERNS)
@pytest.mark.parametrize("size", [8, 16, 1 << 20])
def test_same_words_same_hashes(kind, size, monkeypatch):
    word, pattern = PATTERNS[kind]
    monkeypatch.setattr(common, "SLICE_BYTES", size)
    h, off = hash_words(pa.array(TEXTS), word)
    want = [re.findall(pattern, low(t)) for t in TEXTS]
    assert list(np.diff(off)) == [len(w) for w in want]
    flat = [x for w in want for x in w]
    by_word: dict[str, set] = {}
    for x, y in zip(flat, h.tolist(), strict=True):
        by_word.setdefault(x, set()).add(y)
    assert all(len(v) == 1 for v in by_word.values())
    assert len({next(iter(v)) for v in by_word.values()}) == len(by_word)


def test_slices_of_a_column_see_their_own_rows():
    arr = pa.array(["skip", "a b", None, "c"])
    raw, off = text_bytes(arr.slice(1))
    assert raw.tobytes() == b"a bc" and off.tolist() == [0, 3, 3, 4]
    assert len(hash_words(pa.array([], pa.string()))[0]) == 0


def test_row_slices_cover_all_rows():
    b = pa.RecordBatch.from_arrays([pa.array(["a" * 10, "b" * 100, None, "c"] * 3)], names=["t"])
    parts = list(row_slices(b, 0, most=50))
    assert pa.Table.from_batches(parts).to_pylist() == b.to_pylist() and len(parts) > 3


def test_ngrams_depend_on_order_and_length():
    h, _ = hash_words(pa.array(["a b a b c"]))
    g = ngram_hashes(h, 2)
    assert g[0] == g[2] and g[0] != g[1] and len(ngram_hashes(h, 6)) == 0


def test_memory_follows_the_slice():
    """Eight megabytes of words: what is held beside the result is a small part of it."""
    import tracemalloc

    texts = pa.array([("x" * 100 + " ") * 2000] * 40)
    common.hash_words(texts)
    tracemalloc.start()
    h, rows = common.hash_words(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(h) == 80_000 and rows[-1] == len(h)
    assert peak < 16 << 20
