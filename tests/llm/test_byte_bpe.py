"""Encoding against the tiktoken library; decoding against the texts."""

from __future__ import annotations

import base64
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from prodlake.llm import byte_bpe
from prodlake.llm.common import ship, stage
from prodlake.llm.registry import queries
from pyspark.sql import functions as F

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
HARD = [
    "a" * 1000,
    "aaaaaaa aa aaa",
    " " * 3000 + "x" + "\n\n \t\n",
    "don't we'll DON'T 'S's",
    "é" * 77 + "中文字 हिन्दी \U0001f600\U0001f600",
    "͸՘abc࢏xyz 12\U0003e9f8 ⺟",  # unassigned or newer than the library's Unicode
    "<|endoftext|> is text",
    "\x00\x1c\x1d\x85   end ",
]


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary(byte_bpe.read_vocabulary(PATH))


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def encoded(docs, **more):
    return byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN, **more)


def test_replay_as_the_library(vocabulary):
    whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=vocabulary.ranks, special_tokens={})
    r = random.Random(3)
    words = list({"".join(r.choice("aabcdet hé中\n") for _ in range(r.randint(1, 60))) for _ in range(3000)})
    ids, begin = byte_bpe.replay([w.encode() for w in words], vocabulary)
    for i, w in enumerate(words):
        assert ids[begin[i] : begin[i + 1]].tolist() == whole.encode_ordinary(w)


def test_ranks_that_do_not_follow_their_merges():
    for seed in range(60):
        r = random.Random(seed)
        longer = list({bytes(r.choice(b"abc") for _ in range(r.randint(2, 6))) for _ in range(40)})
        r.shuffle(longer)
        tokens = [bytes([x]) for x in range(256)] + longer
        v = byte_bpe.Vocabulary(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
        whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=v.ranks, special_tokens={})
        words = list({bytes(r.choice(b"abc") for _ in range(r.randint(1, 30))) for _ in range(100)})
        ids, begin = byte_bpe.replay(words, v)
        for i, w in enumerate(words):
            assert ids[begin[i] : begin[i + 1]].tolist() == whole.encode_ordinary(w.decode())
            assert byte_bpe.encode_alone(w, v) == whole.encode_ordinary(w.decode())


def test_no_words(vocabulary):
    ids, begin = byte_bpe.replay([], vocabulary)
    assert len(ids) == 0 and begin.tolist() == [0]


def test_documents(spark, docs, doc_rows, library):
    ship(spark)
    rows = [(*r, i) for i, r in enumerate(doc_rows)] + [(900 + i, t, None, None, 0, 900 + i) for i, t in enumerate(HARD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row int")
    out = encoded(df, keep=("doc_id", "row"))
    found = out.select("doc_id", "row", "ids", byte_bpe.decoder(df, PATH)(F.col("ids")).alias("bytes")).collect()
    assert len(found) == len(rows)
    source = {r[-1]: r for r in rows}
    for r in found:
        text = source[r["row"]][1] or ""
        assert r["doc_id"] == source[r["row"]][0]
        assert r["ids"] == library.encode_ordinary(text)
        assert bytes(r["bytes"]) == text.encode()


def test_many_blocks(spark, doc_rows, library):
    ship(spark)
    df = spark.createDataFrame([(r[0], r[1]) for r in doc_rows], "doc_id long, text string").repartition(5)
    found = encoded(stage(df, "bpe-test"), keep=("doc_id", "text")).collect()
    assert len(found) == len(doc_rows)
    assert all(r["ids"] == library.encode_ordinary(r["text"] or "") for r in found)


def test_blocks_are_cut_by_size(monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 300)
    texts = ["one two three " * 10, None, "", "four " * 100, "one"] * 3
    batches = pa.table({"text": pa.array(texts, pa.string())}).to_batches(max_chunksize=4)
    blocks = list(byte_bpe._blocks(iter(batches), byte_bpe.Splitter(public_tokenizers.PATTERN, ""), 0))
    assert len(blocks) > 3 and len({b[0] for b in blocks}) == len(blocks)
    read = []
    for _, rows, sequences, numbers in blocks:
        words = list(numbers)
        assert sum(r.num_rows for r in rows) == len(sequences)
        read += ["".join(words[i] for i in byte_bpe._unpacked(byte_bpe._packed(s))) for s in sequences]
    assert read == [t or "" for t in texts]


def test_a_changed_block_fails():
    rows = pa.table({"k0": [1], "block": ["0-0"], "n_words": [2], "words": [byte_bpe._packed([])]})
    one = byte_bpe._packed(np.ones(1, np.int32))
    words = pa.table({"block": ["0-0"], "numbers": [one], "sizes": [one], "ids": [one]})
    with pytest.raises(RuntimeError, match="input changed"):
        byte_bpe._place_ids(["doc_id"])(rows, words)


def test_clashing_names_and_empty_table(spark, clashing, no_docs):
    ship(spark)
    assert encoded(clashing, keep=("doc_id", "key", "pos")).count() == clashing.count()
    assert encoded(no_docs).count() == 0


def test_unknown_ids_fail(spark):
    ship(spark)
    df = spark.createDataFrame([([10**6],)], "ids array<int>")
    with pytest.raises(Exception, match="lacks"):
        df.select(byte_bpe.decoder(df, PATH)(F.col("ids"))).collect()
    empty = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [bytes(r[0]) for r in empty.select(byte_bpe.decoder(empty, PATH)(F.col("ids"))).collect()] == [b"", b""]


def test_query(spark, library):
    import hashlib

    sf = "/root/testdata/sf0.001"
    source = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries()["op11_byte_bpe"](spark, sf).collect():
        ids = library.encode_ordinary(source[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(source[r["doc_id"]].encode()).hexdigest()
