"""Benchmark decontamination by a positional inverted index (operator 9).

The index is a stored table of postings ``(term, key, pos)``: where each indexed
term stands in which document. Every window of a benchmark item (``window``
consecutive words; an item with fewer is one window) is looked up through its
two rarest terms. The rarest term's postings, moved back by the term's offset
in the item, give the places where the item may begin in a document (its
diagonals); they are intersected with the second term's postings, moved alike.
Equal positions are phrase candidates, positions up to ``slop`` words apart are
proximity matches. Phrase candidates are then checked word by word along the
diagonal, and every word inside a run of at least one window is hit.

Only terms that are the first or second rarest of some window are indexed. A
window with a term that no document has can't occur and is dropped. Term
counts cover all documents. What tasks are sent is a bitmap of fixed size
(``2**BITS`` slots) over the terms wanted; it may let others pass, which a join
on the full hash drops again. Lists are joined on (document, term, position),
so no term's or item's list meets in one task. Words are compared by 64-bit
hashes.

Defined results. Null or empty text: no words, not hit. Null item text: no
window. Items with the same words are looked up once and counted one by one;
an item id that repeats counts once; a null item id is the empty string. Rows
that repeat in id and text get the same result, each its own row. Empty
benchmark: nothing is hit. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.llm.common import ALNUM, hash_words, row_of, stage

BITS = 21
_MASK = np.uint64((1 << BITS) - 1)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows that agree in id and text share a key, and so a result."""
    key, text = docs[id_col], F.coalesce(docs[text_col], F.lit(""))
    return docs.select(
        F.xxhash64(key.cast("string"), F.lit("\x00"), text).alias("key"), key.alias("doc_id"), text.alias("text")
    )


def item_terms(bench: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item`` (id as text), ``cls`` (hash of the words) and ``terms``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, off = hash_words(b.column(1), ALNUM)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(h.view(np.int64)))],
                names=["item", "terms"],
            )

    rows = bench.select(F.coalesce(bench[item_col].cast("string"), F.lit("")).alias("item"), bench[text_col].alias("text"))
    out = rows.mapInArrow(run, "item string, terms array<bigint>").filter(F.size("terms") > 0)
    return out.withColumn("cls", F.xxhash64("terms"))


def term_bitmap(terms: DataFrame):
    """A bitmap of the slots that the column ``term`` fills; at most 2**BITS
    numbers reach the driver, whatever the table's size."""
    slots = terms.select((F.col("term").bitwiseAND(F.lit((1 << BITS) - 1))).alias("slot")).distinct().toArrow()
    bitmap = np.zeros(1 << BITS, bool)
    bitmap[slots.column(0).to_numpy()] = True
    return terms.sparkSession.sparkContext.broadcast(bitmap)


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, n``: how often each wanted term stands in all documents."""
    bitmap = term_bitmap(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, _ = hash_words(b.column(0), ALNUM)
            t, n = np.unique(h[bitmap.value[h & _MASK]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(n)], names=["term", "n"])

    counted = docs.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    return terms.select("term").distinct().join(counted, "term")


def anchors(classes: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """For every window that can occur: its two rarest terms and their offsets
    in the item, ``cls, t1, o1, t2, o2``, each once per item."""
    placed = classes.select("cls", F.posexplode("terms").alias("pos", "term")).join(counts, "term", "left")
    lists = placed.groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("pos", "term", "n"))).alias("t"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for cls, t in zip(pdf["cls"], pdf["t"], strict=True):
                term = np.array([x["term"] for x in t], np.int64)
                n = np.array([-1 if x["n"] is None else x["n"] for x in t], np.int64)
                width = min(window, len(term))
                seen = set()
                for at in range(len(term) - width + 1):
                    part = n[at : at + width]
                    if part.min() < 0:
                        continue
                    order = np.argsort(part, kind="stable")[:2] + at
                    seen.add((int(order[0]), int(order[-1])))
                out += [(cls, int(term[a]), a, int(term[b]), b) for a, b in sorted(seen)]
            yield pd.DataFrame(out, columns=["cls", "t1", "o1", "t2", "o2"])

    return lists.mapInPandas(run, "cls bigint, t1 bigint, o1 int, t2 bigint, o2 int")


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index: a row ``key, doc_id, n_words`` per document (``term``
    null) and a row ``key, term, pos`` per posting of a wanted term."""
    bitmap = term_bitmap(terms)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, off = hash_words(b.column(2), ALNUM)
            at = np.flatnonzero(bitmap.value[h & _MASK])
            row = row_of(off)[at]
            key, doc = b.column(0), b.column(1)
            m, k = len(at), len(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([key, key.take(pa.array(row))]),
                    pa.concat_arrays([doc, pa.nulls(m, doc.type)]),
                    pa.concat_arrays([pa.array(np.diff(off), pa.int64()), pa.nulls(m, pa.int64())]),
                    pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(h[at].view(np.int64))]),
                    pa.concat_arrays([pa.nulls(k, pa.int32()), pa.array(at - off[row], pa.int32())]),
                ],
                names=["key", "doc_id", "n_words", "term", "pos"],
            )

    schema = f"key bigint, doc_id {id_type}, n_words bigint, term bigint, pos int"
    return stage(docs.mapInArrow(run, schema), "positional-index")


def lookup(index: DataFrame, wanted: DataFrame, slop: int) -> DataFrame:
    """Places where both rarest terms of a window stand: ``key, cls, diag``
    and ``apart``, how far the second term is from its place (0: as in the
    item)."""
    posts = index.filter(F.col("term").isNotNull()).select("key", "term", "pos")
    first = posts.join(wanted.withColumnRenamed("t1", "term"), "term")
    first = first.select("key", "cls", (F.col("pos") - F.col("o1")).alias("diag"), F.col("t2").alias("term"), "o2")
    width = slop + 1
    # a second term within slop stands in the bin of its place or a neighbour
    places = first.withColumn("place", F.col("diag") + F.col("o2")).withColumn(
        "bin", F.explode(F.array(*[F.floor(F.col("place") / width) + d for d in (-1, 0, 1)]))
    )
    second = posts.withColumn("bin", F.floor(F.col("pos") / width))
    met = places.join(second, ["key", "term", "bin"]).withColumn("apart", F.abs(F.col("pos") - F.col("place")))
    return met.filter(F.col("apart") <= slop).groupBy("key", "cls", "diag").agg(F.min("apart").alias("apart"))


def phrase_hits(docs: DataFrame, found: DataFrame, classes: DataFrame, window: int) -> DataFrame:
    """The word-by-word check: ``key, n_hit, spans`` (hit word ranges, end
    exclusive) and ``hit`` (classes of the items that occur)."""
    # a document's candidates are at most its words times the items' anchors
    asked = (
        found.filter(F.col("apart") == 0)
        .join(classes, "cls")
        .groupBy("key")
        .agg(F.collect_list(F.struct("cls", "diag", "terms")).alias("asked"))
    )

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            h, off = hash_words(b.column(1), ALNUM)
            keys, counts, spans, hits = b.column(0).to_pylist(), [], [], []
            for i in range(len(keys)):
                words = h[off[i] : off[i + 1]].view(np.int64)
                hit, seen = np.zeros(len(words) + 2, np.int8), set()
                asked_here = b.column(2)[i].values
                cls, diag, terms = (asked_here.field(k) for k in range(3))
                ends, flat = terms.offsets.to_numpy(), terms.values.to_numpy()
                for j in range(len(cls)):
                    item = flat[ends[j] : ends[j + 1]]
                    at = diag[j].as_py()
                    lo, hi = max(0, -at), min(len(item), len(words) - at)
                    if hi <= lo:
                        continue
                    same = np.zeros(hi - lo + 2, np.int8)
                    same[1:-1] = words[at + lo : at + hi] == item[lo:hi]
                    edge = np.diff(same)
                    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                    long = end - start >= min(window, len(item))
                    for s, e in zip(start[long], end[long], strict=True):
                        hit[1 + at + lo + s : 1 + at + lo + e] = 1
                        seen.add(cls[j].as_py())
                edge = np.diff(hit)
                start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                counts.append(int(hit.sum()))
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(start, end, strict=True)])
                hits.append(sorted(seen))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(hits, pa.list_(pa.int64())),
                ],
                names=["key", "n_hit", "spans", "hit"],
            )

    # one row per distinct text: rows that repeat share the answer
    texts = docs.select("key", "text").join(asked, "key")
    schema = "key bigint, n_hit bigint, spans array<struct<start:bigint,end:bigint>>, hit array<bigint>"
    return texts.mapInArrow(run, schema).filter(F.col("n_hit") > 0).dropDuplicates(["key"])


def decontaminate(
    docs: DataFrame,
    bench: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    slop: int = 4,
) -> DataFrame:
    """One row per document: ``key, doc_id, n_words, n_hit, spans, items``
    (ids as text, sorted) and ``n_near`` (places where an item's two rarest
    terms stand near each other, but not as in the item)."""
    keyed = _keyed(docs, id_col, text_col)
    items = stage(item_terms(bench, item_col, item_text_col), "items")
    classes = items.select("cls", "terms").dropDuplicates(["cls"])
    terms = classes.select(F.explode("terms").alias("term"))
    counts = stage(term_counts(keyed, terms), "term-counts")
    wanted = stage(anchors(classes, counts, window), "anchors")
    picked = wanted.select(F.col("t1").alias("term")).union(wanted.select("t2"))
    index = build_index(keyed, picked)
    found = stage(lookup(index, wanted, slop), "places")
    hits = stage(phrase_hits(keyed, found, classes, window), "phrase-hits")
    named = (
        hits.select("key", F.explode("hit").alias("cls"))
        .join(items.select("cls", "item").distinct(), "cls")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    near = found.filter(F.col("apart") > 0).groupBy("key").agg(F.count(F.lit(1)).alias("n_near"))
    head = index.filter(F.col("term").isNull()).select("key", "doc_id", "n_words")
    out = head.join(hits.select("key", "n_hit", "spans"), "key", "left").join(named, "key", "left").join(near, "key", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "key",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        "spans",
        F.coalesce("items", none).alias("items"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )
