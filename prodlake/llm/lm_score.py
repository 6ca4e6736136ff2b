"""Language-model scoring with a log-frequency Bloom filter (operator 7).

Training tokens (words of A-Z lower-cased texts, then one end per document) are
counted as 1- and 2-grams over all training documents. A count ``c`` is kept
quantised, ``q = 1 + floor(log_b c)``, by setting bits for the pairs (n-gram, 1)
to (n-gram, q) in one Bloom filter. A lookup probes level 1, 2, ... until a level
is missing; the last level found stands for the middle of its counts, and a text's
log10 probability is the sum over its tokens of

    P(w | v) = (f(v w) + mu * P(w)) / (f(v) + mu)
    P(w)     = (f(w) + 0.5) / (N + 0.5 * (V + 1))

with ``f`` the filter's answer and the end token in front of the first word.

The filter holds every n-gram and grows with them, so it is not broadcast whole: it
consists of slices, named by an n-gram's hash, each held by the task that asks it.

1. Documents are read in blocks of about ``BLOCK_BYTES`` of text. A block sends each
   slice its distinct n-grams once, packed in one row, with their counts in the
   block's training documents.
2. A slice's task adds up the counts, sets the slice's bits, and answers every block's
   n-grams with the levels found by probing. Of the counts only those of single
   tokens go back as well: the base score is exact.
3. A block's documents, sent as sequences of token numbers, meet the block's answers
   and are scored. Texts cross no shuffle.

Blocks are cut twice, for steps 1 and 3, in the order in which a task reads its rows;
a block that doesn't find all of its n-grams answered fails the job. There are twice
as many slices as shuffle partitions, so a slice is a share of the corpus's n-grams
that a task can hold whenever the shuffle width fits the input.

Pairs of tokens are told apart by 48 bits of their hash and the slice, tokens by 64.

Defined results. Null or empty text: the end token alone. No training documents:
N = V = 0, all counts 0. Rows are scored one by one, so repeated and null ids do
no harm (a null id is not held out). No rows: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodlake.llm.common import _BASE, hash_words, mix64, packed_numbers, row_slices, stage, unpacked_numbers

_U = np.uint64
END = mix64(np.array([0xE0D], np.uint64))[0]  # no word hashes to it but by chance
BLOCK_BYTES = 4 << 20
PAIR_BYTES = 6


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 1, F.lit(False))


def middle(level: np.ndarray, base: float) -> np.ndarray:
    """The middle of a level's counts, 0 of level 0."""
    least = base ** (level - 1.0)
    return np.where(level > 0, (least + np.maximum(base**level.astype(float) - 1, least)) / 2, 0.0)


@dataclass
class LogFrequencyFilter:
    """One slice: ``bits``, a power of two of them."""

    bits: np.ndarray  # uint8
    base: float
    probes: int

    @staticmethod
    def level(c: np.ndarray, base: float) -> np.ndarray:
        """1 + floor(log_base c); the small term keeps exact powers exact."""
        return 1 + np.floor(np.log(c) / math.log(base) + 1e-9).astype(np.int64)

    @staticmethod
    def places(gram: np.ndarray, level: int, probes: int, slots: int) -> Iterator[np.ndarray]:
        """Bit numbers among ``slots`` (a power of two)."""
        h = mix64(gram + _U(level * 0xD6E8FEB86659FD93 % (1 << 64)))
        step = (h >> _U(32)) | _U(1)
        for i in range(probes):
            yield ((h + _U(i) * step) & _U(slots - 1)).astype(np.int64)

    @classmethod
    def fill(cls, gram: np.ndarray, c: np.ndarray, base: float, probes: int, bits_per_level: float) -> LogFrequencyFilter:
        """The slice of some n-grams with their counts, all of them above 0."""
        top = cls.level(c, base)
        slots = 1 << max(10, math.ceil(math.log2(max(1.0, float(top.sum()) * bits_per_level))))
        out = np.zeros(slots, bool)
        for level in range(1, int(top.max(initial=0)) + 1):
            gram, top = gram[top >= level], top[top >= level]
            for at in cls.places(gram, level, probes, slots):
                out[at] = True
        return cls(np.packbits(out, bitorder="little"), base, probes)

    def levels(self, gram: np.ndarray) -> np.ndarray:
        """The level found of each n-gram, 0 if it isn't held."""
        top = np.zeros(len(gram), np.int64)
        live, level = np.arange(len(gram)), 1
        while len(live):
            live = live[self._holds(gram[live], level)]
            top[live] = level
            level += 1
        return top

    def _holds(self, gram: np.ndarray, level: int) -> np.ndarray:
        out = np.ones(len(gram), bool)
        for at in self.places(gram, level, self.probes, len(self.bits) * 8):
            out &= ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
        return out


# ---------------------------------------------------------------- blocks


@dataclass
class Block:
    """Some documents as token numbers; frequent tokens have low numbers. A pair's
    number is its place among the block's pairs, by the numbers of its tokens."""

    key: str
    rows: pa.RecordBatch
    seq: np.ndarray
    offsets: np.ndarray
    words: np.ndarray  # hashes, by number

    @classmethod
    def of(cls, key: str, rows: pa.RecordBatch, texts: pa.Array) -> Block:
        h, off = hash_words(texts)
        tokens = np.insert(h, off[1:], END)
        words, number, count = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        return cls(key, rows, rank[number], off + np.arange(len(off)), words[order])

    @property
    def end(self) -> int:
        return int(np.flatnonzero(self.words == END)[0])


def pairs_of(seq: np.ndarray, offsets: np.ndarray, end: int, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token before each token, the distinct pairs, and each token's pair."""
    before = np.empty_like(seq)
    before[1:] = seq[:-1]
    before[offsets[:-1]] = end
    pairs, number = np.unique(before.astype(np.int64) * n_words + seq, return_inverse=True)
    return before, pairs, number


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Blocks of rows whose column 0 is the text."""
    task = TaskContext.get()
    part, made = task.partitionId() if task else 0, 0
    for batch in batches:
        for rows in row_slices(batch, 0, BLOCK_BYTES):
            yield Block.of(f"{part}-{made}", rows, rows.column(0))
            made += 1


def _deltas(x: np.ndarray) -> bytes:
    return packed_numbers(np.diff(x, prepend=0).astype(np.int32))


def _from_deltas(packed: bytes) -> np.ndarray:
    return np.cumsum(unpacked_numbers(packed, np.int32), dtype=np.int64)


def _by_slice(h: np.ndarray, slices: int) -> dict[int, np.ndarray]:
    """The numbers of the n-grams of each slice."""
    at = ((h >> _U(48)) ^ (h & _U(0xFFFF))) % _U(slices) if slices <= 1 << 16 else mix64(h) % _U(slices)
    order = np.argsort(at, kind="stable")
    met, begin = np.unique(at[order], return_index=True)
    return dict(zip(met.tolist(), np.split(order, begin[1:]), strict=True))


_ASKED = ["slice", "block", "word_no", "word", "word_c", "pair_no", "pair", "pair_c"]
_ANSWERED = ["block", "word_no", "word_c", "word_q", "pair_no", "pair_q", "tokens", "vocabulary"]


def _asked(slices: int):
    """A block's distinct n-grams, a row for each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            held = b.rows.column(1).to_numpy(zero_copy_only=False).astype(bool)
            taught = np.repeat(~held, np.diff(b.offsets))
            n = len(b.words)
            _, pairs, number = pairs_of(b.seq, b.offsets, b.end, n)
            word_c = np.bincount(b.seq, taught, n).astype(np.int32)
            pair_c = np.bincount(number, taught, len(pairs)).astype(np.int32)
            pair = mix64(b.words[pairs // n] * _U(_BASE) + b.words[pairs % n])
            words, doubles = _by_slice(b.words, slices), _by_slice(pair, slices)
            none = np.zeros(0, np.int64)
            for s in sorted(words.keys() | doubles.keys()):
                w, p = words.get(s, none), doubles.get(s, none)
                low = np.ascontiguousarray(pair[p]).view(np.uint8).reshape(-1, 8)[:, :PAIR_BYTES]
                row = [s, b.key, _deltas(w), b.words[w].tobytes(), packed_numbers(word_c[w]), _deltas(p), low.tobytes(), packed_numbers(pair_c[p])]
                kinds = [pa.int32(), pa.string(), *[pa.binary()] * 6]
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=_ASKED)

    return run


def _sums(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, their summed counts, and each hash's place."""
    gram, back = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.zeros(len(gram), np.int64)
    np.add.at(total, back, np.concatenate(counts).astype(np.int64))
    return gram, total, back


def _answered(base: float, probes: int, bits_per_level: float):
    """One slice: fill it with all blocks' n-grams, then probe it for each block's."""

    def run(asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        counts = [[unpacked_numbers(r[c], np.int32) for r in rows] for c in ("word_c", "pair_c")]
        words = [np.frombuffer(r["word"], np.uint64) for r in rows]
        pairs = []
        for r in rows:
            wide = np.zeros((len(r["pair"]) // PAIR_BYTES, 8), np.uint8)
            wide[:, :PAIR_BYTES] = np.frombuffer(r["pair"], np.uint8).reshape(-1, PAIR_BYTES)
            # a pair of equal bits is no word
            wide[:, 7] = 1
            pairs.append(mix64(wide.view(np.uint64).ravel()))
        word, word_n, word_at = _sums(words, counts[0])
        pair, pair_n, pair_at = _sums(pairs, counts[1])
        gram, n = np.concatenate([word, pair]), np.concatenate([word_n, pair_n])
        f = LogFrequencyFilter.fill(gram[n > 0], n[n > 0], base, probes, bits_per_level)
        word_q, pair_q = f.levels(word).astype(np.int8), f.levels(pair).astype(np.int8)
        out: dict[str, list] = {c: [] for c in _ANSWERED}
        w = p = 0
        for r, a, b in zip(rows, words, pairs, strict=True):
            mine, theirs = word_at[w : w + len(a)], pair_at[p : p + len(b)]
            w, p = w + len(a), p + len(b)
            values = [r["block"], r["word_no"], packed_numbers(word_n[mine]), packed_numbers(word_q[mine]), r["pair_no"], packed_numbers(pair_q[theirs]), None, None]
            for c, x in zip(_ANSWERED, values, strict=True):
                out[c].append(x)
        for c, x in zip(_ANSWERED, [None] * 6 + [int(word_n.sum()), int((word_n > 0).sum())], strict=True):
            out[c].append(x)
        return pa.table({c: pa.array(x, k) for (c, x), k in zip(out.items(), [pa.string(), *[pa.binary()] * 5, pa.int64(), pa.int64()], strict=True)})

    return run


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``text, held_out, doc_id`` as token numbers."""
    for b in _blocks(batches):
        rows, n = b.rows, b.rows.num_rows
        _, pairs, _ = pairs_of(b.seq, b.offsets, b.end, len(b.words))
        parts = [packed_numbers(b.seq[x:y]) for x, y in zip(b.offsets[:-1], b.offsets[1:], strict=True)]
        same = [pa.array(np.full(n, x, np.int32)) for x in (len(b.words), len(pairs), b.end)]
        yield pa.RecordBatch.from_arrays(
            [rows.column(2), rows.column(1), pa.array([b.key] * n), *same, pa.array(parts, pa.binary())],
            names=["doc_id", "held_out", "block", "n_words", "n_pairs", "end_no", "seq"],
        )


def _scores(base: float, mu: float, denominator: float):
    scale = math.log10(denominator)

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        n_words, n_pairs, end = (rows.column(c)[0].as_py() if rows.num_rows else 0 for c in ("n_words", "n_pairs", "end_no"))
        c, q, pair_q = np.zeros(n_words, np.int64), np.full(n_words, -1, np.int64), np.full(n_pairs, -1, np.int64)
        for r in answers.to_pylist():
            at = _from_deltas(r["word_no"])
            c[at], q[at] = unpacked_numbers(r["word_c"], np.int64), unpacked_numbers(r["word_q"], np.int8)
            pair_q[_from_deltas(r["pair_no"])] = unpacked_numbers(r["pair_q"], np.int8)
        seqs = [unpacked_numbers(x.as_py(), np.int32) for x in rows.column("seq")]
        off = np.concatenate([[0], np.cumsum([len(x) for x in seqs], dtype=np.int64)])
        seq = np.concatenate(seqs) if seqs else np.zeros(0, np.int32)
        before, pairs, number = pairs_of(seq, off, end, max(1, n_words))
        if len(pairs) != n_pairs or (q < 0).any() or (pair_q < 0).any():
            raise RuntimeError("a block did not find all its n-grams answered: its input changed")
        n, row = rows.num_rows, np.repeat(np.arange(rows.num_rows), np.diff(off))
        f1 = middle(q, base)
        p1 = (f1[seq] + 0.5) / denominator
        # a pair is no more frequent than either of its tokens
        f2 = np.minimum(middle(pair_q, base)[number], np.minimum(f1[before], f1[seq]))
        score = np.bincount(row, np.log10((f2 + mu * p1) / (f1[before] + mu)), n)
        plain = np.bincount(row, np.log10(c + 0.5)[seq] - scale, n)
        known = np.bincount(row, c[seq] > 0, n).astype(np.int64)
        return pa.table(
            [rows.column("doc_id"), rows.column("held_out"), pa.array(np.diff(off)), pa.array(known), pa.array(plain), pa.array(score)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )

    return run


def score_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: float = 1.5,
    probes: int = 4,
    bits_per_level: float = 8.0,
    mu: float = 50.0,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``docs`` must be a table as read (its rows come in the same order whenever a
    task is run again), not the outcome of a shuffle."""
    spark = docs.sparkSession
    rows = docs.select(docs[text_col].alias("text"), held_out(docs[id_col]).alias("held_out"), docs[id_col].alias("doc_id"))
    slices = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    binary = lambda names: ", ".join(f"{c} binary" for c in names)
    asked = rows.mapInArrow(_asked(slices), f"slice int, block string, {binary(_ASKED[2:])}")
    answers = asked.groupBy("slice").applyInArrow(
        _answered(base, probes, bits_per_level), f"block string, {binary(_ANSWERED[1:6])}, tokens bigint, vocabulary bigint"
    )
    answers = stage(answers, "lm-answers")
    size = answers.filter("block is null").agg(F.sum("tokens").alias("n"), F.sum("vocabulary").alias("v")).first()
    total, vocabulary = size["n"] or 0, size["v"] or 0

    id_type = rows.schema["doc_id"].dataType.simpleString()
    sequences = rows.mapInArrow(
        _sequences, f"doc_id {id_type}, held_out boolean, block string, n_words int, n_pairs int, end_no int, seq binary"
    )
    found = answers.filter("block is not null").drop("tokens", "vocabulary")
    scored = (
        sequences.groupBy("block")
        .cogroup(found.groupBy("block"))
        .applyInArrow(
            _scores(base, mu, total + 0.5 * (vocabulary + 1)),
            f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
        )
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
