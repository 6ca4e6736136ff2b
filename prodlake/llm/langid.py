"""Language identification with language-bitmask n-gram filters (operator 4).

One bit-sliced Bloom filter holds the character n-grams of all languages: a slot
is a bitmask over languages, an n-gram of a language sets that language's bit in
``PROBES`` slots, and the AND of an n-gram's slots answers at once which
languages contain it. A text's n-grams are looked up one and all; the bits are
counted per language, each count is corrected for the filter's own rate of false
positives, and the language with the largest corrected count is the answer.

An n-gram belongs to a language if any of its training rows holds it, however
rarely; none is left out. The filter grows with the n-grams, ``SLOTS_PER_GRAM`` slots
for each of the largest language, up to ``MOST_BYTES`` in all, which bounds what is
broadcast; beyond, slots fill up and the rate of false positives, which the counts are
corrected for, rises. It is filled in segments by tasks. A language that most n-grams
of a text belong to is told from its neighbours by the longest n-grams.

Defined results. Null text, empty text, text without a letter (``str.isalpha``):
``und`` with score 0. No training row: ``und`` for every text. Ties: the first
language by code point. Training rows without text or language teach nothing;
an n-gram's number of occurrences doesn't matter. More than ``MOST_LANGUAGES``
different labels are refused: each is a bit of every slot. Long texts are read in
overlapping pieces, so that every n-gram counts once. The score is the share of
the text's n-grams that the language contains, corrected and held within 0 and
1. Extra columns are left alone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodlake.llm.common import mix64, stage

PROBES = 3
ORDERS = (2, 3, 4)
SLICE_CHARS = 1 << 16  # a slice's arrays take some hundred bytes a character
SLOTS_PER_GRAM = 16
MOST_BYTES = 1 << 25
MOST_LANGUAGES = 1024
SEGMENTS = 64
_U = np.uint64
_STEP = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@cache
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 32 (a gap) for all else."""
    out = np.full(sys.maxunicode + 1, 32, np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _slices(texts: pa.Array) -> Iterator[tuple[int, str, int]]:
    """``row, piece, starts``: a text between two gaps, a long one in pieces. The
    n-grams that begin in the first ``starts`` characters count; what follows them
    belongs to the next piece as well."""
    over = max(ORDERS) - 1
    for row in range(len(texts)):
        text = texts[row].as_py()  # one at a time: a batch may be tens of megabytes
        if text:
            text = f" {text} "
            for at in range(0, len(text), SLICE_CHARS):
                piece = text[at : at + SLICE_CHARS + over]
                yield row, piece, min(SLICE_CHARS, len(piece))


def _batches(texts: pa.Array) -> Iterator[tuple[list[int], list[str], list[int]]]:
    """Rows, pieces and starts, about SLICE_CHARS characters together."""
    found, size = [], 0
    for piece in _slices(texts):
        found.append(piece)
        size += len(piece[1])
        if size >= SLICE_CHARS:
            yield tuple(map(list, zip(*found, strict=True)))
            found, size = [], 0
    if found:
        yield tuple(map(list, zip(*found, strict=True)))


def grams(rows: list[int], parts: list[str], starts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every n-gram that holds a letter and begins where its piece
    counts; n-grams never cross pieces."""
    length = np.array([len(p) for p in parts])
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _letters()[codes].astype(np.uint64)
    piece = np.repeat(np.arange(len(parts)), length)
    counts = np.arange(len(codes)) - np.repeat(np.cumsum(length) - length, length) < np.repeat(starts, length)
    row = np.array(rows)
    keep = codes != 32
    found_rows, found = [], []
    for n in ORDERS:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, _U(n), np.uint64)
        letter = np.zeros(len(h), bool)
        for i in range(n):
            h = h * _STEP[0] + codes[i : i + len(h)]
            letter |= keep[i : i + len(h)]
        letter &= (piece[: len(h)] == piece[n - 1 :]) & counts[: len(h)]
        found.append(mix64(h[letter]))
        found_rows.append(row[piece[: len(h)][letter]])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(found_rows), np.concatenate(found)


def language_grams(training: DataFrame) -> DataFrame:
    """Distinct ``lang, gram`` over all rows of ``text, lang``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, list[np.ndarray]] = {}  # the n-grams so far, then what is new
        for b in batches:
            langs = pc.dictionary_encode(b.column(1))
            code, names = langs.indices.to_numpy(zero_copy_only=False), langs.dictionary.to_pylist()
            for rows, parts, starts in _batches(b.column(0)):
                row, h = grams(rows, parts, starts)
                for k in np.unique(code[rows]):
                    have = sets.setdefault(names[k], [])
                    have.append(np.unique(h[code[row] == k]))
                    if len(have) >= 16 and sum(map(len, have[1:])) >= len(have[0]):
                        sets[names[k]] = [np.unique(np.concatenate(have))]
        for name, have in sets.items():
            g = np.unique(np.concatenate(have))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]).take(pa.array(np.zeros(len(g), np.int64))), pa.array(g.view(np.int64))], names=["lang", "gram"]
            )

    rows = training.select("text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    return rows.mapInArrow(run, "lang string, gram bigint").distinct()


@dataclass
class LanguageFilter:
    """``slots[slot, byte]``: bit ``l % 8`` of byte ``l // 8`` is language ``l``."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray

    @classmethod
    def of(cls, languages: list[str], slots: np.ndarray) -> LanguageFilter:
        fill = [np.mean((slots[:, i // 8] >> (i % 8)) & 1) for i in range(len(languages))]
        return cls(languages, slots, np.array(fill) ** PROBES)

    @staticmethod
    def shape(languages: int, most: int) -> tuple[int, int]:
        """Slots and bytes a slot for languages of at most ``most`` n-grams."""
        width = (languages + 7) // 8 or 1
        wanted = max(10, (max(1, most) * SLOTS_PER_GRAM - 1).bit_length())
        return 1 << min(wanted, (MOST_BYTES // width).bit_length() - 1), width

    @classmethod
    def build(cls, languages: list[str], gram: np.ndarray, lang: np.ndarray) -> LanguageFilter:
        """Filled here, from n-grams that fit in memory."""
        size, width = cls.shape(len(languages), int(np.bincount(lang, minlength=1).max()) if len(lang) else 0)
        slots = np.zeros((size, width), np.uint8)
        for i in range(PROBES):
            np.bitwise_or.at(slots, (cls.place(gram, i, size), lang // 8), (1 << (lang % 8)).astype(np.uint8))
        return cls.of(languages, slots)

    @staticmethod
    def place(gram: np.ndarray, probe: int, size: int) -> np.ndarray:
        return ((gram * _STEP[probe]) >> _U(64 - (size.bit_length() - 1))).astype(np.int64)

    def containing(self, gram: np.ndarray) -> np.ndarray:
        """The language bits of each n-gram, one column per language."""
        mask = self.slots[self.place(gram, 0, len(self.slots))]
        for i in range(1, PROBES):
            mask = mask & self.slots[self.place(gram, i, len(self.slots))]
        return np.unpackbits(mask, axis=1, bitorder="little")[:, : len(self.languages)]

    def detect(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        total = np.zeros(len(texts), np.int64)
        count = np.zeros((len(texts), len(self.languages)), np.int64)
        for rows, parts, starts in _batches(texts):
            row, gram = grams(rows, parts, starts)
            row = row - rows[0]
            n = rows[-1] - rows[0] + 1
            total[rows[0] : rows[0] + n] += np.bincount(row, minlength=n)
            bits = self.containing(gram)
            for k in range(len(self.languages)):
                count[rows[0] : rows[0] + n, k] += np.bincount(row[bits[:, k] == 1], minlength=n)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        true = (count - total[:, None] * self.false_rate) / (1 - self.false_rate)
        best = true.argmax(axis=1)
        score = np.clip(true.max(axis=1) / np.maximum(total, 1), 0.0, 1.0)
        return [self.languages[k] if t else "und" for k, t in zip(best, total, strict=True)], score


def learn(training: DataFrame) -> LanguageFilter:
    """The filter over all rows of ``text, lang``. The driver gets a row per
    language and the filter's segments."""
    found = stage(language_grams(training), "language-grams")
    sizes = found.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in sizes)
    size, width = LanguageFilter.shape(len(languages), max((r["n"] for r in sizes), default=0))
    number = {x: i for i, x in enumerate(languages)}
    per_segment = max(1, size // SEGMENTS)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = pc.dictionary_encode(b.column(0))
            names = np.array([number[x] for x in langs.dictionary.to_pylist()], np.int16)
            lang = names[langs.indices.to_numpy()] if len(names) else np.zeros(0, np.int16)
            gram = b.column(1).to_numpy().view(np.uint64)
            for i in range(PROBES):
                at = LanguageFilter.place(gram, i, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at // per_segment).astype(np.int32)), pa.array((at % per_segment).astype(np.int32)), pa.array(lang)],
                    names=["segment", "slot", "lang"],
                )

    def fill(rows: pa.Table) -> pa.Table:
        out = np.zeros((per_segment, width), np.uint8)
        lang = rows.column("lang").to_numpy()
        np.bitwise_or.at(out, (rows.column("slot").to_numpy(), lang // 8), (1 << (lang % 8)).astype(np.uint8))
        return pa.table({"segment": rows.column("segment").slice(0, 1), "bits": pa.array([out.tobytes()], pa.binary())})

    placed = found.mapInArrow(places, "segment int, slot int, lang smallint").distinct()
    slots = np.zeros((size, width), np.uint8)
    for r in placed.groupBy("segment").applyInArrow(fill, "segment int, bits binary").collect():
        begin = r["segment"] * per_segment
        slots[begin : begin + per_segment] = np.frombuffer(r["bits"], np.uint8).reshape(-1, width)
    return LanguageFilter.of(languages, slots)


def detector(df: DataFrame, model: LanguageFilter):
    """A column function: text -> ``struct<lang, score>``."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def detect(texts: pa.Array) -> pa.Array:
        lang, score = sent.value.detect(texts)
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], names=["lang", "score"])

    return detect


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3 (no id: false)."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that aren't held out, then answer every row:
    ``doc_id, held_out, lang_pred, score``."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    model = learn(rows.filter(~held_out(F.col("doc_id"))))
    found = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), detector(docs, model)("text").alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
