"""Secret scan by dictionary-primed zstandard novelty (operator 3).

Two kinds of spans are reported for every whole text, in code points:

* the three patterns (``assign``, ``access``, ``hex``), leftmost and not
  overlapping per kind;
* ``novel``: a run of 16 or more characters of ``[A-Za-z0-9+/_.=-]`` that stands
  near a sensitive word and that zstandard can't compress. If the run as a whole
  isn't one, each value of 16 or more behind an ``=`` inside it is measured alone,
  with the names in front of it (``NAME=value``) as context. The measure is the
  run's marginal cost: bytes of (context + run) less bytes of (context), both
  compressed against a dictionary of identifiers. Ordinary words, paths and
  identifiers are matched in the dictionary or the context and cost little; a
  random string costs half a byte a character (hexadecimal) up to a whole one.

The dictionary holds a fixed list of identifiers common in code and the
``dictionary_words`` most frequent identifiers of the whole corpus (letters and
underscores, 4 to 32 long: a leaked key with digits can't enter, however often it
is copied). Its size is bounded by the parameter. Runs inside a pattern's span
are measured too (``novelty`` of that span), but the span is reported anyway.

Defined results. Null or empty text: no span. A ``novel`` run that overlaps a
pattern's span is not reported twice. Order: by start, then kind as listed.
Empty table: the fixed dictionary, no rows. Rows that repeat are scanned each.
Extra columns are left alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodlake.llm.common import drop_staged, stage, text_bytes

KINDS = ("assign", "access", "hex", "novel")
# fixed values: the three patterns and their least lengths
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more: shorter runs are dropped whole
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

RUN_LEAST = 16
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
VALUE = re.compile(r"(?<==)[A-Za-z0-9+/_.-]+=*")  # inside a run: what an = assigns
SENSITIVE = re.compile(
    r"pass|pwd|secret|token|key|auth|bearer|credential|private|signature|session|cookie|akia", re.ASCII | re.IGNORECASE
)
BEFORE, AFTER = 64, 24

# fixed values: identifiers common in code and configuration
IDENTIFIERS = """
password passwd secret token api_key apikey access_key secret_key private_key public_key client_id client_secret
authorization bearer authentication credential credentials username user_name user_id session session_id cookie
signature certificate encryption environment variable configuration config settings default production development
staging database connection connection_string hostname localhost server endpoint address protocol request response
header content_type application/json text/plain charset=utf-8 http https://www. http:// https:// .com .org .net
function return import from export class const static public private protected void string boolean integer number
object array undefined null none true false self this new delete throw catch finally except raise lambda yield async
await for while break continue switch case if else elif include define struct typedef namespace package interface
extends implements override abstract virtual template typename print println printf format length append insert
remove update select where order group limit values table column index primary foreign reference timestamp
example sample placeholder changeme your_api_key your_token_here xxxxxxxxxxxxxxxx 0000000000000000
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 ================ ---------------- ................
""".split()

MERGED_TASKS = 8
_TOKEN = np.zeros(256, bool)
_TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True


def identifier_dictionary(docs: DataFrame, text_col: str = "text", dictionary_words: int = 4096) -> bytes:
    """Identifiers by rising corpus frequency (zstandard finds the end of a
    dictionary cheapest), the fixed ones last."""
    word = re.compile(r"[A-Za-z_]{4,32}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter[str] = Counter()
            for text in b.column(0):
                # one text at a time; words of the rest of a long run are cut at 32
                seen.update(word.findall(text.as_py() or ""))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
            )

    counted = docs.select(docs[text_col].alias("text")).mapInArrow(run, "word string, n bigint")
    counted = stage(counted.groupBy("word").agg(F.sum("n").alias("n")), "identifiers")
    # the power of two that enough words reach: 64 rows, so that few words are ordered
    power = F.floor(F.log2(F.col("n").cast("double")))
    left, least = dictionary_words, 1
    for r in counted.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("p")).collect():
        left, least = left - r["k"], 1 << int(r["p"])
        if left <= 0:
            break
    # a task's first rows go to the driver: of a few tasks, whatever the table's size
    top = counted.filter(F.col("n") >= least).coalesce(MERGED_TASKS).orderBy(F.desc("n"), "word").limit(dictionary_words)
    words = [r["word"] for r in top.collect()]
    drop_staged(counted)
    return " ".join([*words[::-1], *IDENTIFIERS]).encode()


class Novelty:
    """Marginal compressed bytes of a run behind its context."""

    def __init__(self, dictionary: bytes, level: int = 9):
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=level)
        self.zstd = zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_checksum=False)

    def cost(self, before: str, run: str, after: str) -> float:
        """Bytes per character that the run adds to its surroundings."""
        around = f"{before} {after} ".encode("utf-8", "replace")
        raw = run.encode()
        return (len(self.zstd.compress(around + raw)) - len(self.zstd.compress(around))) / len(raw)


def pattern_spans(text: str) -> list[tuple[str, int, int, int]]:
    """``kind, start, end, start of the secret itself`` of the three patterns."""
    out = []
    if "=" in text or ":" in text:
        out += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return out


def scan_text(text: str, novelty: Novelty, threshold: float) -> list[dict]:
    """All spans of one text, in order."""
    base = pattern_spans(text)
    taken = sorted((s, e) for _, s, e, _ in base)
    out = []
    for kind, start, end, value in base:
        cost = novelty.cost(text[max(0, value - BEFORE) : value], text[value:end], text[end : end + AFTER])
        out.append({"kind": kind, "start": start, "end": end, "value_start": value, "novelty": round(cost, 4)})
    starts = np.array([s for s, _ in taken])
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else None

    def measure(start: int, end: int) -> bool:
        # pattern spans that begin before this end: does any reach into it?
        k = int(np.searchsorted(starts, end, "left")) if taken else 0
        if k and reach[k - 1] > start:
            return False
        cost = novelty.cost(text[max(0, start - BEFORE) : start], text[start:end], text[end : end + AFTER])
        if cost >= threshold:
            out.append({"kind": "novel", "start": start, "end": end, "value_start": start, "novelty": round(cost, 4)})
        return cost >= threshold

    for m in RUN.finditer(text):
        start, end = m.span()
        near = bool(SENSITIVE.search(text, max(0, start - BEFORE), start))
        if (near or SENSITIVE.match(m[0])) and measure(start, end):
            continue
        at = start
        for v in VALUE.finditer(text, start, end):
            # the name in front of the = is part of the run
            near = near or bool(SENSITIVE.search(text, at, v.start()))
            at = v.start()
            if near and v.end() - at >= RUN_LEAST:
                measure(at, v.end())
    return sorted(out, key=lambda x: (x["start"], KINDS.index(x["kind"])))


def _worth_reading(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that can hold a span: an ``=`` or ``:``, or a run of RUN_LEAST."""
    out = np.zeros(len(offsets) - 1, bool)
    step = 1 << 22
    for at in range(0, len(raw), step):
        # slices overlap, so a run across their border is whole in one of them
        part = raw[at : at + step + RUN_LEAST]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = _TOKEN[part]
        edge = np.diff(inside)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = end - start >= RUN_LEAST
        marks = np.flatnonzero((part == ord("=")) | (part == ord(":")))
        row = lambda place: np.searchsorted(offsets, place + at, "right") - 1
        # a run may span rows; all of them are then read, which does no harm
        first, last = row(start[long]), row(end[long] - 1)
        out[first] = out[last] = out[row(marks)] = True
        for a, b in zip(first[last > first + 1], last[last > first + 1], strict=True):
            out[a : b + 1] = True
    return out


@cache
def _novelty(dictionary: bytes) -> Novelty:
    return Novelty(dictionary)


SPANS = "array<struct<kind:string,start:int,end:int,value_start:int,novelty:double>>"
_SPANS = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value_start", pa.int32()), ("novelty", pa.float64())]
    )
)


def scanner(dictionary: bytes, threshold: float = 0.5):
    """A column function: text -> spans. The dictionary's size is bounded by
    its word count, so it travels with the function."""

    @F.arrow_udf(SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        novelty = _novelty(dictionary)
        raw, offsets = text_bytes(texts)
        read = _worth_reading(raw, offsets)
        return pa.array([scan_text(t.as_py(), novelty, threshold) if r else [] for t, r in zip(texts, read, strict=True)], _SPANS)

    return scan


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``doc_id, spans`` for every row."""
    scan = scanner(identifier_dictionary(docs, text_col), threshold)
    return docs.select(docs[id_col].alias("doc_id"), scan(docs[text_col]).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span's secret replaced (overlaps replaced once)."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, spans in zip(texts.to_pylist(), found.to_pylist(), strict=True):
            if spans:
                parts, at = [], 0
                for a, b in sorted((s["value_start"], s["end"]) for s in spans):
                    if a >= at:
                        parts += [text[at:a], mark]
                    at = max(at, b)
                text = "".join([*parts, text[at:]])
            out.append(text)
        return pa.array(out, pa.string())

    return cut(text, spans)


def digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the given kinds, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
