"""Byte-level BPE encoding and decoding by corpus-level merge replay (operator 11).

A text is split into words by the vocabulary's pattern. The corpus is laid out in
blocks of about ``BLOCK_BYTES`` of text, each with a numbered list of its distinct
words; a document becomes the sequence of its words' numbers. All blocks' words
are dealt by word, so that one task holds every place of a word in the corpus,
and the merges are replayed there over the distinct words:

* an inverted index leads from a token pair to the positions, in all words, where
  the pair stands;
* pairs are taken in rank order; all positions of one are merged at once, and
  only the pairs with the two neighbours of a merged position are looked up
  again and entered in the index;
* where a merge makes a pair of lower rank than its own (possible only in a
  vocabulary whose ranks don't follow its own merges), the word is encoded alone,
  step by step, always by its lowest pair, the leftmost first.

The encoded words go back to their blocks, and each document's sequence is read
off. Texts cross no shuffle, only word numbers and distinct words do, a block's
words in one packed row for each bucket of words. Blocks are
cut twice, once for each side, in the order in which a task reads its rows, and
a block that doesn't find as many words as it has distinct ones fails the job.

Bounds: a block ends behind the row that fills it, so memory follows
``BLOCK_BYTES`` and the longest text; the replay takes ``REPLAY_BYTES`` of words
at a time (a word met in two such parts is encoded twice, to the same ids); the
vocabulary, which is broadcast, is refused above ``MOST_VOCABULARY`` bytes.

Results equal the tiktoken library's ``encode_ordinary``, including its Unicode
version: characters that the ``regex`` library already counts as letters or
numbers and tiktoken does not are found by asking tiktoken.

Defined results. Null or empty text: no ids. Ids that the vocabulary lacks and
null ids raise on decoding; a null list of ids decodes to no bytes. Rows that
repeat are each encoded. Order of rows is not kept. No rows: no rows. Extra columns
are kept if named in ``keep``, whatever their names.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
REPLAY_BYTES = 4 << 20
MOST_VOCABULARY = 1 << 27
NO_PAIR = np.int32(np.iinfo(np.int32).max)
LONG_TEXT = 1 << 22


class Vocabulary:
    """Tokens by rank, and the rank of every pair of tokens that may merge."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}
        self.size = max(self.ranks.values(), default=-1) + 1
        self.tokens: list[bytes | None] = [None] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"the vocabulary has no token for the bytes {missing[:8]}")
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        lengths = np.array([len(t) if t is not None else 0 for t in self.tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.bytes = np.frombuffer(b"".join(t or b"" for t in self.tokens), np.uint8)
        self.known = np.array([t is not None for t in self.tokens], bool)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the token that each pair merges to, NO_PAIR if none."""
        if not len(self.keys):
            return np.full(len(a), NO_PAIR, np.int32)
        key = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.merged[at], NO_PAIR)


@functools.lru_cache(maxsize=2)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def read_vocabulary(path: str) -> bytes:
    """The content of a rank file: a line ``base64-token rank`` for each token."""
    with open(path, "rb") as f:
        content = f.read(MOST_VOCABULARY + 1)
    if len(content) > MOST_VOCABULARY:
        raise ValueError(f"{path} is over {MOST_VOCABULARY} bytes; it would be broadcast")
    return content


# ---------------------------------------------------------------- words


@functools.cache
def newer_characters() -> str:
    """A character class of those that ``regex`` takes for letters or numbers and
    tiktoken for neither, or an empty text."""
    candidate = regex.compile(r"[\p{L}\p{N}]")
    doubt = [
        c
        for c in range(128, sys.maxunicode + 1)
        if unicodedata.category(chr(c)) == "Cn" and candidate.match(chr(c))
    ]
    # a known piece comes back as one id, so "!" and the character are one id only if both are of the same class
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {("!" + chr(c)).encode(): 256 + i for i, c in enumerate(doubt)}
    asked = tiktoken.Encoding("asked", pat_str=r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+", mergeable_ranks=ranks, special_tokens={})
    newer = [c for c in doubt if len(asked.encode_ordinary("!" + chr(c))) == 1]
    ranges: list[list[int]] = []
    for c in newer:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]" if ranges else ""


class Splitter:
    """Cuts texts into the pieces that are merged separately."""

    def __init__(self, pattern: str, newer: str):
        self.pattern = regex.compile(pattern)
        self.newer = regex.compile(newer) if newer else None
        # a plain range is searched much faster, and most texts have nothing in it
        self.perhaps = re.compile(f"[{newer[1:11]}-\\U0010ffff]") if newer else None

    def __call__(self, text: str) -> Iterator[str]:
        if self.newer and not text.isascii() and self.perhaps.search(text) and self.newer.search(text):
            shadow = self.newer.sub("\ue000", text)  # a character of neither class, so pieces have the same places
            return (text[m.start() : m.end()] for m in self.pattern.finditer(shadow))
        if len(text) > LONG_TEXT:
            return (m.group() for m in self.pattern.finditer(text))
        return self.pattern.findall(text)


class _Numbers(dict):
    """Numbers words in the order in which they are first met."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _blocks(batches: Iterator[pa.RecordBatch], split: Splitter, text: int) -> Iterator[tuple[str, list, list, _Numbers]]:
    """``key, row slices, word sequences, words`` of every block of a task's rows."""
    task = TaskContext.get()
    part = task.partitionId() if task else 0
    rows, sequences, numbers, size, made = [], [], _Numbers(), 0, 0
    for batch in batches:
        begun = 0
        for i, value in enumerate(batch.column(text)):
            sequence = array("i")
            if (t := value.as_py()) is not None:
                sequence.extend(map(numbers.__getitem__, split(t)))
                size += len(t)
            sequences.append(sequence)
            size += 64
            if size >= BLOCK_BYTES:
                rows.append(batch.slice(begun, i + 1 - begun))
                begun = i + 1
                yield f"{part}-{made}", rows, sequences, numbers
                rows, sequences, numbers, size, made = [], [], _Numbers(), 0, made + 1
        if begun < batch.num_rows:
            rows.append(batch.slice(begun))
    if sequences:
        yield f"{part}-{made}", rows, sequences, numbers


def _packed(numbers) -> bytes:
    """32-bit numbers, byte plane by byte plane, compressed."""
    x = np.frombuffer(numbers, np.int32) if len(numbers) else np.zeros(0, np.int32)
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.int32).ravel()


def _packed_words(words: list[bytes]) -> tuple[bytes, bytes]:
    return _packed(np.fromiter(map(len, words), np.int32, len(words))), zstandard.compress(b"".join(words), 1)


def _unpacked_words(sizes: bytes, joined: bytes) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(_unpacked(sizes), dtype=np.int64)])
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(zstandard.decompress(joined))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, buffers)


def _dealt(numbers: _Numbers, buckets: int) -> Iterator[tuple[int, np.ndarray, list[bytes]]]:
    """``bucket, numbers, words`` of a block's words, dealt by word."""
    words = [w.encode() for w in numbers]
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
    order = np.argsort(bucket, kind="stable")
    met, begin = np.unique(bucket[order], return_index=True)
    for b, at in zip(met.tolist(), np.split(order, begin[1:]), strict=True):
        yield b, at.astype(np.int32), [words[i] for i in at]


# ---------------------------------------------------------------- replay


def encode_alone(word: bytes, v: Vocabulary) -> list[int]:
    """The ids of one word: its lowest pair first, of equal ones the leftmost."""
    if word in v.ranks:
        return [v.ranks[word]]
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        found = min((v.ranks.get(parts[i] + parts[i + 1], int(NO_PAIR)), i) for i in range(len(parts) - 1))
        if found[0] == NO_PAIR:
            break
        parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]
    return [v.ranks[p] for p in parts]


def _distinct(positions: np.ndarray) -> np.ndarray:
    positions.sort()
    new = np.ones(len(positions), bool)
    np.not_equal(positions[1:], positions[:-1], out=new[1:])
    return positions[new]


def replay(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after another, and where each word's begin."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    whole = np.fromiter((v.ranks.get(w, -1) for w in words), np.int64, len(words))
    n = int(begin[-1])
    token = v.byte[np.frombuffer(b"".join(words), np.uint8)]
    after = np.arange(1, n + 1, dtype=np.int32)
    before = np.arange(-1, n - 1, dtype=np.int32)
    filled = sizes > 0
    after[begin[1:][filled] - 1] = -1
    before[begin[:-1][filled]] = -1
    rank = np.full(n, NO_PAIR, np.int32)
    first = np.flatnonzero((after >= 0) & ~np.repeat(whole >= 0, sizes))
    rank[first] = v.pair_rank(token[first], token[first + 1])
    first = first[rank[first] != NO_PAIR]

    # the index: rank of a pair -> arrays of positions
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(positions: np.ndarray) -> None:
        ranks = rank[positions]
        if len(positions) > 1:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
        else:
            cuts = np.zeros(0, np.int64)
        edges = [0, *cuts.tolist(), len(positions)]
        for a, b in zip(edges, edges[1:], strict=False):
            r = int(ranks[a])
            if r in index:
                index[r].append(positions[a:b])
            else:
                index[r] = [positions[a:b]]
                heapq.heappush(queue, r)

    if len(first):
        enter(first)
    alone: set[int] = set()
    while queue:
        r = heapq.heappop(queue)
        lists = index.pop(r)
        at = _distinct(np.concatenate(lists)) if len(lists) > 1 else lists[0]
        at = at[rank[at] == r]
        if not len(at):
            continue
        if len(at) > 1 and len(linked := np.flatnonzero(after[at[:-1]] == at[1:])):
            # in a run of overlapping places every other one merges, from the left
            joined = np.zeros(len(at), bool)
            joined[linked + 1] = True
            place = np.arange(len(at))
            run = np.maximum.accumulate(np.where(joined, 0, place))
            at = at[(place - run) % 2 == 0]
        gone = after[at]
        beyond = after[gone]
        if len(at) > 1 and len(close := np.flatnonzero(beyond[:-1] == at[1:])):
            # the left one merges before its right neighbour has changed
            odd = close[v.pair_rank(np.full(len(close), r), token[beyond[close]]) < r]
            alone.update((np.searchsorted(begin, at[odd], "right") - 1).tolist())
        token[at] = r
        after[at] = beyond
        before[beyond[beyond >= 0]] = at[beyond >= 0]
        rank[gone] = NO_PAIR
        token[gone] = -1
        left = before[at]
        touched = _distinct(np.concatenate([at, left[left >= 0]]))
        follow = after[touched]
        inner = follow >= 0
        new = np.full(len(touched), NO_PAIR, np.int32)
        new[inner] = v.pair_rank(token[touched[inner]], token[follow[inner]])
        alone.update((np.searchsorted(begin, touched[new < r], "right") - 1).tolist())
        rank[touched] = new
        if len(entered := touched[new != NO_PAIR]):
            enter(entered)

    for w in np.flatnonzero(whole >= 0):
        token[begin[w] : begin[w + 1]] = -1
        token[begin[w]] = whole[w]
    for w in alone:
        ids = encode_alone(words[w], v)
        token[begin[w] : begin[w + 1]] = -1
        token[begin[w] : begin[w] + len(ids)] = ids
    kept = token >= 0
    count = np.concatenate([[0], np.cumsum(kept)])
    return token[kept], count[begin]


_WORDS = "block string, numbers binary, sizes binary, words binary"
_CODED = "block string, numbers binary, sizes binary, ids binary"


def _replay_words(content, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of some blocks, a row for each block's share, to their ids."""
    v = vocabulary(content.value)

    def flush(held: list[tuple[str, bytes, pa.Array]]) -> Iterator[pa.RecordBatch]:
        coded = pc.dictionary_encode(pa.concat_arrays([words for _, _, words in held]))
        ids, begin = replay(coded.dictionary.to_pylist(), v)
        at = coded.indices.to_numpy()
        lengths = np.diff(begin).astype(np.int32)
        first = 0
        for block, numbers, words in held:
            mine = at[first : first + len(words)]
            first += len(words)
            out = np.ascontiguousarray(ids[_ranges(begin[mine], lengths[mine])], np.int32)
            row = [[block], [numbers], [_packed(lengths[mine])], [_packed(out)]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, _CODED_TYPES, strict=True)], names=_CODED_NAMES)

    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            words = _unpacked_words(row["sizes"], row["words"])
            held.append((row["block"], row["numbers"], words))
            size += words.nbytes
            if size >= REPLAY_BYTES:
                yield from flush(held)
                held, size = [], 0
    if held:
        yield from flush(held)


_CODED_NAMES = ["block", "numbers", "sizes", "ids"]
_CODED_TYPES = [pa.string(), pa.binary(), pa.binary(), pa.binary()]


# ---------------------------------------------------------------- documents


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...`` of every range, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def _place_ids(names: list[str]):
    def place(rows: pa.Table, words: pa.Table) -> pa.Table:
        """A block's documents and encoded words to the documents' ids."""
        expected = rows.column("n_words")[0].as_py() if rows.num_rows else 0
        lengths = np.full(expected, -1, np.int64)
        shares = [(_unpacked(r["numbers"]), _unpacked(r["sizes"]), _unpacked(r["ids"])) for r in words.to_pylist()]
        for numbers, sizes, _ in shares:
            lengths[numbers] = sizes
        if sum(len(x[0]) for x in shares) != expected or (lengths < 0).any():
            raise RuntimeError(f"a block of {expected} distinct words did not find them again: its input changed")
        begin = np.zeros(expected, np.int64)
        at = 0
        for numbers, sizes, ids in shares:
            begin[numbers] = at + np.cumsum(sizes) - sizes
            at += len(ids)
        flat = np.concatenate([x[2] for x in shares]) if shares else np.zeros(0, np.int32)
        del shares
        parts, ends = [], np.zeros(rows.num_rows + 1, np.int64)
        for row, packed in enumerate(rows.column("words")):
            seq = _unpacked(packed.as_py())
            ids = flat[_ranges(begin[seq], lengths[seq])]
            parts.append(ids)
            ends[row + 1] = ends[row] + len(ids)
        values = pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32))
        if ends[-1] > np.iinfo(np.int32).max:
            raise ValueError("a block has more ids than a column of lists can hold; make BLOCK_BYTES smaller")
        ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
        return pa.table([rows.column(f"k{i}") for i in range(len(names))] + [ids], names=[*[f"k{i}" for i in range(len(names))], "ids"])

    return place


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row and ``ids``, its text's token ids by the
    vocabulary file at ``path`` (read by the driver), split by ``pattern``.

    ``docs`` must be a table as read (its rows come in the same order whenever a
    task is run again), not the outcome of a shuffle."""
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(read_vocabulary(path))
    newer = newer_characters()
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    taken = docs.select(docs[text].alias("text"), *[docs[c].alias(f"k{i}") for i, c in enumerate(keep)])
    kept = [f"k{i}" for i in range(len(keep))]

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows, found, numbers in _blocks(batches, Splitter(pattern, newer), 0):
            t = pa.Table.from_batches(rows)
            n = t.num_rows
            yield from pa.table(
                [*[t.column(c) for c in kept], pa.array([key] * n), pa.array([len(numbers)] * n, pa.int32()), pa.array(map(_packed, found), pa.binary())],
                names=[*kept, "block", "n_words", "words"],
            ).to_batches()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, _, numbers in _blocks(batches, Splitter(pattern, newer), 0):
            for bucket, at, share in _dealt(numbers, buckets):
                row = [[bucket], [key], [_packed(at)], *([x] for x in _packed_words(share))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(row, [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()], strict=True)],
                    names=["bucket", "block", "numbers", "sizes", "words"],
                )

    schema = ", ".join(f"{c} {taken.schema[c].dataType.simpleString()}" for c in kept)
    sequence_rows = taken.mapInArrow(sequences, ", ".join(x for x in (schema, "block string, n_words int, words binary") if x))
    word_rows = taken.mapInArrow(words, f"bucket int, {_WORDS}").repartition("bucket").drop("bucket")
    coded = word_rows.mapInArrow(functools.partial(_replay_words, content), _CODED)
    out = (
        sequence_rows.groupBy("block")
        .cogroup(coded.groupBy("block"))
        .applyInArrow(_place_ids(list(keep)), ", ".join(x for x in (schema, "ids array<int>") if x))
    )
    return out.select(*[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)], "ids")


def decoder(df: DataFrame, path: str):
    """A function from a column of ids to a column of the bytes they stand for."""
    content = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocabulary(content.value)
        for lists in batches:
            filled = pc.fill_null(lists, [])
            if isinstance(filled, pa.ChunkedArray):
                filled = filled.combine_chunks()
            ids = filled.flatten()
            if ids.null_count:
                raise ValueError("a null id can't be decoded")
            flat = ids.to_numpy()
            sizes = pc.list_value_length(filled).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            out = []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                mine = flat[a:b]
                if len(mine) and (mine.min() < 0 or mine.max() >= v.size or not v.known[mine].all()):
                    raise ValueError("an id that the vocabulary lacks can't be decoded")
                begin = v.starts[mine]
                out.append(v.bytes[_ranges(begin, v.starts[mine + 1] - begin)].tobytes())
            yield pa.array(out, pa.binary())

    def apply(ids: Column) -> Column:
        return decode(ids)

    return apply
