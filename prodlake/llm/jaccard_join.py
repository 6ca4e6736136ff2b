"""N-gram Jaccard join by T-occurrence search (operator 1).

A document's set holds its distinct shingles of four words (A-Z lower-cased); a
document with fewer words has its whole sequence as one. Two documents link when
100 * intersection >= 85 * union (the numbers are parameters).

1. Documents with equal sets form a class; one stands for all from here on.
2. Shingles get one global order, rare ones first: by the count in a sketch of
   fixed size over all documents, then by hash. Linked sets share at least T
   shingles within their prefixes of ``n - ceil(0.85 n) + T`` shingles, so
   inverted lists need the prefixes only. Lists with one member are dropped.
3. Groups of near copies are contracted first: in some rounds, every list that
   still holds several components names a leader, each member is compared with
   the leader it shares most lists with, and true links merge components. A group
   of any size costs a comparison per member and round, not all its pairs.
4. The search proper, over the lists that still hold several components: a class
   that is outside the largest component of at least one of its lists queries all
   of them (where it is in the largest, the members outside it). Of two classes in
   different components one at least is outside in a shared list, so one side counts
   all shared lists. The query's short lists are merged, the long ones
   probed by binary search (DivideSkip), and members that occur T times, are in other
   components and whose sizes and shared prefix shingles allow a link are candidates.
   They leave packed, a row for a query and a block of neighbours (classes whose
   commonest list is the same). Where two blocks have many candidates (groups of
   texts that nearly link), the search goes on inside the pair of blocks, over the
   inverted lists of their whole sets and with T the required overlap, so that only
   true links leave it; the other candidates are compared on whole sets one by one.
   No link between components is lost; links inside a component don't change the
   result and aren't listed.
5. Components come from the links found.

A hot list is split by its members' hash in every step, and list rows are sent to
tasks in blocks; no list, group or class meets in one task. Sketch order and
rounds affect speed only, the result is exact but for collisions of 64-bit hashes.

Defined results. Null, empty or blank text: size 0, linked with nothing, its
component is its own id. Rows that repeat: each its own row, same component. A
null id: the row links as others do; component ids are the smallest id that isn't
null, and null if there is none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.llm.common import bounded_batches, hash_words, mix64, ngram_hashes, row_slices, stage, text_bytes
from prodlake.llm.graph import components

_U = np.uint64
SKETCH_BITS = 20
SKETCH_PARTS = 16
SUPPORT = 4  # T: shared prefix shingles asked of candidates
ROUNDS = 3
BLOCK_MEMBERS = 1024  # members of a list sent as one row
BLOCK_SHINGLES = 1 << 17  # shingles compared in one group
MEMBER = ("cls", "n", "comp", "most", "home")  # what a list tells of its members
BLOCK_CLASSES = 256  # classes of a block of neighbours
PROBED = 1 << 13  # members from which a list is probed rather than counted
DENSE = 0.25  # candidates per class from which two blocks are searched as a whole


def shingle_rows(texts: pa.Array, n: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of every text, one text behind the other,
    and the row offsets into them."""
    h, off = hash_words(texts)
    words = np.diff(off)
    width = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    ends = np.concatenate([[0], np.cumsum(width)])
    g = np.append(ngram_hashes(h, n), np.zeros(n, np.uint64))
    flat = g[np.minimum(np.arange(ends[-1]) + np.repeat(off[:-1] - ends[:-1], width), len(g) - 1)]
    for i in np.flatnonzero((words > 0) & (words < n)):
        flat[ends[i]] = ngram_hashes(h[off[i] : off[i + 1]], int(words[i]))[0]
    for a, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        flat[a:e].sort()
    fresh = np.ones(len(flat), bool)
    fresh[1:] = flat[1:] != flat[:-1]
    fresh[ends[:-1][width > 0]] = True
    return flat[fresh], np.concatenate([[0], np.cumsum(fresh)])[ends]


def shingle_sets(texts: pa.Array, n: int = 4) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    flat, off = shingle_rows(texts, n)
    off = off.tolist()
    return [flat[a:e] for a, e in zip(off[:-1], off[1:], strict=True)]


def classes_of(flat: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A hash of each set as a signed 64-bit number; -1, 0 are not special."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(flat), dtype=np.uint64)])
    size = np.diff(off).astype(np.uint64)
    return mix64(total[off[1:]] - total[off[:-1]] + mix64(size)).view(np.int64)


def required(n: np.ndarray | int, percent: int):
    """The least intersection with any partner: ceil(percent / 100 * n)."""
    return (percent * n + 99) // 100


def behind_prefix(n: np.ndarray | int, percent: int):
    """How many shingles of a set of ``n`` its prefix leaves out."""
    least = required(n, percent)
    return least - np.minimum(SUPPORT, least)


def overlap_needed(a, b, percent: int):
    """The least i with 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def _scan_sets(rows: DataFrame, n: int) -> DataFrame:
    """Per row ``doc_id, key, cls, n``; and, with ``part`` set, each task's
    counts of shingles by sketch slot (``part`` the piece of the sketch)."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        kind = None
        for whole in batches:
            kind = whole.column(0).type
            for b in row_slices(whole, 2):
                flat, off = shingle_rows(b.column(2), n)
                sketch += np.bincount((flat >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0),
                        b.column(1),
                        pa.array(classes_of(flat, off), pa.int64()),
                        pa.array(np.diff(off), pa.int64()),
                        pa.nulls(b.num_rows, pa.int32()),
                        pa.nulls(b.num_rows, pa.binary()),
                    ],
                    names=names,
                )
        if kind is not None:
            k = SKETCH_PARTS
            pieces = sketch.astype(np.uint32).reshape(k, -1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(k, kind),
                    pa.nulls(k, pa.int64()),
                    pa.nulls(k, pa.int64()),
                    pa.nulls(k, pa.int64()),
                    pa.array(range(k), pa.int32()),
                    pa.array([p.tobytes() for p in pieces], pa.binary()),
                ],
                names=names,
            )

    names = ["doc_id", "key", "cls", "n", "part", "counts"]
    schema = f"doc_id {id_type}, key bigint, cls bigint, n bigint, part int, counts binary"
    return stage(rows.mapInArrow(run, schema), "shingle-sets")


def _sketch(scanned: DataFrame) -> np.ndarray:
    """The summed sketch: 2**SKETCH_BITS numbers reach the driver."""

    def add(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in tables:
            for part, counts in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                more = np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)
                total[part] = total[part] + more if part in total else more
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["part", "total"]
        )

    pieces = scanned.filter("part is not null").select("part", "counts").repartition(SKETCH_PARTS, "part")
    out = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    for r in pieces.mapInArrow(add, "part int, total binary").collect():
        out[r["part"]] += np.frombuffer(r["total"], np.int64)
    return out.reshape(-1)


def _prefix_lists(rows: DataFrame, sketch: np.ndarray, n: int, percent: int) -> DataFrame:
    """``token, cls, n, most``: inverted lists of the prefixes, those with one
    member dropped, and how many of a class's shingles others may have. Copies are sent once per task. Tokens far above the sketch's mean
    are surely shared and are spread by class as well."""
    sent = rows.sparkSession.sparkContext.broadcast(sketch)
    hot = max(1000, 64 * int(sketch.mean()))

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sent.value, set()
        for whole in batches:
            for b in row_slices(whole, 0):
                flat, off = shingle_rows(b.column(0), n)
                at = counts[(flat >> _U(64 - SKETCH_BITS)).astype(np.int64)]
                size = np.diff(off)
                width = size - behind_prefix(size, percent)
                first, rows = [], []
                for i, c in enumerate(classes_of(flat, off).tolist()):
                    if size[i] and c not in seen:
                        seen.add(c)
                        rows.append((i, c))
                        a, e = off[i], off[i + 1]
                        # a row's shingles are sorted
                        first.append(a + np.argsort(at[a:e], kind="stable")[: width[i]])
                if rows:
                    pick, (row, cls) = np.concatenate(first), np.array(rows, np.int64).T
                    c = np.repeat(cls, width[row])
                    far = np.where(at[pick] >= hot, (c & 1023) + 1, 0).astype(np.int16)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(flat[pick].view(np.int64)), pa.array(c), pa.array(np.repeat(size[row], width[row]).astype(np.int32)), pa.array(far)],
                        names=["token", "cls", "n", "far"],
                    )

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by token and class; drops tokens of one class."""
        held = None  # the last row, not known yet to be shared
        last = None  # token and class of the last row passed on or held
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            t, c, far = (b.column(i).to_numpy() for i in (0, 1, 3))
            fresh = np.ones(len(t), bool)
            fresh[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
            same_before = np.zeros(len(t), bool)
            same_before[1:] = (t[1:] == t[:-1]) & (c[1:] != c[:-1])
            many = np.zeros(len(t), bool)
            # a token is shared if any neighbour rows of it differ in class
            group = np.cumsum(np.concatenate([[True], t[1:] != t[:-1]])) - 1
            hits = np.bincount(group[same_before], minlength=group[-1] + 1) > 0
            many = hits[group] | (far > 0)
            if last is not None and last[0] == t[0]:
                many |= (t == last[0]) & (last[1] | (c != last[2]))
            keep = fresh & many
            end = t == t[-1]
            known = bool(many[-1])
            if known:
                yield pa.RecordBatch.from_arrays([x.filter(pa.array(keep)) for x in b.columns], schema=b.schema)
                # its rows are passed on; later rows of the token follow
                held, last = None, (t[-1], True, c[-1])
            else:
                # one class so far: hold a row of it
                keep &= ~end
                yield pa.RecordBatch.from_arrays([x.filter(pa.array(keep)) for x in b.columns], schema=b.schema)
                held, last = b.slice(len(t) - 1, 1), None

    schema = "token bigint, cls bigint, n int, far smallint"
    parts = rows.mapInArrow(postings, schema).repartition("token", "far").sortWithinPartitions("token", "cls")
    lists = stage(parts.mapInArrow(shared, schema).select("token", "cls", "n").distinct(), "shared-lists")
    # prefix shingles in no other prefix; _may_link tells what they rule out
    left = lists.groupBy("cls", "n").agg(F.count(F.lit(1)).alias("left"))
    least = F.floor((F.col("n") * percent + 99) / 100)
    width = F.least(F.col("n"), F.col("n") - least + F.least(F.lit(SUPPORT), least))
    most = left.select("cls", (F.col("n") - width + F.col("left")).cast("int").alias("most"))
    return stage(lists.join(stage(most, "most-shared"), "cls"), "inverted-lists")


def divide_skip(lists: list[np.ndarray], least: int, ratio: float = 0.01) -> np.ndarray:
    """Members that occur in at least ``least`` of the sorted lists.

    The longest lists are set aside, as many as ``least / (ratio * log2(longest)
    + 1)`` and fewer than ``least``; a member of enough lists must occur
    ``least - aside`` times in the short ones. Those are merged (one sort of
    their concatenation), and what reaches that count is looked up in each long
    list by binary search."""
    lists = sorted((x for x in lists if len(x)), key=len)
    if len(lists) < least:
        return np.zeros(0, np.int64)
    aside = min(least - 1, int(least / (ratio * np.log2(max(2, len(lists[-1]))) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    member, count = np.unique(np.concatenate(short), return_counts=True)
    member, count = member[count >= least - aside], count[count >= least - aside]
    for x in long:
        at = np.minimum(np.searchsorted(x, member), len(x) - 1)
        count = count + (x[at] == member)
    return member[count >= least]


def _compare(pairs: DataFrame, texts: DataFrame, sizes: DataFrame, n: int, percent: int) -> DataFrame:
    """The true links ``u, v`` among ``q, m`` (class pairs), on whole sets. A
    query's members are split into blocks of about BLOCK_SHINGLES."""
    load = pairs.join(sizes.select(F.col("cls").alias("m"), "n"), "m").groupBy("q").agg(F.sum("n").alias("load"))
    blocks = load.select("q", F.ceil(F.col("load") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    placed = pairs.join(blocks, "q").select("q", F.pmod(F.xxhash64("m"), F.col("blocks")).alias("block"), F.col("m").alias("cls"))
    own = blocks.select("q", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("blocks") - 1).cast("long"))).alias("block"), F.col("q").alias("cls"))
    rows = placed.unionByName(own).join(texts, "cls").select("q", "block", "cls", "text")
    # in a block the query comes first
    rows = rows.repartition("q", "block").sortWithinPartitions("q", "block", F.col("cls") != F.col("q"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = np.zeros(0, np.uint64)
        for whole in batches:
            for b in row_slices(whole, 3):
                out = []
                for q, c, s in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), shingle_sets(b.column(3), n), strict=True):
                    if c == q:
                        query = s.copy()  # not the whole slice
                        continue
                    at = np.minimum(np.searchsorted(query, s), len(query) - 1)
                    if int((query[at] == s).sum()) >= overlap_needed(len(query), len(s), percent):
                        out.append((q, c))
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["u", "v"])

    return rows.mapInArrow(run, "u bigint, v bigint")


def _may_link(percent: int):
    """Whether sizes (and shingles that others have) of ``n, most`` and ``qn,
    qmost`` allow a link. Only of the side whose prefix ends first is every shared
    prefix shingle in the other's prefix, so the larger ``most`` is the bound."""
    return F.least("n", "qn", F.greatest("most", "qmost")) * (100 + percent) >= (F.col("n") + F.col("qn")) * percent


def _with_components(lists: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return lists.withColumn("comp", F.col("cls"))
    named = comps.select(F.col("v").alias("cls"), "c")
    return lists.join(named, "cls", "left").withColumn("comp", F.coalesce("c", "cls")).drop("c")


def _open_lists(lists: DataFrame, comps: DataFrame | None, rows: int) -> DataFrame:
    """The lists that hold several components, with their members' components."""
    if comps is None:
        return _with_components(lists, None)  # every list has several classes
    now = stage(_with_components(lists, comps), "lists-now", rows)
    several = now.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b").select("token")
    return stage(now.join(stage(several, "open-tokens", rows), "token"), "open-lists", rows)


def _leader_pairs(opened: DataFrame, turn: int, percent: int, rows: int) -> DataFrame:
    """Each member with the leader it shares most open lists with."""
    rank = F.xxhash64(F.col("cls"), F.lit(turn))
    leaders = opened.groupBy("token").agg(F.min(F.struct(rank, "cls", "n", "comp", "most")).alias("l"))
    named = [F.col("l.cls").alias("q")] + [F.col(f"l.{c}").alias(f"q{c}") for c in ("n", "comp", "most")]
    leaders = stage(leaders.select("token", *named), "leaders", rows)
    met = opened.join(leaders, "token").filter("comp <> qcomp").filter(_may_link(percent))
    shared = met.groupBy(F.col("cls").alias("m"), "q").agg(F.count(F.lit(1)).alias("k"))
    return shared.groupBy("m").agg(F.max(F.struct("k", "q")).alias("b")).select(F.col("b.q").alias("q"), "m")


def _homes(opened: DataFrame, rows: int) -> DataFrame:
    """``cls, home``: blocks of at most about BLOCK_CLASSES classes whose commonest
    open list is the same."""
    sizes = stage(opened.groupBy("token").agg(F.count(F.lit(1)).alias("k")), "open-sizes", rows)
    best = opened.join(sizes, "token").groupBy("cls").agg(F.max(F.struct("k", "token")).alias("h"))
    best = stage(best.select("cls", F.col("h.token").alias("token")), "commonest", rows)
    crowd = best.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES).alias("parts"))
    part = F.pmod(F.xxhash64("cls"), F.col("parts"))
    return best.join(stage(crowd, "crowds", rows), "token").select("cls", F.xxhash64("token", part).alias("home"))


def _candidates(opened: DataFrame, homes: DataFrame, percent: int, rows: int) -> DataFrame:
    """T-occurrence search over the open lists: candidate pairs of different
    components that share enough prefix shingles, packed as ``a, b`` (homes, in
    order) and the lists ``u, v`` of their classes."""
    opened = opened.join(homes, "cls")
    largest = opened.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
    largest = stage(largest.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("l"), F.sum("k").alias("k")), "list-sizes", rows)
    longest = largest.agg(F.max("k")).first()[0] or 0
    blocks = max(1, -(-longest // BLOCK_MEMBERS))
    block = F.pmod(F.xxhash64("cls"), F.lit(blocks)).cast("int")
    member = F.struct(*MEMBER)
    main = largest.select("token", F.col("l.comp").alias("main"))
    told = stage(opened.join(main, "token").withColumn("inside", F.col("comp") == F.col("main")).drop("main"), "told-lists", rows)
    packed = told.groupBy("token", "inside", block.alias("block")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    # columns of plain numbers: a list goes to every class that asks it
    columns = [F.col(f"members.{c}").alias(f"m_{c}") for c in MEMBER]
    packed = stage(packed, "packed-lists", rows).select("token", "inside", "block", *columns)
    askers = stage(told.filter(~F.col("inside")).select("cls").distinct(), "askers", rows)
    asked = told.join(askers, "cls").select("token", "inside", F.col("cls").alias("q"), *[F.col(c).alias(f"q{c}") for c in ("n", "comp", "most", "home")])
    # inside the largest component it is enough to ask the others
    sides = F.when(F.col("inside"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    met = stage(asked, "queries", rows).withColumn("inside", F.explode(sides)).join(packed, ["token", "inside"])

    met = met.select("q", "block", "qn", "qcomp", "qmost", "qhome", *[f"m_{c}" for c in MEMBER])
    met = met.repartition("q", "block").sortWithinPartitions("q", "block")
    return met.mapInArrow(lambda batches: _searched(batches, percent), "a bigint, b bigint, u array<bigint>, v array<bigint>")


def _fitting(b: pa.RecordBatch, percent: int, before: int) -> dict[str, np.ndarray]:
    """The members in lists of ``b`` whose sizes allow a link with their query, in
    order; ``row`` numbers the lists from ``before``."""
    ask = {c: b.column(c).to_numpy() for c in ("q", "block", "qn", "qcomp", "qmost", "qhome")}
    lists = {c: b.column(f"m_{c}") for c in MEMBER}
    member = {c: x.flatten().to_numpy() for c, x in lists.items()}
    row = np.repeat(np.arange(b.num_rows), lists["cls"].value_lengths().to_numpy())
    n, qn = member["n"].astype(np.int64), ask["qn"].astype(np.int64)[row]
    bound = np.minimum(np.minimum(n, qn), np.maximum(member["most"], ask["qmost"][row]))
    fits = np.flatnonzero((bound * (100 + percent) >= (n + qn) * percent) & (member["comp"] != ask["qcomp"][row]))
    out = {c: ask[c][row[fits]] for c in ("q", "block", "qn", "qhome")}
    return out | {"row": row[fits] + before} | {c: member[c][fits] for c in ("cls", "n", "home")}


def _occurring(row: np.ndarray, cls: np.ndarray, size: np.ndarray, qn: int, percent: int) -> np.ndarray:
    """Positions of the candidates of a query of size ``qn``, one each, among the
    members ``cls`` (of ``size``) in its lists ``row``."""
    size = size.astype(np.int64)
    # lists of equal T are searched together: T falls only for tiny sets
    need = np.minimum(np.minimum(SUPPORT, required(size, percent)), required(qn, percent))
    found = [np.zeros(0, np.int64)]
    for t in np.unique(need):
        use = np.flatnonzero(need == t)
        edge = (np.flatnonzero(np.diff(row[use])) + 1).tolist()
        lists = [cls[use[a:e]] for a, e in zip([0, *edge], [*edge, len(use)], strict=True)]
        m = divide_skip(lists, int(t))
        if not len(m):
            continue
        # all shared prefix shingles are counted, and the side whose prefix
        # ends first has no more shared ones than these and those behind it
        member, first, k = np.unique(cls[use], return_index=True, return_counts=True)
        at = np.searchsorted(member, m)
        place = use[first[at]]
        n = size[place]
        behind = np.maximum(behind_prefix(n, percent), behind_prefix(qn, percent))
        found.append(place[k[at] + behind >= overlap_needed(n, qn, percent)])
    return np.concatenate(found)


def _searched(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The search of ``_candidates`` over rows sorted by query and block. Of a
    query whose lists go on in the next slice only the fitting members are held."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    columns = ("q", "block", "qn", "qhome", "row", "cls", "n", "home")

    def packed(x: dict[str, np.ndarray]) -> pa.RecordBatch:
        edge = np.flatnonzero((np.diff(x["q"]) != 0) | (np.diff(x["block"]) != 0)) + 1
        out = []
        for a, e in zip([0, *edge.tolist()], [*edge.tolist(), len(x["q"])], strict=True):
            # fewer fitting members than the least T of any: no candidate
            if e == a or e - a < min(SUPPORT, required(int(min(x["qn"][a], x["n"][a:e].min())), percent)):
                continue
            q, qhome = int(x["q"][a]), int(x["qhome"][a])
            m = a + _occurring(x["row"][a:e], x["cls"][a:e], x["n"][a:e], int(x["qn"][a]), percent)
            at = x["home"][m]
            for h in np.unique(at):
                mine = x["cls"][m[at == h]].tolist()
                sides = [(qhome, [q] * len(mine)), (int(h), mine)]
                (a_, u), (b_, v) = sides if qhome <= h else sides[::-1]
                out.append((a_, b_, u, v))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=list("abuv"))

    held, before = None, 0
    for whole in batches:
        for b in _list_slices(whole):
            x = _fitting(b, percent, before)
            before += b.num_rows
            if held is not None:
                x = {c: np.concatenate([held[c], x[c]]) for c in columns}
            q, block = (b.column(c)[b.num_rows - 1].as_py() for c in ("q", "block"))
            goes_on = (x["q"] == q) & (x["block"] == block)
            yield packed({c: v[~goes_on] for c, v in x.items()})
            held = {c: v[goes_on] for c, v in x.items()}
    if held is not None:
        yield packed(held)


def _list_slices(whole: pa.RecordBatch, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole lists that have about ``most`` members."""
    ends = np.cumsum(whole.column("m_cls").value_lengths().to_numpy())
    at = 0
    while at < whole.num_rows:
        gone = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, gone + most, "right")))
        yield whole.slice(at, end - at)
        at = end


def _packed_sets(texts: DataFrame, n: int) -> DataFrame:
    """``home, cls, size, shingles``: the whole sets of some blocks, from ``home,
    cls, text``."""

    def run(group: pa.Table) -> pa.Table:
        sets = shingle_sets(group.column("text").combine_chunks(), n)
        return pa.table(
            {
                "home": group.column("home").slice(0, 1),
                "cls": pa.array([group.column("cls").to_pylist()], pa.list_(pa.int64())),
                "size": pa.array([[len(x) for x in sets]], pa.list_(pa.int32())),
                "shingles": pa.array([np.concatenate(sets).tobytes()], pa.binary()),
            }
        )

    return texts.groupBy("home").applyInArrow(run, "home bigint, cls array<bigint>, size array<int>, shingles binary")


def overlaps(lists: list[np.ndarray], least: int, members: int, ratio: float = 0.01) -> np.ndarray:
    """How many of the lists each of ``members`` numbered members is in, for those
    in at least ``least``; less than that for others. DivideSkip, as in
    ``divide_skip``: short lists are merged by counting, long ones are probed. One
    of up to PROBED members is counted in less time than a probe takes to start."""
    lists = sorted(lists, key=len)
    longest = len(lists[-1]) if lists else 0
    probed = sum(len(x) > PROBED for x in lists) if longest > PROBED else 0
    aside = min(least - 1, int(least / (ratio * np.log2(max(2, longest)) + 1)), probed)
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    count = np.bincount(np.concatenate(short), minlength=members) if short else np.zeros(members, np.int64)
    open_ = np.flatnonzero(count >= least - aside)
    for x in long:
        if len(x):
            at = np.minimum(np.searchsorted(x, open_), len(x) - 1)
            count[open_[x[at] == open_]] += 1
    return count


def links_between(pairs: list[tuple[np.ndarray, np.ndarray]], cls: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """The true links among candidate pairs of some classes, by a search over the
    inverted lists of their whole sets."""
    size = np.array([len(x) for x in sets], np.int64)
    flat = np.concatenate(sets)
    member = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    token, begin = np.unique(flat[order], return_index=True)
    member, end = member[order], np.append(begin[1:], len(flat))
    by_cls = np.argsort(cls)
    place = lambda x: by_cls[np.searchsorted(cls[by_cls], x)]
    asked = np.unique(np.concatenate([place(u) * len(cls) + place(v) for u, v in pairs]))
    first, second = np.divmod(asked, len(cls))
    edge = np.flatnonzero(np.diff(first)) + 1
    out = []
    for wanted, u in zip(np.split(second, edge), first[np.append(0, edge)], strict=True) if len(asked) else ():
        need = overlap_needed(size[u], size[wanted], percent)
        at = np.searchsorted(token, sets[u])
        count = overlaps([member[begin[i] : end[i]] for i in at], int(need.min()), len(sets))
        out += [(int(cls[u]), int(cls[w])) for w in wanted[count[wanted] >= need]]
    return out


def _search(opened: DataFrame, texts: DataFrame, sizes: DataFrame, n: int, percent: int, rows: int) -> DataFrame:
    """The true links ``u, v`` that the search over the open lists finds."""
    homes = stage(_homes(opened, rows), "homes", rows)
    found = stage(_candidates(opened, homes, percent, rows), "candidates")
    held = homes.groupBy("home").agg(F.count(F.lit(1)).alias("held"))
    number = found.groupBy("a", "b").agg(F.sum(F.size("u")).alias("k"))
    for side in ("a", "b"):
        number = number.join(held.select(F.col("home").alias(side), F.col("held").alias(f"{side}_held")), side)
    dense = stage(number.filter(F.col("k") >= DENSE * (F.col("a_held") + F.col("b_held"))).select("a", "b"), "dense-blocks", rows)

    single = found.join(dense, ["a", "b"], "left_anti").select(F.explode(F.arrays_zip("u", "v")).alias("p"))
    single = single.select(F.least("p.u", "p.v").alias("q"), F.greatest("p.u", "p.v").alias("m")).distinct()
    links = _compare(stage(single, "pairs"), texts, sizes, n, percent)
    if dense.isEmpty():
        return links

    needed = dense.select(F.col("a").alias("home")).union(dense.select("b")).distinct()
    named = homes.join(stage(needed, "dense-homes", rows), "home")
    sets = stage(_packed_sets(texts.join(named, "cls"), n), "dense-sets")
    columns = ["a", "b", "cls", "size", "shingles"]
    first = dense.join(sets.withColumnRenamed("home", "a"), "a").select(*columns)
    second = dense.filter("a <> b").join(sets.withColumnRenamed("home", "b"), "b").select(*columns)

    def run(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        flat = lambda t, c: t.column(c).combine_chunks().flatten().to_numpy()
        whole = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in blocks.column("shingles")] or [np.zeros(0, np.uint64)])
        sets = np.split(whole, np.cumsum(flat(blocks, "size"))[:-1])
        out = links_between([(flat(asked, "u"), flat(asked, "v"))], flat(blocks, "cls"), sets, percent) if asked.num_rows else []
        return pa.table({"u": pa.array([x[0] for x in out], pa.int64()), "v": pa.array([x[1] for x in out], pa.int64())})

    many = found.join(dense, ["a", "b"], "left_semi").groupBy("a", "b")
    return links.unionByName(many.cogroup(first.unionByName(second).groupBy("a", "b")).applyInArrow(run, "u bigint, v bigint"))


def similarity_classes(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 85
) -> DataFrame:
    """One row per document: ``doc_id, key, cls, n_shingles, group,
    component_id``; ``cls`` names the class of documents with equal sets,
    ``group`` the linked classes (also where no document has an id)."""
    bounded_batches(docs.sparkSession)
    key = F.xxhash64(docs[id_col].cast("string"), F.lit("\x00"), F.coalesce(docs[text_col], F.lit("")))
    rows = docs.select(docs[id_col].alias("doc_id"), key.alias("key"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    scanned = _scan_sets(rows, words)
    head = scanned.filter("part is null").select("doc_id", "key", "cls", "n")
    lists = _prefix_lists(rows.select("text"), _sketch(scanned), words, percent)

    # one text for every class that is in a list
    wanted = lists.select("cls").distinct()
    stands = head.filter("n > 0").groupBy("cls").agg(F.min("key").alias("key")).join(wanted, "cls")
    texts = rows.select("key", "text").join(stage(stands, "class-keys"), "key").select("cls", "text").dropDuplicates(["cls"])
    texts = stage(texts, "class-texts")
    sizes = lists.select("cls", "n").distinct()

    links, comps, postings = None, None, lists.count()
    for turn in range(ROUNDS + 1):
        opened = _open_lists(lists, comps, postings)
        if opened.isEmpty():
            break
        if turn < ROUNDS:
            pairs = stage(_leader_pairs(opened, turn, percent, postings), "pairs")
            found = stage(_compare(pairs, texts, sizes, words, percent), "links")
        else:
            found = stage(_search(opened, texts, sizes, words, percent, postings), "links")
        links = found if links is None else links.unionByName(found)
        comps = stage(components(links), "components", postings)

    named = _with_components(head, comps)
    linked = named.filter("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    out = named.join(stage(linked, "component-ids"), "comp", "left")
    return out.select(
        "doc_id",
        "key",
        "cls",
        F.col("n").alias("n_shingles"),
        F.col("comp").alias("group"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
