"""I-Match document fingerprints (operator 8).

The lexicon holds the terms whose document frequency, as a share of all
documents, lies within a band: common terms say nothing, rare ones are typing
errors. A document keeps its distinct terms that are in the lexicon, sorted (by
their 64-bit code). Thirty-two random subsets of the lexicon, at rates from 1/4 down
to 1/512, each give one hash of the kept terms inside the subset; the fingerprint
is the list of these hashes. A change of few terms leaves most subsets' hashes as
they were, in long texts those of the sparse subsets. Likeness of two
fingerprints: of the subsets that hold a term of either, the share with equal
hashes.

Only DataFrame functions run. Document frequencies are counted over all
documents, partly in each task first. A lexicon has at most (distinct terms of a
document on average / lowest share) terms of 16 bytes; it is broadcast if it has
no more than ``broadcast_terms`` and joined by a shuffle otherwise. Neighbouring
documents are found without a global sort: a histogram of ids (65 536 cells) lays
out ranges of about equal size, each range is sorted by itself, and a copy of the
next range's first document stands behind each.

Defined results. Null text: empty. A text without a lexicon term: one hash of all
its distinct terms instead of the list; it is like another such text only if the
hashes agree (1 or 0). Ids are whole numbers; null ids come last, equal ids are
ordered by text hash. A single document is its own neighbour. Rows that repeat
are fingerprinted each. Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodlake.llm.common import stage

RATES = tuple(rate for rate in (4, 8, 16, 32, 64, 128, 256, 512) for _ in range(4))
CELLS = 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def distinct_words(text: Column) -> Column:
    return F.array_distinct(F.split(F.translate(text, _UPPER, _LOWER), r"[\x20\x09-\x0D]+"))


def terms(words: Column) -> Column:
    """Distinct words (A-Z lower-cased), and always the empty one."""
    return F.array_union(F.array(F.lit("")), words)


def lexicon(docs: DataFrame, text_col: str, lowest: float, highest: float) -> DataFrame:
    """``code, subsets``: the terms in the band; bit k of ``subsets`` tells
    whether the term is in subset k. The empty term (code of '') is in none."""
    counted = docs.select(F.explode(terms(distinct_words(F.coalesce(docs[text_col], F.lit(""))))).alias("term"))
    counted = counted.groupBy(F.xxhash64("term").alias("code")).agg(F.count(F.lit(1)).alias("df"))
    # every document has the empty term, so its frequency is their number
    counted = counted.withColumn("n", F.when(F.col("code") == F.xxhash64(F.lit("")), F.col("df")))
    counted = stage(counted, "term-frequencies")
    n = counted.agg(F.max("n")).first()[0] or 0
    band = counted.filter(F.col("n").isNotNull() | F.col("df").between(lowest * n, highest * n))
    bits = F.lit(0).cast("long")
    for k, rate in enumerate(RATES):
        inside = F.pmod(F.xxhash64(F.col("code"), F.lit(k)), F.lit(rate)) == 0
        bits = bits.bitwiseOR(F.when(inside & F.col("n").isNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return stage(band.select("code", bits.alias("subsets")), "lexicon")


def ranges(ids: DataFrame, rows_per_range: int) -> DataFrame:
    """``cell, range`` for the histogram cells of the column ``id`` that hold
    rows; ranges follow one another in id order."""
    cells = ids.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    # one row per cell: at most CELLS + 1
    upto = F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    return cells.select("cell", F.floor(F.coalesce(upto, F.lit(0)) / F.lit(rows_per_range)).cast("long").alias("range"))


def neighbours(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``range, number, extra, doc_id, text, next_text``; rows with ``extra``
    are the copies behind a range."""
    key = docs[id_col].cast("long")
    rows = docs.select(docs[id_col].alias("doc_id"), key.alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    low, high, n = rows.agg(F.min("id"), F.max("id"), F.count(F.lit(1))).first()
    low, span = low or 0, (high or 0) - (low or 0) + 1
    cell = F.floor((F.col("id").cast("double") - F.lit(float(low))) * F.lit(CELLS / span)).cast("long")
    rows = rows.withColumn("cell", F.coalesce(F.least(cell, F.lit(CELLS - 1)), F.lit(CELLS)))
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = stage(ranges(rows, max(1, -(-n // parts))), "id-ranges")
    rows = rows.join(F.broadcast(laid), "cell").drop("cell")  # at most CELLS + 1 rows

    # the first document of every range, to stand behind the range before
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tie")).alias("f")
    firsts = rows.groupBy("range").agg(first)
    before = Window.orderBy("range")  # one row per range
    last = F.max("range").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = stage(
        firsts.select(
            "range", F.coalesce(F.lag("range").over(before), last).alias("to"), F.col("f.id").alias("fid"), F.col("f.tie").alias("ftie")
        ),
        "first-documents",
    )
    same = (F.col("r.range") == F.col("s.range")) & F.col("id").eqNullSafe(F.col("fid")) & (F.col("tie") == F.col("ftie"))
    copies = rows.alias("r").join(F.broadcast(firsts.alias("s")), same)
    copies = copies.select(F.col("to").alias("range"), "doc_id", "id", "text", "tie").dropDuplicates(["range", "id", "tie"])
    columns = ["range", "doc_id", "id", "text", "tie"]
    together = rows.select(*columns, F.lit(False).alias("extra")).unionByName(copies.select(*columns, F.lit(True).alias("extra")))
    order = Window.partitionBy("range").orderBy("extra", F.col("id").asc_nulls_last(), "tie")
    return together.select(
        "range", F.row_number().over(order).alias("number"), "extra", "doc_id", "text", F.lead("text").over(order).alias("next_text")
    )


def subset_hashes(df: DataFrame) -> DataFrame:
    """``hashes`` in place of ``kept``, sorted ``array<struct<code, subsets>>``: one
    hash per subset, 0 if it holds none of the terms. Each step is a projection of its
    own: lists of the subsets of a rate first, so that a sparse subset isn't sought in
    the whole list, then each subset's list, which is made once and read twice."""
    others = [c for c in df.columns if c != "kept"]
    rates = sorted(set(RATES))
    of = {rate: [k for k, r in enumerate(RATES) if r == rate] for rate in rates}

    def inside(column: str, subsets: list[int]) -> Column:
        mask = F.lit(sum(1 << k for k in subsets)).cast("long")
        return F.filter(column, lambda t: t["subsets"].bitwiseAND(mask) != 0)

    df = df.select(*others, *[inside("kept", of[rate]).alias(f"rate{rate}") for rate in rates])
    df = df.select(*others, *[inside(f"rate{rate}", [k])["code"].alias(f"codes{k}") for k, rate in enumerate(RATES)])
    hashed = [F.when(F.size(f"codes{k}") > 0, F.xxhash64(f"codes{k}")).otherwise(F.lit(0)) for k in range(len(RATES))]
    return df.select(*others, F.array(*hashed).alias("hashes"))


def likeness(a: Column, b: Column, a_all: Column, b_all: Column) -> Column:
    held = F.aggregate(F.zip_with(a, b, lambda x, y: ((x != 0) | (y != 0)).cast("int")), F.lit(0), lambda s, x: s + x)
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: ((x != 0) & (x == y)).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(held > 0, equal / held).otherwise((a_all == b_all).cast("double"))


def fingerprints(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lowest: float = 0.001,
    highest: float = 0.01,
    broadcast_terms: int = 1_000_000,
) -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``. The edited text has its last
    half replaced by the beginning of the next document's."""
    words = lexicon(docs, text_col, lowest, highest)
    small = words.count() <= broadcast_terms
    placed = neighbours(docs, id_col, text_col)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next_text", half))
    sides = placed.select(
        "range", "number", "extra", "doc_id", F.posexplode(F.array(F.col("text"), edited)).alias("side", "text")
    ).filter(F.col("text").isNotNull())
    # what a text needs besides its terms is made before they are laid out, so that
    # no term's row holds the text, and goes with the empty term
    row = ["range", "number", "side", "extra", "doc_id"]
    sides = sides.select(
        *row,
        F.length("text").alias("n_chars"),
        F.when(F.col("side") == 1, F.sha2("text", 256)).alias("sha"),
        distinct_words(F.col("text")).alias("words"),
    )
    sides = sides.withColumn("whole", F.xxhash64(F.sort_array("words")))
    exploded = sides.select(*row, "n_chars", "sha", "whole", F.explode(terms(F.col("words"))).alias("term"))
    head = F.col("term") == ""
    slim = exploded.select(
        "range",
        "number",
        "side",
        F.xxhash64("term").alias("code"),
        *[F.when(head, F.col(c)).alias(c) for c in ("extra", "doc_id", "n_chars", "sha", "whole")],
    )
    found = slim.join(F.broadcast(words) if small else words, "code")
    per_side = found.groupBy("range", "number", "side").agg(
        F.sort_array(F.collect_list(F.struct("code", "subsets"))).alias("kept"),
        *[F.max(c).alias(c) for c in ("extra", "doc_id", "n_chars", "sha", "whole")],
    )
    per_side = subset_hashes(per_side)
    of = lambda c, side: F.max(F.when(F.col("side") == side, F.col(c)))
    rows = per_side.groupBy("range", "number").agg(
        of("extra", 0).alias("extra"),
        of("doc_id", 0).alias("doc_id"),
        of("n_chars", 0).cast("long").alias("n_chars"),
        of("sha", 1).alias("edited_sha256"),
        *[of(c, s).alias(f"{c}{s}") for c in ("hashes", "whole") for s in (0, 1)],
    )
    order = Window.partitionBy("range").orderBy("number")
    rows = rows.withColumn("hashes2", F.lead("hashes0").over(order)).withColumn("whole2", F.lead("whole0").over(order))

    def text_of(hashes: str, whole: str) -> Column:
        listed = F.array_join(F.transform(hashes, lambda h: F.hex(h)), "-")
        return F.when(F.exists(hashes, lambda h: h != 0), listed).otherwise(F.concat(F.lit("all-"), F.hex(whole)))

    like = lambda k: likeness(F.col("hashes0"), F.col(f"hashes{k}"), F.col("whole0"), F.col(f"whole{k}"))
    return rows.filter(~F.col("extra")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text_of("hashes0", "whole0").alias("fingerprint"),
        text_of("hashes1", "whole1").alias("edited_fingerprint"),
        like(1).alias("near_edited"),
        like(2).alias("near_next"),
    )
