"""The corpus pipeline: documents in, a mixed training corpus out.

``STAGES`` lists the stages in order; each is ``(spark, docs, sf_dir) ->
DataFrame``, works on all rows of its predecessor and is written as Parquet and
read again before the next one:

1. language ID: rows whose language can't be told go (null text, no letter, or a
   score below ``LEAST_SCORE``);
2. n-gram Jaccard join: of each group of linked documents the one with the
   smallest id stays;
3. benchmark decontamination: documents that hold a benchmark window go;
4. secret scans: every secret found is replaced in the text (``n_chars``
   follows); no document goes;
5. mixing: documents taken at least once, with ``copies`` and the source's
   ``target`` in words.

Stages 1 to 4 return the columns of their input. Nulls, empty texts, rows that
repeat and extra columns are handled as the operators' docstrings say; in stage
2 rows without a word are linked with nothing and all stay, and of rows that
agree in id and text one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prodlake.llm import decontaminate, jaccard_join, langid, mixing, secrets
from prodlake.llm.common import bounded_batches, free_name, row_key, ship, stage, table

LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    bounded_batches(spark)
    model = langid.learn(docs.select("text", "lang"))
    name = free_name(docs, "language_found")
    found = docs.withColumn(name, langid.detector(docs, model)(docs["text"]))
    known = (F.col(name)["lang"] != "und") & (F.col(name)["score"] >= LEAST_SCORE)
    return found.filter(known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    bounded_batches(spark)
    classes = jaccard_join.similarity_classes(docs).filter("n_shingles > 0")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    kept = classes.groupBy("group").agg(F.min(first).alias("first")).select(F.col("first.key").alias("kept_key"))
    name = free_name(docs, "row_key")
    keyed = docs.withColumn(name, row_key(docs["doc_id"], docs["text"]))
    has_word = F.coalesce(docs["text"].rlike(mixing.WORD), F.lit(False))
    chosen = keyed.filter(has_word).join(stage(kept, "kept-keys"), F.col(name) == F.col("kept_key"), "left_semi")
    return chosen.dropDuplicates([name]).unionByName(keyed.filter(~has_word)).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    bounded_batches(spark)
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    hit = stage(found.filter("n_hit > 0").select(F.col("key").alias("hit_key")).distinct(), "hit-keys")
    name = free_name(docs, "row_key")
    keyed = docs.withColumn(name, row_key(docs["doc_id"], docs["text"]))
    return keyed.join(hit, F.col(name) == F.col("hit_key"), "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    bounded_batches(spark)
    scan = secrets.scanner(secrets.identifier_dictionary(docs))
    clean = secrets.redacted(docs["text"], scan(docs["text"]))
    new = {"text": clean.alias("text")}
    out = docs.select(*[new.get(c, docs[c]) for c in docs.columns])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    bounded_batches(spark)
    mixed = mixing.mix_sources(docs, carry=tuple(docs.columns)).filter("copies > 0")
    extra = [F.col(c).alias(free_name(docs, c)) for c in ("target", "copies")]
    return mixed.select(*[F.col("row")[c].alias(c) for c in docs.columns], *extra)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("mixing sources", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each stage's rows are stored
    in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
    return docs


# learned models, hashes and compression can't be expressed in SQL; the tests
# hold the pipeline against a brute-force version instead
ORACLE_SQL = None
