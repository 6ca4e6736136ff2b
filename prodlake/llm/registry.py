"""The training-data queries: ``opN_<name>`` over whole tables, and ``pipeline``.

Each query applies its operator with production parameters and derives the
digest columns of its contract from the operator's output.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prodlake.llm import (
    byte_bpe,
    chat,
    decontaminate,
    hard_negatives,
    imatch,
    jaccard_join,
    langid,
    lm_score,
    mixing,
    oracle,
    resample,
    secrets,
    suffix_dedup,
    vector_codes,
)
from prodlake.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.similarity_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


#: a public vocabulary file; its path is the operator's parameter
VOCABULARY = "byte_bpe_50k.tiktoken"
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.read_back(chat.format_conversations(turns, tokenizer=public_tokenizers.path(VOCABULARY)))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[secrets.count_of(spans, k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(secrets.digest(spans, secrets.KINDS[:3]), 256).alias("base_sha256"),
        secrets.digest(spans, secrets.KINDS).alias("spans"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near",
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


BYTE_BPE = "byte_bpe_multi_50k.tiktoken"


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path(BYTE_BPE)
    coded = byte_bpe.encode(docs, path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decoder(docs, path)(F.col("ids")), 256).alias("decoded_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"])
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Query] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_chat_format": op2_chat_format,
    "op3_secrets": op3_secrets,
    "op4_language_id": op4_language_id,
    "op5_mixing": op5_mixing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_lm_score": op7_lm_score,
    "op8_imatch": op8_imatch,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_vector_codes": op13_vector_codes,
}
ORACLE: dict[str, str] = {
    "op1_jaccard_join": oracle.JACCARD_JOIN,
    "op6_suffix_dedup": oracle.SUFFIX_DEDUP,
    "op12_hard_negatives": oracle.HARD_NEGATIVES,
    "op13_vector_codes": oracle.vector_codes(),
}


def _shipping(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipping(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
