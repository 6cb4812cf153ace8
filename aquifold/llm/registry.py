"""The registered queries of this subpackage and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from aquifold.llm import limb_codes, merkle, mixing, oracles, quality, toxicity
from aquifold.llm.chat import conversation_digest, format_windows
from aquifold.llm.common import table
from aquifold.llm.decontaminate import find_contamination
from aquifold.llm.jaccard_join import similar_documents
from aquifold.llm.language import fold, identify_held_out
from aquifold.llm.packing import pack
from aquifold.llm.personal_data import find_personal_data, span_text
from aquifold.llm.prefix_forest import nearest
from aquifold.llm.token_files import token_file_digest
from aquifold.session import stage


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    judged = quality.judge(quality.fit(docs, table(spark, folder, "labels")), docs, keep=["doc_id"])
    return judged.select("doc_id", "evidence", "site_rate", "quality_score", "keep")


def op2_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    control = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(control)
    return conversation_digest(stage(format_windows(turns), "windows"))


def op3_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_file_digest(table(spark, folder, "documents"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify_held_out(table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = find_contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_documents(table(spark, folder, "documents"))


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(table(spark, folder, "documents"), keep=["doc_id"])

    def number(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(k) for k in ("email", "ip", "card", "phone")],
        F.sha2(span_text("base_spans"), 256).alias("base_sha256"), span_text("spans").alias("spans"),
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = fold("doc_id", 3) == 1
    network = toxicity.fit(docs.filter(~held_out), labels.filter(~held_out))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return toxicity.score_documents(network, rows).select("doc_id", "held_out", "score", "predicted")


def op11_limb_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = limb_codes.compress(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))
    return coded.select(
        "vec_id", limb_codes.code_text().alias("code"), "error", F.col("group_error").alias("label_error"),
        F.lit(books.digest() if books else None).alias("codebooks_sha256"),
    )


def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, mixing.cyclic_weights(docs, [5, 2, 1]))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    rows = merkle.manifest(
        table(spark, folder, "documents"), changed={"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1},
        is_changed=F.crc32(F.col("doc_id").cast("string")) % 7 == 0,
    )
    return rows.select("doc_id", "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root", "verified")


_QUERIES = [
    op1_quality, op2_chat_windows, op3_prefix_forest, op4_token_files, op5_language, op6_packing, op7_decontaminate, op8_jaccard_join, op9_personal_data,
    op10_toxicity, op11_limb_codes, op12_mixing, op13_merkle,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: fn for fn in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql() | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
