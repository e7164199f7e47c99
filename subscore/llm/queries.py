"""The queries of the document operators, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscore.llm.chunk_dedup import exact_duplicates
from subscore.llm.common import ROW, crc_of_id, table
from subscore.llm.decontamination import find_contamination
from subscore.llm.filter_audit import audit_filters
from subscore.llm.mixing import schedule
from subscore.llm.near_dedup import near_duplicates
from subscore.llm.ngram_model import fit_ngrams, held_out, score_ngrams, training_rows
from subscore.llm.packing import pack_documents
from subscore.llm.prefix_trie import prefix_trie
from subscore.llm.secrets import find_secrets, fit_secrets
from subscore.llm.sharding import assign_shards
from subscore.llm.suffix_dedup import repeated_passages
from subscore.llm.token_counts import count_tokens
from subscore.llm.toxicity import FOLDS, fit_toxicity, score_toxicity

TOKENIZER = "byte_bpe_50k.json"
CONTEXT = 1024  # tokens
PACKING_TOKENIZER = "word_bpe_49k.json"


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = find_secrets(documents, fit_secrets(documents))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans"
    )


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = assign_shards(table(spark, folder, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = fit_toxicity(documents, table(spark, folder, "labels"))
    held_out = (crc_of_id() % FOLDS == 0).alias("held_out")
    return score_toxicity(documents, model).select("doc_id", held_out, "score", "predicted")


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_passages(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return schedule(table(spark, folder, "documents")).drop(ROW)


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = fit_ngrams(training_rows(documents))
    return score_ngrams(documents, model).select(
        "doc_id", held_out(), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack_documents(table(spark, folder, "documents"), public_tokenizers.path(PACKING_TOKENIZER))
    return packed.select(
        "doc_id",
        "start",
        F.shiftright(F.length("ids"), 2).cast("bigint").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: f
        for name, f in globals().items()
        if name.startswith("op") and name[2].isdigit() and callable(f)
    }
