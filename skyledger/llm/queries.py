"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import (
    bpe, chat, exact_dedup, language, licenses, lm_scoring, merkle, mixing, near_dedup, neighbours, private_data,
    ranked_search, suffix_dedup)
from skyledger.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

WEIGHTS = (5, 2, 1)
CAP = 3
BEST = 50


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), vocabulary_path()).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-1, 0, "user", shown), (-1, 1, "assistant", shown)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    back = chat.read_back(chat.format_chats(rows, vocabulary_path("byte_bpe_50k.json")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), WEIGHTS, CAP).select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = exact_dedup.new_index(spark).add(read_table(spark, sf_dir, "documents"))
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.train(read_table(spark, sf_dir, "documents"))
    found = language.identify(language.page_rows(read_table(spark, sf_dir, "pages"), model.languages), model)
    return found.withColumnRenamed("row", "page_id")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest_columns(licenses.scan_licenses(read_table(spark, sf_dir, "documents")))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read_table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(merkle.manifest(read_table(spark, sf_dir, "documents")))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), BEST)


def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.digest_columns(private_data.find_private(read_table(spark, sf_dir, "documents")))


def all_queries() -> dict[str, Query]:
    return {
        "op1_bpe": op1_bpe,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_neighbours": op3_neighbours,
        "op4_chat_format": op4_chat_format,
        "op5_mixing": op5_mixing,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_language_id": op7_language_id,
        "op8_near_dedup": op8_near_dedup,
        "op9_licenses": op9_licenses,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_merkle": op11_merkle,
        "op12_ranked_search": op12_ranked_search,
        "op13_private_data": op13_private_data,
    }
