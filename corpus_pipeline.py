"""A training corpus in five stages, each over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import bpe, exact_dedup, language, mixing, near_dedup
from skyledger.llm.common import read_table, staged
from skyledger.llm.queries import CAP, WEIGHTS, vocabulary_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; trained on the labels of all of them."""
    return language.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.keep_first_copies(docs, exact_dedup.new_index(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id."""
    return near_dedup.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, to the nearest whole copy."""
    return mixing.mixed_rows(docs, WEIGHTS, CAP)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each document as packed ids, and a digest of what they decode to."""
    return bpe.round_trip(docs, vocabulary_path()).select(
        "doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mix),
    ("bpe", tokenize),
]

#: Language identification is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
