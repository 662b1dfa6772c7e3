"""Documents to training data: stages that each write a table the next one reads."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import bpe, jaccard, lines, mixing, quality
from tradewind.llm.common import column, fresh_name, importable, table
from tradewind.operators.lineage import written


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; those that lose every line go."""
    removed = fresh_name(docs, "removed")
    cut = lines.dedup_lines(docs, removed=removed)
    left = cut.filter((column(removed) == 0) | (F.length(F.trim("text")) > 0)).drop(removed)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest id."""
    return jaccard.keep_one(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for."""
    return mixing.mix(docs)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and a digest of the text they decode to. Other columns than those of
    ``documents`` end here."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode_and_decode(F.col("text"), vocabulary)
    return docs.select("doc_id", "lang", "source", coded.alias("coded")).select(
        "doc_id", "lang", "source", F.col("coded.ids").alias("token_ids"),
        F.size("coded.ids").cast("long").alias("n_tokens"), F.sha2(F.col("coded.text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", keep_good_documents),
    ("line dedup", cut_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_to_weights),
    ("BPE", encode_documents),
]

# Hash signatures and token merges have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(importable(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
