"""One query per operator, on whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    bpe, decontaminate, jaccard, lines, lm, mixing, quality, spelling, tokens, topk, urls, warc, whitening,
)
from tradewind.llm.common import importable, table, text_or_empty
from tradewind.llm.oracle import ORACLE as ORACLE


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, name = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = F.col(name)
    return judged.select(
        "doc_id", *[f"{name}.{measure}" for measure in quality.BASE], f"{name}.base_failed",
        (~found["base_failed"] & found["reason"].isNull()).alias("kept"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned, name = mixing.mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select(
        "doc_id", f"{name}.size", f"{name}.source_size", f"{name}.target",
        (F.col(f"{name}.size") * F.col(f"{name}.copies")).alias("taken"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, name = lm.score_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select("doc_id", *[f"{name}.{c}" for c in ("n_words", "log_prob", "mean_log_prob")])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs, removed="n_removed")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = text_or_empty(F.col("text"))
    return docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
        tokens.token_count(F.col("text"), public_tokenizers.path("byte_bpe_50k.json")).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > 512)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode_and_decode(F.col("text"), path)
    encoded = table(spark, sf_dir, "documents").select("doc_id", coded.alias("coded")).select("doc_id", "coded.*")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read_records(index, with_payload=False).select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.withColumnRenamed("id", "vec_id")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("id").alias("doc_id"), "class_id", "copy_id", "n_copies", "n_links", "n_texts")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, name = urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return judged.select("page_id", *[f"{name}.{c}" for c in ("host", "path", "rule", "verdict")])


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text"), misspell=97))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    of = F.col(name)
    return found.select(
        "doc_id", of["n_words"].alias("n_words"), of["n_hit"].alias("n_hit"), F.size(of["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", of["items"]).cast("binary"), 256).alias("items_sha256"), (of["n_hit"] > 0).alias("contaminated"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(importable(spark), sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    build.__name__: _query(build)
    for build in (
        op1_quality_rules, op2_mix_sources, op3_lm_scoring, op4_line_dedup, op5_token_counts, op6_bpe, op7_warc, op8_topk_search, op9_jaccard_join,
        op10_url_filters, op11_spelling_variants, op12_decontaminate, op13_whitening,
    )
}
