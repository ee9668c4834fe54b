"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, collocations, decontaminate, lang_id, line_dedup, lm_score, near_dup, packing, quality,
    simhash, spelling, token_files, url_filter,
)
from .common import documents, take
from .oracles import oracle_sql  # noqa: F401  (part of this module's interface)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), chunks=1_000_000).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.pseudo_likelihood(documents(spark, sf_dir))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir), shingle=4).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(take(documents(spark, sf_dir), "doc_id", "text"))
    return judged.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept")])


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat.contrasts(spark.read.parquet(f"{sf_dir}/conversations.parquet"))

    def mask(name: str):
        return F.array_join(F.transform(name, lambda s: F.concat_ws(
            ":", s["start"], s["length"], s["train"])), ",").alias(name)

    return chat.format_turns(pairs).select(
        "chosen_id", "rejected_id", "n_common", "prompt", "chosen", "rejected",
        mask("chosen_mask"), mask("rejected_mask"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(take(documents(spark, sf_dir), "doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = take(documents(spark, sf_dir), "doc_id", "text")
    return decontaminate.scan(docs, benchmark).select(
        "doc_id", "hits.n_words", "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_filter.judge_urls(pages, url_filter.rules_frame(spark))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = lang_id.learn(docs.where(~held_out))
    return lang_id.predict(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(documents(spark, sf_dir), chunks=1_000_000)
    return token_files.read(spark, files).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_lm_score": op2_lm_score,
        "op3_near_duplicates": op3_near_duplicates,
        "op4_quality_rules": op4_quality_rules,
        "op5_preference_format": op5_preference_format,
        "op6_line_dedup": op6_line_dedup,
        "op9_decontamination": op9_decontamination,
        "op7_language_id": op7_language_id,
        "op8_token_files": op8_token_files,
        "op10_url_filter": op10_url_filter,
        "op11_collocations": op11_collocations,
        "op12_simhash": op12_simhash,
        "op13_spelling_variants": op13_spelling_variants,
    }
