"""The corpus pipeline: from documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written and read again as the next stage's
``docs``.  All but the last return the columns of ``documents``; a stage that
changes texts sets ``n_chars`` anew.  The last returns one row per packed
piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.llm import decontaminate, line_dedup, near_dup, packing, quality
from starweave.llm.common import (
    documents, forget, free_name, named_again, plain_names, shared_path, written,
)
from starweave.session import owned_scratch

# Distinct chunks of text that a packing worker remembers, about 30 MB: the executors
# still hold what the stages before took, and fewer chunks cost CPU seconds, no rows.
PACKING_CHUNKS = 120_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule, unchanged."""
    return quality.good_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without long lines that several documents share (the
    largest doc_id keeps them)."""
    docs, old = plain_names(docs, "doc_id", "text", *[c for c in docs.columns if c == "n_chars"])
    cleaned = line_dedup.dedup(docs)
    cleaned = cleaned.drop(*cleaned.columns[-2:])
    if "n_chars" in old:
        kind = cleaned.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(kind))
    return named_again(cleaned, old)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, unchanged: the one with
    the smallest doc_id; of several rows with that doc_id in the group, the
    one whose hash is least.  Texts that share a doc_id but are in no common group
    are different documents.  Rows without a doc_id stay."""
    docs, old = plain_names(docs, "doc_id", "text")
    found = written(near_dup.near_duplicates(docs).where(F.col("doc_id").isNotNull()), "found")
    name, key = free_name(docs, "found_id"), free_name(docs, "found_key")
    same = (F.col("doc_id") == F.col(name)) & (F.xxhash64("text") == F.col(key))
    lost = found.where(~F.col("kept")).select(
        F.col("doc_id").alias(name), F.col("text_key").alias(key)).distinct()
    kept = docs.join(lost, same, "left_anti")
    repeated = found.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = written(found.where("kept").join(repeated, "doc_id").select(
        F.col("doc_id").alias(name), F.col("text_key").alias(key),
        F.coalesce(F.col("group_id").cast("string"), F.concat(F.lit("text "), F.col("text_key")))
        .alias(free_name(docs, "found_group"))).distinct(), "again")
    if not again.isEmpty():
        rows = kept.join(again, same)
        one = rows.groupBy(*again.columns[::2]).agg(F.min_by(
            F.struct(*docs.columns), F.struct(F.col(key), F.xxhash64(*docs.columns))).alias("row"))
        kept = kept.join(again, same, "left_anti").unionAll(one.select("row.*"))
    return named_again(kept, old)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window, unchanged."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_documents(docs, benchmark)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, packed: one row per piece, with its ids."""
    return packing.pack(docs, chunks=PACKING_CHUNKS)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Token ids are not expressible in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and reread, and
    what it wrote on the way is deleted then, as is its input."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        path, before = shared_path(spark, "stage"), docs
        with owned_scratch(spark):
            step = stage(spark, docs, sf_dir)
            step.write.parquet(path)
        docs = spark.read.schema(step.schema).parquet(path)
        docs.written_to = path
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
