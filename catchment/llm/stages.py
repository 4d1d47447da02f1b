"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir); all but the last return the columns of documents.

Nulls: a null text is not toxic, has fingerprint zero, holds no benchmark passage and no secret, and has no tokens.
A document without doc_id belongs to no group that could be named, so deduplication leaves it in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catchment.llm import bpe, decontamination, secrets, simhash, toxicity
from catchment.llm.queries import fold, table, vocabulary


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned outside the held-out fold, calls toxic go."""
    model = toxicity.train(docs.where(fold(5) != 0), table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score("text", model) < 0.5)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: of the least doc_id, and of its texts in the group the one of least hash."""
    text_hash = F.xxhash64("text").alias("_hash")
    near = simhash.grouped(docs, also=[text_hash]).where("doc_id is not null")
    first = near.groupBy("root").agg(F.min(F.struct("doc_id", "_hash")).alias("first")).select("first.*")
    copies = Window.partitionBy("doc_id", "_hash").orderBy(F.xxhash64(*[c for c in docs.columns if c != "text"]))
    kept = docs.withColumn("_hash", text_hash).join(first, ["doc_id", "_hash"], "left_semi")
    kept = kept.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy", "_hash")
    return kept.unionByName(docs.where("doc_id is null")).select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by marks; every document stays, with its count of characters brought up to date."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars")))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    path, pattern = vocabulary()
    ids = docs.select("doc_id", "text", bpe.encode("text", path, pattern).alias("ids"))
    back = bpe.decode("ids", path) == F.coalesce("text", F.lit("")).cast("binary")
    return ids.select("doc_id", "ids", bpe.n_tokens("ids").alias("n_tokens"), back.alias("round_trip"))
