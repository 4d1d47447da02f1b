"""The queries of this subpackage: thin digests of the operators' results over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int) -> Column:
    """Which of n folds a document is in, by the checksum of its id as text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


def vocabulary() -> tuple[str, str]:
    """Path of the public vocabulary and its splitting pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import decontamination

    found = decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "n_tiles", "longest")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import language

    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(4) == 2)
    model = language.train(docs.where("not held_out"))
    called = docs.select("doc_id", "held_out", language.identify("text", model).alias("call"))
    return called.select("doc_id", "held_out", F.col("call.lang").alias("lang_pred"), "call.score", "call.ambiguous")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import bpe

    path, pattern = vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = docs.select("doc_id", bpe.encode("text", path, pattern).alias("ids"))
    decoded = ids.withColumn("decoded", bpe.decode("ids", path))
    return decoded.select("doc_id", bpe.n_tokens("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import simhash

    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import parsing

    kept = parsing.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import sharding

    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot")
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import secrets

    found = table(spark, sf_dir, "documents").select("doc_id", secrets.scan("text").alias("found"))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    base = F.filter("found", lambda s: s["kind"] != "entropy")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import recompression

    kept = recompression.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import embeddings

    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold(5) == 0).alias("held_out"))
    model = toxicity.train(docs.where("not held_out"), table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", "held_out", toxicity.score("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import negatives

    vectors = table(spark, sf_dir, "embeddings")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    rows, d = negatives.prepared(moved, "embedding", "vec_id", "label", scale=256)
    return negatives.mine(rows, rows.where(F.col("key") % 100 == 0), d, positives=5, negatives=5)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catchment.llm import whitening

    return whitening.whiten(table(spark, sf_dir, "embeddings"), "embedding", "vec_id", components=32)


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from catchment.llm import pieces

    docs = table(spark, sf_dir, "documents").select("doc_id", pieces.encode("text", public_tokenizers.path("piece_bpe_32k.model")).alias("enc"))
    ids_text = F.concat_ws(",", F.col("enc.ids").cast("array<string>"))
    return docs.select(
        "doc_id",
        F.size("enc.ids").cast("long").alias("n_tokens"),
        F.sha2(ids_text.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("enc.decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.col("enc.agrees").alias("library_agrees"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_decontamination, op2_language, op3_bpe, op4_simhash, op5_parsing, op6_sharding, op7_secrets, op8_recompression, op9_embeddings, op10_toxicity, op11_negatives, op12_whitening, op13_pieces)
}
SQL: dict[str, str] = {}
