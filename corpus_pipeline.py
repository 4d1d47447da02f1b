"""A training-data pipeline over `documents`: each stage works on all that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from catchment.llm import stages
from catchment.session import shared_dir

STAGES = [
    ("toxicity", stages.toxicity_filter),
    ("simhash", stages.simhash_dedup),
    ("decontamination", stages.benchmark_decontamination),
    ("secrets", stages.secret_scan),
    ("bpe", stages.bpe_encoding),
]

#: Trained scores, fingerprints and merges are beyond SQL: the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4()}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
