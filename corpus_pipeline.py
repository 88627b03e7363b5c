"""Text pipeline over ``documents``: the stages in order, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackside.llm import stages
from trackside.session import work_dir

STAGES = [
    ("toxicity", stages.clean),
    ("exact_dedup", stages.distinct),
    ("near_dedup", stages.dissimilar),
    ("mix", stages.mix),
    ("pack", stages.pack),
]

#: SQL cannot say the classifier or the sampling; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
