"""Stages of the text pipeline: an operator's decisions applied to the rows of ``documents``.

All but the last return the columns of their input as they are. A row is found again by its doc_id
and a hash of its text, so rows without doc_id and repeated ids are handled; rows equal in both are
one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.llm import exact_dedup, mixing, near_dedup, queries, toxicity
from trackside.llm.common import table


def _keyed(docs: DataFrame) -> DataFrame:
    """The whole row as ``row``, and its key: doc_id as text (none without one), hash of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.struct(*docs.columns).alias("row"), _id(F.col("doc_id")).alias("id"), F.xxhash64(text).alias("key"))


def _id(doc_id):
    return F.coalesce(doc_id.cast("long").cast("string"), F.lit("none"))


def _staying(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """One row of ``docs`` for each row of ``decided`` (doc_id, text_key, kept) that is kept."""
    stays = decided.filter("kept").select(_id(F.col("doc_id")).alias("id"), F.col("text_key").alias("key")).distinct()
    return _keyed(docs).join(stays, ["id", "key"]).dropDuplicates(["id", "key"]).select("row.*")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model of the labelled ones."""
    model = toxicity.learn(toxicity.graded(docs, table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, model, queries.REJECT)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return _staying(docs, exact_dedup.exact_duplicates(docs))


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return _staying(docs, near_dedup.near_duplicates(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Rows that repeat share the copies of both evenly."""
    mixed = mixing.pareto_mix(docs).groupBy(_id(F.col("doc_id")).alias("id"), F.col("text_key").alias("key"))
    copies = mixed.agg(F.round(F.sum("copies") / F.count(F.lit(1))).cast("int").alias("copies")).filter("copies > 0")
    return _keyed(docs).join(copies, ["id", "key"]).select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences for training."""
    return queries.packed(docs)
