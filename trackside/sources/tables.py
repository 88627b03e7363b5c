"""Plain tables, batch and stream."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

# Rows of a narrow table one task makes documents of; a document takes some 0.3 ms to make and read.
ROWS_PER_TASK = 50_000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """A table as a file stream, whether it is one file or a folder of files."""
    table = read_table(spark, folder, name)
    reader = spark.readStream.schema(table.schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    first = table.select("_metadata.file_path").first()
    if first is not None and first.file_path.endswith(f"/{name}.parquet"):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return reader.parquet(f"{folder}/{name}.parquet")


def slices(table: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> int:
    """How many tasks the work on a table is cut into: one per so many rows, at least one per core. Counted
    from the footers of its files."""
    return max(table.sparkSession.sparkContext.defaultParallelism, math.ceil(table.count() / rows_per_task))


def dealt(table: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Deal the narrow rows of a table out evenly before work that is heavy per row, so that no task grows
    with the table, however its files are cut."""
    return table.repartition(slices(table, rows_per_task))


def dealt_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """:func:`stream_table`, each batch dealt out as :func:`dealt` would deal the whole table."""
    return stream_table(spark, folder, name).repartition(slices(read_table(spark, folder, name)))


def spread(df: DataFrame) -> DataFrame:
    """Spread a table with fewer splits than cores before work that is heavy per row.

    A large table has splits enough and is passed through without a shuffle. For scans: to count
    the splits of a plan with shuffles would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
