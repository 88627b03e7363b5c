"""Push frames landed as files: a header map and a compressed body per frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from trackside.sources.records import stream_files

FRAME_SCHEMA = T.StructType(
    [
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("body", T.BinaryType()),
    ]
)


def stream_frames(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return stream_files(spark, path, FRAME_SCHEMA, max_files=max_files)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FRAME_SCHEMA).parquet(path)
