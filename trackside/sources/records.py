"""Topic records, as a stream or as a bounded read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed value: the topic.
TOPIC = "train_data"

# The columns every topic source has.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def stream_topic(
    spark: SparkSession,
    topic: str = TOPIC,
    servers: str = "localhost:9092",
    starting: str = "latest",
    max_offsets: int | None = None,
    **options: str,
) -> DataFrame:
    """Unbounded records of one topic; needs the Kafka connector on the class path.

    ``max_offsets`` bounds a micro-batch, so that a restart after a long stop does not read
    the whole backlog at once. Checkpoints belong to the writers, not here.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.options(**options).load()


def read_topic(
    spark: SparkSession,
    topic: str = TOPIC,
    servers: str = "localhost:9092",
    starting: str = "earliest",
    ending: str = "latest",
    **options: str,
) -> DataFrame:
    """Bounded read of a topic between two offsets."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("endingOffsets", ending)
        .options(**options)
        .load()
    )


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TOPIC_SCHEMA,
    fmt: str = "parquet",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Records landed as files, with the same columns, as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.options(**options).load(path)
