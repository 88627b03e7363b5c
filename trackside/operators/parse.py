"""Topic records to twelve flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.functions.values import to_date, to_long
from trackside.schemas import RECORD_FIELDS, RECORD_SCHEMA


def text_pairs(records: DataFrame) -> DataFrame:
    """Key and value of topic records as text."""
    return records.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def parse_records(
    records: DataFrame, schema: T.StructType = RECORD_SCHEMA, keep: tuple[str, ...] = ()
) -> DataFrame:
    """JSON values to the record columns, all text, in fixed order.

    Malformed JSON gives a row of NULLs. The parse is a one-row generator, so that a later
    filter on a field is not pushed below it and the JSON parsed twice. ``keep`` names columns
    of the topic that go along, such as the ``value`` for rejects.
    """
    value = F.col("value").cast("string")
    parsed = records.select(*keep, F.explode(F.array(F.from_json(value, schema))).alias("train"))
    return parsed.select(*[F.col("train")[field.name].alias(field.name) for field in schema.fields], *keep)


def parse_records_typed(records: DataFrame) -> DataFrame:
    """The same with the two ids as long and the service date as date."""
    typed = {
        "sequence_number": to_long("sequence_number"),
        "schedule_id": to_long("schedule_id"),
        "service_start_date": to_date("service_start_date"),
    }
    return parse_records(records).select(
        *[typed.get(name, F.col(name)).alias(name) for name in RECORD_FIELDS]
    )


def decode_pairs(records: DataFrame) -> DataFrame:
    """Key and value decoded from JSON, as a plain reader of the topic would see them."""
    pairs = text_pairs(records).select(
        F.when(F.trim("key") != "null", F.get_json_object("key", "$")).alias("key"),
        F.explode(F.array(F.from_json("value", RECORD_SCHEMA))).alias("train"),
    )
    return pairs.select("key", *[F.col("train")[name].alias(name) for name in RECORD_FIELDS])


def schema_text(df: DataFrame) -> str:
    """The schema, one column per line, for logs."""
    return "\n".join(f"{field.name}: {field.dataType.simpleString()}" for field in df.schema.fields)
