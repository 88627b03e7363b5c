"""Topic records from ``events``: one record per event, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.functions.values import NULL_TEXT

TOPIC = "train_data"

# A code of seven characters from the whole event type: its first letter and a hash of it. SQL text
# for both engines.
LOCATION = "upper(concat(substr(event_type, 1, 1), substr(md5(event_type), 1, 6)))"


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _hhmm(moment: Column) -> Column:
    return F.date_format(moment, "HH:mm")


def record_fields() -> dict[str, Column]:
    """The twelve text fields of an event's record."""
    k, ts = _k(), F.col("ts")
    later = ts + F.expr("INTERVAL '2' MINUTE")
    estimate = ts + F.make_dt_interval(mins=k % 30 - 10)
    return {
        "sequence_number": F.col("event_id").cast("string"),
        "schedule_id": F.concat(F.date_format(ts, "yyyyMMdd"), F.lpad(F.col("user_id").cast("string"), 8, "0")),
        "unique_id": F.concat(F.lit("C"), F.lpad(F.col("user_id").cast("string"), 5, "0")),
        "service_start_date": F.date_format(ts, "yyyy-MM-dd"),
        "location_code": F.expr(LOCATION),
        "scheduled_arrival": F.date_format(ts, "HH:mm:ss"),
        "scheduled_departure": F.date_format(later, "HH:mm:ss"),
        "actual_arrival": F.when(k % 5 == 1, NULL_TEXT).when(k % 5 != 0, _hhmm(ts)),
        "actual_departure": F.when(k % 5 == 2, NULL_TEXT).otherwise(_hhmm(later)),
        "platforms": F.when(k % 7 == 0, NULL_TEXT).otherwise((k % 30 + 1).cast("string")),
        "estimated_time": F.when(k % 11 == 0, NULL_TEXT).otherwise(_hhmm(estimate)),
        "source": F.when(k % 4 == 0, "TD").when(k % 4 == 1, "TRUST").when(k % 4 == 2, "CIS").otherwise(NULL_TEXT),
    }


def topic_records(events: DataFrame) -> DataFrame:
    """Records with the seven topic columns."""
    fields = record_fields()
    value = F.to_json(
        F.struct(*[column.alias(name) for name, column in fields.items()]), {"ignoreNullFields": "false"}
    )
    key = F.concat(F.lit('"'), fields["unique_id"], F.lit('"'))
    return events.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def break_some(records: DataFrame) -> DataFrame:
    """Every tenth value loses its end, every fifteenth becomes plain text."""
    text = F.col("value").cast("string")
    broken = (
        F.when(F.col("offset") % 10 == 3, F.substring(text, 1, 40))
        .when(F.col("offset") % 15 == 4, F.lit("not json"))
        .otherwise(text)
    )
    return records.withColumn("value", broken.cast("binary"))


# The same fields for the checking engine.
RECORDS_SQL = f"""
SELECT event_id, ts, user_id, k,
  CAST(event_id AS VARCHAR) AS sequence_number,
  strftime(ts, '%Y%m%d') || lpad(CAST(user_id AS VARCHAR), 8, '0') AS schedule_id,
  'C' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS unique_id,
  strftime(ts, '%Y-%m-%d') AS service_start_date,
  {LOCATION} AS location_code,
  strftime(ts, '%H:%M:%S') AS scheduled_arrival,
  strftime(ts + INTERVAL 2 MINUTE, '%H:%M:%S') AS scheduled_departure,
  CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN 'null' ELSE strftime(ts, '%H:%M') END AS actual_arrival,
  CASE WHEN k % 5 = 2 THEN 'null' ELSE strftime(ts + INTERVAL 2 MINUTE, '%H:%M') END AS actual_departure,
  CASE WHEN k % 7 = 0 THEN 'null' ELSE CAST(k % 30 + 1 AS VARCHAR) END AS platforms,
  CASE WHEN k % 11 = 0 THEN 'null'
       ELSE strftime(ts + to_minutes(CAST(k % 30 - 10 AS INTEGER)), '%H:%M') END AS estimated_time,
  CASE k % 4 WHEN 0 THEN 'TD' WHEN 1 THEN 'TRUST' WHEN 2 THEN 'CIS' ELSE 'null' END AS source
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""
