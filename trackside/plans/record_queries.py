"""Registered queries over topic records: parse, clean, stores and streams."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.operators import clean as c
from trackside.operators.parse import decode_pairs, parse_records, parse_records_typed
from trackside.operators.publish import to_records
from trackside.plans.joins import sorted_join
from trackside.schemas import RECORD_FIELDS
from trackside.session import work_dir
from trackside.sources.tables import read_table, spread, stream_table
from trackside.streaming import jobs, sinks, stores
from trackside.testfeed.records import RECORDS_SQL, break_some, topic_records

FIELDS = ", ".join(RECORD_FIELDS)


def records(spark: SparkSession, sf: str) -> DataFrame:
    return topic_records(spread(read_table(spark, sf, "events")))


def record_stream(spark: SparkSession, sf: str) -> DataFrame:
    return topic_records(stream_table(spark, sf, "events"))


def parse_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return parse_records(records(spark, sf))


def parse_typed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_records_typed(records(spark, sf))


def parse_malformed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_records(break_some(records(spark, sf)))


def null_sentinel(spark: SparkSession, sf: str) -> DataFrame:
    return c.normalise_null_text(parse_records(records(spark, sf)))


def cast_ids_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Some ids and dates are made unreadable first."""
    n = F.col("sequence_number").cast("bigint")
    spoiled = parse_records(records(spark, sf)).select(
        F.col("sequence_number").alias("row"),
        F.when(n % 9 == 0, F.concat(F.lit("x"), "sequence_number"))
        .when(n % 9 == 1, F.concat("sequence_number", F.lit(".7")))
        .otherwise(F.col("sequence_number"))
        .alias("sequence_number"),
        F.when(n % 7 == 0, "P1234567890123").otherwise(F.col("schedule_id")).alias("schedule_id"),
        F.when(n % 11 == 0, "2024-13-45").otherwise(F.col("service_start_date")).alias("service_start_date"),
    )
    return c.cast_ids_dates(spoiled)


def time_of_day_anchored(spark: SparkSession, sf: str) -> DataFrame:
    typed = c.cast_ids_dates(c.normalise_null_text(parse_records(records(spark, sf))))
    return c.anchor_clocks(typed.select("sequence_number", "service_start_date", *c.CLOCK_COLUMNS))


def time_of_day_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Times on the processing day: shown as the distance to that day's start, which is the same every day."""
    typed = c.clocks_today(c.normalise_null_text(parse_records(records(spark, sf))))
    today = F.current_date().cast("timestamp")
    return typed.select(
        F.col("sequence_number").cast("bigint").alias("sequence_number"),
        *[
            (F.unix_timestamp(name) - F.unix_timestamp(today)).alias(f"{name}_seconds")
            for name in c.CLOCK_COLUMNS
        ],
    )


def clean_data(spark: SparkSession, sf: str) -> DataFrame:
    return c.clean(parse_records(records(spark, sf)))


def json_encode_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Rows encoded as keyed records, and read back as a plain reader would."""
    return decode_pairs(to_records(parse_records(records(spark, sf))))


def raw_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return stores.upsert_view(stores.whole_keys(parse_records(records(spark, sf))))


def raw_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Records the keyed store cannot take: malformed JSON has no key."""
    broken = stores.broken_keys(parse_records(break_some(records(spark, sf))))
    return broken.agg(F.count(F.lit(1)).alias("rejected"), F.count("sequence_number").alias("with_sequence"))


def keyed_store(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches written to the keyed store, the second one twice; the view has each key once."""
    path = work_dir(spark, "keyed")
    rows = parse_records(records(spark, sf))
    early = F.col("sequence_number").cast("bigint") % 2 == 0
    stores.append_keyed(rows.where(early), 0, path)
    stores.append_keyed(rows.where(~early), 1, path)
    stores.append_keyed(rows.where(~early), 1, path)
    return stores.read_keyed(spark, path)


def keyed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "keyed")
    stores.append_keyed(parse_records(records(spark, sf)), 0, path)
    return stores.read_key(spark, path, "C00008", "ECB5E10")


def keyed_lookup_folded(spark: SparkSession, sf: str) -> DataFrame:
    """The same after the store was folded, part by part and into different numbers of files, up to the
    second level, and has a batch that came later."""
    path = work_dir(spark, "keyed")
    rows = parse_records(records(spark, sf))
    part = F.col("sequence_number").cast("bigint") % 6
    for number in range(5):
        stores.append_keyed(rows.where(part == number), number, path)
        stores.compact_keyed(spark, path, files=3 + number)
    stores.append_keyed(rows.where(part == 5), 5, path)
    return stores.read_key(spark, path, "C00008", "ECB5E10")


def time_partitioned_write(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "dated")
    stores.write_by_date(clean_data(spark, sf), path)
    return stores.read_by_date(spark, path)


def time_range_read(spark: SparkSession, sf: str) -> DataFrame:
    """A range of a store of six batches, five of which are folded into days, some up to the second level."""
    path = work_dir(spark, "dated")
    rows = clean_data(spark, sf)
    for number in range(6):
        stores.append_by_date(rows.where(F.col("sequence_number") % 6 == number), number, path)
        if number < 5:
            stores.compact_by_date(spark, path)
    return stores.read_between(spark, path, "2024-01-03 12:00:00", "2024-01-05 06:30:00")


def stream_clean_available_now(spark: SparkSession, sf: str) -> DataFrame:
    """The record stream cleaned into the dated store, drained."""
    path = work_dir(spark, "stream-clean")
    cleaned = c.clean(parse_records(record_stream(spark, sf)))
    sinks.drain(sinks.start_batches(cleaned, sinks.dated_writer(f"{path}/rows"), f"{path}/checkpoint", drain=True))
    return stores.read_by_date(spark, f"{path}/rows")


def stream_fanout(spark: SparkSession, sf: str) -> DataFrame:
    """One stream, some of it malformed, into four sinks; the rows each sink holds afterwards."""
    path = work_dir(spark, "fanout")
    query = jobs.start_stores(
        break_some(record_stream(spark, sf)),
        raw=sinks.keyed_writer(f"{path}/raw"),
        cleaned=sinks.dated_writer(f"{path}/clean"),
        extra=[sinks.file_writer(f"{path}/parsed")],
        reject=sinks.file_writer(f"{path}/rejects"),
        checkpoint=f"{path}/checkpoint",
        drain=True,
    )
    sinks.drain(query)
    held = [
        ("raw", stores.read_keyed(spark, f"{path}/raw")),
        ("clean", stores.read_by_date(spark, f"{path}/clean")),
        ("parsed", stores.read_batches(spark, f"{path}/parsed")),
        ("rejects", stores.read_batches(spark, f"{path}/rejects")),
    ]
    counts = [df.agg(F.lit(name).alias("sink"), F.count(F.lit(1)).alias("rows")) for name, df in held]
    return functools.reduce(DataFrame.unionByName, counts)


def stream_separate_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """Raw and clean store fed by two independent queries on the same source."""
    path = work_dir(spark, "separate")
    started = jobs.start_separately(
        record_stream(spark, sf),
        raw=sinks.keyed_writer(f"{path}/service_performance"),
        cleaned=sinks.dated_writer(f"{path}/clean"),
        checkpoint=f"{path}/checkpoint",
        console=False,
        drain=True,
    )
    for query in started:
        sinks.drain(query)
    raw = stores.read_keyed(spark, f"{path}/service_performance")
    late = stores.read_by_date(spark, f"{path}/clean").select("sequence_number", "actual_arrival")
    held = raw.select(F.col("sequence_number").cast("bigint").alias("sequence_number"), *stores.RAW_KEY)
    return sorted_join(held, late, ["sequence_number"], "left")


def bounded_tail(spark: SparkSession, sf: str) -> DataFrame:
    """Take what the topic holds, then stop; key and value decoded."""
    path = work_dir(spark, "tail")
    query = sinks.start_batches(
        decode_pairs(record_stream(spark, sf)), sinks.file_writer(f"{path}/rows"), f"{path}/checkpoint", drain=True
    )
    sinks.drain(query)
    return stores.read_batches(spark, f"{path}/rows").select("key", *RECORD_FIELDS)


QUERIES = {
    fn.__name__: fn
    for fn in (
        parse_flatten,
        parse_typed,
        parse_malformed,
        null_sentinel,
        cast_ids_dates,
        time_of_day_anchored,
        time_of_day_parity,
        clean_data,
        json_encode_keyed,
        raw_upsert,
        raw_rejects,
        keyed_store,
        keyed_lookup,
        keyed_lookup_folded,
        time_partitioned_write,
        time_range_read,
        stream_clean_available_now,
        stream_fanout,
        stream_separate_sinks,
        bounded_tail,
    )
}

_R = f"WITH r AS ({RECORDS_SQL})"

_DATED = """t AS (
  SELECT CAST(sequence_number AS BIGINT) AS sequence_number, CAST(schedule_id AS BIGINT) AS schedule_id,
    unique_id, CAST(service_start_date AS DATE) AS service_start_date, location_code,
    TRY_CAST(service_start_date || ' ' || scheduled_arrival AS TIMESTAMP) AS scheduled_arrival,
    TRY_CAST(service_start_date || ' ' || scheduled_departure AS TIMESTAMP) AS scheduled_departure,
    TRY_CAST(service_start_date || ' ' || nullif(actual_arrival, 'null') || ':00' AS TIMESTAMP) AS actual_arrival,
    TRY_CAST(service_start_date || ' ' || nullif(actual_departure, 'null') || ':00' AS TIMESTAMP) AS actual_departure,
    nullif(platforms, 'null') AS platforms,
    TRY_CAST(service_start_date || ' ' || nullif(estimated_time, 'null') || ':00' AS TIMESTAMP) AS estimated_time,
    nullif(source, 'null') AS source
  FROM r)"""


def _near(name: str) -> str:
    ref = "coalesce(scheduled_arrival, scheduled_departure)"
    return (
        f"CASE WHEN {name} < {ref} - INTERVAL 12 HOUR THEN {name} + INTERVAL 1 DAY "
        f"WHEN {name} > {ref} + INTERVAL 12 HOUR THEN {name} - INTERVAL 1 DAY ELSE {name} END AS {name}"
    )


_ANCHORED = f"""a AS (
  SELECT sequence_number, schedule_id, unique_id, service_start_date, location_code, scheduled_arrival,
    {_near('scheduled_departure')}, {_near('actual_arrival')}, {_near('actual_departure')},
    platforms, {_near('estimated_time')}, source FROM t)"""

_CLEAN = f"{_R}, {_DATED}, {_ANCHORED} SELECT {FIELDS} FROM a WHERE actual_arrival IS NOT NULL"

_LATEST = (
    f"SELECT {FIELDS} FROM (SELECT *, row_number() OVER (PARTITION BY unique_id, location_code, schedule_id "
    f"ORDER BY CAST(sequence_number AS BIGINT) DESC) AS n FROM r) WHERE n = 1"
)

_LOOKED_UP = f"{_R} SELECT * FROM ({_LATEST}) WHERE unique_id = 'C00008' AND location_code = 'ECB5E10'"

_BROKEN = "(event_id % 10 = 3 OR event_id % 15 = 4)"


def _seconds(name: str, value: str) -> str:
    whole = f"({value} || CASE WHEN length({value}) = 5 THEN ':00' ELSE '' END)"
    return (
        f"CAST(substr({whole}, 1, 2) AS BIGINT) * 3600 + CAST(substr({whole}, 4, 2) AS BIGINT) * 60 "
        f"+ CAST(substr({whole}, 7, 2) AS BIGINT) AS {name}_seconds"
    )


ORACLE = {
    "parse_flatten": f"{_R} SELECT {FIELDS} FROM r",
    "parse_typed": f"""{_R} SELECT CAST(sequence_number AS BIGINT) AS sequence_number,
        CAST(schedule_id AS BIGINT) AS schedule_id, unique_id, CAST(service_start_date AS DATE) AS service_start_date,
        location_code, scheduled_arrival, scheduled_departure, actual_arrival, actual_departure, platforms,
        estimated_time, source FROM r""",
    "parse_malformed": f"{_R} SELECT "
    + ", ".join(f"CASE WHEN NOT {_BROKEN} THEN {name} END AS {name}" for name in RECORD_FIELDS)
    + " FROM r",
    "null_sentinel": f"{_R} SELECT "
    + ", ".join(
        f"nullif({name}, 'null') AS {name}" if name in c.NULL_TEXT_COLUMNS else name for name in RECORD_FIELDS
    )
    + " FROM r",
    "cast_ids_dates": f"""{_R} SELECT sequence_number AS "row",
        CASE WHEN event_id % 9 <> 0 THEN event_id END AS sequence_number,
        CASE WHEN event_id % 7 <> 0 THEN CAST(schedule_id AS BIGINT) END AS schedule_id,
        CASE WHEN event_id % 11 <> 0 THEN CAST(service_start_date AS DATE) END AS service_start_date FROM r""",
    "time_of_day_anchored": f"""{_R}, {_DATED}, {_ANCHORED} SELECT sequence_number, service_start_date,
        {', '.join(c.CLOCK_COLUMNS)} FROM a""",
    "time_of_day_parity": f"{_R} SELECT event_id AS sequence_number, "
    + ", ".join(_seconds(name, f"nullif({name}, 'null')") for name in c.CLOCK_COLUMNS)
    + " FROM r",
    "clean_data": _CLEAN,
    "json_encode_keyed": f"{_R} SELECT unique_id AS key, {FIELDS} FROM r",
    "raw_upsert": f"{_R} {_LATEST}",
    "raw_rejects": f"SELECT count(*) AS rejected, CAST(0 AS BIGINT) AS with_sequence FROM events WHERE {_BROKEN}",
    "keyed_store": f"{_R} {_LATEST}",
    "keyed_lookup": _LOOKED_UP,
    "keyed_lookup_folded": _LOOKED_UP,
    "time_partitioned_write": _CLEAN,
    "time_range_read": f"""SELECT * FROM ({_CLEAN})
        WHERE actual_arrival >= TIMESTAMP '2024-01-03 12:00:00' AND actual_arrival < TIMESTAMP '2024-01-05 06:30:00'""",
    "stream_clean_available_now": _CLEAN,
    "stream_fanout": f"""SELECT 'raw' AS sink, count(*) AS "rows" FROM (
          SELECT DISTINCT unique_id, location_code, schedule_id FROM ({RECORDS_SQL}) WHERE NOT {_BROKEN})
        UNION ALL SELECT 'clean', count(*) FROM ({_CLEAN}) WHERE NOT {_BROKEN.replace('event_id', 'sequence_number')}
        UNION ALL SELECT 'parsed', count(*) FROM events
        UNION ALL SELECT 'rejects', count(*) FROM events WHERE {_BROKEN}""",
    "stream_separate_sinks": f"""SELECT CAST(l.sequence_number AS BIGINT) AS sequence_number, l.unique_id,
        l.location_code, l.schedule_id, c.actual_arrival FROM ({_R} {_LATEST}) l
        LEFT JOIN ({_CLEAN}) c ON CAST(l.sequence_number AS BIGINT) = c.sequence_number""",
    "bounded_tail": f"{_R} SELECT unique_id AS key, {FIELDS} FROM r",
}
