"""Registered queries over push frames and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.operators import decode, messages, quality
from trackside.operators.parse import decode_pairs
from trackside.operators.publish import to_records
from trackside.schemas import MESSAGE_KINDS, RECORD_FIELDS
from trackside.session import landed, work_dir
from trackside.sources import timetable
from trackside.sources.tables import dealt, dealt_stream, read_table, spread
from trackside.streaming import jobs, sinks
from trackside.streaming.stores import read_batches, upsert_view, whole_keys
from trackside.testfeed import fields as f
from trackside.testfeed import frames as feed
from trackside.testfeed import messages as m
from trackside.testfeed import timetable as files


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return dealt(read_table(spark, sf, "orders"))


def _seq(df: DataFrame) -> DataFrame:
    return df.withColumn("sequence_number", F.col("sequence_number").cast("bigint"))


# --- frames ---------------------------------------------------------------------------------


def frames_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Compressed frames, some broken, to location rows."""
    return decode.locations(decode.decode_frames(feed.status_frames(orders(spark, sf))))


def frames_first_ts_parity(spark: SparkSession, sf: str) -> DataFrame:
    """The same with every location under the first train of its document."""
    return decode.locations(decode.decode_frames(feed.status_frames(orders(spark, sf))), first_header=True)


def frames_precedence(spark: SparkSession, sf: str) -> DataFrame:
    """Estimate and source by which of arrival and departure is present."""
    rows = decode.locations(decode.decode_frames(feed.status_frames(orders(spark, sf), broken=False)))
    return rows.groupBy("source", F.col("estimated_time").isNull().alias("no_estimate")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def frames_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejected = decode.rejects(decode.decode_frames(feed.status_frames(orders(spark, sf))))
    return _seq(rejected.select("reason", "sequence_number"))


def frames_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Frames to keyed JSON records, read back."""
    rows = decode.locations(decode.decode_frames(feed.status_frames(orders(spark, sf))))
    return decode_pairs(to_records(rows))


def frames_message_types(spark: SparkSession, sf: str) -> DataFrame:
    """Header facts per message type and outcome, as an intake log would count them."""
    decoded = decode.decode_frames(feed.status_frames(orders(spark, sf)))
    return decoded.groupBy("message_type", "reason").agg(
        F.count(F.lit(1)).alias("frames"), F.count("sequence_number").alias("with_sequence")
    )


def frames_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Frames to documents for the message tables: forecasts of the usable ones, of any version,
    and the others by reason."""
    path = work_dir(spark, "documents")
    decode.read_documents(feed.status_frames(orders(spark, sf))).write.parquet(path)
    documents = spark.read.parquet(path)
    used = messages.forecasts(documents.where("reason is null")).select(
        F.concat_ws(" ", F.lit("forecasts of version"), "feed_version").alias("outcome"), "sequence_number"
    )
    lost = _seq(decode.rejects(documents)).select(F.col("reason").alias("outcome"), "sequence_number")
    return used.unionByName(lost).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sequence_number").alias("sequence_sum")
    )


def frames_raw_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The raw store's view of location rows; a train that calls at a place twice in one message
    leaves its last call there."""
    rows = decode.locations(decode.decode_frames(feed.status_frames(orders(spark, sf), broken=False)), place=True)
    return upsert_view(whole_keys(rows))


def stream_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of several kinds as a stream, each document parsed once; rows per table and rejects."""
    path = work_dir(spark, "kinds")
    frames = feed.frames_of(m.mixed_documents(dealt_stream(spark, sf, "orders")), "X")
    tables = ["schedules", "deactivations", "alarms", "station_messages"]
    query = jobs.start_messages(
        frames,
        tables={name: sinks.file_writer(f"{path}/{name}") for name in tables},
        reject=sinks.file_writer(f"{path}/rejects"),
        checkpoint=f"{path}/checkpoint",
        drain=True,
    )
    sinks.drain(query)
    counts = [read_batches(spark, f"{path}/{name}").agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name in [*tables, "rejects"]]
    merged = counts[0]
    for one in counts[1:]:
        merged = merged.union(one)
    return merged


def stream_intake(spark: SparkSession, sf: str) -> DataFrame:
    """Frames as a stream, decoded once per batch into records and rejects."""
    path = work_dir(spark, "intake")
    frames = feed.status_frames(dealt_stream(spark, sf, "orders"))
    query = jobs.start_intake(
        frames,
        publish=sinks.file_writer(f"{path}/records"),
        reject=sinks.file_writer(f"{path}/rejects"),
        checkpoint=f"{path}/checkpoint",
        drain=True,
    )
    sinks.drain(query)
    published = decode_pairs(read_batches(spark, f"{path}/records")).select(
        F.lit("published").alias("outcome"), F.col("sequence_number").cast("bigint").alias("sequence_number")
    )
    rejected = read_batches(spark, f"{path}/rejects").select(
        F.col("reason").alias("outcome"), F.col("sequence_number").cast("bigint").alias("sequence_number")
    )
    return published.unionByName(rejected).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sequence_number").alias("sequence_sum")
    )


# --- forecasts --------------------------------------------------------------------------------


def status_rows(spark: SparkSession, sf: str) -> DataFrame:
    return messages.forecasts(feed.status_documents(orders(spark, sf)))


def forecast_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Locations with platform, length and train attributes as sent."""
    return status_rows(spark, sf).select(
        "sequence_number", "doc_ts", "response", "update_origin", "train_index", "location_index", "rid", "uid", "ssd",
        "is_reverse_formation", "late_reason", "late_reason_tiploc", "late_reason_near", "tpl", "wta", "wtd", "pta", "ptd",
        "platform", "platsup", "platsrc", "suppr", "length",
    )


def forecast_long(spark: SparkSession, sf: str) -> DataFrame:
    """One row per arrival or departure forecast."""
    return messages.forecast_events(status_rows(spark, sf)).select(
        "sequence_number", "rid", "location_index", "tpl", "event", "et", "at", "delayed", "src", "src_inst"
    )


def defaults_filled(spark: SparkSession, sf: str) -> DataFrame:
    filled = quality.fill_defaults(status_rows(spark, sf), "forecast")
    return filled.select(
        "sequence_number", "rid", "location_index", "is_reverse_formation", "late_reason_near", "platsup", "cis_platsup",
        "platsrc", "conf", "suppr", "length", "detach_front",
    )


def platform_mask(spark: SparkSession, sf: str) -> DataFrame:
    """What a display may show of each forecast."""
    shown = quality.for_display(messages.forecast_events(status_rows(spark, sf)))
    return shown.select("sequence_number", "rid", "location_index", "event", "platform", "shown_estimate")


def version_union(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of six feed versions in one table; newer columns are NULL in older versions."""
    docs = m.mixed_version_documents(orders(spark, sf))
    events = messages.forecast_events(messages.forecasts(docs))
    return messages.only_in_version(events).select(
        "sequence_number", "feed_version", "rid", "tpl", "update_origin", "et", "wet", "at_class"
    )


# --- schedules --------------------------------------------------------------------------------


def schedule_headers(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.fill_defaults(messages.schedules(m.schedule_documents(orders(spark, sf))), "schedule")
    return rows.select(
        "sequence_number", "rid", "uid", "train_id", "rsid", "ssd", "toc", "status", "train_cat", "is_passenger_svc",
        "is_active", "deleted", "cancel_reason", "cancel_reason_tiploc", "points",
    )


def usable_schedules(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.schedules(m.schedule_documents(orders(spark, sf)))
    return quality.usable_schedules(rows).select("sequence_number", "rid")


def calling_points(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.calling_points(m.schedule_documents(orders(spark, sf)))
    return rows.select(
        "sequence_number", "rid", "ssd", "pos", "kind", "tpl", "act", "wta", "wtd", "wtp", "pta", "ptd", "can", "fid", "rdelay"
    )


def activity_codes(spark: SparkSession, sf: str) -> DataFrame:
    """One row per activity code; a missing activity has the contract's blank code."""
    points = quality.fill_defaults(messages.calling_points(m.schedule_documents(orders(spark, sf))), "calling_point")
    return quality.activities(points).select("sequence_number", "pos", "activity")


def disruption_reasons(spark: SparkSession, sf: str) -> DataFrame:
    o = orders(spark, sf)
    docs = feed.status_documents(o).drop("feed_version").unionByName(m.schedule_documents(o))
    return messages.reasons(docs).select("sequence_number", "rid", "domain", "code", "tiploc", "near")


# --- other kinds ------------------------------------------------------------------------------


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    return messages.envelopes(m.mixed_documents(orders(spark, sf)))


def deactivations(spark: SparkSession, sf: str) -> DataFrame:
    return messages.deactivations(m.mixed_documents(orders(spark, sf))).select("sequence_number", "item_index", "rid")


def associations(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.fill_defaults(messages.associations(m.association_documents(orders(spark, sf))), "association")
    return rows.select(
        "sequence_number", "tiploc", "category", "main_rid", "main_wta", "main_pta", "assoc_rid", "assoc_wtd",
        "is_cancelled", "is_deleted",
    )


def formation_coaches(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.coaches(messages.formations(m.formation_documents(orders(spark, sf))))
    return rows.select(
        "sequence_number", "rid", "fid", "src", "coach_index", "coach_number", "coach_class", "toilet", "toilet_status"
    )


def coach_loadings(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.coach_loadings(messages.loadings(m.loading_documents(orders(spark, sf))))
    return rows.select("sequence_number", "rid", "fid", "tpl", "wtd", "coach_number", "loading", "src")


def station_messages(spark: SparkSession, sf: str) -> DataFrame:
    docs = m.station_message_documents(spread(read_table(spark, sf, "documents")))
    rows = quality.fill_defaults(messages.station_messages(docs), "station_message")
    return rows.select("id", "category", "severity", "suppress", "crs", "body", F.get("links", F.lit(0)).alias("link"))


def train_alerts(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.train_alerts(m.alert_documents(dealt(read_table(spark, sf, "customer"))))
    return rows.select(
        "alert_id", "alert_text", "audience", "alert_type", "source", "by_sms", "by_email", "by_twitter",
        "copied_from_alert_id", "rid", "uid", "ssd", "location",
    )


def train_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.train_orders(messages.train_order_events(m.train_order_documents(orders(spark, sf))))
    return rows.select("sequence_number", "tiploc", "crs", "platform", "op", "place", "rid", "wta", "wtd", "train_id")


def tracking_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.tracking_ids(m.tracking_documents(dealt(read_table(spark, sf, "customer"))))
    return rows.select("sequence_number", "area", "berth", "incorrect_train_id", "correct_train_id")


def alarms(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.alarms(m.alarm_documents(dealt(read_table(spark, sf, "events"))))
    return rows.select("sequence_number", "op", "id", "kind", "area")


def failures(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.failures(m.failure_documents(read_table(spark, sf, "supplier")))
    return rows.select("sequence_number", "code", "message", "request_source", "request_id")


def facet_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast rows with some values spoiled: one row per broken rule."""
    n = F.col("sequence_number") + F.col("location_index")
    spoiled = status_rows(spark, sf).select(
        "sequence_number",
        "train_index",
        "location_index",
        "rid",
        F.when(n % 10 == 0, F.lit("C1")).otherwise(F.col("uid")).alias("uid"),
        F.when(n % 11 == 0, F.concat("tpl", F.lit("TOOLONG"))).otherwise(F.col("tpl")).alias("tpl"),
        F.when(n % 12 == 0, F.lit("10000")).otherwise(F.col("platform")).alias("platform"),
        F.when(n % 13 == 0, F.lit("24:00")).otherwise(F.col("wta")).alias("wta"),
        F.when(n % 14 == 0, F.lit(120)).otherwise(F.col("length").cast("int")).alias("length"),
        "late_reason",
    )
    broken = quality.invalid_rows(quality.broken_rules(spoiled, "forecast"))
    return broken.select("sequence_number", "train_index", "location_index", "rule")


def malformed_values(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per rule that values broke which could not be read, and per column that stays without
    its default for that."""
    rows = landed(messages.forecasts(feed.spoiled_documents(orders(spark, sf))), "spoiled")
    found = [
        quality.invalid_rows(quality.broken_rules(rows, "forecast")).select("rule"),
        quality.invalid_rows(quality.broken_rules(messages.forecast_events(rows), "forecast_event")).where("rule = 'delayed'").select("rule"),
    ]
    filled = quality.fill_defaults(rows, "forecast")
    blank = [F.when(F.col(name).isNull(), F.lit(f"{name} blank")) for name in ("length", "suppr", "platsup", "is_reverse_formation")]
    left = filled.select(F.explode(F.array_compact(F.array(*blank))).alias("rule"))
    return found[0].union(found[1]).union(left).groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))


def facet_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Calling points of which every value keeps its rule, by kind."""
    rows = messages.calling_points(m.schedule_documents(orders(spark, sf)))
    checked = quality.broken_rules(rows, "calling_point")
    return quality.valid_rows(checked).groupBy("kind").agg(F.count(F.lit(1)).alias("valid"))


# --- files ------------------------------------------------------------------------------------


def timetable_load(spark: SparkSession, sf: str) -> DataFrame:
    """Journeys of timetable files with their points in order."""
    path = work_dir(spark, "timetable")
    files.write_timetable(orders(spark, sf), path)
    points = timetable.journey_points(timetable.read_journeys(spark, path))
    return points.select("rid", "ssd", "pos", "kind", "tpl", "act", "platform", "wta", "wtd", "wtp", "pta", "ptd", "can", "rdelay")


def timetable_journeys(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "timetable")
    files.write_timetable(orders(spark, sf), path)
    return timetable.read_journeys(spark, path).select(
        "rid", "uid", "train_id", "ssd", "toc", "status", "train_cat", "deleted", "qtrain", "cancel_reason",
        F.size("points").alias("points"),
    )


def timetable_associations(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "timetable")
    files.write_timetable(orders(spark, sf), path)
    return timetable.read_timetable_associations(spark, path).select(
        "tiploc", "category", "main_rid", "main_wta", "assoc_rid", "assoc_wtd"
    )


def refdata_load(spark: SparkSession, sf: str) -> DataFrame:
    """The six reference tables, as one list of table, code and text."""
    path = work_dir(spark, "refdata")
    files.write_reference(spark, sf, path)
    parts = [
        timetable.read_locations(spark, path).select(F.lit("location").alias("list"), F.col("tpl").alias("code"), F.concat_ws("/", "crs", "toc", "locname").alias("text")),
        timetable.read_operators(spark, path).select(F.lit("operator"), "toc", F.concat_ws("/", "tocname", "url")),
        timetable.read_late_reasons(spark, path).select(F.lit("late"), F.col("code").cast("string"), "reasontext"),
        timetable.read_cancel_reasons(spark, path).select(F.lit("cancel"), F.col("code").cast("string"), "reasontext"),
        timetable.read_via(spark, path).select(F.lit("via"), "at", F.concat_ws("/", "dest", "loc1", "loc2", "viatext")),
        timetable.read_instances(spark, path).select(F.lit("instance"), "code", "name"),
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.union(part)
    return merged


QUERIES = {
    fn.__name__: fn
    for fn in (
        frames_decode,
        frames_first_ts_parity,
        frames_precedence,
        frames_rejects,
        frames_publish,
        frames_message_types,
        frames_documents,
        stream_intake,
        frames_raw_upsert,
        stream_messages,
        malformed_values,
        forecast_rows,
        forecast_long,
        defaults_filled,
        platform_mask,
        version_union,
        schedule_headers,
        usable_schedules,
        calling_points,
        activity_codes,
        disruption_reasons,
        envelopes,
        deactivations,
        associations,
        formation_coaches,
        coach_loadings,
        station_messages,
        train_alerts,
        train_order,
        tracking_ids,
        alarms,
        failures,
        facet_rejects,
        facet_valid,
        timetable_load,
        timetable_journeys,
        timetable_associations,
        refdata_load,
    )
}

_P = f"WITH p AS ({feed.POINTS_SQL})"

# Arrival first, whatever it holds; then the departure.
_PICK = """CASE shape WHEN 0 THEN et WHEN 2 THEN et END AS estimated_time,
  CASE shape WHEN 0 THEN 'TD' WHEN 1 THEN 'TRUST' WHEN 2 THEN 'CIS' END AS source"""


def _locations(first: bool, where: str = "reason IS NULL") -> str:
    rid, uid = ("rid", "uid") if first else (
        "CASE WHEN second_train THEN rid_2 ELSE rid END", "CASE WHEN second_train THEN uid_2 ELSE uid END"
    )
    return f"""{_P} SELECT CAST(o_orderkey AS VARCHAR) AS sequence_number, {rid} AS schedule_id, {uid} AS unique_id,
      ssd AS service_start_date, tpl AS location_code, wta AS scheduled_arrival, wtd AS scheduled_departure,
      pta AS actual_arrival, ptd AS actual_departure, platform AS platforms, {_PICK} FROM p WHERE {where}"""


_TRAIN = "CASE WHEN second_train THEN rid_2 ELSE rid END AS rid"
_PLACE = "CASE WHEN second_train THEN 0 ELSE i END"
_K = "o_orderkey"
_PLATSUP = f"CASE WHEN platform IS NOT NULL AND ({_K} + i) % 3 = 0 THEN TRUE END"
_PLATSRC = f"CASE WHEN platform IS NOT NULL AND ({_K} + i) % 4 = 0 THEN 'A' END"
_SUPPR = f"CASE WHEN ({_K} + i) % 8 = 0 THEN TRUE END"
_LENGTH = f"CASE WHEN ({_K} + i) % 7 = 0 THEN CAST(({_K} + i) % 13 AS SMALLINT) END"
_REVERSE = f"CASE WHEN {_K} % 12 = 0 AND NOT second_train THEN TRUE END"
_LATE = f"{_K} % 9 = 0 AND NOT second_train"

_EVENTS = f"""e AS (
  SELECT *, 'arr' AS event, CASE WHEN shape = 0 THEN et END AS e_et, CASE WHEN shape = 1 THEN substr(wta, 1, 5) END AS e_at,
    CAST(NULL AS BOOLEAN) AS e_delayed, CASE WHEN shape = 0 THEN 'TD' ELSE 'TRUST' END AS e_src, CAST(NULL AS VARCHAR) AS e_inst
  FROM p WHERE shape <= 1
  UNION ALL
  SELECT *, 'dep', et, NULL, CASE WHEN ({_K} + i) % 9 = 0 THEN TRUE END, 'CIS', 'CS01' FROM p WHERE shape <= 2)"""

_SP = f"WITH s AS ({m.SCHEDULE_POINTS_SQL})"
_O = "FROM orders"
_RID, _UID = f.RID, f.UID


def _filled(expression: str, default: str, name: str) -> str:
    return f"coalesce({expression}, {default}) AS {name}"


_OUTCOME = f"(SELECT o_orderkey, {f.FRAME_REASON} AS reason FROM orders)"

ORACLE = {
    "frames_decode": _locations(first=False),
    "frames_first_ts_parity": _locations(first=True),
    "frames_precedence": f"""SELECT source, estimated_time IS NULL AS no_estimate, count(*) AS "rows"
        FROM ({_locations(False, 'TRUE')}) GROUP BY ALL""",
    "frames_rejects": f"""SELECT reason, CASE WHEN reason <> 'missing_header' THEN o_orderkey END AS sequence_number
        FROM {_OUTCOME} WHERE reason IS NOT NULL""",
    "frames_publish": f"SELECT unique_id AS key, {', '.join(RECORD_FIELDS)} FROM ({_locations(first=False)})",
    "frames_message_types": f"""SELECT 'TS' AS message_type, reason, count(*) AS frames,
        count(CASE WHEN reason IS DISTINCT FROM 'missing_header' THEN 1 END) AS with_sequence
        FROM {_OUTCOME} GROUP BY reason""",
    "frames_documents": f"""SELECT outcome, count(*) AS "rows", CAST(sum(seq) AS BIGINT) AS sequence_sum FROM (
        SELECT CASE WHEN reason = 'other_version' THEN 'forecasts of version 15' ELSE 'forecasts of version 16' END AS outcome,
          o_orderkey AS seq FROM ({feed.POINTS_SQL}) WHERE reason IS NULL OR reason = 'other_version'
        UNION ALL SELECT reason, CASE WHEN reason <> 'missing_header' THEN o_orderkey END FROM {_OUTCOME}
          WHERE reason IN ('missing_header', 'bad_body', 'bad_xml'))
        GROUP BY outcome""",
    "stream_intake": f"""SELECT outcome, count(*) AS "rows", CAST(sum(seq) AS BIGINT) AS sequence_sum FROM (
        SELECT 'published' AS outcome, CAST(sequence_number AS BIGINT) AS seq FROM ({_locations(first=False)})
        UNION ALL SELECT reason, CASE WHEN reason <> 'missing_header' THEN o_orderkey END FROM {_OUTCOME} WHERE reason IS NOT NULL)
        GROUP BY outcome""",
    "forecast_rows": f"""{_P} SELECT {_K} AS sequence_number, CAST({f.DOC_TS} AS TIMESTAMP) AS doc_ts,
        CASE WHEN {_K} % 7 = 0 THEN 'snapshot' ELSE 'update' END AS response,
        CASE WHEN {_K} % 7 <> 0 THEN 'TD' END AS update_origin,
        CAST(CASE WHEN second_train THEN 1 ELSE 0 END AS INTEGER) AS train_index, CAST({_PLACE} AS INTEGER) AS location_index,
        {_TRAIN}, CASE WHEN second_train THEN uid_2 ELSE uid END AS uid, CAST(ssd AS DATE) AS ssd,
        {_REVERSE} AS is_reverse_formation,
        CASE WHEN {_LATE} THEN CAST(100 + {_K} % 40 AS SMALLINT) END AS late_reason,
        CASE WHEN {_LATE} AND {_K} % 2 = 0 THEN {f.place('0')} END AS late_reason_tiploc,
        CASE WHEN {_LATE} AND {_K} % 4 = 0 THEN TRUE END AS late_reason_near,
        tpl, wta, wtd, pta, ptd, platform, {_PLATSUP} AS platsup, {_PLATSRC} AS platsrc, {_SUPPR} AS suppr, {_LENGTH} AS length
        FROM p""",
    "forecast_long": f"""{_P}, {_EVENTS} SELECT {_K} AS sequence_number, {_TRAIN}, CAST({_PLACE} AS INTEGER) AS location_index,
        tpl, event, e_et AS et, e_at AS "at", e_delayed AS delayed, e_src AS src, e_inst AS src_inst FROM e""",
    "defaults_filled": f"""{_P} SELECT {_K} AS sequence_number, {_TRAIN}, CAST({_PLACE} AS INTEGER) AS location_index,
        {_filled(_REVERSE, 'FALSE', 'is_reverse_formation')},
        ({_LATE} AND {_K} % 4 = 0) AS late_reason_near, {_filled(_PLATSUP, 'FALSE', 'platsup')}, FALSE AS cis_platsup,
        {_filled(_PLATSRC, "'P'", 'platsrc')}, FALSE AS conf, {_filled(_SUPPR, 'FALSE', 'suppr')},
        {_filled(_LENGTH, 'CAST(0 AS SMALLINT)', 'length')}, FALSE AS detach_front FROM p""",
    "platform_mask": f"""{_P}, {_EVENTS} SELECT {_K} AS sequence_number, {_TRAIN}, CAST({_PLACE} AS INTEGER) AS location_index, event,
        CASE WHEN ({_K} + i) % 3 <> 0 THEN platform END AS platform,
        CASE WHEN coalesce(e_delayed, FALSE) THEN 'Delayed' ELSE e_et END AS shown_estimate
        FROM e WHERE ({_K} + i) % 8 <> 0""",
    "version_union": f"""SELECT o_orderkey AS sequence_number, CAST(v AS INTEGER) AS feed_version, {_RID} AS rid, {f.place('0')} AS tpl,
        CASE WHEN v >= 12 THEN 'CIS' END AS update_origin, {f.et('0')} AS et,
        CASE WHEN v >= 12 THEN {f.pta('0')} END AS wet, CASE WHEN v >= 13 THEN 'X' END AS at_class
        FROM (SELECT *, 11 + o_orderkey % 6 AS v FROM orders)""",
    "schedule_headers": f"""SELECT {_K} AS sequence_number, {_RID} AS rid, {_UID} AS uid, {m.TRAIN_ID} AS train_id,
        CASE WHEN {_K} % 4 = 0 THEN concat('RS', lpad(CAST({_K} % 10000 AS VARCHAR), 4, '0')) END AS rsid,
        CAST(o_orderdate AS DATE) AS ssd, {m.TOC} AS toc,
        CASE WHEN {_K} % 16 = 0 THEN 'B' ELSE 'P' END AS status, CASE WHEN {_K} % 9 = 0 THEN 'XX' ELSE 'OO' END AS train_cat,
        TRUE AS is_passenger_svc, {_K} % 14 <> 0 AS is_active, {_K} % 37 = 0 AS deleted,
        CASE WHEN {_K} % 21 = 0 THEN CAST(500 + {_K} % 40 AS SMALLINT) END AS cancel_reason,
        CASE WHEN {_K} % 42 = 0 THEN {f.place('0')} END AS cancel_reason_tiploc, CAST({f.POINTS} AS INTEGER) AS points {_O}""",
    "usable_schedules": f"SELECT {_K} AS sequence_number, {_RID} AS rid {_O} WHERE {_K} % 37 <> 0 AND {_K} % 14 <> 0",
    "frames_raw_upsert": f"""{_P} SELECT {', '.join(RECORD_FIELDS)} FROM (
        {_locations(False, 'TRUE').replace(_P, '').replace('SELECT CAST', 'SELECT o_orderkey, i, CAST', 1)})
        QUALIFY row_number() OVER (PARTITION BY unique_id, location_code, schedule_id ORDER BY o_orderkey DESC, i DESC) = 1""",
    "stream_messages": f"""SELECT 'schedules' AS "table", CAST(sum({_K} % 3) AS BIGINT) AS "rows" {_O}
        UNION ALL SELECT 'deactivations', CAST(sum({_K} % 2) AS BIGINT) {_O} UNION ALL SELECT 'alarms', CAST(sum({_K} % 5) AS BIGINT) {_O}
        UNION ALL SELECT 'station_messages', CAST(0 AS BIGINT)
        UNION ALL SELECT 'rejects', count(*) {_O} WHERE {_K} % 3 = 0 AND {_K} % 2 = 0 AND {_K} % 5 = 0""",
    "malformed_values": f"""{_P}, b AS (SELECT *, ({_K} % 5 = 0) AS ssd_bad, (({_K} + i) % 7 = 0 AND {_K} % 6 = 1) AS length_bad,
          (({_K} + i) % 8 = 0 AND {_K} % 6 = 1) AS suppr_bad, (platform IS NOT NULL AND ({_K} + i) % 3 = 0 AND {_K} % 4 = 1) AS platsup_bad,
          ({_LATE} AND {_K} % 2 = 1) AS late_bad, ({_K} % 12 = 0 AND NOT second_train AND {_K} % 5 = 1) AS reverse_bad,
          (shape <= 2 AND ({_K} + i) % 9 = 0 AND {_K} % 4 = 2) AS delayed_bad FROM p)
        SELECT rule, count(*) AS "rows" FROM (SELECT unnest(list_filter([CASE WHEN ssd_bad THEN 'ssd' END,
            CASE WHEN length_bad THEN 'length' END, CASE WHEN suppr_bad THEN 'suppr' END, CASE WHEN platsup_bad THEN 'platsup' END,
            CASE WHEN late_bad THEN 'late_reason' END, CASE WHEN reverse_bad THEN 'is_reverse_formation' END,
            CASE WHEN delayed_bad THEN 'delayed' END, CASE WHEN length_bad THEN 'length blank' END, CASE WHEN suppr_bad THEN 'suppr blank' END,
            CASE WHEN platsup_bad THEN 'platsup blank' END, CASE WHEN reverse_bad THEN 'is_reverse_formation blank' END],
            lambda r: r IS NOT NULL)) AS rule FROM b) GROUP BY rule""",
    "calling_points": f"""{_SP} SELECT sequence_number, rid, ssd, pos, kind, tpl, act, wta, wtd, wtp, pta, ptd, can, fid, rdelay FROM s""",
    "activity_codes": f"""{_SP} SELECT sequence_number, pos, substr(code, CAST(1 + 2 * c AS INTEGER), 2) AS activity FROM (
        SELECT sequence_number, pos, coalesce(act, '  ') AS code,
          unnest(range(CAST(length(coalesce(act, '  ')) / 2 AS BIGINT))) AS c FROM s)""",
    "disruption_reasons": f"""SELECT {_K} AS sequence_number, {_RID} AS rid, 'late' AS domain, CAST(100 + {_K} % 40 AS SMALLINT) AS code,
        CASE WHEN {_K} % 2 = 0 THEN {f.place('0')} END AS tiploc, CASE WHEN {_K} % 4 = 0 THEN TRUE END AS near {_O} WHERE {_K} % 9 = 0
        UNION ALL SELECT {_K}, {_RID}, 'cancel', CAST(500 + {_K} % 40 AS SMALLINT),
        CASE WHEN {_K} % 2 = 0 THEN {f.place('0')} END, NULL {_O} WHERE {_K} % 21 = 0""",
    "envelopes": f"""SELECT {_K} AS sequence_number, CAST(11 + {_K} % 6 AS INTEGER) AS feed_version, CAST({f.DOC_TS} AS TIMESTAMP) AS doc_ts,
        CASE WHEN {_K} % 7 = 0 THEN 'snapshot' ELSE 'update' END AS response,
        CASE WHEN {_K} % 7 <> 0 THEN 'CIS' END AS update_origin,
        CASE WHEN {_K} % 7 <> 0 AND {_K} % 3 > 0 THEN {m.REQUEST_SOURCE} END AS request_source,
        CASE WHEN {_K} % 7 <> 0 AND {_K} % 4 > 0 THEN {m.REQUEST_ID} END AS request_id,
        concat(CAST(11 + {_K} % 6 AS VARCHAR), '.0') AS version, """
    + ", ".join(
        f"CAST({ {'schedule': f'{_K} % 3', 'deactivated': f'{_K} % 2', 'TS': f'{_K} % 4', 'alarm': f'{_K} % 5'}.get(kind, '0')} AS INTEGER) AS n_{kind}"
        for kind in MESSAGE_KINDS
    )
    + f" {_O}",
    "deactivations": f"SELECT {_K} AS sequence_number, CAST(0 AS INTEGER) AS item_index, '0' AS rid {_O} WHERE {_K} % 2 = 1",
    "associations": f"""SELECT {_K} AS sequence_number, {f.place('1')} AS tiploc, {m.CATEGORY} AS category, {_RID} AS main_rid,
        {f.wta('1')} AS main_wta, CASE WHEN {_K} % 2 = 0 THEN {f.pta('1')} END AS main_pta, {m.ASSOC_RID} AS assoc_rid,
        {f.wtd('1')} AS assoc_wtd, {_K} % 6 = 0 AS is_cancelled, {_K} % 10 = 0 AS is_deleted {_O}""",
    "formation_coaches": f"""SELECT sequence_number, rid, fid, src, coach_index, coach_number, coach_class, toilet, toilet_status
        FROM ({m.FORMATION_COACHES_SQL})""",
    "coach_loadings": f"""SELECT {_K} * 3 + j AS sequence_number, {_RID} AS rid, {m.FID} AS fid, {f.place('1')} AS tpl, {f.wtd('1')} AS wtd,
        substr('ABCDEFGH', CAST(i + 1 AS INT), 1) AS coach_number, CAST(({_K} + i * 7 + j * 11) % 101 AS INTEGER) AS loading, 'CIS' AS src
        FROM (SELECT *, unnest(range({m.COACHES})) AS i FROM (SELECT *, unnest(range(3)) AS j FROM orders))
        WHERE ({_K} + i + j) % 3 > 0""",
    "station_messages": """SELECT CAST(doc_id AS INTEGER) AS id, CASE WHEN doc_id % 2 = 0 THEN 'Station' ELSE 'Misc' END AS category,
        CAST(doc_id % 4 AS VARCHAR) AS severity, doc_id % 5 = 0 AS suppress,
        CASE WHEN i >= 0 THEN concat('S', lpad(CAST((doc_id + i) % 100 AS VARCHAR), 2, '0')) END AS crs,
        text || 'more' AS body, concat('http://info.example/m?id=', CAST(doc_id AS VARCHAR), '&x=1') AS link
        FROM (SELECT *, unnest(CASE WHEN doc_id % 3 = 0 THEN [-1] ELSE range(doc_id % 3) END) AS i FROM documents)""",
    "train_alerts": """SELECT CAST(c_custkey AS VARCHAR) AS alert_id, concat(c_name, ' <', c_mktsegment, '>') AS alert_text,
        'Customer' AS audience, CASE WHEN c_custkey % 5 = 0 THEN 'Forced' ELSE 'Normal' END AS alert_type,
        concat('N', CAST(c_nationkey AS VARCHAR)) AS source, TRUE AS by_sms, c_custkey % 2 = 0 AS by_email, FALSE AS by_twitter,
        CASE WHEN c_custkey % 6 = 0 THEN CAST(c_custkey - 1 AS VARCHAR) END AS copied_from_alert_id,
        CASE WHEN i >= 0 THEN concat('20240101', lpad(CAST(c_custkey * 2 + i AS VARCHAR), 8, '0')) END AS rid,
        CASE WHEN i >= 0 THEN concat('U', lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')) END AS uid,
        CASE WHEN i >= 0 THEN DATE '2024-01-01' END AS ssd,
        CASE WHEN i < 0 THEN NULL WHEN l = 0 THEN concat('L', CAST((c_custkey + i) % 50 AS VARCHAR)) ELSE 'L99' END AS location
        FROM (SELECT *, unnest(CASE WHEN i >= 0 AND c_custkey % 4 = 0 THEN [0, 1] ELSE [0] END) AS l FROM (
          SELECT *, unnest(CASE WHEN c_custkey % 3 = 0 THEN [-1] ELSE range(c_custkey % 3) END) AS i FROM customer))""",
    "train_order": f"""WITH t AS (SELECT *, {m.ORDER_TIPLOC} AS tiploc, {m.ORDER_CRS} AS crs, {m.ORDER_PLATFORM} AS platform FROM orders)
        SELECT {_K} AS sequence_number, tiploc, crs, platform, 'clear' AS op, CAST(NULL AS INTEGER) AS place, CAST(NULL AS VARCHAR) AS rid,
          CAST(NULL AS VARCHAR) AS wta, CAST(NULL AS VARCHAR) AS wtd, CAST(NULL AS VARCHAR) AS train_id FROM t WHERE {_K} % 6 = 0
        UNION ALL SELECT {_K}, tiploc, crs, platform, 'set', 1, {_RID}, NULL, {f.wtd('0')}, NULL FROM t WHERE {_K} % 6 <> 0
        UNION ALL SELECT {_K}, tiploc, crs, platform, 'set', 2, NULL, NULL, NULL, {m.TRAIN_ID} FROM t WHERE {_K} % 6 <> 0 AND {_K} % 4 > 0
        UNION ALL SELECT {_K}, tiploc, crs, platform, 'set', 3, {f.RID_2}, {f.wta('1')}, NULL, NULL FROM t WHERE {_K} % 6 <> 0 AND {_K} % 4 > 1""",
    "tracking_ids": f"""SELECT c_custkey AS sequence_number, {m.AREA} AS area, {m.BERTH} AS berth,
        {m.WRONG_ID} AS incorrect_train_id, {m.RIGHT_ID} AS correct_train_id FROM customer""",
    "alarms": f"""SELECT event_id AS sequence_number, CASE WHEN event_type IN ('click', 'error') THEN 'clear' ELSE 'set' END AS op,
        {m.ALARM_ID} AS id,
        CASE WHEN event_type IN ('click', 'error') THEN NULL WHEN event_type = 'signup' THEN 'td_feed_fail'
          WHEN event_type = 'view' THEN 'tyrell_feed_fail' ELSE 'td_area_fail' END AS kind,
        CASE WHEN event_type NOT IN ('click', 'error', 'signup', 'view') THEN concat('A', CAST(user_id % 10 AS VARCHAR)) END AS area
        FROM events""",
    "failures": """SELECT s_suppkey AS sequence_number, concat('E', CAST(s_nationkey AS VARCHAR)) AS code,
        concat('no data for ', s_name) AS message, CASE WHEN s_suppkey % 2 = 0 THEN 'CI01' END AS request_source,
        CASE WHEN s_suppkey % 2 = 0 THEN concat('Q', CAST(s_suppkey AS VARCHAR)) END AS request_id FROM supplier""",
    "facet_rejects": f"""{_P}, x AS (SELECT *, {_K} + ({_PLACE}) AS n, CAST(CASE WHEN second_train THEN 1 ELSE 0 END AS INTEGER) AS train_index,
          CAST({_PLACE} AS INTEGER) AS location_index FROM p)
        SELECT {_K} AS sequence_number, train_index, location_index, rule FROM (
          SELECT *, unnest(list_filter([CASE WHEN n % 10 = 0 THEN 'uid' END, CASE WHEN n % 11 = 0 THEN 'tpl' END,
            CASE WHEN n % 12 = 0 THEN 'platform' END, CASE WHEN n % 13 = 0 THEN 'wta' END,
            CASE WHEN n % 14 = 0 THEN 'length' END], lambda r: r IS NOT NULL)) AS rule FROM x)""",
    "facet_valid": f"{_SP} SELECT kind, count(*) AS valid FROM s GROUP BY kind",
    "timetable_load": f"""{_SP} SELECT rid, ssd, pos, kind, tpl, act, CAST(1 + sequence_number % 9 AS VARCHAR) AS platform,
        wta, wtd, wtp, pta, ptd, can, rdelay FROM s""",
    "timetable_journeys": f"""SELECT {_RID} AS rid, {_UID} AS uid, {m.TRAIN_ID} AS train_id, CAST(o_orderdate AS DATE) AS ssd, {m.TOC} AS toc,
        CASE WHEN {_K} % 16 = 0 THEN 'B' END AS status, CASE WHEN {_K} % 9 = 0 THEN 'XX' END AS train_cat,
        CASE WHEN {_K} % 37 = 0 THEN TRUE END AS deleted, CASE WHEN {_K} % 31 = 0 THEN TRUE END AS qtrain,
        CASE WHEN {_K} % 21 = 0 THEN CAST(500 + {_K} % 40 AS SMALLINT) END AS cancel_reason,
        CAST({f.POINTS} AS INTEGER) AS points {_O}""",
    "timetable_associations": f"""SELECT {f.place('1')} AS tiploc, {m.CATEGORY} AS category, {_RID} AS main_rid, {f.wta('1')} AS main_wta,
        {m.ASSOC_RID} AS assoc_rid, {f.wtd('1')} AS assoc_wtd {_O}""",
    "refdata_load": files.REFERENCE_SQL,
}
