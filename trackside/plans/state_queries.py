"""Registered queries over joins, journeys and current state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.operators import decode, journey, messages, reference, state
from trackside.plans.joins import balanced_join
from trackside.plans.message_queries import orders, status_rows
from trackside.session import landed, work_dir
from trackside.sources.tables import dealt, dealt_stream, read_table, slices
from trackside.streaming import jobs, matching, sinks
from trackside.testfeed import fields as f
from trackside.testfeed import frames as feed
from trackside.testfeed import messages as m
from trackside.testfeed.frames import POINTS_SQL

# --- reference data -----------------------------------------------------------------------------

FACTS = {
    "tpl": "concat('P', cast(l_partkey as string))",
    "toc": "lpad(cast(l_suppkey % 30 as string), 2, '0')",
    "domain": "case when l_returnflag = 'R' then 'cancel' else 'late' end",
    "code": "cast(100 + l_suppkey % 40 as int)",
    "src_inst": "concat('CI0', cast(l_linenumber as string))",
}
LOCATIONS = {
    "tpl": "concat('P', cast(p_partkey as string))",
    "crs": "case when p_partkey % 3 = 0 then concat('S', lpad(cast(p_partkey % 100 as string), 2, '0')) end",
    "locname": "p_name",
}
OPERATORS = {"toc": "lpad(cast(n_nationkey as string), 2, '0')", "tocname": "n_name"}
LATE = {"code": "cast(100 + n_nationkey as int)", "reasontext": "concat('late ', n_name)"}
CANCELLED = {"code": "cast(100 + n_nationkey as int)", "reasontext": "concat('cancelled ', n_name)"}
INSTANCES = {"code": "concat('CI0', cast(r_regionkey as string))", "name": "r_name"}


def _columns(columns: dict[str, str]) -> list[str]:
    return [f"{sql} as {name}" for name, sql in columns.items()]


def facts(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_extendedprice", *_columns(FACTS))


def dimension(spark: SparkSession, sf: str, table: str, columns: dict[str, str]) -> DataFrame:
    return read_table(spark, sf, table).selectExpr(*_columns(columns))


def enrich_dims(spark: SparkSession, sf: str) -> DataFrame:
    """Location, operator, reason and instance names for every row."""
    rows = reference.with_location_names(facts(spark, sf), dimension(spark, sf, "part", LOCATIONS))
    rows = reference.with_operator_names(rows, dimension(spark, sf, "nation", OPERATORS))
    rows = reference.with_reason_texts(
        rows, dimension(spark, sf, "nation", LATE), dimension(spark, sf, "nation", CANCELLED)
    )
    return reference.with_instance_names(rows, dimension(spark, sf, "region", INSTANCES))


def enrich_balanced(spark: SparkSession, sf: str) -> DataFrame:
    """Location names by the join for lookups too large to broadcast; rows of hot locations are not shuffled."""
    third = F.when(F.col("l_linenumber") <= 2, F.lit("P7")).otherwise(F.col("tpl"))
    rows = facts(spark, sf).withColumn("tpl", third).select("l_orderkey", "l_linenumber", "l_extendedprice", "tpl")
    named = balanced_join(rows, dimension(spark, sf, "part", LOCATIONS), ["tpl"])
    return named.groupBy("tpl", "locname", "crs").agg(F.count(F.lit(1)).alias("rows"))


def tiploc_semi(spark: SparkSession, sf: str) -> DataFrame:
    wanted = read_table(spark, sf, "part").where("p_size < 10").selectExpr(f"{LOCATIONS['tpl']} as tpl")
    return reference.keep_locations(facts(spark, sf), wanted).select("l_orderkey", "l_linenumber", "tpl")


def area_semi(spark: SparkSession, sf: str) -> DataFrame:
    wanted = read_table(spark, sf, "region").where("r_regionkey >= 3").selectExpr("concat('A', cast(r_regionkey as string)) as area")
    return reference.keep_areas(m.sightings(read_table(spark, sf, "events")), wanted)


def _corrected(spark: SparkSession, sf: str, hot: str | None = None) -> DataFrame:
    corrections = messages.tracking_ids(m.tracking_documents(read_table(spark, sf, "customer")))
    seen = m.timed_sightings(read_table(spark, sf, "events"), hot)
    return reference.correct_train_ids(seen, corrections, ["sequence_number"], "seen_at", "doc_ts")


def tracking_fix(spark: SparkSession, sf: str) -> DataFrame:
    """Sightings with the headcode that the last correction before them says they should have."""
    return _corrected(spark, sf)


def tracking_fix_hot(spark: SparkSession, sf: str) -> DataFrame:
    """The same where a third of all sightings is of four berths."""
    return _corrected(spark, sf, HOT)


HOT = "event_id % 3 = 0"


# --- journeys -----------------------------------------------------------------------------------


def points(spark: SparkSession, sf: str) -> DataFrame:
    return messages.calling_points(m.schedule_documents(orders(spark, sf)))


CLOCK_POINT = ["rid", "ssd", "pos", "wta", "wtd", "wtp", "pta", "ptd"]


def journey_anchor(spark: SparkSession, sf: str) -> DataFrame:
    """A landed table of calling points with dates."""
    return journey.anchor_journeys(landed(points(spark, sf).select(*CLOCK_POINT), "points"))


def calling_points_anchored(spark: SparkSession, sf: str) -> DataFrame:
    """The same straight from the schedule documents."""
    rows = journey.anchored_points(m.schedule_documents(orders(spark, sf)))
    return rows.select(*CLOCK_POINT, "day")


def journey_anchor_in_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same counted in blocks of two points, so that every journey spans several."""
    table = landed(points(spark, sf).select(*CLOCK_POINT), "points")
    return journey.journey_days(table, block=2).select("rid", "pos", "day")


def instance_match(spark: SparkSession, sf: str) -> DataFrame:
    ids = ["sequence_number", "train_index", "location_index"]
    return journey.match_calls(status_rows(spark, sf), points(spark, sf), ids, slices(read_table(spark, sf, "orders")))


def instance_match_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same on a stream in four stretches: half of the status documents, a third of the schedules, the
    other status documents, the other schedules."""
    path, files = work_dir(spark, "matching"), 4
    table = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    half, third = F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 3 == 0
    # Rows, of which the stream makes the documents, so that no text is written or dealt out.
    for is_status, part in ((True, half), (False, third), (True, ~half), (False, ~third)):
        rows = table.where(part).withColumn("is_status", F.lit(is_status))
        rows.repartition(files).write.mode("append").parquet(f"{path}/orders")
    kind = spark.read.parquet(f"{path}/orders").schema
    arriving = spark.readStream.schema(kind).option("maxFilesPerTrigger", files).parquet(f"{path}/orders").repartition(slices(table))
    status, schedules = (made(arriving.where(which)).select("sequence_number", "xml") for made, which in ((feed.status_documents, "is_status"), (m.schedule_documents, "not is_status")))
    docs = status.unionByName(schedules)
    # The feed's days go on for years, so none is over.
    sinks.drain(jobs.start_matching(docs, f"{path}/calls", f"{path}/checkpoint", keep_days=None, drain=True))
    return matching.read_matches(spark, f"{path}/calls")


VIA = {
    "at": "concat('C', cast(o_custkey % 997 as string))",
    "dest": f.place(f"({f.POINTS} - 1)"),
    "loc1": f.place("1"),
    "loc2": f"case when o_orderkey % 3 = 0 then {f.place('2')} when o_orderkey % 3 = 1 then {f.place('0')} end",
    "viatext": "concat('via ', cast(o_orderkey % 5 as string))",
}
STATIONS = {"tpl": "concat('T', cast(o_custkey % 997 as string))", "crs": "concat('C', cast(o_custkey % 997 as string))"}


def via_text(spark: SparkSession, sf: str) -> DataFrame:
    table = read_table(spark, sf, "orders")
    via = table.selectExpr(*_columns(VIA)).distinct()
    stations = table.selectExpr(*_columns(STATIONS)).distinct()
    return reference.via_texts(points(spark, sf), via, stations)


# --- state --------------------------------------------------------------------------------------


def events(spark: SparkSession, sf: str) -> DataFrame:
    return dealt(read_table(spark, sf, "events"))


def schedule_state(spark: SparkSession, sf: str) -> DataFrame:
    history = messages.schedule_history(m.schedule_event_documents(events(spark, sf)))
    now = state.in_force(state.latest(history, ["rid"], state.SCHEDULE_ORDER))
    return now.select("rid", "uid", "train_id", "doc_ts", "sequence_number")


def _from_frames(docs: DataFrame, kind: str) -> DataFrame:
    """Documents of one moment through push frames; their sequence went along as text."""
    documents = decode.read_documents(feed.frames_of(feed.at_once(docs), kind))
    return documents.where("reason is null")


def frames_schedule_state(spark: SparkSession, sf: str) -> DataFrame:
    history = messages.schedule_history(_from_frames(m.schedule_event_documents(events(spark, sf)), "SC"))
    now = state.in_force(state.latest(history, ["rid"], state.SCHEDULE_ORDER))
    return now.select("rid", "uid", "train_id", "sequence_number")


def frames_alarm_state(spark: SparkSession, sf: str) -> DataFrame:
    now = state.set_clear_state(messages.alarms(_from_frames(m.alarm_documents(events(spark, sf)), "AL")), ["id"])
    return now.select("id", "kind", "area", "sequence_number")


def alarm_state(spark: SparkSession, sf: str) -> DataFrame:
    now = state.set_clear_state(messages.alarms(m.alarm_documents(events(spark, sf))), ["id"])
    return now.select("id", "kind", "area", "sequence_number")


def train_order_state(spark: SparkSession, sf: str) -> DataFrame:
    history = messages.train_order_events(m.train_order_documents(orders(spark, sf)))
    now = state.set_clear_state(history, ["tiploc", "crs", "platform"])
    return messages.train_orders(now).select("tiploc", "crs", "platform", "place", "rid", "train_id")


def alarm_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The alarm state kept on a stream."""
    path = work_dir(spark, "alarms")
    history = messages.alarms(m.alarm_documents(dealt_stream(spark, sf, "events")))
    sinks.drain(jobs.start_state(history, ["id"], state.ORDER, f"{path}/state", f"{path}/checkpoint", drain=True))
    now = jobs.read_state(spark, f"{path}/state", ["id"], state.ORDER).where(F.col("op") == "set")
    return now.select("id", "kind", "area", "sequence_number")


def schedule_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The schedule state kept on a stream."""
    path = work_dir(spark, "schedules")
    history = messages.schedule_history(m.schedule_event_documents(dealt_stream(spark, sf, "events")))
    sinks.drain(jobs.start_state(history, ["rid"], state.SCHEDULE_ORDER, f"{path}/state", f"{path}/checkpoint", drain=True))
    now = state.in_force(jobs.read_state(spark, f"{path}/state", ["rid"], state.SCHEDULE_ORDER))
    return now.select("rid", "uid", "train_id", "doc_ts", "sequence_number")


def at_retract_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Current actual times and estimates kept on a stream."""
    path = work_dir(spark, "times")
    docs = m.forecast_event_documents(dealt_stream(spark, sf, "events"))
    history = messages.forecast_events(messages.forecasts(docs))
    order = ["doc_ts", "sequence_number"]
    sinks.drain(jobs.start_times(history, FORECAST_KEY, order, f"{path}/state", f"{path}/checkpoint", drain=True))
    return jobs.read_times(spark, f"{path}/state", FORECAST_KEY)


FORECAST_KEY = ["rid", "tpl", "wta", "event"]


def forecast_history(spark: SparkSession, sf: str) -> DataFrame:
    docs = m.forecast_event_documents(events(spark, sf))
    return messages.forecast_events(messages.forecasts(docs))


def at_retract(spark: SparkSession, sf: str) -> DataFrame:
    """Current actual time and estimate; a withdrawn actual time is gone."""
    return state.actual_times(forecast_history(spark, sf), FORECAST_KEY, ["doc_ts", "sequence_number"])


def snapshot_overlay(spark: SparkSession, sf: str) -> DataFrame:
    now = state.overlay(forecast_history(spark, sf), FORECAST_KEY, ["doc_ts", "sequence_number"])
    return now.select(*FORECAST_KEY, "response", "sequence_number", "et", "at")


def request_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.envelopes(m.mixed_documents(orders(spark, sf)))
    once = state.distinct_requests(rows, ["doc_ts", "sequence_number"])
    return once.select("sequence_number", "request_source", "request_id")


def request_dedup_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same on a stream of four files, in which the first of several copies often comes last."""
    path = work_dir(spark, "requests")
    docs = m.mixed_documents(read_table(spark, sf, "orders"))
    docs.repartitionByRange(4, F.col("sequence_number").desc()).write.parquet(f"{path}/documents")
    arriving = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/documents")
    order = ["doc_ts", "sequence_number"]
    sinks.drain(jobs.start_requests(messages.envelopes(arriving), order, f"{path}/rows", f"{path}/checkpoint", drain=True))
    return jobs.read_requests(spark, f"{path}/rows", order).select("sequence_number", "request_source", "request_id")


def formation_loading(spark: SparkSession, sf: str) -> DataFrame:
    """Loading of every coach; coaches the last message leaves out are cleared."""
    o = orders(spark, sf)
    formations = messages.formations(m.formation_documents(o))
    loadings = messages.loadings(m.loading_documents(o))
    now = state.coach_loading_state(formations, loadings)
    return now.select("rid", "fid", "tpl", "wtd", "coach_number", "loading")


QUERIES = {
    fn.__name__: fn
    for fn in (
        enrich_dims,
        enrich_balanced,
        tiploc_semi,
        area_semi,
        tracking_fix,
        tracking_fix_hot,
        journey_anchor,
        journey_anchor_in_blocks,
        calling_points_anchored,
        instance_match,
        instance_match_stream,
        via_text,
        schedule_state,
        frames_schedule_state,
        frames_alarm_state,
        alarm_state,
        train_order_state,
        alarm_state_stream,
        schedule_state_stream,
        at_retract,
        at_retract_stream,
        snapshot_overlay,
        request_dedup,
        request_dedup_stream,
        formation_loading,
    )
}


def _sql(columns: dict[str, str]) -> str:
    return ", ".join(f'{sql} AS "{name}"' for name, sql in columns.items())


_FACTS = f"SELECT l_orderkey, l_linenumber, l_extendedprice, {_sql(FACTS)} FROM lineitem"
_SCHEDULED = f"s AS ({m.SCHEDULE_POINTS_SQL})"


def _clock(name: str) -> str:
    return f"({name} || CASE WHEN length({name}) = 5 THEN ':00' ELSE '' END)"


_DAYS = f"""{_SCHEDULED},
  t AS (SELECT *, epoch(CAST('1970-01-01 ' || {_clock('coalesce(wta, wtp, wtd)')} AS TIMESTAMP)) AS sec FROM s),
  d AS (SELECT *, CASE WHEN lag(sec) OVER (PARTITION BY rid ORDER BY pos) - sec > 43200 THEN 1 ELSE 0 END AS step FROM t),
  j AS (SELECT *, CAST(sum(step) OVER (PARTITION BY rid ORDER BY pos ROWS UNBOUNDED PRECEDING) AS INTEGER) AS "day" FROM d),
  a AS (SELECT *, CAST(CAST(ssd + "day" AS DATE) AS VARCHAR) AS on_date FROM j),
  b AS (SELECT *, CAST(on_date || ' ' || {_clock('coalesce(wta, wtp, wtd)')} AS TIMESTAMP) AS main_at FROM a)"""


def _anchored(name: str) -> str:
    at = f"CAST(on_date || ' ' || {_clock(name)} AS TIMESTAMP)"
    return (
        f"CASE WHEN {at} < main_at - INTERVAL 12 HOUR THEN {at} + INTERVAL 1 DAY "
        f"WHEN {at} > main_at + INTERVAL 12 HOUR THEN {at} - INTERVAL 1 DAY ELSE {at} END AS {name}"
    )


_JOURNEYS = f"""WITH {_DAYS} SELECT rid, ssd, pos, {', '.join(_anchored(n) for n in ('wta', 'wtd', 'wtp', 'pta', 'ptd'))},
        "day" FROM b"""

_POINTS_OF = "SELECT *, CASE WHEN second_train THEN rid_2 ELSE rid END AS train FROM p"

_OFFERED = "unnest([{}])".format(
    ", ".join(f"{{'rank': {rank}, 'kind_of': '{name}', 'clock': {name}}}" for rank, name in enumerate(journey.INSTANCE_TIMES) if name != "wtp")
)

# One join of what the rows offer with what the points answer, both told apart by rank and clock.
_MATCHES = f"""f AS MATERIALIZED ({_POINTS_OF}),
  offered AS (SELECT o_orderkey, i, train AS rid, tpl, o.rank AS rank, o.kind_of AS kind_of, o.clock AS clock
    FROM (SELECT o_orderkey, i, train, tpl, {_OFFERED} AS o FROM f) WHERE o.clock IS NOT NULL),
  answers AS MATERIALIZED (SELECT rid, tpl, o.rank AS rank, o.clock AS clock, min(pos) AS pos
    FROM (SELECT rid, tpl, pos, {_OFFERED} AS o FROM s) WHERE o.clock IS NOT NULL GROUP BY ALL),
  best AS (SELECT o_orderkey, i, min({{'rank': rank, 'pos': pos, 'kind_of': kind_of}}) AS met
    FROM offered JOIN answers USING (rid, tpl, rank, clock) GROUP BY ALL)"""

_ALARMS = f"""SELECT event_id, ts, {m.ALARM_ID} AS id, event_type,
  CASE WHEN event_type = 'signup' THEN 'td_feed_fail' WHEN event_type = 'view' THEN 'tyrell_feed_fail' ELSE 'td_area_fail' END AS kind,
  CASE WHEN event_type NOT IN ('signup', 'view') THEN concat('A', CAST(user_id % 10 AS VARCHAR)) END AS area,
  row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) DESC, event_id DESC) AS n FROM events"""

_ALARM_STATE = f"""SELECT id, kind, area, event_id AS sequence_number FROM ({_ALARMS})
  WHERE n = 1 AND event_type NOT IN ('click', 'error')"""

_FORECASTS = f"""SELECT {m.EVENT_RID} AS rid, concat('T', CAST(event_id % 3 AS VARCHAR)) AS tpl, '10:00' AS wta, 'arr' AS event,
  date_trunc('second', ts) AS doc_ts, event_id AS seq, event_type,
  CASE WHEN event_id % 50 = 0 THEN 'snapshot' ELSE 'update' END AS response,
  CASE WHEN event_type <> 'purchase' THEN strftime(ts, '%H:%M') END AS et,
  CASE WHEN event_type = 'purchase' THEN strftime(ts, '%H:%M') END AS "at" FROM events"""

_REQUESTS = f"""SELECT o_orderkey AS sequence_number, CAST({f.DOC_TS} AS TIMESTAMP) AS doc_ts,
  CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 3 > 0 THEN {m.REQUEST_SOURCE} END AS request_source,
  CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 4 > 0 THEN {m.REQUEST_ID} END AS request_id FROM orders"""
_KEYED = "request_source IS NOT NULL AND request_id IS NOT NULL"

_REQUEST_DEDUP = f"""WITH r AS ({_REQUESTS})
        SELECT sequence_number, request_source, request_id FROM r WHERE NOT ({_KEYED})
        UNION ALL SELECT sequence_number, request_source, request_id FROM (SELECT * FROM r WHERE {_KEYED}
          QUALIFY row_number() OVER (PARTITION BY request_source, request_id ORDER BY doc_ts, sequence_number) = 1)"""

_SCHEDULE_STATE = f"""SELECT rid, uid, train_id, doc_ts, event_id AS sequence_number FROM (
        SELECT {m.EVENT_RID} AS rid, concat('C', lpad(CAST(user_id AS VARCHAR), 5, '0')) AS uid,
          concat('1A', lpad(CAST(event_id % 100 AS VARCHAR), 2, '0')) AS train_id, date_trunc('second', ts) AS doc_ts, event_id, event_type,
          CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
          row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) DESC, event_id DESC) AS n FROM events)
        WHERE n = 1 AND event_type <> 'error' AND k % 17 <> 0 AND k % 13 <> 0"""


def _in_sequence(sql: str) -> str:
    """The same where all documents are of one moment."""
    return sql.replace("ORDER BY date_trunc('second', ts) DESC, event_id DESC", "ORDER BY event_id DESC")


_ACTUAL_TIMES = f"""WITH x AS ({_FORECASTS}),
        a AS (SELECT rid, tpl, wta, event, CASE WHEN event_type = 'purchase' THEN "at" END AS "at" FROM x
          WHERE event_type IN ('purchase', 'error') OR response = 'snapshot'
          QUALIFY row_number() OVER (PARTITION BY rid, tpl ORDER BY doc_ts DESC, seq DESC) = 1),
        e AS (SELECT rid, tpl, et FROM x WHERE et IS NOT NULL OR response = 'snapshot'
          QUALIFY row_number() OVER (PARTITION BY rid, tpl ORDER BY doc_ts DESC, seq DESC) = 1)
        SELECT k.rid, k.tpl, k.wta, k.event, a."at", e.et FROM (SELECT DISTINCT rid, tpl, wta, event FROM x) k
        LEFT JOIN a ON a.rid = k.rid AND a.tpl = k.tpl LEFT JOIN e ON e.rid = k.rid AND e.tpl = k.tpl"""

_CALLS = f"""WITH p AS ({POINTS_SQL}), {_SCHEDULED}, {_MATCHES}
        SELECT f.o_orderkey AS sequence_number, CAST(CASE WHEN second_train THEN 1 ELSE 0 END AS INTEGER) AS train_index,
          CAST(CASE WHEN second_train THEN 0 ELSE f.i END AS INTEGER) AS location_index, f.train AS rid, f.tpl,
          best.met.pos AS pos, best.met.kind_of AS matched_by
        FROM f LEFT JOIN best ON best.o_orderkey = f.o_orderkey AND best.i = f.i"""


def _corrected_sql(hot: str | None) -> str:
    return f"""SELECT x.*, coalesce(c.right_id, x.train_id) AS shown_train_id
        FROM (SELECT event_id, CAST({m.SEEN_AT} AS TIMESTAMP) AS seen_at, {_sql(m.seen_at(hot))} FROM events) x
        ASOF LEFT JOIN (SELECT {m.AREA} AS area, {m.BERTH} AS berth, {m.WRONG_ID} AS train_id, CAST({m.CORRECTED_AT} AS TIMESTAMP) AS since,
          arg_max({m.RIGHT_ID}, c_custkey) AS right_id FROM customer GROUP BY ALL) c
        ON c.area = x.area AND c.berth = x.berth AND c.train_id = x.train_id AND x.seen_at >= c.since"""


ORACLE = {
    "enrich_dims": f"""SELECT x.*, p.locname, p.crs, n.tocname, r.reasontext, i.name AS instance_name FROM ({_FACTS}) x
        LEFT JOIN (SELECT {_sql(LOCATIONS)} FROM part) p USING (tpl)
        LEFT JOIN (SELECT {_sql(OPERATORS)} FROM nation) n USING (toc)
        LEFT JOIN (SELECT 'late' AS domain, {_sql(LATE)} FROM nation UNION ALL SELECT 'cancel', {_sql(CANCELLED)} FROM nation) r
          ON r.domain = x.domain AND r.code = x.code
        LEFT JOIN (SELECT {_sql(INSTANCES)} FROM region) i ON i.code = x.src_inst""",
    "enrich_balanced": f"""SELECT tpl, locname, crs, count(*) AS "rows" FROM (
        SELECT CASE WHEN l_linenumber <= 2 THEN 'P7' ELSE tpl END AS tpl FROM ({_FACTS})) x
        LEFT JOIN (SELECT {_sql(LOCATIONS)} FROM part) p USING (tpl) GROUP BY ALL""",
    "tiploc_semi": f"""SELECT l_orderkey, l_linenumber, tpl FROM ({_FACTS})
        WHERE tpl IN (SELECT {LOCATIONS['tpl']} FROM part WHERE p_size < 10)""",
    "area_semi": f"SELECT * FROM (SELECT event_id, {_sql(m.SIGHTING)} FROM events) WHERE area IN ('A3', 'A4')",
    "tracking_fix": _corrected_sql(None),
    "tracking_fix_hot": _corrected_sql(HOT),
    "journey_anchor": _JOURNEYS,
    "calling_points_anchored": _JOURNEYS,
    "journey_anchor_in_blocks": f'WITH {_DAYS} SELECT rid, pos, "day" FROM b',
    "instance_match": _CALLS,
    "instance_match_stream": _CALLS,
    "via_text": f"""WITH {_SCHEDULED}, c AS (SELECT rid, tpl, pos FROM s WHERE kind IN ('OR', 'IP', 'DT')),
        ends AS (SELECT rid, arg_max(tpl, pos) AS dest FROM c GROUP BY rid),
        v AS (SELECT DISTINCT {_sql(VIA)} FROM orders),
        st AS (SELECT DISTINCT {_sql(STATIONS)} FROM orders)
        SELECT DISTINCT x.rid, x.tpl, st.crs, v.viatext, v.loc1, v.loc2 FROM c x JOIN st USING (tpl) JOIN ends USING (rid)
        JOIN v ON v."at" = st.crs AND v.dest = ends.dest
        WHERE EXISTS (SELECT 1 FROM c a WHERE a.rid = x.rid AND a.tpl = v.loc1 AND (v.loc2 IS NULL OR EXISTS (
          SELECT 1 FROM c b WHERE b.rid = x.rid AND b.tpl = v.loc2 AND b.pos > a.pos)))""",
    "schedule_state": _SCHEDULE_STATE,
    "schedule_state_stream": _SCHEDULE_STATE,
    "frames_schedule_state": f"SELECT rid, uid, train_id, sequence_number FROM ({_in_sequence(_SCHEDULE_STATE)})",
    "frames_alarm_state": _in_sequence(_ALARM_STATE),
    "at_retract_stream": _ACTUAL_TIMES,
    "alarm_state": _ALARM_STATE,
    "alarm_state_stream": _ALARM_STATE,
    "train_order_state": f"""WITH t AS (SELECT *, {m.ORDER_TIPLOC} AS tiploc, {m.ORDER_CRS} AS crs, {m.ORDER_PLATFORM} AS platform,
          {f.DOC_TS} AS doc_ts FROM orders),
        l AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY tiploc, crs, platform ORDER BY doc_ts DESC, o_orderkey DESC) = 1)
        SELECT tiploc, crs, platform, CAST(1 AS INTEGER) AS place, {f.RID} AS rid, CAST(NULL AS VARCHAR) AS train_id FROM l WHERE o_orderkey % 6 <> 0
        UNION ALL SELECT tiploc, crs, platform, 2, NULL, {m.TRAIN_ID} FROM l WHERE o_orderkey % 6 <> 0 AND o_orderkey % 4 > 0
        UNION ALL SELECT tiploc, crs, platform, 3, {f.RID_2}, NULL FROM l WHERE o_orderkey % 6 <> 0 AND o_orderkey % 4 > 1""",
    "at_retract": _ACTUAL_TIMES,
    "snapshot_overlay": f"""SELECT rid, tpl, wta, event, response, seq AS sequence_number, et, "at" FROM ({_FORECASTS})
        QUALIFY row_number() OVER (PARTITION BY rid, tpl ORDER BY doc_ts DESC, response = 'update' DESC, seq DESC) = 1""",
    "request_dedup": _REQUEST_DEDUP,
    "request_dedup_stream": _REQUEST_DEDUP,
    "formation_loading": f"""SELECT {f.RID} AS rid, {m.FID} AS fid, {f.place('1')} AS tpl, {f.wtd('1')} AS wtd,
        substr('ABCDEFGH', CAST(i + 1 AS INT), 1) AS coach_number,
        CASE WHEN (o_orderkey + i + 2) % 3 > 0 THEN CAST((o_orderkey + i * 7 + 22) % 101 AS INTEGER) END AS loading
        FROM (SELECT *, unnest(range({m.COACHES})) AS i FROM orders)""",
}
