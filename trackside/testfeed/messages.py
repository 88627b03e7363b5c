"""Documents of the other message kinds, each built from one table row alone.

Columns of every document table: ``sequence_number`` and ``xml``. The ``*_SQL`` texts give the
checking engine the same content as rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.functions.xml import escape, once
from trackside.testfeed import fields as f
from trackside.testfeed.frames import attr, part_uri, pport, repeated, tag


def q(text: str) -> str:
    """SQL text literal."""
    return f"'{text}'"


# --- schedules, from orders -------------------------------------------------------------------

TRAIN_ID = "concat(cast(o_orderkey % 10 as string), substr('ABCDEFGHIJ', cast(1 + o_custkey % 10 as int), 1), lpad(cast(o_orderkey % 100 as string), 2, '0'))"
TOC = "concat('O', cast(o_custkey % 10 as string))"


def point_kind(i: str) -> str:
    return (
        f"case when {i} = 0 then (case when o_orderkey % 5 = 0 then 'OPOR' else 'OR' end) "
        f"when {i} = {f.POINTS} - 1 then (case when o_orderkey % 5 = 1 then 'OPDT' else 'DT' end) "
        f"when (o_orderkey + {i}) % 4 = 0 then 'PP' when (o_orderkey + {i}) % 4 = 1 then 'OPIP' else 'IP' end"
    )


def activity(i: str) -> str:
    return f"case when {i} = 0 then 'TB' when {i} = {f.POINTS} - 1 then 'TF' when (o_orderkey + {i}) % 3 = 0 then 'T -D' else 'T ' end"


def has_activity(i: str) -> str:
    return f"({i} = 0 or (o_orderkey + {i}) % 7 <> 0)"


def _passes(i: str) -> str:
    return f"({i} > 0 and {i} < {f.POINTS} - 1 and (o_orderkey + {i}) % 4 = 0)"


def _calls(i: str) -> str:
    return (
        f"(case when {i} = 0 then o_orderkey % 5 <> 0 when {i} = {f.POINTS} - 1 then o_orderkey % 5 <> 1 "
        f"else (o_orderkey + {i}) % 4 >= 2 end)"
    )


HAS_FORMATION = "(o_orderkey % 3 = 0)"
FID = "concat('F', cast(o_orderkey as string))"


def schedule_element(name: str, prefix: str, point_extra: str = "''", extra: tuple[str, ...] = ()) -> str:
    """SQL text of a schedule with its points; ``extra`` are more attribute texts."""
    i = "i"
    not_first, not_last = f"{i} > 0", f"{i} < {f.POINTS} - 1"
    stops = f"not {_passes(i)}"
    point = (
        f"concat('<{prefix}', {point_kind(i)}, "
        f"{attr('tpl', f.place(i))}, {attr('act', activity(i), has_activity(i))}, "
        f"{attr('wta', f.wta(i), f'{stops} and {not_first}')}, {attr('wtd', f.wtd(i), f'{stops} and {not_last}')}, "
        f"{attr('wtp', f.wta(i), _passes(i))}, "
        f"{attr('pta', f.pta(i), f'{_calls(i)} and {not_first}')}, {attr('ptd', f.ptd(i), f'{_calls(i)} and {not_last}')}, "
        f"{attr('can', q('true'), 'o_orderkey % 21 = 0')}, {attr('fid', FID, f'{HAS_FORMATION} and {i} = 0')}, "
        f"{attr('rdelay', 'cast(o_orderkey % 7 as string)', f'{not_first} and o_orderkey % 13 = 0')}, {point_extra}, '/>')"
    )
    reason = tag(
        f"{prefix}cancelReason",
        attr("tiploc", f.place("0"), "o_orderkey % 2 = 0"),
        inside="cast(500 + o_orderkey % 40 as string)",
    )
    cancelled = f"case when o_orderkey % 21 = 0 then {reason} else '' end"
    return tag(
        name,
        attr("rid", f.RID), attr("uid", f.UID), attr("trainId", TRAIN_ID), attr("ssd", f.SSD), attr("toc", TOC),
        attr("rsid", "concat('RS', lpad(cast(o_orderkey % 10000 as string), 4, '0'))", "o_orderkey % 4 = 0"),
        attr("status", q("B"), "o_orderkey % 16 = 0"),
        attr("trainCat", q("XX"), "o_orderkey % 9 = 0"),
        attr("isActive", q("false"), "o_orderkey % 14 = 0"),
        attr("deleted", q("true"), "o_orderkey % 37 = 0"),
        *extra,
        inside=f"concat({repeated(f.POINTS, point)}, {cancelled})",
    )


def schedule_documents(orders: DataFrame) -> DataFrame:
    xml = pport(schedule_element("schedule", "s:"), uris=part_uri("s", "Schedules/v3"))
    return orders.select(F.col("o_orderkey").alias("sequence_number"), once(F.expr(xml)).alias("xml"))


SCHEDULE_POINTS_SQL = f"""
SELECT o_orderkey AS sequence_number, o_custkey, {f.RID} AS rid, CAST(o_orderdate AS DATE) AS ssd,
  CAST(i AS INTEGER) AS pos, {point_kind('i')} AS kind, {f.place('i')} AS tpl,
  CASE WHEN {has_activity('i')} THEN {activity('i')} END AS act,
  CASE WHEN NOT {_passes('i')} AND i > 0 THEN {f.wta('i')} END AS wta,
  CASE WHEN NOT {_passes('i')} AND i < {f.POINTS} - 1 THEN {f.wtd('i')} END AS wtd,
  CASE WHEN {_passes('i')} THEN {f.wta('i')} END AS wtp,
  CASE WHEN {_calls('i')} AND i > 0 THEN {f.pta('i')} END AS pta,
  CASE WHEN {_calls('i')} AND i < {f.POINTS} - 1 THEN {f.ptd('i')} END AS ptd,
  CASE WHEN o_orderkey % 21 = 0 THEN TRUE END AS can,
  CASE WHEN {HAS_FORMATION} AND i = 0 THEN {FID} END AS fid,
  CASE WHEN i > 0 AND o_orderkey % 13 = 0 THEN CAST(o_orderkey % 7 AS SMALLINT) END AS rdelay
FROM (SELECT *, unnest(range({f.POINTS})) AS i FROM orders)
"""


# --- mixed documents for the envelope, from orders ----------------------------------------------

def mixed_documents(orders: DataFrame) -> DataFrame:
    body = "concat(" + ", ".join(
        [
            repeated("o_orderkey % 3", tag("schedule", attr("rid", "cast(i as string)"), inside=q("<OR tpl=\"A\"/>"))),
            repeated("o_orderkey % 2", tag("deactivated", attr("rid", "cast(i as string)"))),
            repeated("o_orderkey % 4", tag("TS", attr("rid", "cast(i as string)"))),
            repeated("o_orderkey % 5", tag("alarm", inside=q("<clear>1</clear>"))),
        ]
    ) + ")"
    kind = "case when o_orderkey % 7 = 0 then 'sR' else 'uR' end"
    extra = (
        "case when o_orderkey % 7 = 0 then '' else concat("
        f"{attr('updateOrigin', q('CIS'))}, "
        f"{attr('requestSource', REQUEST_SOURCE, 'o_orderkey % 3 > 0')}, "
        f"{attr('requestID', REQUEST_ID, 'o_orderkey % 4 > 0')}) end"
    )
    version = "cast(11 + o_orderkey % 6 as string)"
    return orders.select(
        F.col("o_orderkey").alias("sequence_number"), once(F.expr(pport(body, kind, version=version, extra=extra))).alias("xml")
    )


# Requests repeat: several orders share a source and an id.
REQUEST_SOURCE = "concat('CI', lpad(cast(o_custkey % 20 as string), 2, '0'))"
REQUEST_ID = "concat('R', cast(floor(o_orderkey / 40) as bigint))"


def mixed_version_documents(orders: DataFrame) -> DataFrame:
    """Status documents of versions 11 to 16, all with attributes only later versions define."""
    arr = tag("f:arr", attr("et", f.et("0")), attr("wet", f.pta("0")), attr("atClass", q("X")), attr("src", q("TD")))
    train = tag(
        "TS", attr("rid", f.RID), attr("uid", f.UID), attr("ssd", f.SSD),
        inside=tag("f:Location", attr("tpl", f.place("0")), attr("wta", f.wta("0")), inside=arr),
    )
    xml = pport(
        train,
        version="cast(11 + o_orderkey % 6 as string)",
        uris=part_uri("f", "Forecasts/v3"),
        extra="' updateOrigin=\"CIS\"'",
    )
    return orders.select(F.col("o_orderkey").alias("sequence_number"), once(F.expr(xml)).alias("xml"))


# --- associations, from orders ------------------------------------------------------------------

CATEGORY = "case o_orderkey % 4 when 0 then 'JJ' when 1 then 'VV' when 2 then 'LK' else 'NP' end"
ASSOC_RID = f"concat({f.digits('o_orderdate')}, lpad(cast(o_custkey as string), 8, '0'))"


def association_element(name: str, prefix: str) -> str:
    main = tag(f"{prefix}main", attr("rid", f.RID), attr("wta", f.wta("1")), attr("pta", f.pta("1"), "o_orderkey % 2 = 0"))
    assoc = tag(f"{prefix}assoc", attr("rid", ASSOC_RID), attr("wtd", f.wtd("1")))
    return tag(
        name,
        attr("tiploc", f.place("1")), attr("category", CATEGORY),
        attr("isCancelled", q("true"), "o_orderkey % 6 = 0"), attr("isDeleted", q("1"), "o_orderkey % 10 = 0"),
        inside=f"concat({main}, {assoc})",
    )


def association_documents(orders: DataFrame) -> DataFrame:
    xml = pport(association_element("association", "a:"), uris=part_uri("a", "Schedules/v2"))
    return orders.select(F.col("o_orderkey").alias("sequence_number"), once(F.expr(xml)).alias("xml"))


# --- formations and loading, from orders --------------------------------------------------------

COACHES = "(2 + o_orderkey % 4)"
LOADING_MESSAGES = 3


def formation_documents(orders: DataFrame) -> DataFrame:
    coach = tag(
        "m:coach",
        attr("coachNumber", "substr('ABCDEFGH', i + 1, 1)"),
        attr("coachClass", "case when i = 0 then 'First' else 'Standard' end", "(o_orderkey + i) % 5 > 0"),
        inside=f"case when (o_orderkey + i) % 3 = 0 then "
        + tag("m:toilet", attr("status", q("NotInService"), "o_orderkey % 2 = 0"), inside=q("Accessible"))
        + " else '' end",
    )
    item = tag(
        "scheduleFormations", attr("rid", f.RID),
        inside=tag("m:formation", attr("fid", FID), attr("src", q("TOC")), inside=tag("m:coaches", inside=repeated(COACHES, coach))),
    )
    return orders.select(
        F.col("o_orderkey").alias("sequence_number"), once(F.expr(pport(item, uris=part_uri("m", "Formations/v2")))).alias("xml")
    )


FORMATION_COACHES_SQL = f"""
SELECT o_orderkey AS sequence_number, {f.RID} AS rid, {FID} AS fid, 'TOC' AS src, CAST(i AS INTEGER) AS coach_index,
  substr('ABCDEFGH', CAST(i + 1 AS INT), 1) AS coach_number,
  CASE WHEN (o_orderkey + i) % 5 > 0 THEN CASE WHEN i = 0 THEN 'First' ELSE 'Standard' END END AS coach_class,
  CASE WHEN (o_orderkey + i) % 3 = 0 THEN 'Accessible' END AS toilet,
  CASE WHEN (o_orderkey + i) % 3 = 0 AND o_orderkey % 2 = 0 THEN 'NotInService' END AS toilet_status,
  o_orderkey, o_custkey, i
FROM (SELECT *, unnest(range({COACHES})) AS i FROM orders)
"""


def loading_documents(orders: DataFrame) -> DataFrame:
    """Three loading messages per formation; each leaves out some coaches, the last counts."""
    value = tag(
        "n:loading", attr("coachNumber", "substr('ABCDEFGH', i + 1, 1)"), attr("src", q("CIS")),
        inside="cast((o_orderkey + i * 7 + j * 11) % 101 as string)",
    )
    item = tag(
        "formationLoading",
        attr("fid", FID), attr("rid", f.RID), attr("tpl", f.place("1")), attr("wtd", f.wtd("1")),
        inside=repeated(COACHES, f"case when (o_orderkey + i + j) % 3 > 0 then {value} else '' end"),
    )
    messages = orders.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(LOADING_MESSAGES - 1))))
    return messages.select(
        (F.col("o_orderkey") * LOADING_MESSAGES + F.col("j")).alias("sequence_number"),
        once(F.expr(pport(item, uris=part_uri("n", "Formations/v1")))).alias("xml"),
    )


# --- station messages, from documents -----------------------------------------------------------

def station_message_documents(documents: DataFrame) -> DataFrame:
    """The whole text is the message's paragraph, followed by a link."""
    crs = "concat('S', lpad(cast((doc_id + i) % 100 as string), 2, '0'))"
    stations = repeated("doc_id % 3", tag("w:Station", attr("crs", crs)))
    link = tag("w:a", attr("href", "concat('http://info.example/m?id=', cast(doc_id as string), '&amp;x=1')"), inside=q("more"))
    item = tag(
        "OW",
        attr("id", "cast(doc_id as string)"),
        attr("cat", "case when doc_id % 2 = 0 then 'Station' else 'Misc' end"),
        attr("sev", "cast(doc_id % 4 as string)"),
        attr("suppress", q("true"), "doc_id % 5 = 0"),
        inside=f"concat({stations}, " + tag("w:Msg", inside=f"concat({tag('w:p', inside='safe')}, {link})") + ")",
    )
    ts = "'2024-02-01T08:00:00'"
    safe = documents.select("doc_id", escape(F.col("text")).alias("safe"))
    return safe.select(
        F.col("doc_id").alias("sequence_number"), once(F.expr(pport(item, ts=ts, uris=part_uri("w", "StationMessages/v1")))).alias("xml")
    )


# --- train alerts and tracking corrections, from customer ---------------------------------------

def alert_documents(customer: DataFrame) -> DataFrame:
    place = tag("t:Location", inside="concat('L', cast((c_custkey + i) % 50 as string))")
    second = tag("t:Location", inside=q("L99"))
    service = tag(
        "t:AlertService",
        attr("RID", "concat('20240101', lpad(cast(c_custkey * 2 + i as string), 8, '0'))"),
        attr("UID", "concat('U', lpad(cast(c_custkey % 100000 as string), 5, '0'))"),
        attr("SSD", q("2024-01-01")),
        inside=f"concat({place}, case when c_custkey % 4 = 0 then {second} else '' end)",
    )
    item = tag(
        "trainAlert",
        inside="concat("
        + ", ".join(
            [
                tag("t:AlertID", inside="cast(c_custkey as string)"),
                tag("t:AlertServices", inside=repeated("c_custkey % 3", service)),
                tag("t:SendAlertBySMS", inside=q("true")),
                tag("t:SendAlertByEmail", inside="case when c_custkey % 2 = 0 then 'true' else 'false' end"),
                tag("t:SendAlertByTwitter", inside=q("false")),
                tag("t:Source", inside="concat('N', cast(c_nationkey as string))"),
                tag("t:AlertText", inside="concat(c_name, ' &lt;', c_mktsegment, '&gt;')"),
                tag("t:Audience", inside=q("Customer")),
                tag("t:AlertType", inside="case when c_custkey % 5 = 0 then 'Forced' else 'Normal' end"),
                "case when c_custkey % 6 = 0 then " + tag("t:CopiedFromAlertID", inside="cast(c_custkey - 1 as string)") + " else '' end",
            ]
        )
        + ")",
    )
    return customer.select(
        F.col("c_custkey").alias("sequence_number"),
        once(F.expr(pport(item, ts="'2024-02-01T09:00:00'", uris=part_uri("t", "TrainAlerts/v1")))).alias("xml"),
    )


AREA = "concat('A', cast(c_nationkey % 5 as string))"
BERTH = "lpad(cast(c_nationkey * 10 + c_custkey % 4 as string), 4, '0')"
WRONG_ID = "concat('1A', lpad(cast(c_custkey % 10 as string), 2, '0'))"
RIGHT_ID = "concat('2B', lpad(cast(c_custkey % 100 as string), 2, '0'))"
# Corrections come throughout the month of the sightings.
CORRECTED_AT = f"concat('2024-01-', lpad(cast(1 + c_custkey % 28 as string), 2, '0'), 'T', {f.hhmm('(c_custkey * 37) % 1440')}, ':00')"


def tracking_documents(customer: DataFrame) -> DataFrame:
    item = tag(
        "trackingID",
        inside="concat("
        + ", ".join(
            [
                tag("d:berth", attr("area", AREA), inside=BERTH),
                tag("d:incorrectTrainID", inside=WRONG_ID),
                tag("d:correctTrainID", inside=RIGHT_ID),
            ]
        )
        + ")",
    )
    return customer.select(
        F.col("c_custkey").alias("sequence_number"),
        once(F.expr(pport(item, ts=CORRECTED_AT, uris=part_uri("d", "TDData/v1")))).alias("xml"),
    )


def sightings(events: DataFrame) -> DataFrame:
    """Berth sightings of trains, one per event."""
    return events.selectExpr("event_id", *[f"{sql} as {name}" for name, sql in SIGHTING.items()])


def timed_sightings(events: DataFrame, hot: str | None = None) -> DataFrame:
    """Sightings with their time; those where ``hot`` holds are of one area and four berths."""
    return events.selectExpr("event_id", f"cast({SEEN_AT} as timestamp_ntz) as seen_at", *[f"{sql} as {name}" for name, sql in seen_at(hot).items()])


def seen_at(hot: str | None) -> dict[str, str]:
    """The columns of sightings, for both engines."""
    if hot is None:
        return SIGHTING
    return {name: f"case when {hot} then {HOT_SIGHTING[name]} else {sql} end" if name in HOT_SIGHTING else sql for name, sql in SIGHTING.items()}


SEEN_AT = "date_trunc('second', ts)"
HOT_SIGHTING = {"area": "'A1'", "berth": "lpad(cast(10 + event_id % 4 as string), 4, '0')"}
SIGHTING = {
    "area": "concat('A', cast(user_id % 5 as string))",
    "berth": "lpad(cast((user_id % 25) * 10 + event_id % 4 as string), 4, '0')",
    "train_id": "concat('1A', lpad(cast(event_id % 10 as string), 2, '0'))",
}


def failure_documents(supplier: DataFrame) -> DataFrame:
    """Failure responses in place of data."""
    item = tag(
        "FailureResp",
        attr("code", "concat('E', cast(s_nationkey as string))"),
        attr("requestSource", q("CI01"), "s_suppkey % 2 = 0"),
        attr("requestID", "concat('Q', cast(s_suppkey as string))", "s_suppkey % 2 = 0"),
        inside="concat('no data for ', s_name)",
    )
    xml = pport("''", ts="'2024-02-01T10:00:00'")
    inside = f"replace({xml}, '<uR></uR>', {item})"
    return supplier.select(F.col("s_suppkey").alias("sequence_number"), once(F.expr(inside)).alias("xml"))


# --- train order, from orders -------------------------------------------------------------------

ORDER_TIPLOC = "concat('T', cast(o_custkey % 50 as string))"
ORDER_CRS = "concat('S', lpad(cast(o_custkey % 50 as string), 2, '0'))"
ORDER_PLATFORM = "cast(1 + o_orderkey % 3 as string)"


def train_order_documents(orders: DataFrame) -> DataFrame:
    first = tag("o:first", inside=tag("o:rid", attr("wtd", f.wtd("0")), inside=f.RID))
    second = tag("o:second", inside=tag("o:trainID", inside=TRAIN_ID))
    third = tag("o:third", inside=tag("o:rid", attr("wta", f.wta("1")), inside=f.RID_2))
    order = tag(
        "o:set",
        inside=f"concat({first}, case when o_orderkey % 4 > 0 then {second} else '' end, case when o_orderkey % 4 > 1 then {third} else '' end)",
    )
    item = tag(
        "trainOrder", attr("tiploc", ORDER_TIPLOC), attr("crs", ORDER_CRS), attr("platform", ORDER_PLATFORM),
        inside=f"case when o_orderkey % 6 = 0 then '<o:clear/>' else {order} end",
    )
    return orders.select(
        F.col("o_orderkey").alias("sequence_number"), once(F.expr(pport(item, uris=part_uri("o", "TrainOrder/v1")))).alias("xml")
    )


# --- schedule, alarm and forecast history, from events ------------------------------------------

EVENT_TS = "replace(substr(cast(ts as string), 1, 19), ' ', 'T')"
EVENT_RID = "concat('20240101', lpad(cast(user_id as string), 8, '0'))"


def schedule_event_documents(events: DataFrame) -> DataFrame:
    """An error deactivates the user's schedule, any other event sends it anew."""
    k = "cast(get_json_object(props, '$.k') as int)"
    put = tag(
        "schedule",
        attr("rid", EVENT_RID), attr("uid", "concat('C', lpad(cast(user_id as string), 5, '0'))"),
        attr("trainId", "concat('1A', lpad(cast(event_id % 100 as string), 2, '0'))"), attr("ssd", q("2024-01-01")),
        attr("toc", q("O1")), attr("deleted", q("true"), f"{k} % 17 = 0"), attr("isActive", q("false"), f"{k} % 13 = 0"),
        inside=q("<OR tpl=\"A\" wtd=\"10:00\"/><DT tpl=\"B\" wta=\"11:00\"/>"),
    )
    body = f"case when event_type = 'error' then {tag('deactivated', attr('rid', EVENT_RID))} else {put} end"
    return events.select(F.col("event_id").alias("sequence_number"), once(F.expr(pport(body, ts=EVENT_TS))).alias("xml"))


ALARM_ID = "concat('AL', cast(user_id as string))"


def alarm_documents(events: DataFrame) -> DataFrame:
    """Clicks and errors clear the user's alarm, other events set one."""
    area = "concat('A', cast(user_id % 10 as string))"
    kind = (
        "case event_type when 'signup' then '<l:tdFeedFail/>' when 'view' then '<l:tyrellFeedFail/>' "
        f"else concat('<l:tdAreaFail>', {area}, '</l:tdAreaFail>') end"
    )
    put = tag("l:set", attr("id", ALARM_ID), inside=kind)
    item = tag("alarm", inside=f"case when event_type in ('click', 'error') then {tag('l:clear', inside=ALARM_ID)} else {put} end")
    return events.select(
        F.col("event_id").alias("sequence_number"),
        once(F.expr(pport(item, ts=EVENT_TS, uris=part_uri("l", "Alarms/v1")))).alias("xml"),
    )


def forecast_event_documents(events: DataFrame) -> DataFrame:
    """Purchases report an actual time, errors withdraw it, other events estimate."""
    clock = "substr(cast(ts as string), 12, 5)"
    arr = tag(
        "f:arr",
        attr("et", clock, "event_type <> 'purchase'"),
        attr("at", clock, "event_type = 'purchase'"),
        attr("atRemoved", q("true"), "event_type = 'error'"),
        attr("src", q("TD")),
    )
    item = tag(
        "TS", attr("rid", EVENT_RID), attr("uid", q("C00001")), attr("ssd", q("2024-01-01")),
        inside=tag("f:Location", attr("tpl", "concat('T', cast(event_id % 3 as string))"), attr("wta", q("10:00")), inside=arr),
    )
    kind = "case when event_id % 50 = 0 then 'sR' else 'uR' end"
    return events.select(
        F.col("event_id").alias("sequence_number"),
        once(F.expr(pport(item, kind, ts=EVENT_TS, uris=part_uri("f", "Forecasts/v3")))).alias("xml"),
    )
