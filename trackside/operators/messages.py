"""The message kinds of the feed as tables.

Input is a document table: ``sequence_number`` and ``xml`` (see ``decode.open_frames``), batch
or stream. Every function here is narrow: a text check, one parse per matching document, and
explodes. The parse asks for the columns of its own kind only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.functions.values import Typed, to_date, to_flag, to_int, to_local_time, to_short
from trackside.functions.xml import (
    feed_version,
    fragments,
    has_element,
    inner,
    links,
    parse_once,
    plain_text,
    points_in_order,
)
from trackside.schemas import (
    ALARM,
    ASSOCIATION,
    FAILURE,
    FIRST_VERSION,
    FORMATIONS,
    LOADING,
    MESSAGE_KINDS,
    REASON,
    SCHEDULE,
    STATION_MESSAGE_FIELDS,
    TRACKING_ID,
    TRAIN_ALERT,
    TRAIN_ORDER,
    TS_FULL,
    response_ddl,
    strings,
)

# Columns every message table starts with.
ENVELOPE = [
    "sequence_number",
    "feed_version",
    "doc_ts",
    "response",
    "update_origin",
    "request_source",
    "request_id",
]


def _envelope(m: str = "m") -> list[Column]:
    return [
        F.col("sequence_number"),
        F.col("feed_version"),
        to_local_time(f"{m}._ts").alias("doc_ts"),
        F.when(F.col(f"{m}.uR").isNotNull(), "update").when(F.col(f"{m}.sR").isNotNull(), "snapshot").alias("response"),
        F.col(f"{m}.uR._updateOrigin").alias("update_origin"),
        F.col(f"{m}.uR._requestSource").alias("request_source"),
        F.col(f"{m}.uR._requestID").alias("request_id"),
    ]


# The entry schema of each kind. Station messages are mixed markup and stay texts.
ENTRIES = {
    "schedule": SCHEDULE,
    "deactivated": "struct<_rid:string>",
    "association": ASSOCIATION,
    "scheduleFormations": FORMATIONS,
    "TS": TS_FULL,
    "formationLoading": LOADING,
    "trainAlert": TRAIN_ALERT,
    "trainOrder": TRAIN_ORDER,
    "trackingID": TRACKING_ID,
    "alarm": ALARM,
}


def parse_documents(docs: DataFrame, kinds: list[str]) -> DataFrame:
    """Documents parsed once for several kinds: the envelope, and a column per kind with its entries.

    Every function here that makes a table takes such rows in place of documents, so all tables
    come from one scan and one parse; write or persist the result before reading several of them.
    """
    xml = F.col("xml")
    text = F.when(has_element(xml, "schedule"), points_in_order(xml)).otherwise(xml) if "schedule" in kinds else xml
    listed = ",".join(f"{kind}:array<{ENTRIES[kind]}>" for kind in kinds if kind != "OW")
    parts = f",{listed}" if listed else ""
    ddl = (
        f"struct<{strings('_ts', '_version')},uR:struct<{strings('_updateOrigin', '_requestSource', '_requestID')}{parts}>,"
        f"sR:struct<_x:string{parts}>,FailureResp:{FAILURE},_corrupt_record:string>"
    )
    texts = docs.select(
        "sequence_number",
        feed_version(xml).alias("feed_version"),
        *([F.when(has_element(xml, "OW"), fragments(xml, "OW")).alias("OW")] if "OW" in kinds else []),
        text.alias("text"),
    )
    kept = [name for name in texts.columns if name != "text"]
    parsed = texts.select(*kept, parse_once(F.col("text"), ddl).alias("m"))
    return parsed.select(
        *_envelope(),
        *[F.coalesce(f"m.uR.{kind}", f"m.sR.{kind}").alias(kind) if kind != "OW" else F.col("OW") for kind in kinds],
        F.col("m.FailureResp").alias("FailureResp"),
    )


def without_kind(parsed: DataFrame, kinds: list[str]) -> DataFrame:
    """Documents of :func:`parse_documents` that hold none of the kinds and no failure either."""
    none = F.col("FailureResp").isNull()
    for kind in kinds:
        none = none & (F.coalesce(F.size(kind), F.lit(0)) < 1)
    return parsed.where(none)


def _parsed(docs: DataFrame, element: str, item: str, text: Column | None = None) -> DataFrame:
    """Documents that hold an element, parsed for it, with its entries as the array ``items``."""
    if element in docs.columns:
        return docs.select(*ENVELOPE, F.col(element).alias("items"))
    xml = F.col("xml")
    versioned = docs.where(has_element(xml, element)).select(
        "sequence_number",
        feed_version(xml).alias("feed_version"),
        (xml if text is None else text).alias("text"),
    )
    parsed = versioned.select(
        "sequence_number", "feed_version", parse_once(F.col("text"), response_ddl(element, item)).alias("m")
    )
    return parsed.select(
        *_envelope(), F.coalesce(f"m.uR.{element}", f"m.sR.{element}").alias("items")
    )


def _items(docs: DataFrame, element: str, item: str, text: Column | None = None) -> DataFrame:
    """One row per entry of a kind: the envelope, ``item_index`` and the struct ``item``."""
    return _parsed(docs, element, item, text).select(
        *ENVELOPE, F.posexplode("items").alias("item_index", "item")
    )


def _circular(prefix: str, alias: str = "") -> list[Column]:
    return [F.col(f"{prefix}._{name}").alias(f"{alias}{name}") for name in ("wta", "wtd", "wtp", "pta", "ptd")]


def envelopes(docs: DataFrame) -> DataFrame:
    """One row per data document: its kind, origin and how many entries of each kind it has."""
    entry = "array<struct<_x:string>>"
    kinds = ",".join(f"{kind}:{entry}" for kind in MESSAGE_KINDS)
    ddl = (
        f"struct<{strings('_ts', '_version')},"
        f"uR:struct<{strings('_updateOrigin', '_requestSource', '_requestID')},{kinds}>,sR:struct<{kinds}>>"
    )
    xml = F.col("xml")
    versioned = docs.select("sequence_number", feed_version(xml).alias("feed_version"), "xml")
    parsed = versioned.select("sequence_number", "feed_version", parse_once(xml, ddl).alias("m")).where(F.col("m.uR").isNotNull() | F.col("m.sR").isNotNull())
    counts = [
        F.coalesce(F.size(F.coalesce(f"m.uR.{kind}", f"m.sR.{kind}")), F.lit(0)).alias(f"n_{kind}")
        for kind in MESSAGE_KINDS
    ]
    return parsed.select(*_envelope(), F.col("m._version").alias("version"), *counts)


def _time_data(event: str) -> Column:
    t, typed = f"l.{event}", Typed()
    told = F.struct(
        F.col(f"{t}._et").alias("et"),
        F.col(f"{t}._wet").alias("wet"),
        F.col(f"{t}._at").alias("at"),
        typed(to_flag, f"{t}._atRemoved", "at_removed"),
        F.col(f"{t}._atClass").alias("at_class"),
        F.col(f"{t}._etmin").alias("etmin"),
        typed(to_flag, f"{t}._etUnknown", "et_unknown"),
        typed(to_flag, f"{t}._delayed", "delayed"),
        F.col(f"{t}._src").alias("src"),
        F.col(f"{t}._srcInst").alias("src_inst"),
        typed.malformed(),
    )
    return F.when(F.col(t).isNotNull(), told).alias("passing" if event == "pass" else event)


TRAIN_COLUMNS = ["rid", "uid", "ssd"]


def forecasts(docs: DataFrame) -> DataFrame:
    """One row per train location with everything the contract has for it.

    ``arr``, ``dep`` and ``passing`` are structs, NULL where the element is absent. Values are
    as sent; ``quality.fill_defaults`` adds what the contract leaves out.
    """
    # The train's own columns are taken out before its locations are exploded; a row that still
    # needed the train element would carry all its locations.
    typed, placed = Typed(), Typed()
    trains = _items(docs, "TS", TS_FULL).select(
        *ENVELOPE,
        F.col("item_index").alias("train_index"),
        F.col("item._rid").alias("rid"),
        F.col("item._uid").alias("uid"),
        typed(to_date, "item._ssd", "ssd"),
        typed(to_flag, "item._isReverseFormation", "is_reverse_formation"),
        typed(to_short, "item.LateReason._VALUE", "late_reason"),
        F.col("item.LateReason._tiploc").alias("late_reason_tiploc"),
        typed(to_flag, "item.LateReason._near", "late_reason_near"),
        typed.malformed(),
        F.col("item.Location").alias("listed"),
    )
    train = [name for name in trains.columns if name not in (*ENVELOPE, "train_index", "listed", "malformed")]
    located = trains.select(
        *ENVELOPE, "train_index", *train, "malformed", F.posexplode("listed").alias("location_index", "l")
    )
    return located.select(
        *ENVELOPE,
        "train_index",
        "location_index",
        *train,
        F.col("l._tpl").alias("tpl"),
        *_circular("l"),
        _time_data("arr"),
        _time_data("dep"),
        _time_data("pass"),
        F.col("l.plat._VALUE").alias("platform"),
        placed(to_flag, "l.plat._platsup", "platsup"),
        placed(to_flag, "l.plat._cisPlatsup", "cis_platsup"),
        F.col("l.plat._platsrc").alias("platsrc"),
        placed(to_flag, "l.plat._conf", "conf"),
        placed(to_flag, "l.suppr", "suppr"),
        placed(to_short, "l.length", "length"),
        placed(to_flag, "l.detachFront", "detach_front"),
        F.concat("malformed", placed.malformed()).alias("malformed"),
    )


TIME_FIELDS = ["et", "wet", "at", "at_removed", "at_class", "etmin", "et_unknown", "delayed", "src", "src_inst"]


def forecast_events(rows: DataFrame) -> DataFrame:
    """Forecast rows in long form: one row per arrival, departure or passing that is present."""
    keep = [name for name in rows.columns if name not in ("arr", "dep", "passing", "malformed")]
    events = F.array(
        *[
            F.struct(F.lit(label).alias("event"), F.col(name).alias("t"))
            for label, name in (("arr", "arr"), ("dep", "dep"), ("pass", "passing"))
        ]
    )
    long = rows.select(*keep, "malformed", F.explode(events).alias("e")).where(F.col("e.t").isNotNull())
    return long.select(
        *keep,
        F.col("e.event").alias("event"),
        *[F.col(f"e.t.{f}").alias(f) for f in TIME_FIELDS],
        F.concat("malformed", "e.t.malformed").alias("malformed"),
    )


def schedule_columns(s: str, typed: Typed) -> list[Column]:
    return [
        F.col(f"{s}._rid").alias("rid"),
        F.col(f"{s}._uid").alias("uid"),
        F.col(f"{s}._trainId").alias("train_id"),
        F.col(f"{s}._rsid").alias("rsid"),
        typed(to_date, f"{s}._ssd", "ssd"),
        F.col(f"{s}._toc").alias("toc"),
        F.col(f"{s}._status").alias("status"),
        F.col(f"{s}._trainCat").alias("train_cat"),
        typed(to_flag, f"{s}._isPassengerSvc", "is_passenger_svc"),
        typed(to_flag, f"{s}._isActive", "is_active"),
        typed(to_flag, f"{s}._deleted", "deleted"),
        typed(to_flag, f"{s}._isCharter", "is_charter"),
        typed(to_flag, f"{s}._qtrain", "qtrain"),
        typed(to_flag, f"{s}._can", "can"),
        typed(to_short, f"{s}.cancelReason._VALUE", "cancel_reason"),
        F.col(f"{s}.cancelReason._tiploc").alias("cancel_reason_tiploc"),
        typed(to_flag, f"{s}.cancelReason._near", "cancel_reason_near"),
    ]


def point_columns(p: str, typed: Typed) -> list[Column]:
    return [
        F.col(f"{p}._kind").alias("kind"),
        F.col(f"{p}._tpl").alias("tpl"),
        F.col(f"{p}._act").alias("act"),
        F.col(f"{p}._planAct").alias("plan_act"),
        typed(to_flag, f"{p}._can", "can"),
        F.col(f"{p}._fid").alias("fid"),
        F.col(f"{p}._plat").alias("platform"),
        *_circular(p),
        typed(to_int, f"{p}._avgLoading", "avg_loading"),
        typed(to_short, f"{p}._rdelay", "rdelay"),
        F.col(f"{p}._fd").alias("fd"),
    ]


def schedule_items(docs: DataFrame) -> DataFrame:
    return _items(docs, "schedule", SCHEDULE, None if "schedule" in docs.columns else points_in_order(F.col("xml")))


def schedules(docs: DataFrame) -> DataFrame:
    """One row per schedule: header, cancel reason and the number of calling points."""
    typed = Typed()
    return schedule_items(docs).select(
        *ENVELOPE,
        "item_index",
        *schedule_columns("item", typed),
        F.coalesce(F.size("item.pt"), F.lit(0)).alias("points"),
        typed.malformed(),
    )


def schedule_history(docs: DataFrame) -> DataFrame:
    """Schedules sent (``op`` is ``set``) and taken back (``remove``) as one history, from one parse."""
    typed = Typed()
    parsed = docs if "schedule" in docs.columns else parse_documents(docs, ["schedule", "deactivated"])
    fields = T.DataType.fromDDL(SCHEDULE).fields
    kind = f"array<struct<op:string,rank:int,item_index:int,item:{SCHEDULE}>>"

    def entries(column: str, op: str, rank: int, item) -> Column:
        made = F.transform(column, lambda x, i: F.struct(F.lit(op).alias("op"), F.lit(rank).alias("rank"), i.alias("item_index"), item(x).alias("item")))
        return F.coalesce(made.cast(kind), F.array().cast(kind))

    bare = lambda x: F.struct(*[(x["_rid"] if f.name == "_rid" else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields])
    both = F.concat(entries("schedule", "set", 0, lambda x: x), entries("deactivated", "remove", 1, bare))
    rows = parsed.select(*ENVELOPE, F.explode(both).alias("e"))
    return rows.select(
        *ENVELOPE,
        "e.item_index",
        *schedule_columns("e.item", typed),
        F.coalesce(F.size("e.item.pt"), F.lit(0)).alias("points"),
        typed.malformed(),
        "e.op",
        "e.rank",
    )


def calling_points(docs: DataFrame) -> DataFrame:
    """One row per calling point, all seven kinds in their order (``pos`` from 0)."""
    headed = schedule_items(docs).select(
        *ENVELOPE,
        "item_index",
        F.col("item._rid").alias("rid"),
        to_date("item._ssd").alias("ssd"),
        F.col("item.pt").alias("listed"),
    )
    points = headed.select(
        *ENVELOPE, "item_index", "rid", "ssd", F.posexplode("listed").alias("pos", "p")
    )
    typed = Typed()
    return points.select(*ENVELOPE, "item_index", "rid", "ssd", "pos", *point_columns("p", typed), typed.malformed())


def reasons(docs: DataFrame) -> DataFrame:
    """Late running and cancel reasons; ``domain`` tells the two code lists apart. One parse finds
    both."""
    xml, typed = F.col("xml"), Typed()
    if "TS" not in docs.columns:
        told = docs.where(has_element(xml, "LateReason") | has_element(xml, "cancelReason"))
        inside = f"TS:array<struct<_rid:string,LateReason:{REASON}>>,schedule:array<struct<_rid:string,cancelReason:{REASON}>>"
        ddl = (
            f"struct<{strings('_ts')},uR:struct<{strings('_updateOrigin', '_requestSource', '_requestID')},{inside}>,"
            f"sR:struct<{inside}>>"
        )
        texts = told.select("sequence_number", feed_version(xml).alias("feed_version"), "xml")
        parsed = texts.select("sequence_number", "feed_version", parse_once(xml, ddl).alias("m"))
        docs = parsed.select(*_envelope(), *[F.coalesce(f"m.uR.{kind}", f"m.sR.{kind}").alias(kind) for kind in ("TS", "schedule")])
    kind = f"array<struct<domain:string,rid:string,reason:{REASON}>>"

    def listed(column: str, element: str, domain: str) -> Column:
        given = F.filter(column, lambda x: x[element].isNotNull())
        made = F.transform(given, lambda x: F.struct(F.lit(domain).alias("domain"), x["_rid"].alias("rid"), x[element].alias("reason")))
        return F.coalesce(made.cast(kind), F.array().cast(kind))

    both = F.concat(listed("TS", "LateReason", "late"), listed("schedule", "cancelReason", "cancel"))
    return docs.select(*ENVELOPE, F.explode(both).alias("r")).select(
        *ENVELOPE,
        "r.rid",
        "r.domain",
        typed(to_short, "r.reason._VALUE", "code"),
        F.col("r.reason._tiploc").alias("tiploc"),
        typed(to_flag, "r.reason._near", "near"),
        typed.malformed(),
    )


def deactivations(docs: DataFrame) -> DataFrame:
    return _items(docs, "deactivated", "struct<_rid:string>").select(
        *ENVELOPE, "item_index", F.col("item._rid").alias("rid")
    )


def association_columns(a: str, typed: Typed) -> list[Column]:
    return [
        F.col(f"{a}._tiploc").alias("tiploc"),
        F.col(f"{a}._category").alias("category"),
        F.col(f"{a}.main._rid").alias("main_rid"),
        *_circular(f"{a}.main", "main_"),
        F.col(f"{a}.assoc._rid").alias("assoc_rid"),
        *_circular(f"{a}.assoc", "assoc_"),
        typed(to_flag, f"{a}._isCancelled", "is_cancelled"),
        typed(to_flag, f"{a}._isDeleted", "is_deleted"),
        typed.malformed(),
    ]


def associations(docs: DataFrame) -> DataFrame:
    return _items(docs, "association", ASSOCIATION).select(*ENVELOPE, "item_index", *association_columns("item", Typed()))


def formations(docs: DataFrame) -> DataFrame:
    """One row per formation with its coaches as an array, in train order."""
    headed = _items(docs, "scheduleFormations", FORMATIONS).select(
        *ENVELOPE, "item_index", F.col("item._rid").alias("rid"), F.col("item.formation").alias("listed")
    )
    listed = headed.select(
        *ENVELOPE, "item_index", "rid", F.posexplode("listed").alias("formation_index", "f")
    )
    return listed.select(
        *ENVELOPE,
        "item_index",
        "rid",
        "formation_index",
        F.col("f._fid").alias("fid"),
        F.col("f._src").alias("src"),
        F.col("f._srcInst").alias("src_inst"),
        F.transform(
            "f.coaches.coach",
            lambda c: F.struct(
                c["_coachNumber"].alias("coach_number"),
                c["_coachClass"].alias("coach_class"),
                c["toilet"]["_VALUE"].alias("toilet"),
                c["toilet"]["_status"].alias("toilet_status"),
            ),
        ).alias("coaches"),
    )


def coaches(formation_rows: DataFrame) -> DataFrame:
    """One row per coach of :func:`formations`."""
    keep = [name for name in formation_rows.columns if name != "coaches"]
    return formation_rows.select(*keep, F.posexplode("coaches").alias("coach_index", "c")).select(
        *keep, "coach_index", "c.*"
    )


def _unread(cast, text: Column, name: str) -> Column:
    typed = Typed()
    typed(cast, text, name)
    return typed.malformed()


def loadings(docs: DataFrame) -> DataFrame:
    """One row per loading message with its coach values as an array."""
    return _items(docs, "formationLoading", LOADING).select(
        *ENVELOPE,
        "item_index",
        F.col("item._fid").alias("fid"),
        F.col("item._rid").alias("rid"),
        F.col("item._tpl").alias("tpl"),
        *_circular("item"),
        F.transform(
            F.coalesce("item.loading", F.array().cast("array<struct<_VALUE:string,_coachNumber:string,_src:string,_srcInst:string>>")),
            lambda x: F.struct(
                x["_coachNumber"].alias("coach_number"),
                to_int(x["_VALUE"]).alias("loading"),
                x["_src"].alias("src"),
                x["_srcInst"].alias("src_inst"),
                _unread(to_int, x["_VALUE"], "loading"),
            ),
        ).alias("loadings"),
    )


def coach_loadings(loading_rows: DataFrame) -> DataFrame:
    """One row per coach value of :func:`loadings`."""
    keep = [name for name in loading_rows.columns if name != "loadings"]
    return loading_rows.select(*keep, F.explode("loadings").alias("x")).select(*keep, "x.*")


def station_messages(docs: DataFrame) -> DataFrame:
    """One row per station message and station; messages without a station keep one row.

    The message body is mixed markup, so it is taken from the text of the element: tags away
    for ``body``, anchor targets for ``links``.
    """
    if "OW" not in docs.columns:
        docs = parse_documents(docs.where(has_element(F.col("xml"), "OW")), ["OW"])
    texts = docs.select(*ENVELOPE, F.posexplode("OW").alias("item_index", "ow"))
    parsed = texts.select(
        *ENVELOPE,
        "item_index",
        inner(F.col("ow"), "Msg").alias("msg"),
        parse_once(F.col("ow"), f"struct<{STATION_MESSAGE_FIELDS}>").alias("o"),
    )
    body, typed = F.col("msg"), Typed()
    told = parsed.select(
        *ENVELOPE,
        "item_index",
        typed(to_int, "o._id", "id"),
        F.col("o._cat").alias("category"),
        F.col("o._sev").alias("severity"),
        typed(to_flag, "o._suppress", "suppress"),
        plain_text(body).alias("body"),
        links(body).alias("links"),
        typed.malformed(),
        F.col("o.Station._crs").alias("listed"),
    )
    keep = [name for name in told.columns if name != "listed"]
    return told.select(*keep, F.explode_outer("listed").alias("crs"))


def train_alerts(docs: DataFrame) -> DataFrame:
    """One row per alert, service and location; alerts without services keep one row."""
    typed, dated = Typed(), Typed()
    alerts = _items(docs, "trainAlert", TRAIN_ALERT).select(
        *ENVELOPE,
        "item_index",
        F.col("item.AlertID").alias("alert_id"),
        F.col("item.AlertText").alias("alert_text"),
        F.col("item.Audience").alias("audience"),
        F.col("item.AlertType").alias("alert_type"),
        F.col("item.Source").alias("source"),
        typed(to_flag, "item.SendAlertBySMS", "by_sms"),
        typed(to_flag, "item.SendAlertByEmail", "by_email"),
        typed(to_flag, "item.SendAlertByTwitter", "by_twitter"),
        F.col("item.CopiedFromAlertID").alias("copied_from_alert_id"),
        F.col("item.CopiedFromSource").alias("copied_from_source"),
        typed.malformed(),
        F.col("item.AlertServices.AlertService").alias("listed"),
    )
    alert = [name for name in alerts.columns if name not in ("listed", "malformed")]
    services = alerts.select(*alert, "malformed", F.explode_outer("listed").alias("s")).select(
        *alert,
        F.col("s._RID").alias("rid"),
        F.col("s._UID").alias("uid"),
        dated(to_date, "s._SSD", "ssd"),
        F.concat("malformed", dated.malformed()).alias("malformed"),
        F.col("s.Location").alias("places"),
    )
    return services.select(*alert, "rid", "uid", "ssd", "malformed", F.explode_outer("places").alias("location"))


def train_order_events(docs: DataFrame) -> DataFrame:
    """One row per train order message: ``op`` is ``set`` or ``clear``, ``items`` up to three trains."""
    orders = _items(docs, "trainOrder", TRAIN_ORDER)

    def item(place: int, name: str) -> Column:
        it = f"item.set.{name}"
        return F.when(
            F.col(it).isNotNull(),
            F.struct(
                F.lit(place).alias("place"),
                F.col(f"{it}.rid._VALUE").alias("rid"),
                *[F.col(f"{it}.rid._{t}").alias(t) for t in ("wta", "wtd", "wtp", "pta", "ptd")],
                F.col(f"{it}.trainID").alias("train_id"),
            ),
        )

    trains = F.array_compact(F.array(item(1, "first"), item(2, "second"), item(3, "third")))
    return orders.select(
        *ENVELOPE,
        "item_index",
        F.col("item._tiploc").alias("tiploc"),
        F.col("item._crs").alias("crs"),
        F.col("item._platform").alias("platform"),
        F.when(F.col("item.set").isNotNull(), "set").otherwise("clear").alias("op"),
        trains.alias("items"),
    )


def train_orders(order_events: DataFrame) -> DataFrame:
    """One row per train in an order; a ``clear`` keeps one row without a train."""
    keep = [name for name in order_events.columns if name != "items"]
    return order_events.select(*keep, F.explode_outer("items").alias("x")).select(*keep, "x.*")


def tracking_ids(docs: DataFrame) -> DataFrame:
    return _items(docs, "trackingID", TRACKING_ID).select(
        *ENVELOPE,
        "item_index",
        F.col("item.berth._area").alias("area"),
        F.col("item.berth._VALUE").alias("berth"),
        F.col("item.incorrectTrainID").alias("incorrect_train_id"),
        F.col("item.correctTrainID").alias("correct_train_id"),
    )


def alarms(docs: DataFrame) -> DataFrame:
    """One row per alarm message; ``kind`` is set for a new alarm only."""
    was_set = F.col("item.set").isNotNull()
    kind = (
        F.when(F.col("item.set.tdAreaFail").isNotNull(), "td_area_fail")
        .when(F.col("item.set.tdFeedFail").isNotNull(), "td_feed_fail")
        .when(F.col("item.set.tyrellFeedFail").isNotNull(), "tyrell_feed_fail")
    )
    return _items(docs, "alarm", ALARM).select(
        *ENVELOPE,
        "item_index",
        F.when(was_set, "set").otherwise("clear").alias("op"),
        F.when(was_set, F.col("item.set._id")).otherwise(F.col("item.clear")).alias("id"),
        kind.alias("kind"),
        F.col("item.set.tdAreaFail").alias("area"),
    )


def failures(docs: DataFrame) -> DataFrame:
    """Failure responses: a code, a message, and the request they answer."""
    if "FailureResp" not in docs.columns:
        docs = parse_documents(docs.where(has_element(F.col("xml"), "FailureResp")), [])
    return docs.where(F.col("FailureResp").isNotNull()).select(
        "sequence_number",
        "doc_ts",
        F.col("FailureResp._code").alias("code"),
        F.col("FailureResp._VALUE").alias("message"),
        F.col("FailureResp._requestSource").alias("request_source"),
        F.col("FailureResp._requestID").alias("request_id"),
    )


def only_in_version(rows: DataFrame) -> DataFrame:
    """NULL for columns the row's feed version does not have yet.

    The versions only add columns, so one parse with the newest schema reads all of them and
    one scan serves all versions.
    """
    version = F.col("feed_version")
    shown = []
    for field in rows.schema.fields:
        first = FIRST_VERSION.get(field.name)
        shown.append(
            F.when(version >= first, F.col(field.name)).alias(field.name) if first else F.col(field.name)
        )
    return rows.select(*shown)


def union_versions(*tables: DataFrame) -> DataFrame:
    """Tables landed per version as one; columns a version lacks are NULL."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table, allowMissingColumns=True)
    return merged
