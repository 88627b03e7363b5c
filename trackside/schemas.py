"""Fixed schemas of the feed: the flat record, and one XML schema per message kind.

Attribute and element values are declared as strings. Typing happens later with
``try_cast``, so one malformed value never costs the row and can still be reported.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The twelve record fields in topic order.
RECORD_FIELDS = [
    "sequence_number",
    "schedule_id",
    "unique_id",
    "service_start_date",
    "location_code",
    "scheduled_arrival",
    "scheduled_departure",
    "actual_arrival",
    "actual_departure",
    "platforms",
    "estimated_time",
    "source",
]

RECORD_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RECORD_FIELDS])

# Key of the raw store.
RAW_KEY = ["unique_id", "location_code", "schedule_id"]

# Namespace URIs that identify the feed version and its parts.
PUSHPORT_URI = "http://www.thalesgroup.com/rtti/PushPort/v16"
FORECASTS_URI = "http://www.thalesgroup.com/rtti/PushPort/Forecasts/v3"
PUSHPORT_URI_STEM = "http://www.thalesgroup.com/rtti/PushPort/v"

# The data kinds a response may carry, in contract order.
MESSAGE_KINDS = [
    "schedule",
    "deactivated",
    "association",
    "scheduleFormations",
    "TS",
    "formationLoading",
    "OW",
    "trainAlert",
    "trainOrder",
    "trackingID",
    "alarm",
]


def strings(*names: str) -> str:
    """DDL of string fields, e.g. ``_a:string,_b:string``."""
    return ",".join(f"{name}:string" for name in names)


CIRCULAR_TIMES = strings("_wta", "_wtd", "_wtp", "_pta", "_ptd")
REASON = f"struct<{strings('_VALUE', '_tiploc', '_near')}>"

TIME_DATA = "struct<" + strings(
    "_et", "_wet", "_at", "_atRemoved", "_atClass", "_etmin", "_etUnknown", "_delayed", "_src", "_srcInst"
) + ">"
PLATFORM = f"struct<{strings('_VALUE', '_platsup', '_cisPlatsup', '_platsrc', '_conf')}>"

# The columns the flat record needs, and nothing else.
TS_BRIEF = (
    f"struct<{strings('_rid', '_uid', '_ssd')},"
    f"Location:array<struct<{strings('_tpl', '_wta', '_wtd', '_pta', '_ptd')},"
    f"arr:struct<{strings('_et', '_src')}>,dep:struct<{strings('_et', '_src')}>,plat:struct<_VALUE:string,_platsup:string>>>>"
)

TS_FULL = (
    f"struct<{strings('_rid', '_uid', '_ssd', '_isReverseFormation')},LateReason:{REASON},"
    f"Location:array<struct<_tpl:string,{CIRCULAR_TIMES},arr:{TIME_DATA},dep:{TIME_DATA},pass:{TIME_DATA},"
    f"plat:{PLATFORM},{strings('suppr', 'length', 'detachFront')}>>>"
)

# The calling point kinds of a schedule.
POINT_KINDS = ["OR", "OPOR", "IP", "OPIP", "PP", "DT", "OPDT"]

# Calling points are renamed to ``pt`` before parsing, which keeps their order across kinds.
POINT = "struct<" + strings(
    "_kind", "_tpl", "_act", "_planAct", "_can", "_fid", "_plat",
    "_pta", "_ptd", "_avgLoading", "_wta", "_wtd", "_wtp", "_rdelay", "_fd",
) + ">"
SCHEDULE_ATTRIBUTES = [
    "_rid", "_uid", "_trainId", "_rsid", "_ssd", "_toc", "_status", "_trainCat",
    "_isPassengerSvc", "_isActive", "_deleted", "_isCharter", "_qtrain", "_can",
]
SCHEDULE_FIELDS = f"{strings(*SCHEDULE_ATTRIBUTES)},pt:array<{POINT}>,cancelReason:{REASON}"
SCHEDULE = f"struct<{SCHEDULE_FIELDS}>"

ASSOC_SERVICE = f"struct<_rid:string,{CIRCULAR_TIMES}>"
ASSOCIATION_FIELDS = (
    f"{strings('_tiploc', '_category', '_isCancelled', '_isDeleted')},main:{ASSOC_SERVICE},assoc:{ASSOC_SERVICE}"
)
ASSOCIATION = f"struct<{ASSOCIATION_FIELDS}>"

FORMATIONS = (
    f"struct<_rid:string,formation:array<struct<{strings('_fid', '_src', '_srcInst')},"
    f"coaches:struct<coach:array<struct<{strings('_coachNumber', '_coachClass')},"
    f"toilet:struct<{strings('_VALUE', '_status')}>>>>>>>"
)
LOADING = (
    f"struct<{strings('_fid', '_rid', '_tpl')},{CIRCULAR_TIMES},"
    f"loading:array<struct<{strings('_VALUE', '_coachNumber', '_src', '_srcInst')}>>>"
)
STATION_MESSAGE_FIELDS = (
    f"{strings('_id', '_cat', '_sev', '_suppress')},Station:array<struct<_crs:string>>"
)
TRAIN_ALERT = (
    f"struct<{strings('AlertID')},"
    f"AlertServices:struct<AlertService:array<struct<{strings('_RID', '_UID', '_SSD')},Location:array<string>>>>,"
    + strings(
        "SendAlertBySMS", "SendAlertByEmail", "SendAlertByTwitter", "Source",
        "AlertText", "Audience", "AlertType", "CopiedFromAlertID", "CopiedFromSource",
    )
    + ">"
)
ORDER_ITEM = f"struct<rid:struct<_VALUE:string,{CIRCULAR_TIMES}>,trainID:string>"
TRAIN_ORDER = (
    f"struct<{strings('_tiploc', '_crs', '_platform')},"
    f"set:struct<first:{ORDER_ITEM},second:{ORDER_ITEM},third:{ORDER_ITEM}>>"
)
TRACKING_ID = (
    f"struct<berth:struct<_VALUE:string,_area:string>,{strings('incorrectTrainID', 'correctTrainID')}>"
)
ALARM = f"struct<set:struct<{strings('_id', 'tdAreaFail', 'tdFeedFail', 'tyrellFeedFail')}>,clear:string>"
FAILURE = f"struct<{strings('_VALUE', '_code', '_requestSource', '_requestID')}>"


def response_ddl(element: str, item: str) -> str:
    """Document schema for one data kind, in an update (``uR``) or a snapshot (``sR``)."""
    return (
        f"struct<{strings('_ts', '_version')},"
        f"uR:struct<{strings('_updateOrigin', '_requestSource', '_requestID')},{element}:array<{item}>>,"
        f"sR:struct<{element}:array<{item}>>,_corrupt_record:string>"
    )


# Attribute defaults of the contract, per table and column.
DEFAULTS = {
    "forecast": {
        "platsup": False,
        "cis_platsup": False,
        "platsrc": "P",
        "conf": False,
        "suppr": False,
        "length": 0,
        "detach_front": False,
        "is_reverse_formation": False,
        "late_reason_near": False,
    },
    "forecast_event": {
        "at_removed": False,
        "et_unknown": False,
        "delayed": False,
    },
    "schedule": {
        "status": "P",
        "train_cat": "OO",
        "is_passenger_svc": True,
        "is_active": True,
        "deleted": False,
        "is_charter": False,
        "qtrain": False,
        "can": False,
    },
    "calling_point": {
        "act": "  ",
        "can": False,
        "rdelay": 0,
    },
    "association": {
        "is_cancelled": False,
        "is_deleted": False,
    },
    "coach": {
        "toilet": "Unknown",
        "toilet_status": "InService",
    },
    "station_message": {
        "suppress": False,
    },
}

# Value rules of the contract. (kind, argument) per rule name.
FACETS = {
    "rid": ("max_length", 16),
    "uid": ("length", 6),
    "train_id": ("pattern", "[0-9][A-Z][0-9][0-9]"),
    "rsid": ("length_between", (6, 8)),
    "toc": ("length", 2),
    "tpl": ("length_between", (1, 7)),
    "crs": ("length", 3),
    "platform": ("length_between", (1, 3)),
    "length": ("between", (0, 99)),
    "activity": ("pattern", r"([A-Z0-9\- ][A-Z0-9\- ]){1,6}"),
    "status": ("pattern", "[BFPST12345]"),
    "train_cat": ("length_between", (0, 2)),
    "public_time": ("pattern", "([0-1][0-9]|2[0-3]):[0-5][0-9]"),
    "working_time": ("pattern", "([0-1][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?"),
    "source_instance": ("length", 4),
    "reason_code": ("between", (-32768, 32767)),
    "request_id": ("pattern", "[-_A-Za-z0-9]{1,16}"),
    "area": ("length", 2),
    "berth": ("length", 4),
    "formation_id": ("length_between", (1, 20)),
    "loading": ("between", (0, 100)),
    "coach_number": ("length_between", (1, 2)),
    "platsrc": ("one_of", ("P", "A", "M")),
    "association_category": ("one_of", ("JJ", "VV", "LK", "NP")),
    "message_category": (
        "one_of",
        ("Train", "Station", "Connections", "System", "Misc", "PriorTrains", "PriorOther"),
    ),
    "message_severity": ("one_of", ("0", "1", "2", "3")),
    "alert_audience": ("one_of", ("Customer", "Staff", "Operations")),
    "alert_type": ("one_of", ("Normal", "Forced")),
    "toilet_status": ("one_of", ("Unknown", "InService", "NotInService")),
}

# Which rule a column of a message table has to keep.
RULES = {
    "envelope": {"request_source": "source_instance", "request_id": "request_id"},
    "forecast": {
        "rid": "rid",
        "uid": "uid",
        "tpl": "tpl",
        "wta": "working_time",
        "wtd": "working_time",
        "wtp": "working_time",
        "pta": "public_time",
        "ptd": "public_time",
        "platform": "platform",
        "platsrc": "platsrc",
        "length": "length",
        "late_reason": "reason_code",
        "late_reason_tiploc": "tpl",
    },
    "forecast_event": {
        "et": "public_time",
        "wet": "public_time",
        "at": "public_time",
        "etmin": "public_time",
        "src_inst": "source_instance",
    },
    "schedule": {
        "rid": "rid",
        "uid": "uid",
        "train_id": "train_id",
        "rsid": "rsid",
        "toc": "toc",
        "status": "status",
        "train_cat": "train_cat",
        "cancel_reason": "reason_code",
        "cancel_reason_tiploc": "tpl",
    },
    "calling_point": {
        "rid": "rid",
        "tpl": "tpl",
        "act": "activity",
        "plan_act": "activity",
        "fid": "formation_id",
        "platform": "platform",
        "wta": "working_time",
        "wtd": "working_time",
        "wtp": "working_time",
        "pta": "public_time",
        "ptd": "public_time",
        "avg_loading": "loading",
        "rdelay": "reason_code",
        "fd": "tpl",
    },
    "association": {
        "tiploc": "tpl",
        "category": "association_category",
        "main_rid": "rid",
        "main_wta": "working_time",
        "main_wtd": "working_time",
        "main_wtp": "working_time",
        "main_pta": "public_time",
        "main_ptd": "public_time",
        "assoc_rid": "rid",
        "assoc_wta": "working_time",
        "assoc_wtd": "working_time",
        "assoc_wtp": "working_time",
        "assoc_pta": "public_time",
        "assoc_ptd": "public_time",
    },
    "coach": {
        "rid": "rid",
        "fid": "formation_id",
        "src_inst": "source_instance",
        "coach_number": "coach_number",
        "toilet_status": "toilet_status",
    },
    "coach_loading": {
        "rid": "rid",
        "fid": "formation_id",
        "tpl": "tpl",
        "coach_number": "coach_number",
        "loading": "loading",
        "src_inst": "source_instance",
    },
    "station_message": {"crs": "crs", "category": "message_category", "severity": "message_severity"},
    "train_alert": {"audience": "alert_audience", "alert_type": "alert_type", "rid": "rid", "uid": "uid"},
    "train_order": {
        "tiploc": "tpl",
        "crs": "crs",
        "platform": "platform",
        "rid": "rid",
        "train_id": "train_id",
        "wta": "working_time",
        "wtd": "working_time",
        "wtp": "working_time",
        "pta": "public_time",
        "ptd": "public_time",
    },
    "tracking_id": {
        "area": "area",
        "berth": "berth",
        "incorrect_train_id": "train_id",
        "correct_train_id": "train_id",
    },
    "alarm": {"area": "area"},
}

# First feed version that carries a column.
FIRST_VERSION = {
    "update_origin": 12,
    "wet": 12,
    "at_class": 13,
    "rsid": 14,
    "fid": 15,
    "avg_loading": 15,
    "coach_number": 15,
    "loading": 15,
    "toilet": 16,
    "toilet_status": 16,
}
