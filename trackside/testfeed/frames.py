"""Push frames and documents from ``orders``: one document per order, built from its row alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.functions.body import deflate, deflate_gzip
from trackside.functions.xml import once
from trackside.schemas import PUSHPORT_URI, PUSHPORT_URI_STEM
from trackside.testfeed import fields as f

# Fixed value: what the namespaces of a document's parts begin with.
PARTS_STEM = "http://www.thalesgroup.com/rtti/PushPort/"


def attr(name: str, value: str, present: str = "true") -> str:
    """SQL text of one attribute, left out where ``present`` is false."""
    return f"case when {present} then concat(' {name}=\"', {value}, '\"') else '' end"


def tag(name: str, *parts: str, inside: str | None = None) -> str:
    """SQL text of an element with attribute texts and optional content."""
    head = ", ".join([f"'<{name}'", *parts])
    return f"concat({head}, '/>')" if inside is None else f"concat({head}, '>', {inside}, '</{name}>')"


# All clock times of a day, by their minute.
CLOCKS = " ".join(f"{hour:02}:{minute:02}" for hour in range(24) for minute in range(60))

# The minutes of which clock times are made at place ``i``, and the names of those needed more than once.
_AT_PLACE = {f.minute("i"): "arrives", f"({f.minute('i')} + 2) % 1440": "departs", f"({f.minute('i')} + {f.K} % 30 + 1430) % 1440": ""}


def let(name: str, value: str, body: str) -> str:
    """SQL text of ``body`` with ``value``, made once, under a name."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def looked_up(body: str) -> str:
    """``body`` (in ``i``) with its clock times looked up in ``clocks``, because a repeated body is not compiled
    and each of its steps counts; minutes outside of a day are written as before."""
    for minute, name in _AT_PLACE.items():
        text = f.hhmm(minute)
        if text in body:
            clock = f"coalesce(get(clocks, cast({minute} as int)), {text})"
            body = let(name, clock, body.replace(text, name)) if name else body.replace(text, clock)
    return body


def repeated(count: str, body: str, start: str = "0") -> str:
    """SQL text of ``body`` (in ``i``) repeated for i from start to count - 1."""
    steps = f"case when {count} > {start} then sequence({start}, cast({count} as int) - 1) else array() end"
    quick = looked_up(body)
    joined = f"array_join(transform({steps}, i -> {quick}), '')"
    return joined if quick == body else let("clocks", f"split('{CLOCKS}', ' ')", joined)


def pport(body: str, kind: str = "'uR'", ts: str = f.DOC_TS, version: str = "'16'", uris: str = "", extra: str = "''") -> str:
    """SQL text of a document around response content; ``extra`` are update attributes."""
    return (
        f"concat('<?xml version=\"1.0\" encoding=\"UTF-8\"?>\n<Pport xmlns=\"{PUSHPORT_URI_STEM}', {version}, '\"{uris} ts=\"', {ts}, "
        f"'\" version=\"', {version}, '.0\"><', {kind}, {extra}, '>', {body}, '</', {kind}, '></Pport>')"
    )


def part_uri(prefix: str, name: str) -> str:
    return f' xmlns:{prefix}="{PARTS_STEM}{name}"'


def _location(p: str) -> str:
    i = "i"
    arrival = (
        f"case {f.shape(i)} when 0 then {tag(p + ':arr', attr('et', f.et(i)), attr('src', repr('TD')))} "
        f"when 1 then {tag(p + ':arr', attr('at', f.pta(i)), attr('src', repr('TRUST')))} else '' end"
    )
    departure = (
        f"case when {f.shape(i)} <= 2 then "
        f"{tag(p + ':dep', attr('et', f.et(i)), attr('src', repr('CIS')), attr('srcInst', repr('CS01')), attr('delayed', repr('true'), f'(o_orderkey + i) % 9 = 0'))} "
        f"else '' end"
    )
    platform = (
        f"case when {f.has_platform(i)} then "
        f"{tag(p + ':plat', attr('platsup', repr('true'), '(o_orderkey + i) % 3 = 0'), attr('platsrc', repr('A'), '(o_orderkey + i) % 4 = 0'), inside=f.platform(i))} "
        f"else '' end"
    )
    length = f"case when (o_orderkey + i) % 7 = 0 then {tag(p + ':length', inside='cast((o_orderkey + i) % 13 as string)')} else '' end"
    suppr = f"case when (o_orderkey + i) % 8 = 0 then {tag(p + ':suppr', inside=repr('true'))} else '' end"
    return tag(
        p + ":Location",
        attr("tpl", f.place(i)),
        attr("wta", f.wta(i)),
        attr("wtd", f.wtd(i)),
        attr("pta", f.pta(i), f.has_pta(i)),
        attr("ptd", f.ptd(i)),
        inside=f"concat({arrival}, {departure}, {platform}, {suppr}, {length})",
    )


def status_text(version: str = "'16'", two_trains: bool = True) -> Column:
    """Train status document of an order; the prefix of the forecasts part varies."""

    def build(p: str) -> str:
        first = f"({f.POINTS} - case when {f.TWO_TRAINS} then 1 else 0 end)" if two_trains else f.POINTS
        reason = (
            f"case when o_orderkey % 9 = 0 then "
            f"{tag(p + ':LateReason', attr('tiploc', f.place('0'), 'o_orderkey % 2 = 0'), attr('near', repr('true'), 'o_orderkey % 4 = 0'), inside='cast(100 + o_orderkey % 40 as string)')} "
            f"else '' end"
        )
        trains = tag(
            "TS",
            attr("rid", f.RID), attr("uid", f.UID), attr("ssd", f.SSD),
            attr("isReverseFormation", repr("true"), "o_orderkey % 12 = 0"),
            inside=f"concat({reason}, {repeated(first, _location(p))})",
        )
        if two_trains:
            last = tag(
                "TS", attr("rid", f.RID_2), attr("uid", f.UID_2), attr("ssd", f.SSD),
                inside=repeated(f.POINTS, _location(p), start=f"cast({f.POINTS} - 1 as int)"),
            )
            trains = f"concat({trains}, case when {f.TWO_TRAINS} then {last} else '' end)"
        kind = "case when o_orderkey % 7 = 0 then 'sR' else 'uR' end"
        extra = "case when o_orderkey % 7 = 0 then '' else ' updateOrigin=\"TD\"' end"
        return pport(trains, kind, version=version, uris=part_uri(p, "Forecasts/v3"), extra=extra)

    return F.when(F.col("o_orderkey") % 2 == 0, F.expr(build("f"))).otherwise(F.expr(build("ns5")))


def status_documents(orders: DataFrame) -> DataFrame:
    """Train status documents, all usable."""
    return orders.select(
        F.col("o_orderkey").alias("sequence_number"), once(status_text()).alias("xml"), F.lit(16).alias("feed_version")
    )


def compressed(text: Column) -> Column:
    """gzip and zlib bodies in turn."""
    return deflate(text, F.coalesce(F.col("o_orderkey") % 2 == 0, F.lit(False)))


def status_frames(orders: DataFrame, broken: bool = True) -> DataFrame:
    """Push frames of the train status documents; by default some are broken in five ways."""
    text = F.col("text")
    reason = F.col("wanted")
    wanted = F.expr(f.FRAME_REASON) if broken else F.lit(None).cast("string")
    deactivated = F.expr(pport(tag("deactivated", attr("rid", f.RID))))
    texts = orders.select("o_orderkey", wanted.alias("wanted"), deactivated.alias("deactivated"), once(status_text()).alias("text"))
    shown = (
        F.when(reason == "bad_xml", F.replace(text, F.lit("</Pport>"), F.lit("</Prt>")))
        .when(reason == "other_version", F.replace(text, F.lit(PUSHPORT_URI), F.lit(PUSHPORT_URI_STEM + "15")))
        .when(reason == "no_train_status", F.col("deactivated"))
        .otherwise(text)
    )
    made = texts.select("o_orderkey", once(shown).alias("text"), "wanted")
    packed = made.select("o_orderkey", "wanted", compressed(F.col("text")).alias("body"))
    headers = F.when(
        F.col("wanted") == "missing_header", F.create_map(F.lit("MessageType"), F.lit("TS"))
    ).otherwise(
        F.create_map(
            F.lit("SequenceNumber"), F.col("o_orderkey").cast("string"), F.lit("MessageType"), F.lit("TS")
        )
    )
    body = F.when(F.col("wanted") == "bad_body", F.expr("substring(body, 1, 30)")).otherwise(F.col("body"))
    return packed.select(headers.alias("headers"), body.alias("body"))


def frames_of(docs: DataFrame, kind: str) -> DataFrame:
    """Push frames of documents (``sequence_number``, ``xml``), all of one message type."""
    headers = F.create_map(F.lit("SequenceNumber"), F.col("sequence_number").cast("string"), F.lit("MessageType"), F.lit(kind))
    return docs.select(headers.alias("headers"), deflate_gzip(F.col("xml")).alias("body"))


def at_once(docs: DataFrame) -> DataFrame:
    """Documents of one moment, which only their sequence tells apart."""
    return docs.withColumn("xml", F.regexp_replace("xml", ' ts="[^"]*"', ' ts="2024-01-01T00:00:00"'))


# What is spoiled in a status document: (every how many orders, which of them, pattern, replacement).
SPOILED = {
    "ssd": (5, 0, ' ssd="', ' ssd="x'),
    "length": (6, 1, ":length>", ":length>many"),
    "suppr": (6, 1, ":suppr>true", ":suppr>maybe"),
    "platsup": (4, 1, ' platsup="true', ' platsup="sometimes'),
    "late_reason": (2, 1, r":LateReason([^>]*>)[0-9]+", ":LateReason$199999"),
    "is_reverse_formation": (5, 1, ' isReverseFormation="true', ' isReverseFormation="unknown'),
    "delayed": (4, 2, ' delayed="true', ' delayed="soon'),
}


def spoiled_documents(orders: DataFrame) -> DataFrame:
    """Status documents some of whose numbers, flags and dates cannot be read or are out of range."""
    docs, text = status_documents(orders), F.col("xml")
    for every, which, pattern, replacement in SPOILED.values():
        # A step of its own each, so that only what is to be spoiled is searched.
        spoiled = F.regexp_replace(text, F.lit(pattern), F.lit(replacement))
        docs = docs.withColumn("xml", F.when(F.col("sequence_number") % every == which, spoiled).otherwise(text))
    # A reader's filters would be pushed below these steps, each of which doubles them.
    return docs.select("sequence_number", once(text).alias("xml"), "feed_version")


# The checking engine's view: one row per document, and one per location (`i` is its place).
POINTS_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderdate, CAST(i AS BIGINT) AS i, {f.FRAME_REASON} AS reason,
  {f.RID} AS rid, {f.UID} AS uid, {f.SSD} AS ssd,
  ({f.TWO_TRAINS} AND i = {f.POINTS} - 1) AS second_train, {f.RID_2} AS rid_2, {f.UID_2} AS uid_2,
  {f.place('i')} AS tpl, {f.wta('i')} AS wta, {f.wtd('i')} AS wtd,
  CASE WHEN {f.has_pta('i')} THEN {f.pta('i')} END AS pta, {f.ptd('i')} AS ptd,
  {f.et('i')} AS et, {f.shape('i')} AS shape,
  CASE WHEN {f.has_platform('i')} THEN {f.platform('i')} END AS platform
FROM (SELECT *, unnest(range({f.POINTS})) AS i FROM orders)
"""
