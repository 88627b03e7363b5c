"""Push frames to documents, location rows and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.functions.body import inflate
from trackside.functions.xml import (
    declares,
    feed_version,
    has_more_than_root,
    parse_once,
    without_comments,
)
from trackside.schemas import FORECASTS_URI, PUSHPORT_URI, TS_BRIEF, response_ddl

# Why a frame is rejected, in the order in which it is looked for.
REASONS = ["missing_header", "bad_body", "bad_sequence", "bad_xml", "other_version", "no_train_status"]


def open_frames(frames: DataFrame) -> DataFrame:
    """Frames (``headers`` map, ``body`` binary) to documents.

    Columns: ``sequence_number``, ``message_type``, ``xml``, ``feed_version``, ``reason`` and,
    for rejected frames only, the ``payload``. A frame is rejected here if a header is missing
    or the body does not decompress; it stays a row, so nothing is lost silently.
    """
    sequence, kind = F.col("headers")["SequenceNumber"], F.col("headers")["MessageType"]
    opened = frames.select(
        sequence.alias("sequence_number"),
        kind.alias("message_type"),
        "body",
        inflate("body").alias("xml"),
    )
    reason = (
        F.when(F.col("sequence_number").isNull() | F.col("message_type").isNull(), "missing_header")
        .when(F.col("xml").isNull(), "bad_body")
    )
    return opened.select(
        "sequence_number",
        "message_type",
        F.when(reason.isNull(), without_comments(F.col("xml"))).alias("xml"),
        feed_version(F.col("xml")).alias("feed_version"),
        reason.alias("reason"),
        "body",
    )


def _not_well_formed(root: str) -> Column:
    """The text was not, or not wholly, parsed into the struct ``root``."""
    unparsed = F.col(root).isNull() | F.col(f"{root}._corrupt_record").isNotNull()
    return unparsed | F.col("junk")


def read_documents(frames: DataFrame) -> DataFrame:
    """Frames to documents of any kind and version, the input of the message tables.

    Columns: ``sequence_number`` (a number, by which state is ordered), ``sequence_text`` (as sent),
    ``message_type``, ``feed_version``, ``xml``, ``reason`` and ``payload``. A document that is not
    well formed, or whose sequence is no number, is rejected here, once for all kinds; take the rows
    without a ``reason`` on, and :func:`rejects` of the rest.
    """
    xml, sequence = F.col("xml"), F.col("sequence_number")
    opened = open_frames(frames).withColumn("junk", has_more_than_root(xml))
    rooted = opened.select("*", parse_once(xml, "struct<_ts:string,_corrupt_record:string>").alias("root"))
    number = sequence.try_cast("bigint")
    broken = xml.isNotNull() & _not_well_formed("root")
    reason = F.coalesce(
        "reason", F.when(sequence.isNotNull() & number.isNull(), F.lit("bad_sequence")), F.when(broken, F.lit("bad_xml"))
    )
    return rooted.select(
        number.alias("sequence_number"),
        sequence.alias("sequence_text"),
        "message_type",
        "feed_version",
        F.when(reason.isNull(), F.col("xml")).alias("xml"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.col("body")).alias("payload"),
    )


def _stations(m: str) -> Column:
    """The train status entries of an update or a snapshot."""
    return F.coalesce(F.col(f"{m}.uR.TS"), F.col(f"{m}.sR.TS"))


def decode_frames(frames: DataFrame) -> DataFrame:
    """Frames to train status documents with the reason a frame is unusable, if it is.

    Columns: ``sequence_number``, ``message_type``, ``stations`` (the ``TS`` entries),
    ``reason`` and ``payload`` (the body of a rejected frame). One narrow stage: one Arrow
    batch call to decompress, one XML parse. Write or persist the result before reading both
    :func:`locations` and :func:`rejects` from it.
    """
    xml = F.col("xml")
    opened = open_frames(frames).select(
        "sequence_number",
        "message_type",
        "reason",
        "body",
        "xml",
        declares(xml, PUSHPORT_URI).alias("known_version"),
        declares(xml, FORECASTS_URI).alias("known_forecasts"),
        has_more_than_root(xml).alias("junk"),
    )
    kept = [name for name in opened.columns if name != "xml"]
    parsed = opened.select(*kept, parse_once(xml, response_ddl("TS", TS_BRIEF)).alias("m"))
    stations = _stations("m")
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(_not_well_formed("m"), "bad_xml")
        .when(~F.col("known_version"), "other_version")
        .when(F.coalesce(F.size(stations), F.lit(0)) < 1, "no_train_status")
    )
    usable = F.when(reason.isNull(), stations)
    # Location elements belong to the forecasts namespace; without it there are none.
    bare = F.transform(usable, lambda ts: ts.withField("Location", F.lit(None).cast(_location_type())))
    return parsed.select(
        "sequence_number",
        "message_type",
        F.when(F.col("known_forecasts"), usable).otherwise(bare).alias("stations"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.col("body")).alias("payload"),
    )


def _location_type() -> str:
    inside = TS_BRIEF[len("struct<"):-1]
    return inside[inside.index("Location:") + len("Location:"):]


def rejects(decoded: DataFrame) -> DataFrame:
    """Rejected frames with their reason and raw body."""
    sequence = "sequence_text" if "sequence_text" in decoded.columns else "sequence_number"
    return decoded.where(F.col("reason").isNotNull()).select("reason", "payload", F.col(sequence).alias("sequence_number"))


# Where a location stands in its document.
PLACE = ["train_index", "location_index"]


def locations(decoded: DataFrame, first_header: bool = False, place: bool = False) -> DataFrame:
    """One row per train location, the twelve record columns.

    Each location belongs to the train it is listed under. ``first_header=True`` gives every
    location of a document to the document's first train. ``place=True`` adds where in the document
    the location stands, by which later ones replace earlier ones.
    """
    good = decoded.where(F.col("reason").isNull())
    if first_header:
        listed = F.flatten(F.transform("stations", lambda ts: F.coalesce(ts["Location"], F.array())))
        trains = good.select("sequence_number", F.lit(0).alias("train_index"), F.col("stations")[0].alias("ts"), listed.alias("listed"))
    else:
        trains = good.select("sequence_number", F.posexplode("stations").alias("train_index", "ts")).select(
            "*", F.col("ts.Location").alias("listed")
        )
    # The header goes on by itself, or every row would carry all locations of its train.
    headed = trains.select(
        "sequence_number",
        "train_index",
        F.col("ts._rid").alias("schedule_id"),
        F.col("ts._uid").alias("unique_id"),
        F.col("ts._ssd").alias("service_start_date"),
        "listed",
    )
    header = ["sequence_number", "schedule_id", "unique_id", "service_start_date"]
    rows = headed.select(*header, "train_index", F.posexplode("listed").alias("location_index", "l"))
    return rows.select(
        *header,
        F.col("l._tpl").alias("location_code"),
        F.col("l._wta").alias("scheduled_arrival"),
        F.col("l._wtd").alias("scheduled_departure"),
        F.col("l._pta").alias("actual_arrival"),
        F.col("l._ptd").alias("actual_departure"),
        F.col("l.plat._VALUE").alias("platforms"),
        _first_present("_et").alias("estimated_time"),
        _first_present("_src").alias("source"),
        *(PLACE if place else []),
    )


def _first_present(field: str) -> Column:
    """Field of the arrival if there is one, even when the field is absent, else of the departure."""
    return F.when(F.col("l.arr").isNotNull(), F.col(f"l.arr.{field}")).when(
        F.col("l.dep").isNotNull(), F.col(f"l.dep.{field}")
    )
