"""Timetable and reference files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.functions.values import Typed
from trackside.functions.xml import fragments, parse_once, points_in_order
from trackside.operators.messages import association_columns, point_columns, schedule_columns
from trackside.schemas import ASSOCIATION_FIELDS, SCHEDULE_FIELDS


def _rows(spark: SparkSession, path: str, tag: str, ddl: str) -> DataFrame:
    schema = T.DataType.fromDDL(f"struct<{ddl}>")
    return (
        spark.read.format("xml")
        .option("rowTag", tag)
        .option("ignoreNamespace", "true")
        .option("charset", "UTF-8")
        .schema(schema)
        .load(path)
    )


def _journey_documents(spark: SparkSession, path: str, end: str) -> DataFrame:
    """One text per journey, split at its end tag, so a large file is read by many tasks.

    Most pieces name a journey once, in its start tag, and are cut there; others are searched.
    """
    pieces = spark.read.option("lineSep", end).text(path)
    before, rest = F.substring_index("value", "Journey", 1), F.substring_index("value", "Journey", -1)
    once = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit("Journey"), F.lit(""))) == len("Journey")
    opened = F.right(before, F.lit(1)).isin("<", ":") & F.left(rest, F.lit(1)).isin(" ", "\n", "\t", "\r", ">") & ~F.endswith(F.substring_index(rest, ">", 1), F.lit("/"))
    cut = F.array(F.concat(F.lit("<Journey"), rest, F.lit("</Journey>")))
    return pieces.select(F.explode(F.when(once & opened, cut).otherwise(fragments(F.concat("value", F.lit(end)), "Journey"))).alias("xml"))


def read_journeys(spark: SparkSession, path: str, end: str = "</Journey>") -> DataFrame:
    """Journey headers of timetable files, with their calling points in order as an array.

    ``end`` is the end tag as the files write it, with its prefix if they use one.
    """
    ddl = f"struct<{SCHEDULE_FIELDS},_corrupt_record:string>"
    documents = _journey_documents(spark, path, end)
    parsed = documents.select(parse_once(points_in_order(F.col("xml")), ddl).alias("s"))
    typed = Typed()
    return parsed.where(F.col("s._rid").isNotNull()).select(
        *schedule_columns("s", typed), F.col("s.pt").alias("points"), typed.malformed()
    )


def journey_points(journeys: DataFrame) -> DataFrame:
    """One row per calling point of :func:`read_journeys`."""
    exploded = journeys.select("rid", "ssd", F.posexplode("points").alias("pos", "p"))
    typed = Typed()
    return exploded.select("rid", "ssd", "pos", *point_columns("p", typed), typed.malformed())


def read_timetable_associations(spark: SparkSession, path: str) -> DataFrame:
    rows = _rows(spark, path, "Association", ASSOCIATION_FIELDS)
    return rows.select(F.struct("*").alias("a")).select(*association_columns("a", Typed()))


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    rows = _rows(spark, path, "LocationRef", "_tpl:string,_crs:string,_toc:string,_locname:string")
    return rows.toDF("tpl", "crs", "toc", "locname")


def read_operators(spark: SparkSession, path: str) -> DataFrame:
    return _rows(spark, path, "TocRef", "_toc:string,_tocname:string,_url:string").toDF("toc", "tocname", "url")


def _reasons(spark: SparkSession, path: str, tag: str) -> DataFrame:
    rows = _rows(spark, path, tag, "Reason:array<struct<_code:string,_reasontext:string>>")
    listed = rows.select(F.explode("Reason").alias("r"))
    return listed.select(F.col("r._code").try_cast("int").alias("code"), F.col("r._reasontext").alias("reasontext"))


def read_late_reasons(spark: SparkSession, path: str) -> DataFrame:
    """Late running reasons; the same codes mean something else among the cancellations."""
    return _reasons(spark, path, "LateRunningReasons")


def read_cancel_reasons(spark: SparkSession, path: str) -> DataFrame:
    return _reasons(spark, path, "CancellationReasons")


def read_via(spark: SparkSession, path: str) -> DataFrame:
    rows = _rows(spark, path, "Via", "_at:string,_dest:string,_loc1:string,_loc2:string,_viatext:string")
    return rows.toDF("at", "dest", "loc1", "loc2", "viatext")


def read_instances(spark: SparkSession, path: str) -> DataFrame:
    """Names of the instances that supply forecasts."""
    return _rows(spark, path, "CISSource", "_code:string,_name:string").toDF("code", "name")
