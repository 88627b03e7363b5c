"""Joins with the reference dimensions, list filters, via texts and headcode corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.plans.joins import asof_join, lookup_join, sorted_join
from trackside.session import landed

# Kinds of point where a passenger train calls.
CALLING_KINDS = ["OR", "IP", "DT"]


def keep_locations(rows: DataFrame, wanted: DataFrame, column: str = "tpl") -> DataFrame:
    """Only rows of the listed locations (``wanted`` has a column ``tpl``)."""
    listed = wanted.select(F.col("tpl").alias(column)).distinct()
    return lookup_join(rows, listed, [column], "left_semi")


def keep_areas(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Only rows of the listed describer areas."""
    return lookup_join(rows, wanted.select("area").distinct(), ["area"], "left_semi")


def with_location_names(rows: DataFrame, locations: DataFrame, column: str = "tpl") -> DataFrame:
    """Add ``locname`` and ``crs``; an unknown code keeps its row."""
    names = locations.select(F.col("tpl").alias(column), "locname", "crs")
    return lookup_join(rows, names, [column])


def with_operator_names(rows: DataFrame, operators: DataFrame) -> DataFrame:
    return lookup_join(rows, operators.select("toc", "tocname"), ["toc"])


def with_reason_texts(reason_rows: DataFrame, late: DataFrame, cancelled: DataFrame) -> DataFrame:
    """Add ``reasontext`` from the list of the row's ``domain``; the two lists share codes."""
    lists = late.select(F.lit("late").alias("domain"), "code", "reasontext").unionByName(
        cancelled.select(F.lit("cancel").alias("domain"), "code", "reasontext")
    )
    return lookup_join(reason_rows, lists, ["domain", "code"])


def with_instance_names(rows: DataFrame, instances: DataFrame, column: str = "src_inst") -> DataFrame:
    names = instances.select(F.col("code").alias(column), F.col("name").alias("instance_name"))
    return lookup_join(rows, names, [column])


def via_texts(points: DataFrame, via: DataFrame, locations: DataFrame) -> DataFrame:
    """Via texts that apply per journey and station: ``rid``, ``tpl``, ``crs`` and the rule.

    A rule applies at a station for a destination if the journey calls at ``loc1`` and, where
    the rule has one, at ``loc2`` after that. Some call at loc2 is later than some call at loc1
    exactly if the last one at loc2 is later than the first one at loc1, so calls are reduced
    to first and last place per journey and location before any join, and no pairs arise.
    """
    if "kind" in points.columns:
        points = points.where(F.col("kind").isin(CALLING_KINDS))
    calls = points.groupBy("rid", "tpl").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    calls = landed(calls, "calls")
    ends = calls.groupBy("rid").agg(F.max_by("tpl", "last").alias("dest"))
    stations = lookup_join(calls.select("rid", "tpl"), locations.select("tpl", "crs"), ["tpl"])
    viewed = sorted_join(stations.where(F.col("crs").isNotNull()), ends, ["rid"])
    rules = via.select(F.col("at").alias("crs"), "dest", "loc1", "loc2", "viatext")
    offered = lookup_join(viewed, rules, ["crs", "dest"], "inner")
    at_loc1 = calls.select("rid", F.col("tpl").alias("loc1"), F.col("first").alias("first_1"))
    at_loc2 = calls.select("rid", F.col("tpl").alias("loc2"), F.col("last").alias("last_2"))
    checked = sorted_join(offered, at_loc1, ["rid", "loc1"])
    checked = sorted_join(checked, at_loc2, ["rid", "loc2"], "left")
    applies = F.col("loc2").isNull() | (F.col("last_2") > F.col("first_1"))
    return checked.where(applies).select("rid", "tpl", "crs", "loc1", "loc2", "viatext")


def correct_train_ids(sightings: DataFrame, corrections: DataFrame, order: list[str], seen: str, since: str) -> DataFrame:
    """Replace a wrong ``train_id`` reported for a berth by the last correction of it that is not after
    the sighting: headcodes are used again every day, so a correction says nothing of sightings before
    it. ``seen`` and ``since`` are the times of both; corrections of one time rank by ``order``."""
    keys = ["area", "berth", "train_id"]
    told = corrections.withColumnRenamed("incorrect_train_id", "train_id").select(*keys, "correct_train_id", since, *[name for name in order if name != since])
    known = asof_join(sightings, told, keys, seen, since, ["correct_train_id"], [name for name in order if name != since])
    return known.select(*sightings.columns, F.coalesce("correct_train_id", "train_id").alias("shown_train_id"))
