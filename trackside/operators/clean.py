"""Typing, missing-value text and the required column: flat records to clean rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.functions.values import (
    blank_null_text,
    clock_on,
    clock_today,
    near,
    to_date,
    to_long,
)
from trackside.schemas import RECORD_FIELDS

# Clock columns, and the columns where the text ``null`` means missing.
CLOCK_COLUMNS = [
    "scheduled_arrival",
    "scheduled_departure",
    "actual_arrival",
    "actual_departure",
    "estimated_time",
]
NULL_TEXT_COLUMNS = ["actual_arrival", "actual_departure", "platforms", "estimated_time", "source"]
REQUIRED_COLUMN = "actual_arrival"


def normalise_null_text(df: DataFrame) -> DataFrame:
    """NULL for the text ``null`` in the five columns that carry it."""
    return df.select(
        *[
            blank_null_text(name).alias(name) if name in NULL_TEXT_COLUMNS else F.col(name)
            for name in df.columns
        ]
    )


def cast_ids_dates(df: DataFrame) -> DataFrame:
    """Ids as long, service date as date; malformed text becomes NULL."""
    typed = {
        "sequence_number": to_long("sequence_number"),
        "schedule_id": to_long("schedule_id"),
        "service_start_date": to_date("service_start_date"),
    }
    return df.select(*[typed.get(name, F.col(name)).alias(name) for name in df.columns])


def clocks_on_service_date(df: DataFrame) -> DataFrame:
    """Clock texts to local timestamps on the service date (which must be a date by now)."""
    return df.select(
        *[
            clock_on("service_start_date", name).alias(name) if name in CLOCK_COLUMNS else F.col(name)
            for name in df.columns
        ]
    )


def roll_over_midnight(df: DataFrame) -> DataFrame:
    """Move each time to within twelve hours of the scheduled arrival, so that a departure after
    midnight lands on the next day. Without an arrival the scheduled departure counts."""
    reference = F.coalesce("scheduled_arrival", "scheduled_departure")
    moved = [name for name in CLOCK_COLUMNS if name != "scheduled_arrival"]
    return df.select(
        *[
            F.when(reference.isNull(), F.col(name)).otherwise(near(name, reference)).alias(name)
            if name in moved
            else F.col(name)
            for name in df.columns
        ]
    )


def anchor_clocks(df: DataFrame) -> DataFrame:
    """Clock texts to local timestamps around the service date."""
    return roll_over_midnight(clocks_on_service_date(df))


def clocks_today(df: DataFrame) -> DataFrame:
    """Clock texts on the processing day, in the session zone."""
    return df.select(
        *[
            clock_today(name).alias(name) if name in CLOCK_COLUMNS else F.col(name)
            for name in df.columns
        ]
    )


def drop_missing(df: DataFrame, column: str = REQUIRED_COLUMN) -> DataFrame:
    """Rows without the time column of the clean store go."""
    return df.where(F.col(column).isNotNull())


def clean(df: DataFrame, today: bool = False) -> DataFrame:
    """Flat text records to the twelve typed columns of the clean store.

    By default times are anchored on the service date. ``today=True`` gives what a plain cast
    gives: the processing day's date, whatever the service date says.
    """
    typed = cast_ids_dates(normalise_null_text(df.select(*RECORD_FIELDS)))
    if today:
        return drop_missing(clocks_today(typed))
    # A roll-over never makes or removes a NULL, so rows can go before it.
    return roll_over_midnight(drop_missing(clocks_on_service_date(typed)))
