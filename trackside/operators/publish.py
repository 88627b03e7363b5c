"""Location rows to keyed JSON records for the topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.schemas import RECORD_FIELDS


def json_text(column: str):
    """A string as JSON text, quotes included; NULL as ``null``."""
    listed = F.to_json(F.array(F.col(column)))
    return listed.substr(F.lit(2), F.length(listed) - 2)


def to_records(rows: DataFrame) -> DataFrame:
    """One record per row: key is ``unique_id`` as JSON, value the twelve fields, NULLs explicit."""
    value = F.to_json(
        F.struct(*[F.col(name).cast("string").alias(name) for name in RECORD_FIELDS]),
        {"ignoreNullFields": "false"},
    )
    return rows.select(json_text("unique_id").cast("binary").alias("key"), value.cast("binary").alias("value"))
