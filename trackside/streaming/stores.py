"""The two stores as files: a keyed one for raw records, a dated one for clean rows.

Batches write folders of their own and overwrite them when they are run again, so a replay never
doubles rows. A query keeps its id with its checkpoint; one started with a new checkpoint counts
batches from 0 again and gets folders of its own. Both stores are merged in levels, see
``versions``: the keyed one as a whole, sorted by place, the dated one day by day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.operators.state import latest
from trackside.schemas import RAW_KEY, RECORD_FIELDS, RECORD_SCHEMA
from trackside.streaming import versions

# The raw store places a record by these, and sorts by the rest of the key.
RAW_PLACE = ["unique_id", "location_code"]

# Within one message the place in it decides, then the order on the topic.
WITHIN = ["train_index", "location_index", "offset"]

# Rows a file of the keyed store holds about; what a lookup reads of a part.
ROWS_PER_FILE = 1_000_000

# Batches that are open before they are folded.
EVERY = 16

DATE_COLUMN = "arrival_date"

# Columns that come from folder names and are not part of a row.
FOLDER_COLUMNS = ["query", "batch_id", DATE_COLUMN]


def batch_path(rows: DataFrame, path: str, batch_id: int) -> str:
    """Folder of a micro-batch of plain files."""
    return f"{path}/query={versions.query_id(rows)}/batch_id={batch_id}"


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of plain batch folders, without the columns of the folders."""
    return spark.read.parquet(path).drop(*FOLDER_COLUMNS)


def numbered(rows: DataFrame) -> DataFrame:
    """Add the sequence number as a number, by which later records replace earlier ones."""
    return rows.withColumn("_sequence", F.col("sequence_number").try_cast("bigint"))


def upsert_view(rows: DataFrame, keys: list[str] = RAW_KEY) -> DataFrame:
    """One row per key, the last written: by sequence number, then by batch, place in the message
    and topic offset, as far as the rows carry them."""
    order = [name for name in (versions.GENERATION, *WITHIN) if name in rows.columns]
    return latest(numbered(rows), keys, ["_sequence", *order]).drop("_sequence", *order)


def whole_keys(rows: DataFrame, keys: list[str] = RAW_KEY) -> DataFrame:
    """Rows the keyed store can take; a missing key part would fail the write."""
    return rows.where(_key_present(keys))


def broken_keys(rows: DataFrame, keys: list[str] = RAW_KEY) -> DataFrame:
    return rows.where(~_key_present(keys))


def _key_present(keys: list[str]) -> Column:
    present = F.col(keys[0]).isNotNull()
    for name in keys[1:]:
        present = present & F.col(name).isNotNull()
    return present


def last_written(rows: DataFrame) -> DataFrame:
    """The record columns of what a batch leaves in a keyed store."""
    return upsert_view(whole_keys(rows)).select(*RECORD_FIELDS)


def append_keyed(rows: DataFrame, batch_id: int, path: str, every: int | None = None) -> None:
    """Add a batch to the keyed store, reduced to one row per key; a small batch is one file.

    ``every``: fold batches into the store when so many are open.
    """
    reduced = last_written(rows).hint("rebalance").sortWithinPartitions(*RAW_KEY)
    versions.append(reduced, batch_id, path)
    if every and len(versions.open_batches(rows.sparkSession, path)) >= every:
        compact_keyed(rows.sparkSession, path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The keyed store: last row per key over all batches."""
    rows = versions.read(spark, path, RECORD_SCHEMA)
    return upsert_view(rows.select(*RECORD_FIELDS, versions.GENERATION))


def read_key(spark: SparkSession, path: str, unique_id: str, location_code: str) -> DataFrame:
    """Rows of one place, in order of the schedule.

    One manifest says which files may hold it: files of a part are ranges of places, so of each part
    one is opened, or two where a range ends within the train. Their pages, and the few open batches,
    are skipped by the Bloom filter on the train in each file where it is not in them.
    """
    wanted = (F.col("unique_id") == unique_id) & (F.col("location_code") == location_code)
    rows = versions.read(spark, path, RECORD_SCHEMA, files=lambda file: file["least"] <= unique_id <= file["most"])
    return upsert_view(rows.where(wanted).select(*RECORD_FIELDS, versions.GENERATION)).orderBy("schedule_id")


def compact_keyed(spark: SparkSession, path: str, files: int | None = None, most: int | None = None) -> None:
    """Fold the open batches (the first ``most``) into the store, in files that are ranges of places; how
    many follows from the rows unless it is given."""

    def fold(rows: DataFrame) -> DataFrame:
        return upsert_view(rows.select(*RECORD_FIELDS, versions.GENERATION))

    def lay_out(rows: DataFrame, at_most: int) -> DataFrame:
        count = files or max(1, -(-at_most // ROWS_PER_FILE))
        dealt = rows.repartitionByRange(count, *RAW_PLACE) if count > 1 else rows.coalesce(1)
        return dealt.sortWithinPartitions(*RAW_KEY)

    versions.compact(spark, path, fold, lay_out, RECORD_SCHEMA, zone=RAW_PLACE[0], most=most, options=_bloom(RAW_PLACE[0]))


def _bloom(name: str) -> dict[str, str]:
    return {f"parquet.bloom.filter.enabled#{name}": "true", f"parquet.bloom.filter.expected.ndv#{name}": str(ROWS_PER_FILE // 10)}


def append_by_date(rows: DataFrame, batch_id: int, path: str, time: str = "actual_arrival", every: int | None = None) -> None:
    """Add a batch to the dated store, partitioned by the day of its time column.

    ``every``: fold batches into the store's days when so many are open.
    """
    _by_day(rows, time).write.mode("overwrite").partitionBy(DATE_COLUMN).parquet(versions.batch_path(rows, path, batch_id))
    if every and len(versions.open_batches(rows.sparkSession, path)) >= every:
        compact_by_date(rows.sparkSession, path, time)


def write_by_date(rows: DataFrame, path: str, time: str = "actual_arrival") -> None:
    """Write a table to the dated store, as one batch."""
    append_by_date(rows, 0, path, time)


def _by_day(rows: DataFrame, time: str) -> DataFrame:
    """Rows are rebalanced by day, so that a long stretch of days does not make a file per day and
    task; the engine splits a day that is too large and joins small ones."""
    return rows.withColumn(DATE_COLUMN, F.to_date(time)).hint("rebalance", F.col(DATE_COLUMN))


def compact_by_date(spark: SparkSession, path: str, time: str = "actual_arrival", most: int | None = None) -> None:
    """Fold the open batches (the first ``most``) into their days. Only days with rows in them are
    written; of each file the manifest notes its first and last time."""

    def rows(found: DataFrame) -> DataFrame:
        return found.drop(versions.GENERATION, DATE_COLUMN)

    versions.compact(spark, path, rows, lambda found, _: _by_day(found, time).sortWithinPartitions(DATE_COLUMN, time), group=DATE_COLUMN, zone=time, most=most)


def read_by_date(spark: SparkSession, path: str) -> DataFrame:
    """The dated store, all days."""
    return versions.read(spark, path).drop(versions.GENERATION, DATE_COLUMN)


def read_between(spark: SparkSession, path: str, start: str, end: str, time: str = "actual_arrival") -> DataFrame:
    """Rows with ``start <= time < end``; only files of those days whose times reach into the range
    are listed and read, and the folders of those days in open batches."""
    first, last = F.lit(start).try_cast("timestamp_ntz"), F.lit(end).try_cast("timestamp_ntz")
    days = first, last - F.expr("interval 1 microsecond")
    from_day, to_day, begin, stop = spark.range(1).select(*[F.to_date(x).cast("string") for x in days], *[x.cast("string") for x in (first, last)]).first()
    if begin is None or stop is None:
        raise ValueError(f"not times: {start}, {end}")
    rows = versions.read(
        spark,
        path,
        parts=lambda part: from_day <= part["group"] <= to_day,
        files=lambda file: file["most"] >= begin and file["least"] < stop,
        within=lambda day: from_day <= day <= to_day,
    )
    return rows.where((F.col(time) >= first) & (F.col(time) < last)).drop(versions.GENERATION, DATE_COLUMN)
