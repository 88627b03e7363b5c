"""Small helpers that several operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space in all contracts: blank and \t \n \v \f \r.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Words of a text, none where it is NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(rows: DataFrame, group: list[str], order: list[str], buckets: int, name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps.

    Rows are dealt into ``buckets`` by a hash of the ``order`` columns; the counts of the buckets give
    each bucket its first number, so no task sees a whole group. Number of groups times ``buckets``
    rows are broadcast: groups must be few and known (shards), which bounds them.
    """
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = dealt.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy(*group, "_bucket").orderBy(*order)
    placed = dealt.withColumn("_at", F.row_number().over(within) - 1)
    return placed.join(F.broadcast(first), [*group, "_bucket"]).withColumn(name, F.col("_first") + F.col("_at")).drop("_bucket", "_at", "_first")


def arrow_map(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(function, schema)


def utf8_cells(column: pa.Array) -> Iterator[memoryview]:
    """The cells of a string column as bytes, without decoding them; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    cells = memoryview(data) if data is not None else memoryview(b"")
    valid = column.is_valid().to_numpy(zero_copy_only=False) if column.null_count else None
    for k in range(len(column)):
        yield cells[at[k] : at[k + 1]] if valid is None or valid[k] else memoryview(b"")


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def sample_by(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """About ``most`` rows of each group, those with the smallest hashes of ``key``, to fit a model.

    The cut follows from the number of rows in a group, as hashes lie evenly. One row per group (a
    label) is broadcast. Rows that repeat a key are in or out together.
    """
    share = F.lit(float(most)) / F.col("_n")
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    cuts = counts.select(group, F.when(share >= 1, F.lit(2**63 - 1)).otherwise((share * 2.0**64 - 2.0**63).cast("long")).alias("_cut"))
    return rows.join(F.broadcast(cuts), group).filter(F.xxhash64(key) <= F.col("_cut")).drop("_cut")


def kept_in_worker(key: tuple, make: Callable):
    """What ``make`` gives, made once per Python worker. Functions here are sent to workers by value, so
    the module that holds it is made there too."""
    held = sys.modules.setdefault("_trackside_kept", types.ModuleType("_trackside_kept"))
    kept = vars(held).setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
