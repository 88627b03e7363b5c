"""Operator 9: mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackside.llm.common import n_words
from trackside.session import landed


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Target of each source: (source, source_size, target).

    Sources in code point order, NULL last, weigh ``weights`` in turn and share ``share`` times all
    sizes; a target stops at ``most`` times its source's size and the excess goes to the others by
    weight. Instead of resharing again and again, sources are ordered by the level (target per
    weight) at which they fill up; the level of the first that does not is everyone's. The window
    holds one row per source.
    """
    if share > most:
        raise ValueError("the share cannot exceed what all sources may give")
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    weighed = sums.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    every = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = weighed.withColumn("level", level)
    held = F.first(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level")), ignorenulls=True).over(every)
    return levels.withColumn("held", held).select(
        "source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("held") * F.col("weight"), F.col("cap"))).cast("double").alias("target")
    )


def uniform(*key: Column) -> Column:
    """A number in (0, 1) that depends on the key only."""
    return (F.pmod(F.xxhash64(*key), F.lit(2**52)).cast("double") + 0.5) / float(2**52)


def _extended(rows: DataFrame, first: bool, last: bool) -> DataFrame:
    """Choose the next documents of each source in rank order, as far as its gap in words goes."""
    size = F.col("size")
    sums = rows.groupBy("source").agg(F.sum(F.col("p") * size).alias("quota"), F.sum(F.when(F.col("chosen"), size).otherwise(0)).alias("got"))
    gaps = sums.select(F.col("source").alias("_source"), (F.col("quota") - F.col("got")).alias("gap"))
    fits = F.lit(True) if first else size <= F.col("gap") * (2 if last else 1)
    known = rows.join(gaps, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    known = known.withColumn("open", ~F.col("chosen") & (F.col("p") > 0) & fits).withColumn("words", F.when(F.col("open"), size).otherwise(0))
    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = known.groupBy("source", "bucket").agg(F.sum("words").alias("in_bucket")).select(
        F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), F.coalesce(F.sum("in_bucket").over(along), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("source", "bucket").orderBy("rank", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    inside = known.withColumn("inside", F.coalesce(F.sum("words").over(within), F.lit(0)))
    joined = inside.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
    end = F.col("start") + F.col("inside") + (size / 2 if last else size)
    return joined.withColumn("chosen", F.col("chosen") | (F.col("open") & (end <= F.col("gap")))).select(*rows.columns)


def pareto_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    weight: str | None = None,
    seed: int = 9,
    passes: int = 3,
    buckets: int = 4096,
) -> DataFrame:
    """Copies of each document so that each source gives its target of words.

    Columns: doc_id, text_key (hash of the text), source, size, source_size, target, copies, taken
    (copies times size). One row per row of ``docs``.

    A document's expected copies are target / source_size, times its ``weight`` column over the
    source's mean weight if one is named, at most ``most``. The whole part is certain. The fraction
    is its inclusion probability p: documents are ranked by (u / (1 - u)) / (p / (1 - p)), u a
    number hashed from doc_id, text and ``seed``, and the sample is the front of that order that
    holds the words that the fractions ask for: its size in words is fixed. The document at the cut
    may be long, so later passes go on along the same order with the documents that still fit, and
    the last one takes the nearer side of its cut. Sums along the order are kept per bucket of it,
    so no task sees a whole source; documents that are never chosen lie evenly in the buckets. NULL and empty texts have size 0 and are never taken more than that; a NULL
    source is a source; rows that repeat are ranked apart; an empty table gives no rows.
    """
    own = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = landed(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"),
            F.col("source"),
            n_words(F.col("text")).alias("size"),
            F.greatest(F.coalesce(own, F.lit(0.0)), F.lit(0.0)).alias("own"),
        ),
        "mix-sizes",
    )
    targets = source_targets(rows, weights, share, most).withColumnRenamed("source", "_source")
    if weight:
        mean = rows.groupBy(F.col("source").alias("_own")).agg(F.try_divide(F.sum(F.col("own") * F.col("size")), F.sum("size")).alias("mean"))
        targets = targets.join(mean, F.col("_source").eqNullSafe(F.col("_own"))).drop("_own")
    else:
        targets = targets.withColumn("mean", F.lit(1.0))
    asked = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.coalesce(F.try_divide("own", "mean"), F.lit(0.0)))
    each = (
        rows.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .select("doc_id", "text_key", "source", "size", "source_size", "target", F.least(F.coalesce(asked, F.lit(0.0)), F.lit(float(most))).alias("asked"))
        .withColumn("whole", F.floor("asked").cast("long"))
        .withColumn("p", F.col("asked") - F.col("whole"))
    )
    u = uniform(F.col("doc_id"), F.col("text_key"), F.lit(seed))
    odds = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    ranked = each.withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds)).otherwise(u))
    rows = ranked.withColumn("bucket", F.least(F.floor(F.col("rank") * buckets), F.lit(buckets - 1))).withColumn("chosen", F.lit(False))
    for k in range(passes):
        rows = _extended(landed(rows, "mix-ranks"), k == 0, k + 1 == passes)
    copies = F.col("whole") + F.when(F.col("chosen"), 1).otherwise(0)
    return rows.select("doc_id", "text_key", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
