"""Current state from a history of messages.

Every state here is an aggregate over its key, never an ordered walk through a key's rows: each
task first reduces a key to one row, so a key with a third of all messages costs no more than
any other. The functions work on batch tables and, in update or complete mode, on streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.plans.joins import sorted_join

# Contract order of messages: document time, then sequence, then place in the document.
ORDER = ["doc_ts", "sequence_number", "item_index"]


def _ordered(rows: DataFrame, order: list[str]) -> None:
    """Refuse an order by text, where 9 comes after 10."""
    kinds = dict(rows.dtypes)
    texts = [name for name in order if kinds[name] == "string"]
    if texts:
        raise TypeError(f"cannot order by text: {', '.join(texts)}")


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key by ``order``; ties are settled by the other columns' values."""
    _ordered(rows, order)
    rest = [name for name in rows.columns if name not in keys and name not in order]
    last = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_last"))
    picked = {name: F.col(name) if name in keys else F.col(f"_last.{name}") for name in rows.columns}
    return last.select(*[column.alias(name) for name, column in picked.items()])


def first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key by ``order``."""
    _ordered(rows, order)
    rest = [name for name in rows.columns if name not in keys and name not in order]
    head = rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    picked = {name: F.col(name) if name in keys else F.col(f"_first.{name}") for name in rows.columns}
    return head.select(*[column.alias(name) for name, column in picked.items()])


def set_clear_state(events: DataFrame, keys: list[str], order: list[str] = ORDER) -> DataFrame:
    """What is set now: the last event per key, where that is a ``set``."""
    return latest(events, keys, order).where(F.col("op") == "set").drop("op")


# In a document schedules come before deactivations, hence the rank between them.
SCHEDULE_ORDER = ["doc_ts", "sequence_number", "rank", "item_index"]


def schedule_events(schedules: DataFrame, deactivations: DataFrame) -> DataFrame:
    """Schedules sent and taken back as one history, with ``op`` and ``rank``."""
    put = schedules.withColumn("op", F.lit("set")).withColumn("rank", F.lit(0))
    taken = deactivations.select("rid", *ORDER).withColumn("op", F.lit("remove")).withColumn("rank", F.lit(1))
    return put.unionByName(taken, allowMissingColumns=True)


def in_force(last_events: DataFrame) -> DataFrame:
    """Of the last event per schedule those that put one, unless it was put as deleted, or as
    inactive until a later message says otherwise."""
    put = (F.col("op") == "set") & ~F.coalesce("deleted", F.lit(False)) & F.coalesce("is_active", F.lit(True))
    return last_events.where(put).drop("op", "rank")


def schedule_state(schedules: DataFrame, deactivations: DataFrame) -> DataFrame:
    """Schedules in force: the last one per ``rid`` that was neither deactivated nor deleted since."""
    return in_force(latest(schedule_events(schedules, deactivations), ["rid"], SCHEDULE_ORDER))


def fold_times(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the last word on its actual time (``_at``) and on its estimate (``_et``), each with
    its place in the order, so that folds of several batches can be folded again.

    An actual time stands until a later event sets another or withdraws it (``at_removed``, which
    is sent once and never in a snapshot). A snapshot says all there is: what it leaves out is gone.
    """
    _ordered(events, order)
    removed = F.coalesce("at_removed", F.lit(False))
    whole = F.coalesce(F.col("response") == "snapshot", F.lit(False)) if "response" in events.columns else F.lit(False)
    at = F.when(
        removed | whole | F.col("at").isNotNull(),
        F.struct(*order, F.when(~removed, F.col("at")).alias("at")),
    )
    et = F.when(whole | F.col("et").isNotNull(), F.struct(*order, "et"))
    return events.groupBy(*keys).agg(F.max(at).alias("_at"), F.max(et).alias("_et"))


def merge_times(folded: DataFrame, keys: list[str]) -> DataFrame:
    """One fold out of several."""
    return folded.groupBy(*keys).agg(F.max("_at").alias("_at"), F.max("_et").alias("_et"))


def shown_times(folded: DataFrame, keys: list[str]) -> DataFrame:
    return folded.select(*keys, F.col("_at.at").alias("at"), F.col("_et.et").alias("et"))


def actual_times(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Current actual time and estimate per key from forecast events, see :func:`fold_times`."""
    return shown_times(fold_times(events, keys, order), keys)


def overlay(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Snapshot rows overlaid by updates: the last row per key by time, and at the same time the
    update. Both come from one table with the column ``response``, so it is read once."""
    time, *within = order
    ranked = rows.withColumn("_rank", (F.col("response") == "update").cast("int"))
    return latest(ranked, keys, [time, "_rank", *within]).drop("_rank")


REQUEST_KEY = ["request_source", "request_id"]


def distinct_requests(rows: DataFrame, order: list[str]) -> DataFrame:
    """Drop repeats of an originated update; rows without both parts of the key all stay.

    Rows without the key never meet in a shuffle, so their number does not matter. On a stream each
    batch is reduced by this and kept as files, and so are all batches when they are read: a first
    row that comes late still replaces the repeats before it.
    """
    keyed = F.col("request_source").isNotNull() & F.col("request_id").isNotNull()
    return first(rows.where(keyed), REQUEST_KEY, order).unionByName(rows.where(~keyed))


LOADING_KEY = ["rid", "fid", "tpl", "wta", "wtd", "wtp", "pta", "ptd"]


def coach_loading_state(formations: DataFrame, loadings: DataFrame, order: list[str] = ORDER) -> DataFrame:
    """Current loading of every coach at every place it was reported for.

    The last loading message of a place counts as a whole: a coach of the formation without a
    value in it is cleared. Where the formation is not known the message's own coaches are shown.
    Messages and formations are reduced before they meet, and the coach values are looked up
    inside the row.
    """
    message = latest(loadings.select(*LOADING_KEY, *order, "loadings"), LOADING_KEY, order)
    train = latest(formations.select("rid", "fid", *order, "coaches"), ["rid", "fid"], order)
    both = sorted_join(message.drop(*order), train.drop(*order), ["rid", "fid"], "left")

    def reported(coach_number: Column) -> Column:
        value = F.filter("loadings", lambda x: x["coach_number"] == coach_number)
        return F.struct(coach_number.alias("coach_number"), F.get(value, F.lit(0))["loading"].alias("loading"))

    numbers = F.coalesce("coaches.coach_number", "loadings.coach_number")
    return both.select(*LOADING_KEY, F.explode(F.transform(numbers, reported)).alias("c")).select(*LOADING_KEY, "c.*")
