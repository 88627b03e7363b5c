"""The streaming jobs: frames to records, records to the stores."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackside.operators import messages
from trackside.operators.clean import clean
from trackside.operators.decode import REASONS, decode_frames, locations, read_documents, rejects
from trackside.operators.parse import parse_records
from trackside.operators.publish import to_records
from trackside.operators.state import distinct_requests, fold_times, latest, merge_times, shown_times
from trackside.schemas import RECORD_FIELDS
from trackside.sources.tables import spread
from trackside.streaming import matching, sinks, versions
from trackside.streaming.stores import EVERY, broken_keys, last_written

log = logging.getLogger(__name__)

Fold = Callable[[DataFrame], DataFrame]


def start_intake(
    frames: DataFrame,
    publish: sinks.Writer,
    reject: sinks.Writer,
    checkpoint: str,
    first_header: bool = False,
    **run,
) -> StreamingQuery | None:
    """Push frames to topic records, and to rejects with a reason.

    Each frame is decoded once. Decoding is the heavy step, so a batch with fewer splits than
    cores is spread out for it.
    """
    writers = sinks.fan_out(
        [
            sinks.then(lambda decoded: to_records(locations(decoded, first_header)), publish),
            sinks.then(rejects, reject),
        ]
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"intake-{batch_id}")
        writers(observed_intake(decode_frames(spread(batch)), seen), batch_id)
        log_intake(seen.get, batch_id)

    return sinks.start_batches(frames, write, checkpoint, **run)


def observed_intake(decoded: DataFrame, seen: Observation) -> DataFrame:
    """Count what a batch of frames holds while it is decoded, without a job of its own: frames, their
    distinct types, the last sequence, and the rejected by reason."""
    by_reason = [F.count(F.when(F.col("reason") == reason, 1)).alias(f"rejected_{reason}") for reason in REASONS]
    return decoded.observe(
        seen,
        F.count(F.lit(1)).alias("frames"),
        F.approx_count_distinct("message_type").alias("types"),
        F.count("reason").alias("rejected"),
        F.max(F.col("sequence_number").try_cast("bigint")).alias("last"),
        *by_reason,
    )


def log_intake(seen: dict, batch_id: int) -> None:
    """Log what :func:`observed_intake` counted."""
    reasons = ", ".join(f"{reason} {seen[f'rejected_{reason}']}" for reason in REASONS if seen.get(f"rejected_{reason}"))
    log.info(
        "batch %s: %s frames of %s types, %s rejected (%s), last sequence %s",
        batch_id, seen["frames"], seen["types"], seen["rejected"], reasons or "none", seen["last"],
    )


# The tables that documents can be turned into: the kinds they are made of, and how.
TABLES: dict[str, tuple[list[str], Fold]] = {
    "forecasts": (["TS"], messages.forecasts),
    "schedules": (["schedule"], messages.schedules),
    "calling_points": (["schedule"], messages.calling_points),
    "reasons": (["TS", "schedule"], messages.reasons),
    "deactivations": (["deactivated"], messages.deactivations),
    "schedule_history": (["schedule", "deactivated"], messages.schedule_history),
    "associations": (["association"], messages.associations),
    "formations": (["scheduleFormations"], messages.formations),
    "loadings": (["formationLoading"], messages.loadings),
    "station_messages": (["OW"], messages.station_messages),
    "train_alerts": (["trainAlert"], messages.train_alerts),
    "train_orders": (["trainOrder"], messages.train_order_events),
    "tracking_ids": (["trackingID"], messages.tracking_ids),
    "alarms": (["alarm"], messages.alarms),
    "failures": ([], messages.failures),
}


def start_messages(frames: DataFrame, tables: dict[str, sinks.Writer], reject: sinks.Writer, checkpoint: str, **run) -> StreamingQuery | None:
    """Push frames to the asked tables of ``TABLES``: each frame is opened and each document parsed
    once for all of them. ``reject`` gets frames that cannot be read, and documents of which no
    asked kind and no failure is part."""
    kinds = list(dict.fromkeys(kind for name in tables for kind in TABLES[name][0]))

    def write(batch: DataFrame, batch_id: int) -> None:
        documents = read_documents(spread(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        parsed = messages.parse_documents(documents.where("reason is null"), kinds).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, writer in tables.items():
                writer(TABLES[name][1](parsed), batch_id)
            # Few rows, found by their sequence; their body is not needed again.
            other = messages.without_kind(parsed, kinds).select(F.lit("no_kind").alias("reason"), F.col("sequence_number").cast("string").alias("sequence_number"))
            reject(rejects(documents).unionByName(other, allowMissingColumns=True), batch_id)
        finally:
            parsed.unpersist()
            documents.unpersist()

    return sinks.start_batches(frames, write, checkpoint, **run)


def start_matching(docs: DataFrame, path: str, checkpoint: str, every: int = EVERY, keep_days: int | None = 3, **run) -> StreamingQuery | None:
    """Keep which call each forecast row of a stream of documents means (``matching.read_matches``), whichever
    of a row and its schedule comes first. Each document is parsed for the kinds its text has; what is
    kept of a batch are the rows, not the parsed documents, which are many times larger."""

    def write(batch: DataFrame, batch_id: int) -> None:
        docs = spread(batch)
        matching.match_batch(messages.forecasts(docs), messages.calling_points(docs), batch_id, path, every=every, keep_days=keep_days)

    return sinks.start_batches(docs, write, checkpoint, **run)


def start_stores(
    records: DataFrame,
    raw: sinks.Writer,
    cleaned: sinks.Writer,
    checkpoint: str,
    extra: list[sinks.Writer] | None = None,
    reject: sinks.Writer | None = None,
    today: bool = False,
    **run,
) -> StreamingQuery | None:
    """One query that feeds the raw and the clean store, and more writers of parsed rows.

    Records without a whole key, such as malformed JSON, cannot enter the raw store; ``reject``
    gets them with their text as it came.
    """

    def rows(parsed: DataFrame) -> DataFrame:
        return parsed.select(*RECORD_FIELDS)

    writers = [
        sinks.then(last_written, raw),
        sinks.then(lambda parsed: clean(rows(parsed), today), cleaned),
        *[sinks.then(rows, writer) for writer in extra or []],
    ]
    if reject:
        writers.append(sinks.then(lambda parsed: broken_keys(parsed).select("value", "sequence_number"), reject))
    # The offset tells which of two records of one message was written last.
    kept = tuple(name for name in ("value", "offset") if name in records.columns and (reject or name != "value"))
    write = sinks.then(lambda batch: parse_records(spread(batch), keep=kept), sinks.fan_out(writers))
    return sinks.start_batches(records, write, checkpoint, **run)


def start_separately(
    records: DataFrame,
    raw: sinks.Writer,
    cleaned: sinks.Writer,
    checkpoint: str,
    console: bool = True,
    today: bool = False,
    **run,
) -> list[StreamingQuery]:
    """The same as independent queries, each reading the source and advancing by itself."""
    parsed = parse_records(records)
    kept = tuple(name for name in ("offset",) if name in records.columns)
    started = [
        sinks.start_batches(parse_records(records, keep=kept), sinks.then(last_written, raw), f"{checkpoint}/raw", **run),
        sinks.start_batches(clean(parsed, today), cleaned, f"{checkpoint}/clean", **run),
    ]
    if console:
        started.append(
            sinks.start_console(parsed, checkpoint=f"{checkpoint}/console", drain=run.get("drain", False))
        )
    return started


def start_fold(
    events: DataFrame, fold: Fold, merge: Fold, path: str, checkpoint: str, every: int = EVERY, **run
) -> StreamingQuery | None:
    """Keep a fold of a stream as files.

    Each batch is reduced by ``fold`` and added; ``merge`` makes one fold out of several, when the
    state is read, when ``every`` batches have come together, and level by level (see ``versions``), so
    that state is not written again as a whole. Nothing grows in the executors, however many keys there are.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        versions.append(fold(batch).hint("rebalance"), batch_id, path)
        if len(versions.open_batches(batch.sparkSession, path)) >= every:
            versions.compact(batch.sparkSession, path, lambda rows: merge(rows.drop(versions.GENERATION)), lambda rows, _: rows.hint("rebalance"))

    return sinks.start_batches(events, write, checkpoint, **run)


def read_fold(spark: SparkSession, path: str, merge: Fold) -> DataFrame:
    """The state written by :func:`start_fold`."""
    return merge(versions.read(spark, path).drop(versions.GENERATION))


def start_state(events: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str, **run) -> StreamingQuery | None:
    """Keep the last event per key of a stream."""
    last = lambda rows: latest(rows, keys, order)
    return start_fold(events, last, last, path, checkpoint, **run)


def read_state(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """The last event per key written by :func:`start_state`."""
    return read_fold(spark, path, lambda rows: latest(rows, keys, order))


def start_times(events: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str, **run) -> StreamingQuery | None:
    """Keep actual times and estimates of a stream of forecast events."""
    return start_fold(events, lambda rows: fold_times(rows, keys, order), lambda rows: merge_times(rows, keys), path, checkpoint, **run)


def read_times(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Actual times and estimates written by :func:`start_times`."""
    return shown_times(read_fold(spark, path, lambda rows: merge_times(rows, keys)), keys)


def start_requests(rows: DataFrame, order: list[str], path: str, checkpoint: str, **run) -> StreamingQuery | None:
    """Keep originated updates once each, the first by ``order`` whenever it comes."""
    once = lambda batch: distinct_requests(batch, order)
    return start_fold(rows, once, once, path, checkpoint, **run)


def read_requests(spark: SparkSession, path: str, order: list[str]) -> DataFrame:
    return read_fold(spark, path, lambda rows: distinct_requests(rows, order))
