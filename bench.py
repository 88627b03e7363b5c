"""Time the operators and print one JSON line.

Inputs the tables do not hold as such (topic records, push frames, documents) are derived from
them and written to files first; that is not timed. Every timed query then reads whole files.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from trackside.operators import decode, journey, messages, quality, reference, state  # noqa: E402
from trackside.operators.clean import clean  # noqa: E402
from trackside.operators.parse import parse_records, parse_records_typed  # noqa: E402
from trackside.operators.publish import to_records  # noqa: E402
from trackside.plans import state_queries as sq  # noqa: E402
from trackside.session import build_session, work_dir  # noqa: E402
from trackside.sources import frames as frame_source  # noqa: E402
from trackside.sources import timetable  # noqa: E402
from trackside.sources.records import stream_files  # noqa: E402
from trackside.sources.tables import read_table  # noqa: E402
from trackside.streaming import jobs, sinks, stores  # noqa: E402
from trackside.testfeed import frames as feed  # noqa: E402
from trackside.testfeed import messages as made  # noqa: E402
from trackside.testfeed import timetable as files  # noqa: E402
from trackside.testfeed.records import topic_records  # noqa: E402


def prepare(spark: SparkSession, sf: str, parts: int) -> dict[str, str]:
    """Write the derived inputs; returns their folders."""
    orders = read_table(spark, sf, "orders").repartition(parts)
    events = read_table(spark, sf, "events").repartition(parts)
    inputs = {
        "records": topic_records(events),
        "frames": feed.status_frames(orders),
        "status": feed.status_documents(orders),
        "schedules": made.schedule_documents(orders),
        "formations": made.formation_documents(orders),
        "loadings": made.loading_documents(orders),
        "schedule_events": made.schedule_event_documents(events),
        "forecast_events": made.forecast_event_documents(events),
        "points": messages.calling_points(made.schedule_documents(orders)),
        "parsed": parse_records(topic_records(events)),
    }
    paths = {}
    for name, df in inputs.items():
        paths[name] = work_dir(spark, f"bench-{name}")
        df.write.parquet(paths[name])
    paths["timetable"] = work_dir(spark, "bench-timetable")
    files.write_timetable(orders, paths["timetable"])
    return paths


def timed_queries(spark: SparkSession, sf: str, paths: dict[str, str]) -> dict[str, Callable[[], DataFrame | None]]:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(paths[name])

    def stream_stores() -> None:
        path = work_dir(spark, "bench-stores")
        sinks.drain(
            jobs.start_stores(
                stream_files(spark, paths["records"]),
                raw=sinks.keyed_writer(f"{path}/raw"),
                cleaned=sinks.dated_writer(f"{path}/clean"),
                checkpoint=f"{path}/checkpoint",
                drain=True,
            )
        )

    def stream_intake() -> None:
        path = work_dir(spark, "bench-intake")
        sinks.drain(
            jobs.start_intake(
                frame_source.stream_frames(spark, paths["frames"]),
                publish=sinks.file_writer(f"{path}/records"),
                reject=sinks.file_writer(f"{path}/rejects"),
                checkpoint=f"{path}/checkpoint",
                drain=True,
            )
        )

    def dated_write() -> None:
        stores.write_by_date(clean(parse_records(read("records"))), work_dir(spark, "bench-dated"))

    columns = ["rid", "ssd", "pos", "wta", "wtd", "wtp", "pta", "ptd"]
    ids = ["sequence_number", "train_index", "location_index"]
    order = ["doc_ts", "sequence_number"]
    return {
        "parse_flatten": lambda: parse_records(read("records")),
        "parse_typed": lambda: parse_records_typed(read("records")),
        "clean_data": lambda: clean(parse_records(read("records"))),
        "json_encode_keyed": lambda: to_records(read("parsed")),
        "raw_upsert": lambda: stores.upsert_view(stores.whole_keys(read("parsed"))),
        "time_partitioned_write": dated_write,
        "stream_stores": stream_stores,
        "frames_decode": lambda: decode.locations(decode.decode_frames(read("frames"))),
        "frames_rejects": lambda: decode.rejects(decode.decode_frames(read("frames"))),
        "stream_intake": stream_intake,
        "forecast_long": lambda: messages.forecast_events(messages.forecasts(read("status"))),
        "defaults_filled": lambda: quality.fill_defaults(messages.forecasts(read("status")), "forecast"),
        "schedule_headers": lambda: messages.schedules(read("schedules")),
        "calling_points": lambda: messages.calling_points(read("schedules")),
        "calling_points_anchored": lambda: journey.anchored_points(read("schedules")),
        "journey_anchor": lambda: journey.anchor_journeys(read("points").select(*columns)),
        "instance_match": lambda: journey.match_calls(messages.forecasts(read("status")), read("points"), ids),
        "via_text": lambda: reference.via_texts(
            read("points"),
            read_table(spark, sf, "orders").selectExpr(*sq._columns(sq.VIA)).distinct(),
            read_table(spark, sf, "orders").selectExpr(*sq._columns(sq.STATIONS)).distinct(),
        ),
        "enrich_dims": lambda: sq.enrich_dims(spark, sf),
        "enrich_balanced": lambda: sq.enrich_balanced(spark, sf),
        "schedule_state": lambda: state.schedule_state(
            messages.schedules(read("schedule_events")), messages.deactivations(read("schedule_events"))
        ),
        "at_retract": lambda: state.actual_times(
            messages.forecast_events(messages.forecasts(read("forecast_events"))), sq.FORECAST_KEY, order
        ),
        "formation_loading": lambda: state.coach_loading_state(
            messages.formations(read("formations")), messages.loadings(read("loadings"))
        ),
        "timetable_load": lambda: timetable.journey_points(timetable.read_journeys(spark, paths["timetable"])),
    }


def run(query: Callable[[], DataFrame | None]) -> float:
    started = time.perf_counter()
    result = query()
    if result is not None:
        result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Warm up: every query once on the smallest tables.
    small = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    warm = timed_queries(spark, small, prepare(spark, small, int(cpus)))
    names = sys.argv[1:] or list(warm)
    for name in names:
        run(warm[name])
    paths = prepare(spark, sf, int(cpus))
    queries = timed_queries(spark, sf, paths)
    # The better of two runs, because the first one still compiles.
    took = {name: round(min(run(queries[name]), run(queries[name])), 3) for name in names}
    frames, records = spark.read.parquet(paths["frames"]).count(), spark.read.parquet(paths["records"]).count()
    rates = {}
    if "frames_decode" in took and "clean_data" in took:
        rates = {"frames_per_sec": round(frames / took["frames_decode"]), "records_per_sec": round(records / took["clean_data"])}
    line = {"metric": "operators", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf, **rates}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
