"""The jobs as a program: ``python -m trackside.streaming.main [stores|intake|messages|calls] --help``."""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trackside.operators.decode import read_documents
from trackside.operators.parse import parse_records, schema_text
from trackside.session import build_session
from trackside.sources.frames import stream_frames
from trackside.sources.records import TOPIC, stream_files, stream_topic
from trackside.streaming import jobs, sinks

JOBS = ("stores", "intake", "messages", "calls")


def frame_arguments(job: str, argv: Sequence[str]) -> argparse.Namespace:
    """Arguments of the jobs that read push frames."""
    about = {
        "intake": "Push frames to topic records.",
        "messages": "Push frames to tables of their messages.",
        "calls": "Push frames to the call that each forecast means.",
    }
    parser = argparse.ArgumentParser(prog=job, description=about[job])
    parser.add_argument("--frames", required=True, help="folder where frames are landed as parquet")
    parser.add_argument("--checkpoint", required=True, help="folder for checkpoints")
    parser.add_argument("--max-files", type=int, help="most files per batch")
    parser.add_argument("--drain", action="store_true", help="take what is there and stop")
    if job == "intake":
        out = parser.add_mutually_exclusive_group(required=True)
        out.add_argument("--servers", help="brokers of the topic")
        out.add_argument("--out", help="folder for records")
        parser.add_argument("--topic", default=TOPIC)
        parser.add_argument("--first-header", action="store_true", help="all locations of a document to its first train")
    else:
        parser.add_argument("--out", required=True, help="folder for the results")
    if job == "messages":
        parser.add_argument("--tables", nargs="+", choices=list(jobs.TABLES), default=list(jobs.TABLES), help="which tables")
    if job != "calls":
        parser.add_argument("--rejects", required=True, help="folder for frames that cannot be read")
    return parser.parse_args(argv)


def start_frames(spark: SparkSession, job: str, args: argparse.Namespace) -> StreamingQuery | None:
    frames = stream_frames(spark, args.frames, args.max_files)
    if job == "intake":
        out = sinks.file_writer(args.out) if args.out else sinks.format_writer("kafka", topic=args.topic, **{"kafka.bootstrap.servers": args.servers})
        return jobs.start_intake(frames, out, sinks.file_writer(args.rejects), args.checkpoint, args.first_header, drain=args.drain)
    if job == "messages":
        tables = {name: sinks.file_writer(f"{args.out}/{name}") for name in args.tables}
        return jobs.start_messages(frames, tables, sinks.file_writer(args.rejects), args.checkpoint, drain=args.drain)
    docs = read_documents(frames).where("reason is null").select("sequence_number", "xml")
    return jobs.start_matching(docs, args.out, args.checkpoint, drain=args.drain)


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stores", description="Topic records to the raw store, the clean store and the console.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="brokers of the topic")
    source.add_argument("--files", help="folder where records are landed as parquet")
    parser.add_argument("--topic", default=TOPIC)
    parser.add_argument("--starting", default="latest", help="first offsets without a checkpoint")
    parser.add_argument("--max-offsets", type=int, help="most records per batch")
    parser.add_argument("--raw", required=True, help="folder of the keyed raw store")
    clean = parser.add_mutually_exclusive_group(required=True)
    clean.add_argument("--clean", help="folder of the dated clean store")
    clean.add_argument("--jdbc", help="URL of the clean store's database; user and password from JDBC_USER, JDBC_PASSWORD")
    parser.add_argument("--table", default="train_schedule", help="table in the database")
    parser.add_argument("--driver", help="class of the database driver")
    parser.add_argument("--rejects", help="folder for records without a whole key")
    parser.add_argument("--checkpoint", required=True, help="folder for checkpoints")
    parser.add_argument("--console", action="store_true", help="show parsed records too")
    parser.add_argument("--separate", action="store_true", help="one query per sink instead of one for all")
    parser.add_argument("--today", action="store_true", help="times on the processing day")
    parser.add_argument("--drain", action="store_true", help="take what is there and stop")
    return parser.parse_args(argv)


def source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return stream_files(spark, args.files)
    return stream_topic(spark, args.topic, args.servers, args.starting, args.max_offsets)


def clean_writer(args: argparse.Namespace) -> sinks.Writer:
    if args.clean:
        return sinks.dated_writer(args.clean)
    properties = {"user": os.environ.get("JDBC_USER", ""), "password": os.environ.get("JDBC_PASSWORD", "")}
    if args.driver:
        properties["driver"] = args.driver
    return sinks.jdbc_writer(args.jdbc, args.table, properties)


def main(argv: Sequence[str] | None = None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    job = argv.pop(0) if argv and argv[0] in JOBS else "stores"
    if job != "stores":
        args = frame_arguments(job, argv)
        spark = build_session(f"trackside-{job}")
        query = start_frames(spark, job, args)
        if args.drain:
            sinks.drain(query)
        else:
            sinks.await_any(spark)
        return
    args = arguments(argv)
    spark = build_session("trackside-stores")
    records = source(spark, args)
    print(schema_text(records))
    print(schema_text(parse_records(records)))
    raw, cleaned = sinks.keyed_writer(args.raw), clean_writer(args)
    if args.separate:
        started = jobs.start_separately(
            records, raw, cleaned, args.checkpoint, console=args.console, today=args.today, drain=args.drain
        )
    else:
        reject = sinks.file_writer(args.rejects) if args.rejects else None
        started = [
            jobs.start_stores(
                records, raw, cleaned, f"{args.checkpoint}/stores", reject=reject, today=args.today, drain=args.drain
            )
        ]
        if args.console:
            shown = sinks.start_console(
                parse_records(records), checkpoint=f"{args.checkpoint}/console", drain=args.drain
            )
            started.append(shown)
    if args.drain:
        for query in started:
            sinks.drain(query)
    else:
        sinks.await_any(spark)


if __name__ == "__main__":
    main()
