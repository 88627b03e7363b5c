"""Streams against batch results, replays, restarts, and the stores."""

import json

import pytest
from pyspark.sql import functions as F

from trackside.operators.clean import clean
from trackside.operators import decode, journey, messages, state
from trackside.operators.parse import parse_records
from trackside.schemas import RECORD_FIELDS
from trackside.session import landed, work_dir, work_root
from trackside.sources.frames import read_frames
from trackside.sources.records import TOPIC_SCHEMA, read_topic, stream_files, stream_topic
from trackside.sources.tables import read_table, spread, stream_table
from trackside.streaming import jobs, main, matching, sinks, stores, versions
from trackside.testfeed import frames as feed
from trackside.testfeed import messages as m
from trackside.testfeed.records import topic_records

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def topic(spark, tmp_path):
    """Topic records of the events in five files."""
    path = str(tmp_path / "topic")
    topic_records(read_table(spark, SF, "events")).repartition(5).write.parquet(path)
    return path


def as_set(df):
    return sorted(map(str, df.collect()))


def test_clean_stream_equals_batch_file_by_file(spark, topic, tmp_path):
    records = stream_files(spark, topic, max_files=1)
    assert records.schema.fieldNames() == TOPIC_SCHEMA.fieldNames()
    query = sinks.start_batches(
        clean(parse_records(records)), sinks.dated_writer(str(tmp_path / "rows")), str(tmp_path / "ck"), drain=True
    )
    sinks.drain(query)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 5
    batch = clean(parse_records(spark.read.parquet(topic)))
    assert as_set(stores.read_by_date(spark, str(tmp_path / "rows")).select(*batch.columns)) == as_set(batch)


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    source, rows, check = str(tmp_path / "in"), str(tmp_path / "rows"), str(tmp_path / "ck")
    records = topic_records(read_table(spark, SF, "events"))
    for part in range(3):
        records.where(F.col("offset") % 3 == part).coalesce(1).write.mode("append").parquet(source)
        query = sinks.start_batches(clean(parse_records(stream_files(spark, source))), sinks.dated_writer(rows), check, drain=True)
        sinks.drain(query)
    batch = clean(parse_records(records))
    assert as_set(stores.read_by_date(spark, rows).select(*batch.columns)) == as_set(batch)


def test_failed_batch_runs_again_without_doubling(spark, topic, tmp_path):
    rows, check, calls = str(tmp_path / "rows"), str(tmp_path / "ck"), []
    plain = sinks.file_writer(rows)

    def fails_once(batch, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost")

    write = sinks.fan_out([plain, fails_once])
    first = sinks.start_batches(parse_records(stream_files(spark, topic)), write, check, drain=True)
    with pytest.raises(Exception, match="lost"):
        sinks.drain(first)
    sinks.drain(sinks.start_batches(parse_records(stream_files(spark, topic)), write, check, drain=True))
    assert calls == [0, 0]
    assert spark.read.parquet(rows).count() == read_table(spark, SF, "events").count()


def test_a_new_checkpoint_does_not_overwrite_older_batches(spark, topic, tmp_path):
    rows = str(tmp_path / "rows")
    for part in "ab":
        records = parse_records(stream_files(spark, topic)).where(f"cast(sequence_number as int) % 2 = {'ab'.index(part)}")
        sinks.drain(sinks.start_batches(records, sinks.file_writer(rows), str(tmp_path / part), drain=True))
    assert stores.read_batches(spark, rows).count() == 1000


def test_messages_on_a_stream(spark, tmp_path):
    """Message kinds, dates within a document included, are the same on a stream."""
    from trackside.operators import journey, messages
    from trackside.testfeed import messages as made

    orders, documents = read_table(spark, SF, "orders"), read_table(spark, SF, "documents")
    cases = {
        "forecasts": (feed.status_documents(orders), messages.forecasts),
        "points": (made.schedule_documents(orders), journey.anchored_points),
        "alerts": (made.station_message_documents(documents), messages.station_messages),
        "reasons": (made.schedule_documents(orders), messages.reasons),
    }
    for name, (docs, kind) in cases.items():
        source, out = str(tmp_path / name), str(tmp_path / f"{name}-out")
        docs.repartition(3).write.parquet(source)
        stream = stream_files(spark, source, docs.schema, max_files=2)
        sinks.drain(sinks.start_batches(kind(stream), sinks.file_writer(out), f"{out}-ck", drain=True))
        batch = kind(docs)
        assert as_set(stores.read_batches(spark, out).select(*batch.columns)) == as_set(batch), name


def test_a_table_is_not_started(spark, topic, tmp_path):
    assert sinks.start_batches(spark.read.parquet(topic), sinks.file_writer(str(tmp_path)), "x") is None


def test_fan_out_reads_the_source_once(spark, topic, tmp_path):
    query = jobs.start_stores(
        stream_files(spark, topic),
        raw=sinks.keyed_writer(str(tmp_path / "raw")),
        cleaned=sinks.dated_writer(str(tmp_path / "clean")),
        checkpoint=str(tmp_path / "ck"),
        drain=True,
    )
    sinks.drain(query)
    events = read_table(spark, SF, "events").count()
    assert sum(p.numInputRows for p in query.recentProgress) == events
    parsed = parse_records(spark.read.parquet(topic))
    assert as_set(stores.read_keyed(spark, str(tmp_path / "raw"))) == as_set(stores.upsert_view(parsed))


def test_separate_queries(spark, topic, tmp_path):
    started = jobs.start_separately(
        stream_files(spark, topic),
        raw=sinks.keyed_writer(str(tmp_path / "raw")),
        cleaned=sinks.dated_writer(str(tmp_path / "clean")),
        checkpoint=str(tmp_path / "ck"),
        drain=True,
    )
    for query in started:
        sinks.drain(query)
    assert len(started) == 3
    assert stores.read_by_date(spark, str(tmp_path / "clean")).count() == clean(parse_records(spark.read.parquet(topic))).count()
    assert [sum(p.numInputRows for p in query.recentProgress) for query in started] == [1000, 1000, 1000]


def test_console_period_and_any_end(spark, topic, tmp_path):
    spark.streams.resetTerminated()
    query = sinks.start_console(parse_records(stream_files(spark, topic)), period="1 second", checkpoint=str(tmp_path / "ck"))
    query.processAllAvailable()
    query.stop()
    sinks.await_any(spark)
    spark.streams.resetTerminated()


def test_intake_stream(spark, tmp_path):
    orders = read_table(spark, SF, "orders")
    feed.status_frames(orders).write.parquet(str(tmp_path / "frames"))
    from trackside.operators import decode
    from trackside.sources.frames import read_frames, stream_frames

    query = jobs.start_intake(
        stream_frames(spark, str(tmp_path / "frames")),
        publish=sinks.file_writer(str(tmp_path / "records")),
        reject=sinks.file_writer(str(tmp_path / "rejects")),
        checkpoint=str(tmp_path / "ck"),
        drain=True,
    )
    sinks.drain(query)
    decoded = decode.decode_frames(read_frames(spark, str(tmp_path / "frames")))
    sent = parse_records(spark.read.parquet(str(tmp_path / "records")))
    assert as_set(sent) == as_set(decode.locations(decoded))
    kept = spark.read.parquet(str(tmp_path / "rejects")).drop("batch_id")
    assert as_set(kept.select("reason", "sequence_number")) == as_set(decode.rejects(decoded).select("reason", "sequence_number"))


def test_intake_counts_without_a_job_of_its_own(spark, tmp_path, caplog):
    """What the log says of a batch is counted while it is written."""
    frames = feed.status_frames(read_table(spark, SF, "orders"))
    frames.repartition(3).write.parquet(str(tmp_path / "frames"))
    with caplog.at_level("INFO", logger="trackside.streaming.jobs"):
        main.main(["intake", "--frames", str(tmp_path / "frames"), "--out", str(tmp_path / "records"), "--rejects", str(tmp_path / "rejects"), "--checkpoint", str(tmp_path / "ck"), "--drain"])
    decoded = decode.decode_frames(read_frames(spark, str(tmp_path / "frames")))
    want = {r.reason: r["count"] for r in decoded.groupBy("reason").count().collect()}
    told = [r.getMessage() for r in caplog.records if r.name == "trackside.streaming.jobs"]
    assert len(told) == 1 and f"batch 0: {sum(want.values())} frames" in told[0]
    assert all(f"{reason} {n}" in told[0] for reason, n in want.items() if reason)


def test_messages_and_calls_programs(spark, tmp_path):
    table = read_table(spark, SF, "orders").limit(60)
    both = feed.status_documents(table).select("sequence_number", "xml").unionByName(m.schedule_documents(table).select("sequence_number", "xml"))
    feed.frames_of(both, "X").repartition(2).write.parquet(str(tmp_path / "frames"))
    shared = ["--frames", str(tmp_path / "frames"), "--drain"]
    main.main(["messages", *shared, "--out", str(tmp_path / "out"), "--rejects", str(tmp_path / "rejects"), "--checkpoint", str(tmp_path / "ck1"), "--tables", "schedules", "forecasts"])
    assert stores.read_batches(spark, str(tmp_path / "out/schedules")).count() == 60
    rows = messages.forecasts(feed.status_documents(table))
    assert stores.read_batches(spark, str(tmp_path / "out/forecasts")).count() == rows.count()
    main.main(["calls", *shared, "--out", str(tmp_path / "calls"), "--checkpoint", str(tmp_path / "ck2")])
    want = journey.match_calls(rows, messages.calling_points(m.schedule_documents(table)), matching.IDS)
    assert as_set(matching.read_matches(spark, str(tmp_path / "calls"))) == as_set(want)
    with pytest.raises(SystemExit):
        main.main(["messages", *shared])


def test_keyed_store(spark, tmp_path):
    def rows(*values):
        made = [json.dumps(dict(unique_id=u, location_code="A", schedule_id=s, sequence_number=n, source=v)) for u, s, n, v in values]
        return parse_records(spark.createDataFrame([(m.encode(),) for m in made], "value binary"))

    path = str(tmp_path / "raw")
    first = rows(("U1", "2", "9", "old"), ("U1", "1", "1", "x"), ("U2", "1", "1", "y"), (None, "1", "1", "nokey"))
    want = [("1", "x"), ("2", "new")]

    def looked_up():
        got = stores.read_key(spark, path, "U1", "A")
        assert [(r.schedule_id, r.source) for r in got.collect()] == want
        assert stores.read_keyed(spark, path).count() == 3
        return len(got.inputFiles())

    stores.append_keyed(first, 0, path)
    stores.append_keyed(rows(("U1", "2", "10", "new")), 1, path)
    stores.append_keyed(rows(("U1", "2", "10", "new")), 1, path)
    assert stores.broken_keys(first).count() == 1
    looked_up()
    stores.compact_keyed(spark, path, files=2)
    assert looked_up() == 1
    # the same sequence written again later replaces what was folded, an older one does not
    stores.append_keyed(rows(("U1", "2", "10", "again"), ("U1", "1", "0", "older")), 2, path)
    want = [("1", "x"), ("2", "again")]
    looked_up()
    # a batch that a version covers is run again: its rows are there already
    stores.compact_keyed(spark, path)
    stores.append_keyed(rows(("U1", "2", "10", "again"), ("U1", "1", "0", "older")), 2, path)
    looked_up()


def test_last_of_one_message_wins(spark):
    """Two records of one message with one key: the one written last stays."""
    made = [(json.dumps(dict(unique_id="U", location_code="A", schedule_id="1", sequence_number="5", scheduled_arrival=t)).encode(), n) for n, t in enumerate(("23:50", "00:40"))]
    parsed = parse_records(spark.createDataFrame(made, "value binary, offset long"), keep=("offset",))
    assert [r.scheduled_arrival for r in stores.last_written(parsed).collect()] == ["00:40"]


def test_store_stays_small_over_many_batches(spark, tmp_path):
    """Sixty small batches: few files, and a lookup opens at most two of each part."""
    path = str(tmp_path / "raw")
    names = [json.dumps(dict(unique_id=f"U{n % 7}", location_code="A", schedule_id="1", sequence_number=str(n), source=str(n))).encode() for n in range(60)]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for n, value in enumerate(names):
            stores.append_keyed(parse_records(spark.createDataFrame([(value,)], "value binary")), n, path, every=8)
            assert len(versions.open_batches(spark, path)) < 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r.unique_id: r.source for r in stores.read_keyed(spark, path).collect()} == {f"U{n % 7}": str(n) for n in range(53, 60)}
    info = versions.manifest(spark, path)
    opened = [f for f in stores.read_key(spark, path, "U3", "A").inputFiles() if "/parts/" in f]
    assert len(info["parts"]) <= 2 * versions.FAN and len(opened) <= len(info["parts"])
    assert len([f for f in (tmp_path / "raw").rglob("*.parquet")]) <= 2 * (8 + len(info["parts"]) + versions.FAN)


def keyed_batches(spark, path, n_batches, keys, per_batch):
    """Batch folders of a keyed store, all written by one job."""
    n = F.col("id")
    fields = {name: F.lit(None).cast("string") for name in RECORD_FIELDS} | {
        "unique_id": F.format_string("U%05d", (n * 7919) % keys),
        "location_code": F.lit("A"),
        "schedule_id": F.lit("1"),
        "sequence_number": n.cast("string"),
    }
    rows = spark.range(n_batches * per_batch).select(*[c.alias(name) for name, c in fields.items()], F.floor(n / per_batch).alias("batch_id"), F.lit("none").alias("query"))
    rows.repartition(1).write.partitionBy("query", "batch_id").parquet(f"{path}/batches")


def test_levels_write_a_row_a_few_times(spark, tmp_path):
    """A thousand batches: what is written grows with levels, not with the state, and readers see all."""
    path = str(tmp_path / "raw")
    keyed_batches(spark, path, 1000, 10**6, 5)
    want = as_set(stores.read_keyed(spark, path))
    for _ in range(20):
        stores.compact_keyed(spark, path, most=50)
    assert versions.open_batches(spark, path) == []
    info = versions.manifest(spark, path)
    # twenty parts of level 0, five merges into level 1, one into level 2
    assert sorted(part["level"] for part in info["parts"]) == [1, 2]
    assert info["written"] <= 5000 * (1 + 2)
    assert as_set(stores.read_keyed(spark, path)) == want and len(want) == 5000


def test_lookup_opens_two_files_of_a_part_at_most(spark, tmp_path):
    path = str(tmp_path / "raw")
    keyed_batches(spark, path, 6, 900, 2000)
    want = {key: as_set(stores.read_key(spark, path, key, "A")) for key in ("U00000", "U00444", "U00899", "none")}
    for _ in range(3):
        stores.compact_keyed(spark, path, files=8, most=2)
    info = versions.manifest(spark, path)
    assert len(info["parts"]) == 3 and all(len(part["files"]) == 8 for part in info["parts"])
    for key, rows in want.items():
        got = stores.read_key(spark, path, key, "A")
        assert as_set(got) == rows and len(rows) == (key != "none")
        assert key == "none" or len(got.inputFiles()) <= 2 * len(info["parts"])


def test_lookup_while_the_store_is_folded(spark, tmp_path, monkeypatch):
    """A fold that ends between a reader's manifest and its listing takes nothing away from it."""
    path = str(tmp_path / "raw")
    keyed_batches(spark, path, 6, 50, 40)
    stores.compact_keyed(spark, path, files=3, most=2)
    want = {f"U{k:05}": as_set(stores.read_key(spark, path, f"U{k:05}", "A")) for k in (0, 7, 31)}
    listed = versions.open_batches

    def late(session, place, info=None):
        if info is not None and not state["folding"]:
            state["folding"] = True
            stores.compact_keyed(session, place, files=7, most=2)
            state["folding"] = False
        return listed(session, place, info)

    state = {"folding": False}
    for key, rows in want.items():
        monkeypatch.setattr(versions, "open_batches", late)
        got = stores.read_key(spark, path, key, "A")
        monkeypatch.setattr(versions, "open_batches", listed)
        assert as_set(got) == rows and len(rows) == 1


def test_dated_store_over_many_batches(spark, tmp_path):
    """Two hundred batches over three days: few files, and a range read opens its days' files only."""
    path = tmp_path / "dated"
    n = F.col("id")
    at = F.expr("timestampadd(minute, id * 4 + id % 3 * 600, timestamp_ntz'2024-01-01 00:00:00')")
    rows = spark.range(200 * 5).select(n.alias("event"), at.alias("actual_arrival"), F.to_date(at).alias("arrival_date"), F.floor(n / 5).alias("batch_id"), F.lit("none").alias("query"))
    rows.repartition(1).write.partitionBy("query", "batch_id", "arrival_date").parquet(str(path / "batches"))
    told = rows.select("event", "actual_arrival")
    want = as_set(told)
    for _ in range(12):
        stores.compact_by_date(spark, str(path), most=16)
    assert len(versions.open_batches(spark, str(path))) == 8
    assert as_set(stores.read_by_date(spark, str(path))) == want
    info = versions.manifest(spark, str(path))
    days = {part["group"] for part in info["parts"]}
    assert len(days) <= 4 and len(info["parts"]) <= len(days) * 2 * versions.FAN and info["written"] <= 3 * 1000
    assert len(list((path / "parts").rglob("*.parquet"))) <= 2 * len(days) * 2 * versions.FAN
    for begin, end in (("2024-01-02 06:00:00", "2024-01-02 09:30:00"), ("2024-01-01 23:00:00", "2024-01-03 00:00:00"), ("2025-01-01 00:00:00", "2025-01-02 00:00:00")):
        got = stores.read_between(spark, str(path), begin, end)
        assert as_set(got) == as_set(told.where(f"actual_arrival >= timestamp_ntz'{begin}' and actual_arrival < timestamp_ntz'{end}'"))
        if begin < "2025":
            assert begin[:10] in {f.split("arrival_date=")[1][:10] for f in got.inputFiles()} <= {"2024-01-01", "2024-01-02"}
    with pytest.raises(ValueError):
        stores.read_between(spark, str(path), "soon", "2024-01-01")


def test_keyed_store_without_rows(spark, tmp_path):
    path = str(tmp_path / "raw")
    stores.append_keyed(parse_records(spark.createDataFrame([(b"not json",)], "value binary")), 0, path)
    assert stores.read_keyed(spark, path).collect() == []
    assert stores.read_key(spark, path, "U1", "A").collect() == []


def test_range_read_prunes_days(spark, tmp_path):
    rows = clean(parse_records(topic_records(read_table(spark, SF, "events"))))
    stores.write_by_date(rows, str(tmp_path / "dated"))
    want = rows.where("actual_arrival >= timestamp_ntz'2024-01-03 12:00:00' and actual_arrival < timestamp_ntz'2024-01-04 06:00:00'")
    for fold in (False, True):
        if fold:
            stores.compact_by_date(spark, str(tmp_path / "dated"))
        got = stores.read_between(spark, str(tmp_path / "dated"), "2024-01-03 12:00:00", "2024-01-04 06:00:00")
        assert as_set(got.select(*rows.columns)) == as_set(want)
        assert {f.split("arrival_date=")[1][:10] for f in got.inputFiles()} == {"2024-01-03", "2024-01-04"}


@pytest.mark.parametrize("separate", [False, True])
def test_store_program(spark, topic, tmp_path, separate):
    from trackside.streaming import main

    folder = {name: str(tmp_path / name) for name in ("raw", "clean", "rejects", "checkpoint")}
    argv = ["--files", topic, "--drain", "--console", *(["--separate"] if separate else [])]
    main.main([*argv, *[part for name, path in folder.items() for part in (f"--{name}", path)]])
    parsed = parse_records(spark.read.parquet(topic))
    assert as_set(stores.read_keyed(spark, folder["raw"])) == as_set(stores.upsert_view(parsed))
    assert stores.read_by_date(spark, folder["clean"]).count() == clean(parsed).count()


def test_store_program_arguments():
    from trackside.streaming import main

    args = main.arguments(["--servers", "b:9092", "--raw", "r", "--jdbc", "jdbc:x", "--checkpoint", "c"])
    assert (args.topic, args.table, args.starting, args.drain) == ("train_data", "train_schedule", "latest", False)
    with pytest.raises(SystemExit):
        main.arguments(["--raw", "r", "--clean", "c", "--checkpoint", "c"])


def test_jdbc_writer_options(monkeypatch, spark):
    """Without a database: what the writer asks the connector to do."""
    asked = {}
    from pyspark.sql.readwriter import DataFrameWriter

    def jdbc(self, url, table, mode=None, properties=None):
        asked.update(url=url, table=table, mode=mode, properties=properties, columns=self._df.columns, parts=self._df.rdd.getNumPartitions())

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    write = sinks.jdbc_writer("jdbc:x", "train_schedule", {"user": "u"}, connections=2, batch_column="batch")
    write(spark.range(10).repartition(6), 3)
    assert asked == {
        "url": "jdbc:x", "table": "train_schedule", "mode": "append", "properties": {"batchsize": "10000", "user": "u"},
        "columns": ["id", "batch"], "parts": 2,
    }


def test_state_stream_over_several_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = spark.range(300).selectExpr("id % 7 as k", "id as n", "if(id % 5 = 0, 'clear', 'set') as op")
    for part in range(3):
        rows.where(f"n % 3 = {part}").coalesce(1).write.mode("append").parquet(source)
    stream = stream_files(spark, source, rows.schema, max_files=1)
    sinks.drain(jobs.start_state(stream, ["k"], ["n"], str(tmp_path / "state"), str(tmp_path / "ck"), drain=True))
    got = {(r.k, r.n, r.op) for r in jobs.read_state(spark, str(tmp_path / "state"), ["k"], ["n"]).collect()}
    want = {}
    for n in range(300):
        want[n % 7] = (n % 7, n, "clear" if n % 5 == 0 else "set")
    assert got == set(want.values())


def test_fold_over_several_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = spark.range(90).selectExpr(
        "concat('k', id % 4) as k", "id as n", "if(id % 3 = 0, concat('at', id), null) as at", "if(id % 3 = 1, concat('et', id), null) as et",
        "id % 7 = 0 as at_removed",
    )
    for part in range(3):
        rows.where(f"n % 3 = {part}").coalesce(1).write.mode("append").parquet(source)
    stream = stream_files(spark, source, rows.schema, max_files=1)
    sinks.drain(jobs.start_times(stream, ["k"], ["n"], str(tmp_path / "state"), str(tmp_path / "ck"), every=2, drain=True))
    assert as_set(jobs.read_times(spark, str(tmp_path / "state"), ["k"])) == as_set(state.actual_times(rows, ["k"], ["n"]))


def test_requests_that_come_late(spark, tmp_path):
    """A first request that comes after its repeat, and one far older than what came before, both stay."""
    source = str(tmp_path / "in")
    for part in ([("S", "1", 50, "repeat"), ("S", "2", 51, "other")], [("S", "1", 49, "first"), (None, "9", 1, "no key")], [("S", "3", 1, "old")]):
        spark.createDataFrame(part, "request_source string, request_id string, n int, v string").coalesce(1).write.mode("append").parquet(source)
    stream = stream_files(spark, source, spark.read.parquet(source).schema, max_files=1)
    sinks.drain(jobs.start_requests(stream, ["n"], str(tmp_path / "state"), str(tmp_path / "ck"), drain=True))
    assert sorted(r.v for r in jobs.read_requests(spark, str(tmp_path / "state"), ["n"]).collect()) == ["first", "no key", "old", "other"]


def test_work_folder(spark, monkeypatch):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert landed(spark.range(5), "five").count() == 5


def test_spread(spark):
    assert spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(50)
    assert spread(many) is many


def test_table_stream_from_a_folder_of_files(spark, tmp_path):
    read_table(spark, SF, "events").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for folder in (SF, str(tmp_path)):
        out = str(tmp_path / ("out" + str(len(folder))))
        sinks.drain(sinks.start_batches(stream_table(spark, folder, "events"), sinks.file_writer(out), out + "-ck", drain=True))
        assert spark.read.parquet(out).count() == 1000


def test_topic_readers_ask_for_the_connector(spark):
    """The connector is not part of this image; the readers must get as far as looking for it."""
    for reader in (lambda: stream_topic(spark, max_offsets=10), lambda: read_topic(spark)):
        with pytest.raises(Exception, match="(?i)kafka"):
            reader()


def test_observed_counts(spark):
    assert sinks.counted(spark.range(3), "seen").count() == 3


def calls_of(spark, rows):
    """Calling points (rid, day, tpl, pos, wtd) as messages name them; the sequence is the last number of a row."""
    times = [f"cast(null as string) {name}" for name in ("wta", "wtp", "pta", "ptd")]
    made = spark.createDataFrame(rows, "rid string, ssd string, tpl string, pos int, wtd string, sequence_number long")
    return made.selectExpr("*", *times, "cast(null as timestamp_ntz) doc_ts")


def forecasts_of(spark, rows):
    times = [f"cast(null as string) {name}" for name in ("wta", "wtp", "pta", "ptd")]
    made = spark.createDataFrame(rows, "sequence_number long, rid string, ssd string, tpl string, wtd string")
    return made.selectExpr("*", *times, "cast(null as timestamp_ntz) doc_ts", "0 train_index", "0 location_index")


NO_CALLS, NO_FORECASTS = [("-", "2024-01-01", "T", 0, "00:00", 0)][:0], [(0, "-", None, "T", "00:00")][:0]


def test_rows_wait_for_their_schedule(spark, tmp_path):
    path = str(tmp_path)
    batches = [
        ([(1, "a", "2024-01-01", "X", "10:00"), (2, "b", "2024-01-01", "X", "11:00"), (3, None, None, "X", "10:00"), (4, "z", "2024-01-01", "X", "1:00")], NO_CALLS),
        ([(5, "a", "2024-01-01", "Y", "10:30")], [("a", "2024-01-01", "X", 0, "10:00", 100), ("a", "2024-01-01", "Y", 1, "10:30", 100)]),
        ([(6, "a", "2024-01-01", "X", "10:59")], [("b", "2024-01-01", "X", 7, "11:00", 101)]),
        (NO_FORECASTS, [("b", "2024-01-01", "X", 8, "11:00", 102)]),
    ]
    seen = []
    for n, (rows, points) in enumerate(batches):
        for _ in range(2):  # each batch is run again
            matching.match_batch(forecasts_of(spark, rows), calls_of(spark, points), n, path)
        seen.append({r.sequence_number: r.pos for r in matching.read_matches(spark, path).collect()})
    assert seen[0] == {1: None, 2: None, 3: None, 4: None}
    assert seen[1] == {1: 0, 2: None, 3: None, 4: None, 5: 1}
    assert seen[2] == {1: 0, 2: 7, 3: None, 4: None, 5: 1, 6: None}
    # a later schedule settles anew what still stands among the waiting rows
    assert seen[3] == {**seen[2], 2: 8}
    before = as_set(matching.read_matches(spark, path))
    matching.merge(spark, path)
    assert as_set(matching.read_matches(spark, path)) == before
    assert [r.sequence_number for r in versions.read(spark, f"{path}/waiting").collect()] == [4]


def test_what_waits_is_bounded_by_the_service_day(spark, tmp_path):
    path = str(tmp_path)
    for n in range(8):
        day = f"2024-01-{n + 1:02}"
        rows = [(10 * n + k, f"{day}-{k}", day, "X", "10:00") for k in range(3)]
        points = [(f"{day}-0", day, "X", n, "10:00", 1000 + n)]
        matching.match_batch(forecasts_of(spark, rows), calls_of(spark, points), n, path, every=1, keep_days=2)
    days = {part["group"] for name in ("waiting", "schedules") for part in versions.manifest(spark, f"{path}/{name}")["parts"]}
    assert days == {"2024-01-06", "2024-01-07", "2024-01-08"}
    got = {r.sequence_number: (r.pos, r.matched_by) for r in matching.read_matches(spark, path).collect()}
    assert got == {10 * n + k: (n, "wtd") if k == 0 else (None, None) for n in range(8) for k in range(3)}
