"""Work that is heavy per row is dealt out evenly and done once, whatever the files and the filters are."""

import glob

from pyspark.sql import functions as F

from trackside.operators import decode, journey, messages, quality
from trackside.plans import message_queries, state_queries
from trackside.session import work_dir
from trackside.sources.tables import ROWS_PER_TASK, dealt, dealt_stream, slices
from trackside.testfeed import fields as f
from trackside.testfeed import frames as feed
from trackside.testfeed import messages as m


def _orders(spark, count, files=1):
    """A folder with an ``orders`` table of ``count`` rows."""
    folder = work_dir(spark, "sf")
    rows = spark.range(count).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") * 7).alias("o_custkey"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(id % 10 as int))").alias("o_orderdate"),
    )
    rows.coalesce(files).write.parquet(f"{folder}/orders.parquet")
    return folder, spark.read.parquet(f"{folder}/orders.parquet")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tasks_grow_with_the_table(spark):
    _, table = _orders(spark, 2_000)
    cores = spark.sparkContext.defaultParallelism
    assert slices(table) == cores
    parts = dealt(table, rows_per_task=100).groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert len(parts) == 20 and max(row["count"] for row in parts) <= 110
    assert ROWS_PER_TASK <= 100_000


def test_a_stream_is_dealt_before_its_documents_are_made(spark):
    folder, _ = _orders(spark, 50)
    seen = []
    stream = dealt_stream(spark, folder, "orders")
    query = stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.rdd.getNumPartitions())).trigger(availableNow=True)
    query.option("checkpointLocation", work_dir(spark, "ck")).start().awaitTermination(60)
    assert seen == [spark.sparkContext.defaultParallelism]


def test_texts_are_made_once_and_after_the_deal(spark):
    folder, _ = _orders(spark, 20)
    for made in (message_queries.status_rows(spark, folder), message_queries.calling_points(spark, folder)):
        plan = _plan(made)
        assert "RLIKE" in plan and "RLIKE" not in plan[plan.index("Repartition") :]


def test_bodies_are_packed_once(spark):
    _, table = _orders(spark, 40)
    frames = feed.status_frames(table, broken=False)
    assert _plan(frames).count("deflate_batch(") == 1
    heads = {row["head"] for row in frames.select(F.hex(F.substring("body", 1, 1)).alias("head")).collect()}
    assert heads == {"1F", "78"}
    assert decode.decode_frames(frames).where("reason is not null").count() == 0


def test_only_what_is_spoiled_is_searched(spark):
    _, table = _orders(spark, 60)
    docs = feed.spoiled_documents(table)
    assert '"$0"' not in _plan(docs) and "ELSE $0" not in _plan(docs)
    spoiled = quality.broken_rules(messages.forecasts(docs), "forecast").where("array_contains(broken, 'ssd')")
    assert {row["sequence_number"] for row in spoiled.select("sequence_number").collect()} == set(range(0, 60, 5))


def test_match_calls_in_slices(spark):
    points = spark.createDataFrame(
        [("r1", "A", 0, None, "10:00"), ("r1", "A", 4, "11:00", None), (None, "A", 0, None, "10:00")],
        "rid string, tpl string, pos int, wta string, wtd string",
    )
    rows = spark.createDataFrame(
        [(1, "r1", "A", "11:00", None), (2, "r1", "A", None, "10:00"), (3, None, "A", None, "10:00"), (4, "r1", None, None, "10:00"), (5, "r2", "A", None, "10:00")],
        "id int, rid string, tpl string, wta string, wtd string",
    )
    none = {name: F.lit(None).cast("string") for name in ("wtp", "pta", "ptd")}
    met = journey.match_calls(rows.withColumns(none), points.withColumns(none), ["id"], slices=3)
    found = {row["id"]: (row["pos"], row["matched_by"]) for row in met.collect()}
    assert found == {1: (4, "wta"), 2: (0, "wtd"), 3: (None, None), 4: (None, None), 5: (None, None)}
    # Rows that can meet nothing go past the join.
    assert "isnull(rid" in _plan(met).lower()


def test_the_matching_stream_is_fed_rows_not_texts(spark):
    folder, _ = _orders(spark, 24)
    found = state_queries.instance_match_stream(spark, folder).collect()
    root = spark.conf.get("spark.checkpoint.dir")
    fed = [path for path in glob.glob(f"{root}/matching-*/*") if path.endswith(("/orders", "/documents"))]
    assert fed and all("xml" not in spark.read.parquet(path).columns for path in fed)
    assert sorted(map(str, found)) == sorted(map(str, state_queries.instance_match(spark, folder).collect()))


def test_a_timetable_has_more_files_the_more_orders(spark):
    from trackside.testfeed import timetable as files

    _, table = _orders(spark, 400)
    path = work_dir(spark, "timetable")
    files.write_timetable(dealt(table, rows_per_task=20), path)
    assert len(glob.glob(f"{path}/*.txt")) == 40
    assert m.schedule_documents(table).count() == 400


def test_values_are_spoiled_once(spark):
    _, table = _orders(spark, 20)
    docs = feed.spoiled_documents(table)
    assert docs.columns == ["sequence_number", "xml", "feed_version"]
    assert _plan(messages.forecasts(docs)).count("regexp_replace(xml") == len(feed.SPOILED)


def test_spoiling_begins_with_plain_text(spark):
    # A pattern that begins with a group is tried at every character.
    assert not [name for name, (_, _, pattern, _) in feed.SPOILED.items() if pattern.startswith("(")]
    docs = spark.createDataFrame([(k, None) for k in range(60)], "o_orderkey long, o_custkey long").withColumn("o_orderdate", F.lit("2024-01-01"))
    docs = docs.withColumn("o_custkey", F.col("o_orderkey"))
    texts = {row["sequence_number"]: row["xml"] for row in feed.spoiled_documents(docs).collect()}
    assert all(' ssd="x2024-01-01"' in texts[k] for k in range(0, 60, 5)) and ' ssd="2024-01-01"' in texts[1]
    assert ">99999</" in texts[9] and ">118</" in texts[18] and ' platsup="sometimes"' in texts[1]


def test_clock_times_are_looked_up(spark):
    body = f"concat({f.wta('i')}, {f.wtd('i')}, {f.et('i')})"
    assert "get(clocks" in feed.looked_up(body) and f.hhmm(f.minute("i")) in feed.looked_up(body)
    rows = spark.createDataFrame([(k,) for k in [None, *range(-40, 1_500)]], "o_orderkey long")
    plain = F.expr(f"array_join(transform(sequence(0, 3), i -> {body}), '')")
    both = rows.select(F.expr(feed.repeated("4", body)).alias("quick"), plain.alias("plain"))
    assert both.where("not (quick <=> plain)").count() == 0
    # Other bodies stay as they are.
    assert feed.looked_up(f.hhmm("7")) == f.hhmm("7")


def test_calls_are_looked_through_once(spark):
    calls = "array<struct<tpl:string,rank:int,clock:string,pos:int>>"
    times = ", ".join(f"{name} string" for name in journey.INSTANCE_TIMES)
    met = [("A", 4, "10:00", 1), ("A", 1, "09:00", 2), ("B", 0, "08:00", 3), ("A", 0, "08:00", 5)]
    rows = spark.createDataFrame(
        [
            (1, "A", met, "08:00", "09:00", None, None, "10:00"),  # the most usual time first
            (2, "A", met, "07:00", "09:00", None, None, "10:00"),  # then the next that meets one
            (3, "A", met, None, None, None, None, "10:00"),
            (4, "B", met, None, "09:00", None, None, None),
            (5, None, met, "08:00", None, None, None, None),
            (6, "A", None, "08:00", None, None, None, None),
            (7, "A", [], "08:00", None, None, None, None),
            (8, "A", [("A", 0, None, 1)], None, None, None, None, None),
        ],
        f"id int, tpl string, calls {calls}, {times}",
    )
    at_place = rows.select("id", journey.best_call("calls", at_place=True).alias("best"))
    found = {row["id"]: row["best"] and tuple(row["best"]) for row in at_place.collect()}
    assert found == {1: (5, "wtd"), 2: (2, "wta"), 3: (1, "pta"), 4: None, 5: None, 6: None, 7: None, 8: None}
    anywhere = rows.where("id = 5").select(journey.best_call("calls", at_place=False).alias("best")).first()["best"]
    assert tuple(anywhere) == (3, "wtd")
    # The times see the calls at the place by the name they have within the expression.
    assert _plan(at_place).lower().count("filter(calls") == 1
