"""State, journeys and joins against plain Python on small tables, hot keys included."""

import collections
import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from trackside.operators import journey, reference, state
from trackside.plans.joins import asof_join, balanced_join, fits, hot_hashes, lookup_join
from trackside.session import work_root


def test_latest_and_ties(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), (None, 5, "o")], "k string, n int, v string")
    assert {tuple(r) for r in state.latest(rows, ["k"], ["n"]).collect()} == {("a", 2, "z"), ("b", None, "n"), (None, 5, "o")}
    assert {tuple(r) for r in state.first(rows, ["k"], ["n"]).collect()} == {("a", 1, "x"), ("b", None, "n"), (None, 5, "o")}


def test_order_by_text_is_refused(spark):
    rows = spark.createDataFrame([("a", "9"), ("a", "10")], "k string, sequence_number string")
    for fold in (state.latest, state.first):
        with pytest.raises(TypeError, match="sequence_number"):
            fold(rows, ["k"], ["sequence_number"])


def test_alarm_cleared_in_message_ten(spark):
    """Through frames, whose sequence is text: set in message 9, cleared in message 10."""
    from trackside.operators import decode, messages
    from trackside.testfeed import frames as feed

    uri = "http://www.thalesgroup.com/rtti/PushPort/v16"
    body = lambda inside: f'<Pport xmlns="{uri}" ts="2024-01-01T00:00:00" version="16.0"><uR><alarm>{inside}</alarm></uR></Pport>'
    docs = spark.createDataFrame([("9", body('<set id="1"><tyrellFeedFail/></set>')), ("10", body("<clear>1</clear>")), ("x", body("<clear>2</clear>"))], "sequence_number string, xml string")
    read = decode.read_documents(feed.frames_of(docs, "AL"))
    assert [(r.reason, r.sequence_number) for r in decode.rejects(read).collect()] == [("bad_sequence", "x")]
    assert state.set_clear_state(messages.alarms(read.where("reason is null")), ["id"]).collect() == []


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(30000).select((F.col("id") % 3 == 0).cast("string").alias("k"), F.col("id").alias("n"), F.lit("v").alias("v"))
    plan = state.latest(rows, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")  # printed top down: the partial one is below the exchange
    assert "Window" not in plan


def test_equal_rows_of_a_hot_key_stay_where_they_are(spark):
    """Ten thousand equal rows, of which no key or hash could tell one from another, are not shuffled."""
    rows = spark.range(10000, numPartitions=6).select(F.lit("hot").alias("k"), F.lit(1).alias("n"))
    rows = rows.unionByName(spark.range(300).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(2).alias("n")))
    rows = rows.unionByName(spark.range(500).select(F.lit(None).cast("string").alias("k"), F.lit(3).alias("n")))
    lookup = spark.createDataFrame([("hot", 7), ("k5", 8), (None, 9)], "k string, v int")
    assert len(hot_hashes(rows, ["k"])) == 2  # one of them that of no key
    got = collections.Counter(tuple(r) for r in balanced_join(rows, lookup, ["k"]).collect())
    want = {("hot", 1, 7): 10000, ("k5", 2, 8): 1, (None, 3, None): 500}
    assert {k: got[k] for k in want} == want and sum(got.values()) == 10800
    plan = balanced_join(rows, lookup, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
    assert hot_hashes(rows.limit(0), ["k"]) == [] and balanced_join(rows.limit(0), lookup, ["k"]).count() == 0


def order(n):
    return dt.datetime(2024, 1, 1, 0, 0, n)


SENT = [("1", order(1), 1, 0, False), ("1", order(5), 5, 0, False), ("2", order(1), 2, 0, False), ("3", order(1), 3, 0, False), ("3", order(2), 9, 0, True), ("4", order(3), 4, 0, False)]


def test_schedule_state(spark):
    puts = [("5", order(1), 6, 0, False, False), *[(*put, None) for put in SENT]]
    schedules = spark.createDataFrame(puts, "rid string, doc_ts timestamp_ntz, sequence_number long, item_index int, deleted boolean, is_active boolean")
    gone = spark.createDataFrame([("1", order(3), 3, 0), ("2", order(4), 4, 0), ("4", order(3), 4, 0)], "rid string, doc_ts timestamp_ntz, sequence_number long, item_index int")
    now = state.schedule_state(schedules, gone).collect()
    # 1 came back after its deactivation, 2 is gone, 3 is deleted, 4 was put and deactivated in one document, 5 is inactive
    assert [(r.rid, r.sequence_number) for r in now] == [("1", 5)]


def test_actual_time_withdrawn(spark):
    events = [
        ("a", 1, "10:00", None, None), ("a", 2, None, "10:05", None), ("a", 3, "10:07", None, True), ("a", 4, "10:09", None, False),
        ("b", 1, None, "11:00", None), ("b", 2, "11:02", None, None),
        ("c", 2, None, "12:00", None), ("c", 1, "12:01", None, True),
        ("d", 1, None, None, None),
    ]
    df = spark.createDataFrame(events, "k string, n int, et string, at string, at_removed boolean")
    got = {r.k: (r.at, r.et) for r in state.actual_times(df, ["k"], ["n"]).collect()}
    assert got == {"a": (None, "10:09"), "b": ("11:00", "11:02"), "c": ("12:00", "12:01"), "d": (None, None)}


def test_a_snapshot_says_all_there_is(spark):
    events = [("a", 1, None, "10:05", "update"), ("a", 2, "10:07", None, "snapshot"), ("b", 1, None, "11:00", "snapshot"), ("b", 2, "11:02", None, "update"), ("c", 1, "9:00", "9:01", "update"), ("c", 2, None, None, "snapshot")]
    df = spark.createDataFrame(events, "k string, n int, et string, at string, response string").withColumn("at_removed", F.lit(None).cast("boolean"))
    got = {r.k: (r.at, r.et) for r in state.actual_times(df, ["k"], ["n"]).collect()}
    assert got == {"a": (None, "10:07"), "b": ("11:00", "11:02"), "c": (None, None)}


def test_overlay(spark):
    rows = [("a", 1, 1, "snapshot"), ("a", 1, 0, "update"), ("b", 2, 1, "snapshot"), ("b", 1, 9, "update")]
    df = spark.createDataFrame(rows, "k string, t int, n int, response string")
    assert {(r.k, r.response) for r in state.overlay(df, ["k"], ["t", "n"]).collect()} == {("a", "update"), ("b", "snapshot")}


def test_requests(spark):
    rows = [("S", "1", 2), ("S", "1", 1), ("S", "2", 3), ("S", None, 4), ("S", None, 5), (None, None, 6)]
    df = spark.createDataFrame(rows, "request_source string, request_id string, n int")
    assert sorted(r.n for r in state.distinct_requests(df, ["n"]).collect()) == [1, 3, 4, 5, 6]


def test_cleared_loading(spark):
    key = ("1", "F", "A", None, "10:00", None, None, None)
    ddl = "rid string, fid string, tpl string, wta string, wtd string, wtp string, pta string, ptd string, doc_ts int, sequence_number int, item_index int, loadings array<struct<coach_number:string,loading:int>>"
    unknown = ("2", *key[1:])
    loadings = spark.createDataFrame(
        [(*key, 1, 1, 0, [("A", 10), ("B", 20)]), (*key, 2, 2, 0, [("B", 30)]), (*unknown, 1, 1, 0, [("Z", 5)])], ddl
    )
    formations = spark.createDataFrame(
        [("1", "F", 1, 1, 0, [("A",), ("B",), ("C",)])],
        "rid string, fid string, doc_ts int, sequence_number int, item_index int, coaches array<struct<coach_number:string>>",
    )
    got = {(r.rid, r.coach_number): r.loading for r in state.coach_loading_state(formations, loadings).collect()}
    assert got == {("1", "A"): None, ("1", "B"): 30, ("1", "C"): None, ("2", "Z"): 5}


def brute_days(clocks):
    day, last, out = 0, None, []
    for clock in clocks:
        if clock is not None:
            if last is not None and last - clock > 12 * 3600:
                day += 1
            last = clock
        out.append(day)
    return out


def test_journey_days_in_any_blocks(spark):
    rng = random.Random(7)
    journeys = {}
    for rid in ("hot", "a", "b", "c"):
        count = 400 if rid == "hot" else rng.randint(1, 30)
        at, clocks = rng.randrange(86400), []
        for _ in range(count):
            at += rng.randrange(60, 20000)
            clocks.append(None if rng.random() < 0.3 else at % 86400 // 60 * 60)
        journeys[rid] = clocks
    rows = [
        (rid, dt.date(2024, 1, 1), pos, None if c is None else f"{c // 3600:02d}:{c // 60 % 60:02d}", None, None, None, None)
        for rid, clocks in journeys.items()
        for pos, c in enumerate(clocks)
    ]
    points = spark.createDataFrame(rows, "rid string, ssd date, pos int, wta string, wtd string, wtp string, pta string, ptd string")
    want = {(rid, pos): day for rid, clocks in journeys.items() for pos, day in enumerate(brute_days(clocks))}
    for block in (1, 3, 64, 1024):
        got = {(r.rid, r.pos): r.day for r in journey.journey_days(points, block).collect()}
        assert got == want, block
    mixed = points.withColumn("rid", F.when(F.col("pos") % 2 == 0, F.col("rid")))
    assert mixed.where("rid is null").count() == journey.journey_days(mixed).where("rid is null and day is null").count()
    lost = points.limit(3).withColumn("rid", F.lit(None).cast("string"))
    assert [r.day for r in journey.journey_days(lost).collect()] == [None] * 3


def test_match_calls_by_brute_force(spark):
    rng = random.Random(3)

    def clock():
        return rng.choice([None, "10:00", "10:30", "11:00", "11:30"])

    points = [(rng.choice("RS"), rng.choice("AB"), n, clock(), clock(), clock(), clock(), clock()) for n in range(60)]
    rows = [(n, rng.choice("RST"), rng.choice("AB"), clock(), clock(), clock(), clock(), clock()) for n in range(80)]
    names = journey.INSTANCE_TIMES
    ddl = ", ".join(f"{n} string" for n in names)
    got = {
        r.id: (r.pos, r.matched_by)
        for r in journey.match_calls(
            spark.createDataFrame(rows, f"id int, rid string, tpl string, {ddl}"),
            spark.createDataFrame(points, f"rid string, tpl string, pos int, {ddl}"),
            ["id"],
        ).collect()
    }
    for n, rid, tpl, *clocks in rows:
        want = (None, None)
        for at, name in enumerate(names):
            hits = [p[2] for p in points if p[0] == rid and p[1] == tpl and clocks[at] is not None and p[3 + at] == clocks[at]]
            if hits:
                want = (min(hits), name)
                break
        assert got[n] == want


def test_via_texts_by_brute_force(spark):
    rng = random.Random(11)
    journeys = {f"J{n}": [rng.choice("ABCDE") for _ in range(rng.randint(2, 7))] for n in range(40)}
    points = [(rid, pos, tpl) for rid, calls in journeys.items() for pos, tpl in enumerate(calls)]
    rules = {(rng.choice("abcde"), rng.choice("ABCDE"), rng.choice("ABCDE"), rng.choice([None, *"ABCDE"])) for _ in range(60)}
    via = [(*rule, "via " + "".join(x or "-" for x in rule)) for rule in rules]
    got = reference.via_texts(
        spark.createDataFrame(points, "rid string, pos int, tpl string"),
        spark.createDataFrame(via, "at string, dest string, loc1 string, loc2 string, viatext string"),
        spark.createDataFrame([(t, t.lower()) for t in "ABCD"] + [("E", None)], "tpl string, crs string"),
    )
    want = set()
    for rid, calls in journeys.items():
        for tpl in set(calls) - {"E"}:
            for at, dest, loc1, loc2, text in via:
                if at == tpl.lower() and dest == calls[-1] and loc1 in calls:
                    after = calls[calls.index(loc1) + 1:]
                    if loc2 is None or loc2 in after:
                        want.add((rid, tpl, text))
    assert {(r.rid, r.tpl, r.viatext) for r in got.collect()} == want


def test_balanced_join_with_a_hot_key(spark):
    rows = spark.range(9000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k")
    )
    lookup = spark.range(600).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).union(
        spark.createDataFrame([("hot", -1)], "k string, v long")
    )
    plain = {tuple(r) for r in rows.join(lookup, "k", "left").select("n", "k", "v").collect()}
    for how, want in (("left", plain), ("inner", {r for r in plain if r[2] is not None})):
        joined = balanced_join(rows, lookup, ["k"], how)
        got = [tuple(r) for r in joined.select("n", "k", "v").collect()]
        assert len(got) == len(want) and set(got) == want
    mapped = rows.withColumn("m", F.create_map("k", "n"))
    assert balanced_join(mapped, lookup, ["k"]).count() == len(plain)
    semi = balanced_join(rows, lookup, ["k"], "left_semi").select("n").collect()
    assert len(semi) == sum(r[2] is not None for r in plain)


def test_lookup_join_with_repeated_and_missing_keys(spark):
    """Both ways of the join give the same rows where keys repeat in the lookup or are missing."""
    rows = spark.range(3000).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k1", 3), (None, 4)], "k string, v int")
    for how in ("left", "inner", "left_semi"):
        one, two = (lookup_join(rows, lookup, ["k"], how, max_rows=most) for most in (100, 1))
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())), how


def test_lookup_is_broadcast_only_when_small(spark):
    rows = spark.range(100).withColumn("k", F.col("id") % 10)
    small = spark.range(10).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    assert fits(small, 10) and not fits(small, 9)
    joined = lookup_join(rows, small, ["k"], max_rows=10)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    other = lookup_join(rows, small, ["k"], max_rows=9)
    assert sorted(map(tuple, other.collect())) == sorted(map(tuple, joined.collect()))


def test_names_and_corrections(spark):
    reasons = spark.createDataFrame([("late", 1), ("cancel", 1), ("late", 9)], "domain string, code int")
    late = spark.createDataFrame([(1, "late one")], "code int, reasontext string")
    cancelled = spark.createDataFrame([(1, "cancelled one")], "code int, reasontext string")
    texts = {(r.domain, r.code): r.reasontext for r in reference.with_reason_texts(reasons, late, cancelled).collect()}
    assert texts == {("late", 1): "late one", ("cancel", 1): "cancelled one", ("late", 9): None}


def asof_rows(spark, n, hot, slices):
    rng = random.Random(n)
    key = lambda: "hot" if rng.random() < hot else rng.choice([*"abcdef", None])
    left = [(k, key(), rng.choice([None, *range(50)])) for k in range(n)]
    right = [(key(), rng.choice([None, *range(50)]), k, rng.choice([None, f"v{k}"])) for k in range(n // 3)]
    got = asof_join(
        spark.createDataFrame(left, "id int, k string, at int").repartition(5),
        spark.createDataFrame(right, "k string, since int, n int, v string").repartition(3),
        ["k"], "at", "since", ["v"], ["n"], slices,
    )
    assert got.columns == ["id", "k", "at", "v"]
    want = []
    for i, k, at in left:
        before = [(since, n, v) for other, since, n, v in right if k is not None and other == k and at is not None and since is not None and since <= at]
        want.append((i, k, at, max(before, key=lambda r: r[:2])[2] if before else None))
    return sorted(map(str, map(tuple, got.collect()))), sorted(map(str, want))


@pytest.mark.parametrize("n, hot, slices", [(0, 0, 4), (1, 1, 3), (300, 0.0, 4), (600, 0.7, 16), (600, 1.0, 7)])
def test_asof_against_a_plain_search(spark, n, hot, slices):
    got, want = asof_rows(spark, n, hot, slices)
    assert got == want


def test_asof_cuts_a_hot_key(spark):
    """A key with nearly all rows is cut into stretches of time, each one task's work."""
    left = spark.range(20000).selectExpr("'x' as k", "id as at")
    right = spark.range(0, 20000, 1000).selectExpr("'x' as k", "id as since", "id as v")
    got = asof_join(left, right, ["k"], "at", "since", ["v"], slices=8)
    assert got.where("v <> at - at % 1000 or v is null").count() == 0
    cut = max(glob.glob(f"{work_root(spark)}/asof-*"), key=os.path.getmtime)
    sizes = [r["count"] for r in spark.read.parquet(cut).groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20020 / 8


def test_corrections_hold_from_their_time_on(spark):
    seen = spark.createDataFrame(
        [("AA", "0001", "1A01", t) for t in (0, 5, 9, 12, 20)] + [("AA", "0002", "1A01", 30), ("AA", "0001", "9Z99", 30), (None, "0001", "1A01", 30)],
        "area string, berth string, train_id string, at int",
    )
    fixes = spark.createDataFrame(
        [("AA", "0001", "1A01", "2B01", 5, 1), ("AA", "0001", "1A01", "2B02", 12, 2), ("AA", "0001", "1A01", "2B03", 12, 3)],
        "area string, berth string, incorrect_train_id string, correct_train_id string, since int, n int",
    )
    got = reference.correct_train_ids(seen, fixes, ["n"], "at", "since").collect()
    assert sorted((r.at, r.berth, r.shown_train_id) for r in got) == [
        (0, "0001", "1A01"), (5, "0001", "2B01"), (9, "0001", "2B01"), (12, "0001", "2B03"), (20, "0001", "2B03"),
        (30, "0001", "1A01"), (30, "0001", "9Z99"), (30, "0002", "1A01"),
    ]
    with pytest.raises(ValueError):
        reference.correct_train_ids(spark.readStream.format("rate").load().selectExpr("'a' area", "'b' berth", "'c' train_id", "timestamp at"), fixes, ["n"], "at", "since")
