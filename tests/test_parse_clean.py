"""Golden cases of record parsing and cleaning."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackside.functions.values import activity_codes, clock_seconds, near, to_long
from trackside.operators import clean as c
from trackside.operators.parse import decode_pairs, parse_records, parse_records_typed, schema_text, text_pairs
from trackside.operators.publish import to_records
from trackside.schemas import RECORD_FIELDS

BASE = {
    "sequence_number": "7",
    "schedule_id": "2024010100000013",
    "unique_id": "C00013",
    "service_start_date": "2024-01-01",
    "location_code": "ERROR",
    "scheduled_arrival": "23:59:30",
    "scheduled_departure": "00:01:30",
    "actual_arrival": "23:59",
    "actual_departure": "00:01",
    "platforms": "4",
    "estimated_time": "00:10",
    "source": "TD",
}


def records(spark, *values):
    rows = [(b'"k"', v if v is None or isinstance(v, bytes) else v.encode()) for v in values]
    return spark.createDataFrame(rows, "key binary, value binary")


def parsed_one(spark, value):
    return parse_records(records(spark, value)).collect()[0].asDict()


def cleaned(spark, today=False, **changes):
    return c.clean(parse_records(records(spark, json.dumps({**BASE, **changes}))), today).collect()


def test_fields_in_order(spark):
    assert parse_records(records(spark, json.dumps(BASE))).columns == RECORD_FIELDS


@pytest.mark.parametrize("value", ["not json", '{"unique_id": "C1"', None])
def test_malformed_json_is_a_row_of_nulls(spark, value):
    assert set(parsed_one(spark, value).values()) == {None}


def test_json_values_become_text(spark):
    row = parsed_one(spark, '{"platforms": 4, "source": null, "unique_id": "null", "location_code": {"a": 1}, "more": 1}')
    assert row["platforms"] == "4"
    assert row["source"] is None
    assert row["unique_id"] == "null"
    assert row["location_code"] == '{"a":1}'


def test_typed_parse(spark):
    good = parse_records_typed(records(spark, json.dumps(BASE))).collect()[0]
    assert (good.sequence_number, good.schedule_id) == (7, 2024010100000013)
    assert good.service_start_date == dt.date(2024, 1, 1)
    bad = parse_records_typed(records(spark, '{"schedule_id": "P1", "service_start_date": "x"}')).collect()[0]
    assert (bad.schedule_id, bad.service_start_date) == (None, None)


def test_times_around_midnight(spark):
    row = cleaned(spark)[0]
    assert row.scheduled_arrival == dt.datetime(2024, 1, 1, 23, 59, 30)
    assert row.scheduled_departure == dt.datetime(2024, 1, 2, 0, 1, 30)
    assert row.actual_departure == dt.datetime(2024, 1, 2, 0, 1)
    assert row.estimated_time == dt.datetime(2024, 1, 2, 0, 10)


def test_estimate_on_the_day_before(spark):
    row = cleaned(spark, scheduled_arrival="00:05", scheduled_departure="00:07", actual_arrival="00:05", estimated_time="23:58")[0]
    assert row.estimated_time == dt.datetime(2023, 12, 31, 23, 58)


def test_departure_is_the_reference_without_arrival(spark):
    row = cleaned(spark, scheduled_arrival=None, actual_arrival="00:01")[0]
    assert row.scheduled_departure == dt.datetime(2024, 1, 1, 0, 1, 30)
    assert row.actual_arrival == dt.datetime(2024, 1, 1, 0, 1)


@pytest.mark.parametrize("value", ["null", None, "", "25:99", "abc"])
def test_rows_without_required_time_go(spark, value):
    assert cleaned(spark, actual_arrival=value) == []


def test_null_text_is_exact_and_only_in_its_columns(spark):
    row = cleaned(spark, platforms="NULL", source="null", location_code="null")[0]
    assert (row.platforms, row.source, row.location_code) == ("NULL", None, "null")


def test_bad_numbers_become_null(spark):
    row = cleaned(spark, schedule_id="P20240101", sequence_number="1e3")[0]
    assert (row.schedule_id, row.sequence_number) == (None, None)


def test_numbers_lose_their_fraction(spark):
    cases = {"1.5": 1, ".5": 0, "1.": 1, "+1.5": 1, "-1.9": -1, " 1.5 ": 1, "1.5.2": None, "1.5a": None, "": None, " 12 ": 12, "9223372036854775808": None}
    df = spark.createDataFrame([(text,) for text in cases], "v string")
    assert [r[0] for r in df.select(to_long("v")).collect()] == list(cases.values())


def test_missing_service_date_never_means_today(spark):
    assert cleaned(spark, service_start_date=None) == []


def test_today_mode(spark):
    row = cleaned(spark, today=True, service_start_date="1999-01-01")[0]
    today = spark.sql("select current_date() as d").collect()[0].d
    assert row.actual_arrival.date() == today
    assert row.scheduled_departure.date() == today
    assert row.service_start_date == dt.date(1999, 1, 1)


def test_record_round_trip(spark):
    rows = parse_records(records(spark, json.dumps({**BASE, "unique_id": 'a"b', "source": None})))
    sent = to_records(rows)
    key, value = sent.collect()[0]
    assert json.loads(bytes(key).decode()) == 'a"b'
    assert json.loads(bytes(value).decode()) == {**BASE, "unique_id": 'a"b', "source": None}
    back = decode_pairs(sent).collect()[0]
    assert (back.key, back.source) == ('a"b', None)
    assert text_pairs(sent).columns == ["key", "value"]


def test_missing_key_is_json_null(spark):
    rows = parse_records(records(spark, '{"source": "TD"}'))
    sent = to_records(rows)
    assert bytes(sent.collect()[0].key) == b"null"
    assert decode_pairs(sent).collect()[0].key is None


@pytest.mark.parametrize("key, text", [(b'"null"', "null"), (b'"C1"', "C1"), (b"7", "7"), (b"C1", None)])
def test_keys_are_decoded_from_json(spark, key, text):
    pair = spark.createDataFrame([(key, b"{}")], "key binary, value binary")
    assert decode_pairs(pair).collect()[0].key == text


def test_json_is_parsed_once(spark):
    plan = c.clean(parse_records(records(spark, json.dumps(BASE))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_activity_codes(spark):
    df = spark.createDataFrame([("T -D",), ("  ",), ("TB",), (None,), ("T",)], "act string")
    assert [r[0] for r in df.select(activity_codes("act")).collect()] == [["T ", "-D"], ["  "], ["TB"], None, None]


def test_schema_text(spark):
    assert "key: binary" in schema_text(records(spark, "{}"))


CLOCK = st.builds(lambda h, m: f"{h:02d}:{m:02d}", st.integers(0, 23), st.integers(0, 59))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=st.lists(st.tuples(CLOCK, CLOCK), min_size=1, max_size=30))
def test_near_stays_within_half_a_day(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    on = [F.concat(F.lit("2024-03-10 "), F.col(x)).cast("timestamp_ntz") for x in "ab"]
    for row in df.select(near(on[0], on[1]).alias("a"), on[1].alias("b"), F.col("a").alias("t")).collect():
        assert abs(row.a - row.b) <= dt.timedelta(hours=12)
        assert row.a.strftime("%H:%M") == row.t


def test_clock_seconds(spark):
    df = spark.createDataFrame([("00:01",), ("23:59:59",), ("24:00",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(clock_seconds("t")).collect()] == [60, 86399, None, None, None]
