"""Golden cases of the message kinds, on documents as they may be sent: indented, prefixed, with gaps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trackside.functions import xml
from trackside.functions.xml import fragments
from trackside.operators import messages as m
from trackside.operators import quality

STEM = "http://www.thalesgroup.com/rtti/PushPort/"


def docs(spark, *bodies, version=16, kind="uR", attrs=""):
    made = [
        (
            n,
            f'<?xml version="1.0"?>\n<Pport xmlns="{STEM}v{version}" xmlns:x="{STEM}Part/v1" ts="2024-01-01T10:00:0{n}" version="16.0">\n'
            f"  <{kind}{attrs}>\n    {body}\n  </{kind}>\n</Pport>",
        )
        for n, body in enumerate(bodies)
    ]
    return spark.createDataFrame(made, "sequence_number long, xml string")


def test_envelope(spark):
    body = '<schedule rid="1"/><TS rid="1"/><TS rid="2"/><alarm><x:clear>1</x:clear></alarm>'
    (row,) = m.envelopes(docs(spark, body, attrs=' updateOrigin="CIS" requestSource="AA01" requestID="9"')).collect()
    assert (row.response, row.update_origin, row.request_source, row.request_id) == ("update", "CIS", "AA01", "9")
    assert (row.n_schedule, row.n_TS, row.n_alarm, row.n_OW, row.feed_version) == (1, 2, 1, 0, 16)
    (row,) = m.envelopes(docs(spark, body, kind="sR")).collect()
    assert (row.response, row.update_origin, row.n_TS) == ("snapshot", None, 2)


def test_forecast_attributes(spark):
    body = """<TS rid="1" uid="C00001" ssd="2024-01-01" isReverseFormation="1">
      <x:LateReason tiploc="AB" near="true">104</x:LateReason>
      <x:Location tpl="A" wtp="10:00:30"><x:pass at="10:01" atRemoved="false" atClass="Automatic" etmin="10:00" etUnknown="true" delayed="0" src="TD" srcInst="AA01" wet="10:02"/>
        <x:length>8</x:length><x:detachFront>true</x:detachFront></x:Location>
      <x:Location tpl="B"><x:length>many</x:length></x:Location></TS>"""
    a, b = m.forecasts(docs(spark, body)).orderBy("location_index").collect()
    assert (a.late_reason, a.late_reason_tiploc, a.late_reason_near, a.is_reverse_formation) == (104, "AB", True, True)
    assert a.passing.asDict() == dict(
        et=None, wet="10:02", at="10:01", at_removed=False, at_class="Automatic", etmin="10:00", et_unknown=True,
        delayed=False, src="TD", src_inst="AA01", malformed=[],
    )
    assert (a.malformed, b.malformed) == ([], ["length"])
    assert (a.wtp, a.length, a.detach_front, a.arr) == ("10:00:30", 8, True, None)
    assert (b.passing, b.length, b.tpl) == (None, None, "B")
    (event,) = m.forecast_events(m.forecasts(docs(spark, body))).collect()
    assert (event.event, event.at, event.tpl) == ("pass", "10:01", "A")


def test_calling_points_keep_their_order(spark):
    body = """<schedule rid="1" uid="C00001" trainId="1A01" ssd="2024-01-01" toc="AA">
      <x:OR tpl="A" act="TB" wtd="10:00"/> <x:PP tpl="B" wtp="10:05"></x:PP>
      <x:IP tpl="C" act="T " wta="10:10" wtd="10:11" rdelay="-2"/><x:OPIP tpl="D" wta="1" wtd="2"/><x:PP tpl="E"/>
      <x:OPDT tpl="F" wta="10:30"/><x:cancelReason>501</x:cancelReason></schedule>
      <schedule rid="2"><x:OPOR tpl="Z"/><x:DT tpl="Y"/></schedule>"""
    got = m.calling_points(docs(spark, body)).orderBy("item_index", "pos").collect()
    assert [(r.rid, r.pos, r.kind, r.tpl) for r in got] == [
        ("1", 0, "OR", "A"), ("1", 1, "PP", "B"), ("1", 2, "IP", "C"), ("1", 3, "OPIP", "D"), ("1", 4, "PP", "E"),
        ("1", 5, "OPDT", "F"), ("2", 0, "OPOR", "Z"), ("2", 1, "DT", "Y"),
    ]
    assert (got[2].act, got[2].rdelay) == ("T ", -2)
    one, two = m.schedules(docs(spark, body)).orderBy("item_index").collect()
    assert (one.points, one.cancel_reason, two.points, two.cancel_reason) == (6, 501, 2, None)


def test_kind_names_in_text_are_left_alone(spark):
    body = '<schedule rid="1"><x:OR tpl="&lt;OR "/><x:ORX tpl="no"/><x:DT tpl="B"/></schedule>'
    assert [(r.kind, r.tpl) for r in m.calling_points(docs(spark, body)).orderBy("pos").collect()] == [("OR", "<OR "), ("DT", "B")]


def test_reasons_of_both_lists(spark):
    late = '<TS rid="1"><x:LateReason>100</x:LateReason></TS><TS rid="2"/>'
    cancelled = '<schedule rid="3"><x:OR tpl="A"/><x:cancelReason tiploc="B" near="true">100</x:cancelReason></schedule>'
    got = {(r.rid, r.domain, r.code, r.tiploc, r.near) for r in m.reasons(docs(spark, late, cancelled)).collect()}
    assert got == {("1", "late", 100, None, None), ("3", "cancel", 100, "B", True)}


def test_formations_and_loading(spark):
    formation = """<scheduleFormations rid="1"><x:formation fid="F1" src="D"><x:coaches>
      <x:coach coachNumber="A" coachClass="First"/><x:coach coachNumber="B"><x:toilet status="NotInService">Standard</x:toilet></x:coach>
      <x:coach coachNumber="C"><x:toilet>None</x:toilet></x:coach></x:coaches></x:formation></scheduleFormations>"""
    rows = m.coaches(m.formations(docs(spark, formation)))
    assert [tuple(r) for r in rows.select("coach_number", "coach_class", "toilet", "toilet_status").collect()] == [
        ("A", "First", None, None), ("B", None, "Standard", "NotInService"), ("C", None, "None", None),
    ]
    filled = quality.fill_defaults(rows, "coach").select("toilet", "toilet_status").collect()
    assert tuple(filled[0]) == ("Unknown", "InService")
    loading = '<formationLoading fid="F1" rid="1" tpl="A" wtd="10:00"><x:loading coachNumber="A" src="X" srcInst="Y">40</x:loading></formationLoading><formationLoading fid="F2" rid="1" tpl="A"/>'
    messages = m.loadings(docs(spark, loading))
    assert messages.count() == 2
    (value,) = m.coach_loadings(messages).collect()
    assert (value.coach_number, value.loading, value.src, value.src_inst, value.wtd) == ("A", 40, "X", "Y", "10:00")


def test_station_messages(spark):
    body = """<OW id="7" cat="Station" sev="2" suppress="true"><x:Station crs="AAA"/><x:Station crs="BBB"/>
      <x:Msg>Fish &amp; <x:p>chips &lt;hot&gt; <x:a href="http://a/?x=1&amp;y=2">here</x:a></x:p></x:Msg></OW>
      <OW id="8" cat="Misc" sev="0"><x:Msg>all</x:Msg></OW><OW id="9" cat="Misc" sev="0"><x:Station crs="CCC"/><x:Msg/></OW>"""
    got = m.station_messages(docs(spark, body)).orderBy("id", "crs").collect()
    assert [(r.id, r.crs, r.suppress) for r in got] == [(7, "AAA", True), (7, "BBB", True), (8, None, None), (9, "CCC", None)]
    assert got[0].body == "Fish & chips <hot> here"
    assert got[0].links == ["http://a/?x=1&y=2"]
    assert got[3].body == ""
    assert got[0].doc_ts == dt.datetime(2024, 1, 1, 10, 0, 0)


def test_train_alerts(spark):
    def alert(services):
        return (
            f"<trainAlert><x:AlertID>1</x:AlertID><x:AlertServices>{services}</x:AlertServices><x:SendAlertBySMS>true</x:SendAlertBySMS>"
            "<x:AlertText>late</x:AlertText><x:Audience>Staff</x:Audience></trainAlert>"
        )

    two = '<x:AlertService RID="R" UID="U" SSD="2024-01-01"><x:Location>A</x:Location><x:Location>B</x:Location></x:AlertService>'
    got = m.train_alerts(docs(spark, alert(two), alert(""))).orderBy("sequence_number", "location").collect()
    assert [(r.rid, r.location, r.by_sms, r.audience) for r in got] == [
        ("R", "A", True, "Staff"), ("R", "B", True, "Staff"), (None, None, True, "Staff"),
    ]


def test_train_order(spark):
    body = """<trainOrder tiploc="T" crs="AAA" platform="1"><x:set><x:first><x:rid wtd="10:00">R1</x:rid></x:first>
      <x:second><x:trainID>1A01</x:trainID></x:second></x:set></trainOrder>
      <trainOrder tiploc="T" crs="AAA" platform="2"><x:clear/></trainOrder>"""
    rows = m.train_orders(m.train_order_events(docs(spark, body))).orderBy("platform", "place").collect()
    assert [(r.platform, r.op, r.place, r.rid, r.wtd, r.train_id) for r in rows] == [
        ("1", "set", 1, "R1", "10:00", None), ("1", "set", 2, None, None, "1A01"), ("2", "clear", None, None, None, None),
    ]


def test_tracking_alarm_deactivation_association(spark):
    d = docs(
        spark,
        '<trackingID><x:berth area="AB">0001</x:berth><x:incorrectTrainID>1A01</x:incorrectTrainID><x:correctTrainID>1A02</x:correctTrainID></trackingID>',
        '<alarm><x:set id="5"><x:tdAreaFail>AB</x:tdAreaFail></x:set></alarm><alarm><x:set id="6"><x:tyrellFeedFail/></x:set></alarm><alarm><x:clear>5</x:clear></alarm>',
        '<deactivated rid="1"/><deactivated rid="2"/>',
        '<association tiploc="A" category="JJ" isDeleted="true"><x:main rid="1" wta="10:00"/><x:assoc rid="2" ptd="10:05"/></association>',
    )
    (fix,) = m.tracking_ids(d).collect()
    assert (fix.area, fix.berth, fix.incorrect_train_id, fix.correct_train_id) == ("AB", "0001", "1A01", "1A02")
    assert [(r.op, r.id, r.kind, r.area) for r in m.alarms(d).orderBy("item_index").collect()] == [
        ("set", "5", "td_area_fail", "AB"), ("set", "6", "tyrell_feed_fail", None), ("clear", "5", None, None),
    ]
    assert [r.rid for r in m.deactivations(d).orderBy("item_index").collect()] == ["1", "2"]
    (link,) = m.associations(d).collect()
    assert (link.main_rid, link.main_wta, link.assoc_rid, link.assoc_ptd, link.is_deleted, link.is_cancelled) == ("1", "10:00", "2", "10:05", True, None)


def test_failure(spark):
    xml = f'<Pport xmlns="{STEM}v16" ts="2024-01-01T10:00:00" version="16.0"><FailureResp code="E1" requestSource="AA01" requestID="3">no</FailureResp></Pport>'
    (row,) = m.failures(spark.createDataFrame([(1, xml)], "sequence_number long, xml string")).collect()
    assert (row.code, row.message, row.request_source, row.request_id) == ("E1", "no", "AA01", "3")


def test_versions(spark):
    body = '<TS rid="1"><x:Location tpl="A"><x:arr et="1" wet="2" atClass="X"/></x:Location></TS>'
    seen = {}
    tables = []
    for version in (11, 12, 13, 16):
        events = m.only_in_version(m.forecast_events(m.forecasts(docs(spark, body, version=version, attrs=' updateOrigin="D"'))))
        tables.append(events.drop("wet") if version == 11 else events)
        (row,) = events.collect()
        seen[version] = (row.feed_version, row.update_origin, row.et, row.wet, row.at_class)
    assert seen == {
        11: (11, None, "1", None, None), 12: (12, "D", "1", "2", None), 13: (13, "D", "1", "2", "X"), 16: (16, "D", "1", "2", "X"),
    }
    assert {r.wet for r in m.union_versions(*tables).collect()} == {None, "2"}


def test_defaults_rules_and_display(spark):
    rows = spark.createDataFrame(
        [("1", "C00001", "P", None, None, None, "10:00", None), ("12345678901234567", "C1", "Q", "1234", True, True, "1", True)],
        "rid string, uid string, platsrc string, platform string, platsup boolean, suppr boolean, et string, delayed boolean",
    )
    checked = quality.broken_rules(rows, {"rid": "rid", "uid": "uid", "platsrc": "platsrc", "platform": "platform", "et": "public_time"})
    assert [r.rid for r in quality.valid_rows(checked).collect()] == ["1"]
    assert {r.rule for r in quality.invalid_rows(checked).collect()} == {"rid", "uid", "platsrc", "platform", "et"}
    (shown,) = quality.for_display(rows).collect()
    assert (shown.rid, shown.shown_estimate) == ("1", "10:00")
    assert [r.platsup for r in quality.fill_defaults(rows, "forecast").collect()] == [False, True]


def test_pattern_rules_match_whole_values(spark):
    df = spark.createDataFrame([("1A01",), ("1A01x",), ("x1A01",), ("1A01\n",)], "t string")
    assert [r[0] for r in df.select(quality.breaks("t", "train_id")).collect()] == [False, True, True, True]


def test_malformed_values_are_reported_and_not_filled(spark):
    body = """<TS rid="1" uid="C00001" ssd="2024-13-45" isReverseFormation="maybe"><x:LateReason near="x">99999</x:LateReason>
      <x:Location tpl="A"><x:arr et="10:00" delayed="soon" atRemoved="2" etUnknown="?"/><x:plat platsup="x" cisPlatsup="y" conf="z">1</x:plat>
      <x:suppr>maybe</x:suppr><x:length>abc</x:length><x:detachFront>?</x:detachFront></x:Location><x:Location tpl="B"/></TS>
      <schedule rid="1" ssd="x" isActive="x" deleted="x" qtrain="x" can="x" isCharter="x" isPassengerSvc="x"><x:OR tpl="A" rdelay="x" can="x" avgLoading="x"/>
      <x:cancelReason near="x">x</x:cancelReason></schedule><association isCancelled="x" isDeleted="x"><x:main rid="1"/></association>
      <formationLoading fid="F"><x:loading coachNumber="A">x</x:loading><x:loading coachNumber="B">3</x:loading></formationLoading>
      <OW id="x" suppress="x"><x:Msg/></OW><trainAlert><x:AlertServices><x:AlertService SSD="x"/></x:AlertServices><x:SendAlertBySMS>x</x:SendAlertBySMS></trainAlert>"""
    d = docs(spark, body)
    a, b = m.forecasts(d).orderBy("location_index").collect()
    head = {"ssd", "is_reverse_formation", "late_reason", "late_reason_near"}
    assert set(a.malformed) == head | {"platsup", "cis_platsup", "conf", "suppr", "length", "detach_front"} and set(b.malformed) == head
    filled = {r.tpl: r for r in quality.fill_defaults(m.forecasts(d), "forecast").collect()}
    assert (filled["A"].length, filled["A"].suppr, filled["B"].length, filled["B"].suppr) == (None, None, 0, False)
    (event,) = m.forecast_events(m.forecasts(d)).collect()
    assert {"delayed", "at_removed", "et_unknown", "length"} <= set(event.malformed)
    assert {r.rule for r in quality.invalid_rows(quality.broken_rules(m.forecasts(d), "forecast")).collect()} == set(a.malformed)
    (schedule,) = m.schedules(d).collect()
    assert set(schedule.malformed) == {"ssd", "is_active", "deleted", "qtrain", "can", "is_charter", "is_passenger_svc", "cancel_reason", "cancel_reason_near"}
    assert set(m.calling_points(d).first().malformed) == {"rdelay", "can", "avg_loading"}
    assert {tuple(r.malformed) for r in m.reasons(d).collect()} == {("code", "near")}
    assert set(m.associations(d).first().malformed) == {"is_cancelled", "is_deleted"}
    assert [r.malformed for r in m.coach_loadings(m.loadings(d)).orderBy("coach_number").collect()] == [["loading"], []]
    assert set(m.station_messages(d).first().malformed) == {"id", "suppress"}
    assert set(m.train_alerts(d).first().malformed) == {"by_sms", "ssd"}


def test_one_parse_gives_the_same_tables(spark):
    """Tables from documents parsed once for all kinds, and from the documents themselves."""
    from trackside.streaming.jobs import TABLES

    d = docs(
        spark,
        '<TS rid="1"><x:LateReason>100</x:LateReason><x:Location tpl="A"><x:arr et="10:00"/></x:Location></TS><deactivated rid="1"/>',
        '<schedule rid="3"><x:OR tpl="A"/><x:PP tpl="B"/><x:DT tpl="C"/><x:cancelReason>5</x:cancelReason></schedule><alarm><x:clear>5</x:clear></alarm>',
        '<OW id="7" cat="Station" sev="2"><x:Station crs="AAA"/><x:Msg>a <x:p>b</x:p></x:Msg></OW><association tiploc="A"><x:main rid="1"/></association>',
        '<trackingID><x:berth area="AB">1</x:berth></trackingID><trainOrder tiploc="T"><x:clear/></trainOrder><trainAlert><x:AlertID>1</x:AlertID></trainAlert>',
        '<formationLoading fid="F"><x:loading coachNumber="A">4</x:loading></formationLoading><scheduleFormations rid="1"><x:formation fid="F"><x:coaches><x:coach coachNumber="A"/></x:coaches></x:formation></scheduleFormations>',
        "",
    )
    kinds = [*m.ENTRIES, "OW"]
    parsed = m.parse_documents(d, kinds).cache()
    for name, (_, table) in TABLES.items():
        assert sorted(map(str, table(parsed).collect())) == sorted(map(str, table(d).collect())), name
    assert [r.sequence_number for r in m.without_kind(parsed, kinds).collect()] == [5]
    assert [r.response for r in m.station_messages(d).collect()] == ["update"]


def test_odd_but_legal_xml(spark):
    """Prefixes with signs, a closing bracket inside a quoted value, self-closed and unclosed elements."""
    body = """<schedule rid="1"><x-1.a:OR tpl="A>B" wtd="10:00"/><x-1.a:DT tpl="B"></x-1.a:DT></schedule>"""
    d = docs(spark, body).withColumn("xml", F.replace("xml", F.lit("xmlns:x="), F.lit('xmlns:x-1.a="u" xmlns:x=')))
    assert [(r.kind, r.tpl) for r in m.calling_points(d).orderBy("pos").collect()] == [("OR", "A>B"), ("DT", "B")]
    text = spark.createDataFrame([('<p-q:J a=">"/><J b="1">x</J><J c="/">y</J><JK/><J d="never closed"><J>z</J>',)], "t string")
    assert text.select(fragments(F.col("t"), "J")).first()[0] == ['<p-q:J a=">"/>', '<J b="1">x</J>', '<J c="/">y</J>', "<J>z</J>"]
    long = spark.createDataFrame([("<J " + 'a="b" ' * 20000 + ">" + "x" * 500000 + "</J>",)], "t string")
    assert long.select(F.size(fragments(F.col("t"), "J"))).first()[0] == 1


def test_usable_schedules(spark):
    df = spark.createDataFrame(
        [(1, None, None, None), (2, True, None, True), (3, False, True, None), (4, None, None, False)], "id int, deleted boolean, qtrain boolean, is_active boolean"
    )
    assert [r.id for r in quality.usable_schedules(df).collect()] == [1]


def test_rules_fit_their_tables(spark):
    """Every rule names a column of its table and a known facet."""
    from trackside.schemas import FACETS, RULES

    d = docs(spark, "")
    tables = {
        "envelope": m.envelopes(d),
        "forecast": m.forecasts(d),
        "forecast_event": m.forecast_events(m.forecasts(d)),
        "schedule": m.schedules(d),
        "calling_point": m.calling_points(d),
        "association": m.associations(d),
        "coach": m.coaches(m.formations(d)),
        "coach_loading": m.coach_loadings(m.loadings(d)),
        "station_message": m.station_messages(d),
        "train_alert": m.train_alerts(d),
        "train_order": m.train_orders(m.train_order_events(d)),
        "tracking_id": m.tracking_ids(d),
        "alarm": m.alarms(d),
    }
    assert set(tables) == set(RULES)
    for name, rules in RULES.items():
        assert set(rules) <= set(tables[name].columns), name
        assert set(rules.values()) <= set(FACETS), name
        assert quality.invalid_rows(quality.broken_rules(tables[name], name)).count() == 0


GOLDEN_BODIES = [
    ("caf&#233; &#xE9;t&#x00e9; &#128646;", "café été \U0001f686", []),
    ("a &amp;lt; b &amp;#233; &lt;p&gt;", "a &lt; b &#233; <p>", []),
    ("&eacute; &#0; &#xD800; &#x110000; &;", "&eacute; &#0; &#xD800; &#x110000; &;", []),
    ("<![CDATA[1 < 2 & <a href=\"no\">x</a> &amp;]]> <b>so</b>", "1 < 2 & <a href=\"no\">x</a> &amp; so", []),
    ("see <a href='one?a=1&amp;b=2'>one</a>, <ns:a title=\"a>b\" href=\"two\">two</ns:a>", "see one, two", ["one?a=1&b=2", "two"]),
    ("no <!-- <a href=\"hidden\"> --> link, href=\"text\", <abbr href=\"x\">y</abbr>", "no  link, href=\"text\", y", []),
    ("1 & 2 < 3", "1 & 2 < 3", []),
    ("", "", []),
]


@pytest.mark.parametrize("body, text, targets", GOLDEN_BODIES)
def test_bodies_of_station_messages(spark, body, text, targets):
    row = spark.createDataFrame([(body,)], "b string").select(xml.plain_text(F.col("b")).alias("t"), xml.links(F.col("b")).alias("l")).first()
    assert (row.t, row.l) == (text, targets)
