"""Timetable and reference files."""

import datetime as dt

from trackside.sources import timetable as t

TIMETABLE = """<?xml version="1.0" encoding="utf-8"?>
<PportTimetable xmlns="http://www.thalesgroup.com/rtti/XmlTimetable/v8" timetableID="20240101000000">
  <Journey rid="1" uid="C00001" trainId="1A01" ssd="2024-01-01" toc="AA" qtrain="true">
    <OR tpl="A" act="TB" plat="1" wtd="10:00"/><PP tpl="B" wtp="10:05"/><IP tpl="C" wta="10:10" wtd="10:11"/>
    <DT tpl="D" act="TF" wta="10:20"/><cancelReason>501</cancelReason>
  </Journey><Journey rid="2" uid="C00002" trainId="1A02" ssd="2024-01-02" toc="AA"><OPOR tpl="Z"></OPOR><OPDT tpl="Y" can="true"/></Journey>
  <Association tiploc="C" category="NP"><main rid="1" wta="10:10"/><assoc rid="2" wtd="10:30"/></Association>
  <Association tiploc="D" category="JJ" isDeleted="true"><main rid="1"/><assoc rid="2"/></Association>
</PportTimetable>"""

REFERENCE = """<?xml version="1.0" encoding="utf-8"?>
<PportTimetableRef xmlns="http://www.thalesgroup.com/rtti/XmlRefData/v3" timetableId="20240101000000">
  <LocationRef tpl="A" crs="AAA" toc="AA" locname="Alpha &amp; Co"/><LocationRef tpl="B" locname="Beta"/>
  <TocRef toc="AA" tocname="Operator" url="http://x"/>
  <LateRunningReasons><Reason code="100" reasontext="late"/><Reason code="101" reasontext="later"/></LateRunningReasons>
  <CancellationReasons><Reason code="100" reasontext="gone"/></CancellationReasons>
  <Via at="AAA" dest="D" loc1="B" viatext="via Beta"/><Via at="AAA" dest="D" loc1="B" loc2="C" viatext="via both"/>
  <CISSource code="at01" name="Alpha CIS"/>
</PportTimetableRef>"""


def test_journeys(spark, tmp_path):
    (tmp_path / "t.xml").write_text(TIMETABLE)
    journeys = t.read_journeys(spark, str(tmp_path))
    one, two = journeys.orderBy("rid").collect()
    assert (one.uid, one.ssd, one.qtrain, one.cancel_reason) == ("C00001", dt.date(2024, 1, 1), True, 501)
    assert (two.train_id, two.qtrain, two.cancel_reason) == ("1A02", None, None)
    points = t.journey_points(journeys).orderBy("rid", "pos").collect()
    assert [(p.rid, p.pos, p.kind, p.tpl) for p in points] == [
        ("1", 0, "OR", "A"), ("1", 1, "PP", "B"), ("1", 2, "IP", "C"), ("1", 3, "DT", "D"), ("2", 0, "OPOR", "Z"), ("2", 1, "OPDT", "Y"),
    ]
    assert (points[0].platform, points[5].can) == ("1", True)
    links = t.read_timetable_associations(spark, str(tmp_path)).orderBy("tiploc").collect()
    assert [(a.tiploc, a.category, a.main_wta, a.assoc_wtd, a.is_deleted) for a in links] == [
        ("C", "NP", "10:10", "10:30", None), ("D", "JJ", None, None, True),
    ]


def test_prefixed_journeys(spark, tmp_path):
    prefixed = TIMETABLE.replace("<Journey", "<t:Journey").replace("</Journey", "</t:Journey").replace("<IP", "<t:IP")
    (tmp_path / "t.xml").write_text(prefixed)
    points = t.journey_points(t.read_journeys(spark, str(tmp_path), end="</t:Journey>"))
    assert [p.kind for p in points.orderBy("rid", "pos").collect()] == ["OR", "PP", "IP", "DT", "OPOR", "OPDT"]


def test_many_splits_of_one_file(spark, tmp_path):
    """A file larger than a split: journeys cut by split borders appear once."""
    journey = '<Journey rid="{0}" uid="C{0}" ssd="2024-01-01"><OR tpl="A" wtd="10:00"/><DT tpl="B" wta="11:00"/></Journey>'
    body = "".join(journey.format(n) for n in range(3000))
    (tmp_path / "t.xml").write_text(f"<PportTimetable>{body}</PportTimetable>")
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        journeys = t.read_journeys(spark, str(tmp_path))
        assert journeys.rdd.getNumPartitions() > 5
        assert sorted(int(r.rid) for r in journeys.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)


def test_reference(spark, tmp_path):
    (tmp_path / "r.xml").write_text(REFERENCE)
    path = str(tmp_path)
    assert {tuple(r) for r in t.read_locations(spark, path).collect()} == {("A", "AAA", "AA", "Alpha & Co"), ("B", None, None, "Beta")}
    assert [tuple(r) for r in t.read_operators(spark, path).collect()] == [("AA", "Operator", "http://x")]
    assert {tuple(r) for r in t.read_late_reasons(spark, path).collect()} == {(100, "late"), (101, "later")}
    assert [tuple(r) for r in t.read_cancel_reasons(spark, path).collect()] == [(100, "gone")]
    assert {r.loc2 for r in t.read_via(spark, path).collect()} == {None, "C"}
    assert [tuple(r) for r in t.read_instances(spark, path).collect()] == [("at01", "Alpha CIS")]
