"""Golden cases of frame decoding."""

import gzip
import zlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trackside.operators import decode

V16 = "http://www.thalesgroup.com/rtti/PushPort/v16"
V3 = "http://www.thalesgroup.com/rtti/PushPort/Forecasts/v3"


def document(trains, pushport=V16, forecasts=V3, prefix="f", kind="uR"):
    return (
        f'<?xml version="1.0" encoding="UTF-8"?><Pport xmlns="{pushport}" xmlns:{prefix}="{forecasts}" '
        f'ts="2024-01-01T00:09:58" version="16.0"><{kind}>{trains}</{kind}></Pport>'
    )


def train(locations, rid="2024010100000013", uid="C00013", ssd="2024-01-01"):
    return f'<TS rid="{rid}" uid="{uid}" ssd="{ssd}">{locations}</TS>'


HEADERS = {"SequenceNumber": "5", "MessageType": "TS"}


def frames(spark, *bodies, headers=HEADERS):
    rows = [(headers, body if isinstance(body, (bytes, type(None))) else gzip.compress(body.encode())) for body in bodies]
    return spark.createDataFrame(rows, "headers map<string,string>, body binary")


def rows(spark, xml, **how):
    return decode.locations(decode.decode_frames(frames(spark, xml)), **how).collect()


def reasons(spark, *bodies, headers=HEADERS):
    return [r.reason for r in decode.rejects(decode.decode_frames(frames(spark, *bodies, headers=headers))).collect()]


GOOD = document(
    train(
        '<f:Location tpl="ERROR" wta="00:09:58" wtd="00:11:58" pta="00:09" ptd="00:11">'
        '<f:arr et="00:10" src="TD"/><f:plat platsup="true" platsrc="A">4</f:plat></f:Location>'
    )
)


def test_one_location(spark):
    (row,) = rows(spark, GOOD)
    assert tuple(row) == (
        "5", "2024010100000013", "C00013", "2024-01-01", "ERROR", "00:09:58", "00:11:58", "00:09", "00:11", "4", "00:10", "TD",
    )


@pytest.mark.parametrize("pack", [lambda b: gzip.compress(b), lambda b: zlib.compress(b)])
def test_both_headers(spark, pack):
    assert len(decode.locations(decode.decode_frames(frames(spark, pack(GOOD.encode())))).collect()) == 1


@pytest.mark.parametrize(
    "children, expected",
    [
        ('<f:arr et="1" src="A"/><f:dep et="2" src="D"/>', ("1", "A")),
        ('<f:arr/><f:dep et="2" src="D"/>', (None, None)),
        ('<f:arr at="3"/><f:dep et="2" src="D"/>', (None, None)),
        ('<f:arr src="A"/><f:dep et="2" src="D"/>', (None, "A")),
        ('<f:dep et="2" src="D"/>', ("2", "D")),
        ('<f:pass et="9" src="P"/>', (None, None)),
        ("", (None, None)),
    ],
)
def test_arrival_hides_departure(spark, children, expected):
    (row,) = rows(spark, document(train(f'<f:Location tpl="A">{children}</f:Location>')))
    assert (row.estimated_time, row.source) == expected


def test_prefix_does_not_matter_but_the_uri_does(spark):
    assert len(rows(spark, GOOD.replace("f:", "other:"))) == 1
    assert reasons(spark, GOOD.replace("PushPort/v16", "PushPort/v15")) == ["other_version"]
    older = GOOD.replace("Forecasts/v3", "Forecasts/v2")
    assert rows(spark, older) == [] and reasons(spark, older) == []


TWO = document(
    train('<f:Location tpl="A"/><f:Location tpl="B"/>', rid="1") + train('<f:Location tpl="C"/>', rid="2") + train("", rid="3")
)


def test_locations_belong_to_their_train(spark):
    assert [(r.schedule_id, r.location_code) for r in rows(spark, TWO)] == [("1", "A"), ("1", "B"), ("2", "C")]


def test_or_all_to_the_first_train(spark):
    assert [(r.schedule_id, r.location_code) for r in rows(spark, TWO, first_header=True)] == [("1", "A"), ("1", "B"), ("1", "C")]


def test_train_without_locations_gives_no_rows_and_no_reject(spark):
    empty = document(train(""))
    assert rows(spark, empty) == [] and reasons(spark, empty) == []


def test_snapshot_documents(spark):
    assert len(rows(spark, GOOD.replace("uR>", "sR>"))) == 1


def test_rejects(spark):
    body = gzip.compress(GOOD.encode())
    assert reasons(spark, body[:30]) == ["bad_body"]
    assert reasons(spark, b"plain") == ["bad_body"]
    assert reasons(spark, None) == ["bad_body"]
    assert reasons(spark, "<Pport><uR></Pport>") == ["bad_xml"]
    assert reasons(spark, document('<deactivated rid="1"/>')) == ["no_train_status"]
    assert reasons(spark, GOOD, headers={"MessageType": "TS"}) == ["missing_header"]
    assert reasons(spark, GOOD, headers={"SequenceNumber": "1"}) == ["missing_header"]
    assert reasons(spark, GOOD) == []


def test_documents_of_any_kind(spark):
    bodies = [GOOD, document('<deactivated rid="1"/>', pushport=V16.replace("v16", "v12")), "<Pport><uR><TS></uR></Pport>", "", "<a", GOOD[:-9]]
    got = decode.read_documents(frames(spark, *bodies)).collect()
    assert [(r.reason, r.feed_version, r.xml is None, r.payload is None) for r in got] == [
        (None, 16, False, True), (None, 12, False, True), *[("bad_xml", None, True, False)] * 3, ("bad_xml", 16, True, False),
    ]


def test_reject_keeps_the_body(spark):
    body = gzip.compress(GOOD.encode())[:30]
    (row,) = decode.rejects(decode.decode_frames(frames(spark, body))).collect()
    assert (bytes(row.payload), row.sequence_number) == (body, "5")


def test_spaces_and_entities_in_values(spark):
    xml = document(train('<f:Location tpl="A&amp;B">\n  <f:plat>\n</f:plat><f:dep et=" 1"/>\n</f:Location>'))
    (row,) = rows(spark, xml)
    assert (row.location_code, row.estimated_time) == ("A&B", " 1")


def test_declared_encoding(spark):
    xml = document(train('<f:Location tpl="É"/>')).replace("UTF-8", "ISO-8859-1")
    (row,) = decode.locations(decode.decode_frames(frames(spark, gzip.compress(xml.encode("latin-1"))))).collect()
    assert row.location_code == "É"


def test_what_follows_the_document(spark):
    for junk in ("x", GOOD, "<a/>", "<!-- c --> x"):
        assert reasons(spark, GOOD + junk) == ["bad_xml"], junk
        assert [r.reason for r in decode.read_documents(frames(spark, GOOD + junk)).collect()] == ["bad_xml"]
    for nothing in ("\n ", "<!-- c -->", " <?p q?>\n<!-- <a> -->"):
        assert reasons(spark, GOOD + nothing) == [] and len(rows(spark, GOOD + nothing)) == 1, nothing


def test_prefixed_root(spark):
    prefixed = GOOD.replace("<Pport xmlns=", "<p:Pport xmlns:p=").replace("</Pport>", "</p:Pport>")
    for name in ("uR", "TS"):
        prefixed = prefixed.replace(f"<{name}", f"<p:{name}").replace(f"</{name}", f"</p:{name}")
    assert len(rows(spark, prefixed)) == 1 and len(rows(spark, prefixed + " ")) == 1
    assert reasons(spark, prefixed + "x") == ["bad_xml"]


def test_comments_and_cdata(spark):
    def platform(text):
        return rows(spark, GOOD.replace(">4<", f">{text}<"))[0].platforms

    assert platform("4<!-- c -->5") == "45"
    assert platform("<![CDATA[4]]>") == "4"
    assert platform("&#52;") == "4"


def test_byte_order_mark(spark):
    (row,) = decode.locations(decode.decode_frames(frames(spark, gzip.compress(b"\xef\xbb\xbf" + GOOD.encode())))).collect()
    assert row.location_code == "ERROR"


def test_documents_are_parsed_once(spark):
    plan = decode.locations(decode.decode_frames(frames(spark, GOOD)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml") == 1


TEXT = st.text(alphabet=st.characters(min_codepoint=33, max_codepoint=0x2FF, exclude_characters="\x7f"), min_size=1, max_size=7)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=5))
def test_any_text_survives(spark, values):
    from xml.sax.saxutils import escape, quoteattr

    body = "".join(f"<f:Location tpl={quoteattr(a)}><f:plat>{escape(b)}</f:plat></f:Location>" for a, b in values)
    got = [(r.location_code, r.platforms) for r in rows(spark, document(train(body)))]
    assert got == values
