"""Parsing of literal lines, against expected values and against Python's re."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagetally.functions import patterns as P
from pagetally.operators import parsing
from pagetally.schemas import RAW_LINE

AGENT = '"reader-app/3.2 (tablet)"'
# A reader opens a thread about bicycles from the list of a section, which is the referer.
ARTICLE = (
    "203.0.113.7 - anna [02/Feb/2022:18:04:59 +0100] "
    '"GET /board/index?mod=viewthread&tid=5120&page=3 HTTP/2" 200 812 '
    f'"https://bikes.example.org/board/index?mod=forumdisplay&fid=12" {AGENT}'
)
# The list of a section itself, opened from a search engine.
SECTION = (
    "198.51.100.20 - - [11/Nov/2021:23:30:00 +0530] "
    f'"GET /?mod=forumdisplay&fid=12 HTTP/1.0" 200 77 "https://search.example.net/?q=tyres" {AGENT}'
)
# A picture, logged without referer and agent.
COMMON = '192.0.2.44 id-9 - [29/Feb/2024:00:00:01 +0000] "GET /img/wheel.png HTTP/1.1" 200 40961'
# A poll of the page, which names a section but does not show it.
POLL = (
    "192.0.2.44 - - [28/Feb/2024:12:15:30 +0000] "
    '"POST /board/poll?mod=unread&fid=12 HTTP/1.1" 200 2 "-" "-"'
)
# A connection that was closed before any request came.
NO_REQUEST = '198.51.100.3 - - [01/May/2023:06:07:08 -0400] "-" 408 - "-" "-"'


def line(request='"GET / HTTP/1.1"', date="[05/Jul/2022:08:09:10 +0200]", status="200"):
    return f"10.0.0.1 - - {date} {request} {status} 1"


def frame(spark, *lines):
    return spark.createDataFrame([(v,) for v in lines], RAW_LINE)


def visits(spark, *lines, **kwargs):
    rows = parsing.visit_facts(frame(spark, *lines), **kwargs)
    return [
        tuple(r)
        for r in rows.select(
            "client_ip", F.col("event_time").cast("string"), "section_id", "article_id"
        ).collect()
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        (ARTICLE, ("203.0.113.7", "2022-02-02 18:04:59", 0, 5120)),
        (SECTION, ("198.51.100.20", "2021-11-11 23:30:00", 12, 0)),
        (COMMON, ("192.0.2.44", "2024-02-29 00:00:01", 0, 0)),
        (POLL, ("192.0.2.44", "2024-02-28 12:15:30", 0, 0)),
        ("xx " + line() + " yy", ("10.0.0.1", "2022-07-05 08:09:10", 0, 0)),
        ("first\n" + line() + "\nlast", ("10.0.0.1", "2022-07-05 08:09:10", 0, 0)),
        (line('"GET /a ?mod=forumdisplay&fid=1 HTTP/1.1"'), ("10.0.0.1", "2022-07-05 08:09:10", 0, 0)),
        (line('"GET ?mod=forumdisplay&fid=007 HTTP/1.1"'), ("10.0.0.1", "2022-07-05 08:09:10", 7, 0)),
        (
            line('"GET ?mod=forumdisplay&fid=99999999999 HTTP/1.1"'),
            ("10.0.0.1", "2022-07-05 08:09:10", 99999999999, 0),
        ),
        (
            line('"GET ?mod=forumdisplay&fid=9223372036854775807 HTTP/1.1"'),
            ("10.0.0.1", "2022-07-05 08:09:10", 9223372036854775807, 0),
        ),
        (
            line('"GET ?mod=forumdisplay&fid=9223372036854775808 HTTP/1.1"'),
            ("10.0.0.1", "2022-07-05 08:09:10", 0, 0),
        ),
        (line(date="[31/DEC/2019:23:59:58 +0000]"), ("10.0.0.1", "2019-12-31 23:59:58", 0, 0)),
    ],
)
def test_visit(spark, text, expected):
    assert visits(spark, text) == [expected]


@pytest.mark.parametrize(
    "text",
    [
        NO_REQUEST,
        "",
        "203.0.113.7 is where the visit came from",
        line(status="404"),
        line(status="404") + ' "a" 200 5',
        line(status="201"),
        line(date="[05/Jul/2022:08:09:10]"),
        line(date="[05/Jul/2022:08:09:10 ]"),
        line(date="[5/Jul/2022:08:09:10 +0200]"),
        line(date="[30/Feb/2022:00:00:00 +0000]"),
    ],
)
def test_no_visit(spark, text):
    assert visits(spark, text) == []


def test_second_record_in_a_line_is_ignored(spark):
    both = line(status="404") + " " + line(status="200")
    assert visits(spark, both) == []
    assert [r.status for r in parsing.parse_lines(frame(spark, both)).collect()] == ["404"]


def test_offset_can_be_honored(spark):
    assert visits(spark, SECTION, honor_offset=True)[0][1] == "2021-11-11 18:00:00"


def test_record_keeps_brackets_and_quotes(spark):
    record = parsing.parse_lines(frame(spark, NO_REQUEST)).first()
    assert record.asDict() == {
        "client_ip": "198.51.100.3",
        "identity": "-",
        "remote_user": "-",
        "date_time": "[01/May/2023:06:07:08 -0400]",
        "request": '"-"',
        "status": "408",
        "bytes": "-",
    }


def test_combined_fields(spark):
    records = parsing.parse_lines(frame(spark, ARTICLE, COMMON), combined=True).collect()
    assert len(records) == 1
    assert records[0].referer == "https://bikes.example.org/board/index?mod=forumdisplay&fid=12"
    assert records[0].user_agent == AGENT.strip('"')


def test_request_parts(spark):
    records = parsing.parse_lines(frame(spark, COMMON, NO_REQUEST))
    parts = [tuple(r)[1:] for r in parsing.request_parts(records).collect()]
    assert parts == [("GET", "/img/wheel.png", "HTTP/1.1"), (None, None, None)]


def test_rejects_name_their_reason(spark):
    lines = frame(spark, SECTION, "prose", None, NO_REQUEST, line(date="[now]"))
    rejected = parsing.rejected_lines(lines).collect()
    assert [(r.value, r.reason) for r in rejected] == [
        ("prose", "no_record"),
        (None, "no_record"),
        (line(date="[now]"), "bad_date"),
    ]


def test_pattern_runs_once_per_line(spark):
    plan = parsing.visit_facts(frame(spark, SECTION))._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    # Two branches: a line takes the one for text with line ends inside, or the other.
    assert text.count("regexp_replace") == 2 and text.count("CASE WHEN RLIKE") == 1
    assert text.count("gettimestamp") == 1


PIECES = st.sampled_from(
    ["1.2.3.4", "10.0.0.1", "-", "[d z]", "[", "]", '"', '"GET / H"', "200", "404", " ", "\n", "x", "7"]
)
RECORD = re.compile(P.LOG_LINE)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.lists(PIECES, max_size=24).map(" ".join), min_size=50, max_size=200))
def test_first_match_of_any_text(spark, texts):
    """Records equal the first match Python finds, also in odd and multi-line texts."""
    texts = texts + ["a " + line() + t + line(status="404") for t in texts[:20]]
    got = [tuple(r) for r in parsing.parse_lines(frame(spark, *texts)).collect()]
    found = filter(None, map(RECORD.search, texts))
    assert got == [m.group(1, 2, 3, 4, 5, 7, 8) for m in found]


QUOTED = [*PIECES.elements, '"a" "b"', '"', '" "', '" 200 5 "', '] "', "[a] \"b\" 200 5", "1.2.3.4 - - [", "1.1.1.1.1.1.1.1", "\t", "é"]


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.lists(st.sampled_from(QUOTED), max_size=30), min_size=100, max_size=300), st.sampled_from(["", " "]))
def test_patterns_for_lines_match_the_same(spark, lists, between):
    """All groups, common and combined, in texts that nearly match at many places."""
    texts = [between.join(x for x in one if x != "\n") for one in lists]
    texts += [line() + between + t for t in texts[:30]] + [t + between + line() for t in texts[:30]]
    for combined, pattern in ((False, P.LOG_LINE), (True, P.COMBINED_LINE)):
        got = [tuple(r) for r in parsing.parse_lines(frame(spark, *texts), combined).collect()]
        groups = (1, 2, 3, 4, 5, 7, 8, 10, 12) if combined else (1, 2, 3, 4, 5, 7, 8)
        found = filter(None, map(re.compile(pattern).search, texts))
        assert got == [m.group(*groups) for m in found]
    rejected = {r.value: r.reason for r in parsing.rejected_lines(frame(spark, *texts)).collect()}
    assert {t for t, reason in rejected.items() if reason == "no_record"} == {t for t in texts if not RECORD.search(t)}


def test_java_line_ends_end_a_date(spark):
    """Next line and its like end `.`, and are part of words."""
    texts = [line(date=f"[05/Jul/2022:08:09:10{x}+0200]") for x in "\r\u0085\u2028"]
    assert parsing.parse_lines(frame(spark, *texts)).count() == 0
    spared = [t + " " + line() for t in texts]
    assert parsing.parse_lines(frame(spark, *spared)).count() == 3


HOSTILE = [
    "1.1.1.1 a b [", "1.1.1.1 a b [c] \"", "1.1.1.1 a b [c] \"d\" ", "1.", "1.1.1.1 ", "[c] \" ", '" 200 ', "] ",
    "1.1.1.1 a b [c] \"d\" 20 ", "[", "1.1.1.1 a b [c] \"d\" 200 5 \"e",
]


def test_time_grows_with_the_line(spark):
    """A megabyte of text that nearly matches everywhere, where backtracking takes minutes."""
    import time

    texts = [(x * (1_000_000 // len(x) + 1))[:1_000_000] for x in HOSTILE]
    texts += ["1.1.1.1 a b [c] \"" + t for t in texts]
    lines = frame(spark, *texts).repartition(8).persist()
    lines.count()
    start = time.perf_counter()
    assert parsing.rejected_lines(lines).count() >= len(HOSTILE)
    parsing.parse_lines(lines, combined=True).count()
    parsing.visit_facts(lines).count()
    lines.unpersist()
    assert time.perf_counter() - start < 60
