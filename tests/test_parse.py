"""Golden lines for parsing and enrichment."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hitledger.operators import parsing
from hitledger.operators.enrich import access_logs
from hitledger.schemas import ACCESS_LOGS, PARSED

BASE = (
    '1.2.3.4 - - [05/Jan/2025:13:04:05 +0000] "GET /home HTTP/1.1" 200 512 "-" "curl/7.68.0"'
)


def lines_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")


def enriched(spark, line):
    return access_logs(lines_of(spark, [line]).select("value")).first()


ACCEPTED = {
    "base": (BASE, {"response_size": 512, "referer": None, "device_type": "Other Desktop",
                    "is_bot": False, "status_category": "Success", "url_path": "/home",
                    "file_extension": "", "hour": 13,
                    "timestamp": dt.datetime(2025, 1, 5, 13, 4, 5)}),
    "dashes": (BASE.replace(" 512 ", " - ").replace("curl/7.68.0", "-"),
               {"response_size": 0, "user_agent": None, "device_type": "Unknown",
                "is_bot": None}),
    "empty agent": (BASE.replace("curl/7.68.0", ""),
                    {"user_agent": "", "device_type": "Unknown", "is_bot": False}),
    "remote user": (BASE.replace("- - [", "- frank ["), {"ip_address": "1.2.3.4"}),
    "ipv6": (BASE.replace("1.2.3.4", "::1"), {"ip_address": "::1"}),
    "offset": (BASE.replace("05/Jan/2025:13:04:05 +0000", "05/Jan/2025:23:30:00 -0530"),
               {"timestamp": dt.datetime(2025, 1, 6, 5, 0), "date": dt.date(2025, 1, 6)}),
    "extra fields": (BASE + ' "10.0.0.1" 0.1', {"user_agent": "curl/7.68.0"}),
    "carriage return": (BASE + "\r", {"user_agent": "curl/7.68.0"}),
    "quote in agent": (BASE.replace("curl/7.68.0", 'a\\"b'), {"user_agent": "a\\"}),
    "path and query": (BASE.replace("/home", "/a.b/c.PNG?x=1.y"),
                       {"url_path": "/a.b/c.PNG", "file_extension": "PNG"}),
    "extension in query": (BASE.replace("/home", "/x?f=a.jpg"),
                           {"url_path": "/x", "file_extension": "jpg"}),
    "huge size": (BASE.replace(" 512 ", " 99999999999999999999 "), {"response_size": None}),
    "199": (BASE.replace(" 200 ", " 199 "), {"status_category": "Success"}),
    "000": (BASE.replace(" 200 ", " 000 "), {"status_category": "Success", "status_code": 0}),
    "301": (BASE.replace(" 200 ", " 301 "), {"status_category": "Redirect"}),
    "404": (BASE.replace(" 200 ", " 404 "), {"status_category": "Client Error"}),
    "999": (BASE.replace(" 200 ", " 999 "), {"status_category": "Server Error"}),
    "year end": (BASE.replace("05/Jan/2025:13:04:05", "30/Dec/2024:00:00:00"),
                 {"year": 2024, "week_of_year": 1, "date": dt.date(2024, 12, 30)}),
    "other digits": (BASE.replace(" 200 512 ", " ٢٠٠ ٥١٢ "),
                     {"status_code": 200, "response_size": 512}),
    "quote in url": (BASE.replace("/home", '/a"b'), {"url": '/a"b'}),
    "month case": (BASE.replace("Jan", "JAN"), {"month": 1}),
    "line feed in the agent": (BASE.replace("curl", "cu\nrl"), {"user_agent": "cu\nrl/7.68.0"}),
    "line feeds in the referer": (BASE.replace('"-"', '"\na\n"'), {"referer": "\na\n"}),
}

REJECTED = {
    "request dash": BASE.replace("GET /home HTTP/1.1", "-"),
    "two tokens": BASE.replace("GET /home HTTP/1.1", "GET /x"),
    "four tokens": BASE.replace("GET /home HTTP/1.1", "GET /x y HTTP/1.1"),
    "leading blank": " " + BASE,
    "user with blank": BASE.replace("- - [", "- a b ["),
    "short status": BASE.replace(" 200 ", " 20 "),
    "empty": "",
    "quote in referer": BASE.replace('"-"', '"a"b"'),
    "no-break space in token": BASE.replace("/home", "/ho me"),
    "separator in token": BASE.replace("/home", "/ho\x1cme"),
    "line feed in a token": BASE.replace("/home", "/ho\nme"),
    "null": None,
    "nine short lines": "\n".join("abcdefghi"),
}


@pytest.fixture(scope="module")
def accepted_rows(spark):
    """Enriched rows of the accepted lines, which keep their order in one partition."""
    lines = lines_of(spark, [line for line, _ in ACCEPTED.values()]).coalesce(1)
    rows = access_logs(lines.select("value")).collect()
    assert len(rows) == len(ACCEPTED)
    return dict(zip(ACCEPTED, rows))


@pytest.mark.parametrize("name", ACCEPTED)
def test_accepted_lines(accepted_rows, name):
    expected = ACCEPTED[name][1]
    assert {key: accepted_rows[name][key] for key in expected} == expected


def test_bad_times_parse_but_are_dropped(spark):
    bad = ["99/Jan/2025:13:04:05", "31/Feb/2025:13:04:05", "05/Foo/2025:13:04:05",
           "05/Jan/2025:24:04:05", "05/Jan/2025:13:04:60", "5/Jan/2025:13:04:05"]
    lines = lines_of(spark, [BASE.replace("05/Jan/2025:13:04:05", time) for time in bad])
    assert parsing.parse_lines(lines).count() == len(bad)
    assert access_logs(lines).count() == 0


def test_rejected_lines(spark):
    lines = lines_of(spark, [*REJECTED.values(), BASE])
    assert parsing.parse_lines(lines).count() == 1
    rejected = parsing.rejected_lines(lines)
    assert rejected.columns == ["id", "value"]
    assert sorted(row.id for row in rejected.collect()) == list(range(len(REJECTED)))


def test_parsed_columns(spark):
    parsed = parsing.parse_lines(lines_of(spark, [BASE]))
    assert [(f.name, f.dataType) for f in parsed.schema] == [
        (f.name, f.dataType) for f in PARSED
    ]


def test_enriched_columns(spark):
    logs = access_logs(lines_of(spark, [BASE]))
    assert [(f.name, f.dataType) for f in logs.schema] == [
        (f.name, f.dataType) for f in ACCESS_LOGS.schema
    ]


def test_funnel(spark):
    bad_time = BASE.replace("05/Jan", "99/Jan")
    lines = lines_of(spark, [BASE, BASE, bad_time, "", None])
    row = parsing.parse_funnel(lines).first()
    assert row.asDict() == {
        "lines_read": 5, "lines_parsed": 3, "lines_rejected": 2, "rows_enriched": 2
    }


def test_results_do_not_depend_on_session_defaults(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert enriched(spark, ACCEPTED["huge size"][0])["response_size"] is None
        lines = lines_of(spark, list(REJECTED.values()))
        assert parsing.parse_lines(lines).count() == 0
        assert parsing.rejected_lines(lines).count() == len(REJECTED)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_all_digits_are_read(spark):
    numbers = ["０１２", "𝟙𝟚𝟛", "१२३", "999"]
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    from hitledger.functions.logline import digits_to_number

    got = [row[0] for row in df.select(digits_to_number(F.col("n"), "int")).collect()]
    assert got == [12, 123, 123, 999]
