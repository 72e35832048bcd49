"""Random input: the parser against Python's own regular expressions, and ranking rules."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from random import Random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from hitledger.functions.logline import FIELDS, format_access_line
from hitledger.operators import parsing, topn
from hitledger.schemas import DAILY_TOP_IPS

# Fixed value: the combined format as it is usually written.
COMBINED = re.compile(
    r'^(\S+) \S+ \S+ \[([\w:/]+\s[+\-]\d{4})\] '
    r'"(\S+) (\S+) (\S+)" (\d{3}) (\d+|-) "([^"]*)" "([^"]*)"'
)

SLOW = settings(
    max_examples=4, deadline=None, suppress_health_check=list(HealthCheck), print_blob=True
)

ODD = ' "-[]:/\t\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2003\u2028\u202f\u3000\xad\ufffd\xe9\u0663\xb2_\U0001f600'
USUAL = ("-", "a", "/x?y", "GET", "1.2.3.4", "HTTP/1.1")


def random_text(rng: Random) -> str:
    if rng.random() < 0.7:
        return rng.choice(USUAL)
    any_char = lambda: chr(rng.randint(32, 0x2FFF))
    return "".join(rng.choice(ODD) if rng.random() < 0.6 else any_char() for _ in range(rng.randint(0, 4)))


def random_line(rng: Random) -> str:
    text = lambda: random_text(rng)
    maybe = lambda usual: usual if rng.random() < 0.9 else text()
    time = maybe("05/Jan/2025:13:04:05 +0000")
    if rng.random() < 0.1:
        time = time.replace(" ", rng.choice(ODD)).replace("J", rng.choice(ODD))
    request = " ".join(text() for _ in range(rng.choice((3, 3, 3, 2, 4))))
    status = maybe(rng.choice(("200", "404", "\u0662\u0660\u0660", "20")))
    size = maybe(rng.choice(("-", "0", "512", "9" * 20, "9" * 18, "\u0967\u0968")))
    tail = rng.choice(("", "\r", ' "x"', " "))
    head = f"{text()} - {maybe('-')}"
    line = f'{head} [{time}] "{request}" {status} {size} "{text()}" "{text()}"{tail}'
    return line.replace("\n", " ")


def python_fields(line):
    match = COMBINED.match(line)
    if not match:
        return None
    values = list(match.groups())
    values[5] = int(values[5])
    values[6] = 0 if values[6] == "-" else int(values[6])
    if values[6] is not None and values[6] >= 2**63:
        values[6] = None
    values[7:] = [None if value == "-" else value for value in values[7:]]
    return tuple(values)


@SLOW
@given(st.integers(0, 2**32))
def test_parser_agrees_with_python(spark, seed):
    rng = Random(seed)
    lines = [random_line(rng) for _ in range(3000)]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    want = Counter(fields for fields in map(python_fields, lines) if fields)
    assert Counter(map(tuple, parsing.parse_lines(df).collect())) == want
    rejected = [line for line in lines if python_fields(line) is None]
    assert sorted(r.value for r in parsing.rejected_lines(df).collect()) == sorted(rejected)
    assert len(want) > 100 and len(rejected) > 100


word = st.text(st.characters(min_codepoint=33, max_codepoint=126, exclude_characters='"'), min_size=1)
rows = st.tuples(
    word, st.datetimes(dt.datetime(1970, 1, 1), dt.datetime(2100, 1, 1)), word, word, word,
    st.integers(100, 999), st.integers(0, 2**63 - 1), word, word,
)


@SLOW
@given(st.lists(rows, min_size=50, max_size=200))
def test_format_then_parse_gives_the_parts_back(spark, parts):
    parts = [(*p[:1], p[1].replace(microsecond=0), *p[2:]) for p in parts]
    names = ["ip", "time", "method", "url", "protocol", "status", "size", "referer", "agent"]
    df = spark.createDataFrame(
        parts, "ip string, time timestamp, method string, url string, protocol string,"
        " status int, size bigint, referer string, agent string"
    )
    from hitledger.functions.logline import format_log_time

    line = format_access_line(
        F.col("ip"), format_log_time(F.col("time")),
        F.concat_ws(" ", "method", "url", "protocol"),
        F.col("status"), F.col("size"), F.col("referer"), F.col("agent"),
    )
    parsed = parsing.with_timestamp(parsing.parse_lines(df.select(line.alias("value"))))
    dash = lambda value: None if value == "-" else value
    want = Counter((*p[:7], dash(p[7]), dash(p[8])) for p in parts)
    assert Counter(map(tuple, parsed.collect())) == want
    assert len(FIELDS) == len(names)


@SLOW
@given(
    st.lists(st.tuples(st.integers(1, 4), st.sampled_from("abcdefgh")), min_size=1, max_size=200),
    st.integers(1, 6),
)
def test_ranks(spark, pairs, n):
    logs = spark.createDataFrame(
        [(dt.date(2025, 1, day), ip) for day, ip in pairs], "date date, ip_address string"
    )
    found: dict[int, list] = {}
    for row in topn.top_requests(logs, DAILY_TOP_IPS, n).collect():
        found.setdefault(row.date.day, []).append((row["rank"], row.request_count, row.ip_address))
    counts = Counter(pairs)
    for day in {day for day, _ in pairs}:
        of_day = sorted((-k, ip) for (d, ip), k in counts.items() if d == day)[:n]
        want = [(i + 1, -k, ip) for i, (k, ip) in enumerate(of_day)]
        assert sorted(found[day]) == want
