"""Derived columns of an access-log row, all as built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Labels in order of precedence with the words that give them.
DEVICE_WORDS = (
    ("Android Mobile", ("android",)),
    ("iOS Mobile", ("iphone", "ipod")),
    ("Mobile", ("mobile",)),
    ("iPad", ("ipad",)),
    ("Tablet", ("tablet",)),
    ("Chrome Desktop", ("chrome",)),
    ("Firefox Desktop", ("firefox",)),
    ("Safari Desktop", ("safari",)),
    ("Edge Desktop", ("edge",)),
    ("Opera Desktop", ("opera",)),
    ("Bot/Crawler", ("bot", "crawler", "spider", "scraper")),
)
NO_AGENT_DEVICE = "Unknown"
OTHER_DEVICE = "Other Desktop"
BOT_WORDS = ("bot", "crawler", "spider", "scraper", "slurp")
STATUS_LIMITS = ((300, "Success"), (400, "Redirect"), (500, "Client Error"))
LAST_STATUS = "Server Error"


def _has_any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, (text.contains(word) for word in words))


def device_type(lower_agent: Column) -> Column:
    """Device label of a lower-case agent; the first matching rule wins."""
    rule = F.when(lower_agent.isNull() | (lower_agent == ""), NO_AGENT_DEVICE)
    for label, words in DEVICE_WORDS:
        rule = rule.when(_has_any(lower_agent, words), label)
    return rule.otherwise(OTHER_DEVICE)


def is_bot(lower_agent: Column) -> Column:
    """Bot flag of a lower-case agent; NULL when there is no agent."""
    return _has_any(lower_agent, BOT_WORDS)


def status_category(status: Column) -> Column:
    bands = F.when(status < STATUS_LIMITS[0][0], STATUS_LIMITS[0][1])
    for limit, label in STATUS_LIMITS[1:]:
        bands = bands.when(status < limit, label)
    return bands.otherwise(LAST_STATUS)


def url_path(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def file_extension(url: Column) -> Column:
    """Letters and digits between a dot and ``?`` or the end; ``''`` when there are none."""
    return F.regexp_extract(url, r"\.([a-zA-Z0-9]+)(?:\?|$)", 1)


def calendar(time: Column) -> dict[str, Column]:
    """Calendar columns of an instant in the session zone."""
    return {
        "date": F.to_date(time),
        "hour": F.hour(time),
        "year": F.year(time),
        "month": F.month(time),
        "day": F.dayofmonth(time),
        "week_of_year": F.weekofyear(time),
    }


def week_start(date: Column) -> Column:
    """Monday of the week."""
    return F.date_sub(F.next_day(date, "MON"), 7)


def week_end(monday: Column) -> Column:
    """Sunday of the week that starts on ``monday``."""
    return F.date_add(monday, 6)


def iso_week_year(date: Column) -> Column:
    """Year the ISO week belongs to, which differs from the calendar year at year ends."""
    return F.extract(F.lit("YEAROFWEEK"), date).cast("int")
