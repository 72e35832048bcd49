"""Combined-format access-log lines: one expression to take a line apart, one to build it.

The line layout is::

    ip ident user [dd/Mon/yyyy:HH:MM:SS +zzzz] "method url protocol" status size "referer" "agent"
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, functions as F

FIELDS = (
    "ip_address",
    "timestamp_str",
    "method",
    "url",
    "protocol",
    "status_code",
    "response_size",
    "referer",
    "user_agent",
)

TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# Lines are cut at "\n", so no captured text can contain it.
_SEPARATOR = "\n"

# Character classes follow Unicode, ASCII members first: Java tests the members of a
# class from left to right, and nearly all log bytes are ASCII.
_SPACE = (
    r"[ [\t-\r\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}]]"
)
_TOKEN = (
    r"[!-~[\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f\xa1-\x{167f}\x{1681}-\x{1fff}"
    r"\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}"
    r"\x{3001}-\x{10ffff}]]"
)
_TIME = r"[0-9A-Za-z_:/[\p{L}\p{N}]]"
_DIGIT = r"[0-9[\p{Nd}]]"

# Anchored at the start only; whatever follows the agent is accepted. Repetitions that
# cannot match the text after them are possessive, so a bad line fails without retries.
LINE_PATTERN = (
    rf"^({_TOKEN}++) {_TOKEN}++ {_TOKEN}++ "
    rf"\[({_TIME}++{_SPACE}[+\-]{_DIGIT}{{4}})\] "
    rf'"({_TOKEN}++) ({_TOKEN}++) ({_TOKEN}+)" '
    rf"({_DIGIT}{{3}}) ({_DIGIT}++|-) "
    r'"([^"]*+)" "([^"]*+)"'
)
_WHOLE_LINE = "(?s)" + LINE_PATTERN + ".*"
_CAPTURES = _SEPARATOR.join(f"${i}" for i in range(1, len(FIELDS) + 1))


def line_fields(line: Column) -> Column:
    """The nine captured texts as an array, or an array of another size for a bad line.

    The pattern runs once per line; extracting the groups one by one would run it ten
    times. That is left to text with a line feed inside, which no scan of lines gives but
    other tables may, and in which the feed cannot part the captures. NULL gives NULL.
    """
    captured = F.split(F.regexp_replace(line, F.lit(_WHOLE_LINE), F.lit(_CAPTURES)), _SEPARATOR)
    groups = [F.regexp_extract(line, _WHOLE_LINE, i) for i in range(1, len(FIELDS) + 1)]
    one_by_one = F.when(line.rlike(_WHOLE_LINE), F.array(*groups)).otherwise(F.array(line))
    return F.when(line.contains(_SEPARATOR), one_by_one).otherwise(captured)


def is_parsed(fields: Column) -> Column:
    return F.coalesce(F.size(fields) == len(FIELDS), F.lit(False))


def _decimal_digits() -> str:
    """All decimal digits beyond ASCII, in runs of ten from zero to nine."""
    found = (chr(c) for c in range(128, sys.maxunicode + 1))
    return "".join(c for c in found if unicodedata.category(c) == "Nd")


_OTHER_DIGITS = _decimal_digits()
_ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)


def digits_to_number(text: Column, sql_type: str) -> Column:
    """Number from decimal digits of any script; NULL when it does not fit the type."""
    return F.coalesce(
        text.try_cast(sql_type),
        F.translate(text, _OTHER_DIGITS, _ASCII_DIGITS).try_cast(sql_type),
    )


def field_columns(fields: Column) -> list[Column]:
    """Typed columns from ``line_fields``; a dash is 0 for the size and NULL for the last two."""
    text = {name: F.get(fields, F.lit(i)) for i, name in enumerate(FIELDS)}
    typed = {
        "status_code": digits_to_number(text["status_code"], "int"),
        "response_size": F.when(text["response_size"] == "-", F.lit(0).cast("bigint")).otherwise(
            digits_to_number(text["response_size"], "bigint")
        ),
        "referer": F.nullif(text["referer"], F.lit("-")),
        "user_agent": F.nullif(text["user_agent"], F.lit("-")),
    }
    return [typed.get(name, text[name]).alias(name) for name in FIELDS]


def log_time(text: Column) -> Column:
    """Instant of a log time with its offset; NULL when it is no valid time."""
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def format_log_time(time: Column, offset: Column | str = "+0000") -> Column:
    """Log time text of a wall-clock time at an offset; ``log_time`` reads it back."""
    zone = F.lit(offset) if isinstance(offset, str) else offset
    return F.concat(F.date_format(time, "dd/MMM/yyyy:HH:mm:ss "), zone)


def format_access_line(
    ip_address: Column,
    time_text: Column,
    request: Column,
    status: Column,
    size: Column,
    referer: Column,
    user_agent: Column,
    user: Column | str = "-",
) -> Column:
    """One combined-format line from its parts; the inverse of ``line_fields``."""
    who = F.lit(user) if isinstance(user, str) else user
    return F.concat(
        ip_address,
        F.lit(" - "),
        who,
        F.lit(" ["),
        time_text,
        F.lit('] "'),
        request,
        F.lit('" '),
        status.cast("string"),
        F.lit(" "),
        size.cast("string"),
        F.lit(' "'),
        referer,
        F.lit('" "'),
        user_agent,
        F.lit('"'),
    )
