"""Access-log lines derived from an ``events`` table.

Every event becomes one line by plain arithmetic on its columns, so the lines grow with
the table and another engine can derive the same ones. They cover what real logs hold:
all device labels, bots, dashes, offsets, extra fields, one address with a third of the
traffic, a week over New Year, and malformed lines of several kinds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hitledger.functions.logline import format_access_line, format_log_time

# Fixed values the lines are made of.
SHIFT_DAYS = 350
BUSY_ADDRESS = "203.0.113.9"
METHODS = ("GET", "GET", "GET", "POST", "PUT", "DELETE", "HEAD")
STATUSES = (200, 200, 200, 201, 204, 301, 304, 400, 403, 404, 500, 503, 199, 999)
REFERERS = ("-", "", "https://shop.example/cart?step=2", "android-app://reader.example")
# One agent for each device label and bot word, and some in which words compete.
AGENTS = (
    "-",
    "",
    "okhttp/4.12 Android 14",
    "FeedApp/7 iPhone17,1",
    "iPod touch music",
    "KaiOS mobile 3.1",
    "iPad reader/2.0",
    "Kids Tablet 10 inch",
    "Chrome/131",
    "Firefox/133",
    "Safari/18.1",
    "Edge/18",
    "Opera/12.16 Presto",
    "linkbot/0.3",
    "site-crawler 2",
    "spiderling/9",
    "price scraper",
    "slurp relay",
    "wget 1.24",
    "Chrome/130 with Safari/537 inside",
    "newsbot on Chrome/120",
    "TABLET spelled large, Mobile too",
    "iPad and Android in one",
    "Edge/17 Chrome/64",
)


def _pick(values: tuple, index: Column) -> Column:
    """The value at ``index`` modulo their number, as text; the array is a constant."""
    choices = F.split(F.lit("\n".join(str(value) for value in values)), "\n")
    return F.get(choices, (index % len(values)).cast("int"))


def event_time() -> Column:
    return F.col("ts") + F.expr(f"INTERVAL '{SHIFT_DAYS}' DAY")


def _address(event: Column, user: Column) -> Column:
    octets = [F.expr("(user_id div 65536) % 256"), F.expr("(user_id div 256) % 256")]
    return (
        F.when(event % 3 == 0, BUSY_ADDRESS)
        .when(event % 41 == 1, F.concat(F.lit("2001:db8::"), (user % 9).cast("string")))
        .otherwise(F.concat_ws(".", F.lit("10"), *octets, user % 256 - user % 4))
    )


def _url(event: Column) -> Column:
    kind = F.col("event_type")
    number = (event % 50).cast("string")
    base = (
        F.when(kind == "view", F.concat(F.lit("/garden/seed-"), number, F.lit(".htm")))
        .when(kind == "click", F.lit("/bundles/w7.min.css?ver=3"))
        .when(kind == "purchase", F.concat(F.lit("/till/receipt?no="), number, F.lit("&f=a.jpg")))
        .when(kind == "signup", F.lit("/members/join"))
        .otherwise(F.lit("/pics/banner.PNG"))
    )
    return F.concat(base, F.when(event % 11 == 3, "#top").otherwise(""))


def _request(event: Column, flaw: Column) -> Column:
    version = F.when(event % 5 == 0, "HTTP/2.0").otherwise("HTTP/1.1")
    whole = F.concat_ws(" ", _pick(METHODS, event), _url(event), version)
    return F.when(flaw == 2, "GET /x").when(flaw == 4, "-").otherwise(whole)


def _time_text(event: Column, flaw: Column) -> Column:
    offset = F.when(event % 31 == 5, "-0530").when(event % 31 == 6, "+0900").otherwise("+0000")
    text = format_log_time(event_time(), offset)
    return F.when(flaw == 11, F.concat(F.lit("99"), F.substring(text, 3, 24))).otherwise(text)


def event_lines(events: DataFrame) -> DataFrame:
    """``event_id``, the day the line belongs to, and the line as ``value``."""
    event, user = F.col("event_id"), F.col("user_id")
    flaw = event % 53
    status = _pick(STATUSES, F.expr("event_id div 3"))
    size = ((event * 6007) % 90001).cast("string")
    line = format_access_line(
        ip_address=_address(event, user),
        time_text=_time_text(event, flaw),
        request=_request(event, flaw),
        status=F.when(flaw == 7, "20").otherwise(status),
        size=F.when(event % 13 == 0, "-")
        .when(event % 997 == 1, "99999999999999999999")
        .otherwise(size),
        referer=F.when(flaw == 5, 'a"b').otherwise(_pick(REFERERS, event)),
        user_agent=F.when(flaw == 10, 'a\\"b').otherwise(_pick(AGENTS, F.expr("event_id div 5"))),
        user=F.when(flaw == 6, "a b").when(event % 29 == 0, "frank").otherwise("-"),
    )
    before = F.when(flaw == 3, " ").otherwise("")
    after = F.when(flaw == 8, ' "10.0.0.1" 0.005').when(flaw == 9, "\r").otherwise("")
    flawed = F.when(flaw == 1, "").otherwise(F.concat(before, line, after))
    return events.select(
        event.alias("event_id"), F.to_date(event_time()).alias("log_day"), flawed.alias("value")
    )
