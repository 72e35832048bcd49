"""Raw lines -> parsed rows, rejected lines and funnel counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hitledger.functions import logline

_FIELDS = "_fields"


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters must not make Spark evaluate again.

    A filter on a projected column is pushed below the projection, expression and all,
    so the expression would run in the filter and again in the projection. Filters are
    not pushed below a generator's own output.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def split_lines(lines: DataFrame) -> DataFrame:
    """Lines with their captured fields; each line is matched once."""
    return compute_once(lines, _FIELDS, logline.line_fields(F.col("value")))


def parsed_rows(split: DataFrame) -> DataFrame:
    fields = F.col(_FIELDS)
    return split.where(logline.is_parsed(fields)).select(*logline.field_columns(fields))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Nine typed columns of every line that has the combined format."""
    return parsed_rows(split_lines(lines))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines ``parse_lines`` leaves out, with whatever columns came along."""
    return split_lines(lines).where(~logline.is_parsed(F.col(_FIELDS))).drop(_FIELDS)


def with_timestamp(parsed: DataFrame) -> DataFrame:
    """Parsed rows with an instant in place of the text; rows without a valid time go."""
    timed = compute_once(parsed, "timestamp", logline.log_time(F.col("timestamp_str")))
    names = ["timestamp" if name == "timestamp_str" else name for name in logline.FIELDS]
    return timed.where(F.col("timestamp").isNotNull()).select(*names)


def dropped_lines(lines: DataFrame) -> DataFrame:
    """Every line that gives no row, with ``reason`` and whatever columns came along.

    ``pattern``: the line has not the combined format. ``time``: it has, but its time is
    none. Together with the enriched rows these are all lines.
    """
    split = split_lines(lines)
    parsed = logline.is_parsed(F.col(_FIELDS))
    stamp = logline.field_columns(F.col(_FIELDS))[logline.FIELDS.index("timestamp_str")]
    bad_time = parsed & logline.log_time(stamp).isNull()
    reason = F.when(~parsed, "pattern").when(bad_time, "time")
    told = compute_once(split, "reason", reason)
    return told.where(F.col("reason").isNotNull()).drop(_FIELDS)


def judged_lines(lines: DataFrame) -> DataFrame:
    """Every line with its typed columns, its instant, and ``reason``, NULL if it gives a row.

    The reasons are those of ``dropped_lines``; columns that came along stay. One match and one
    look at the time serve the rows and the dropped lines alike.
    """
    split = split_lines(lines)
    parsed = logline.is_parsed(F.col(_FIELDS))
    typed = logline.field_columns(F.when(parsed, F.col(_FIELDS)))
    stamp = F.when(parsed, F.get(F.col(_FIELDS), F.lit(logline.FIELDS.index("timestamp_str"))))
    timed = compute_once(split, "timestamp", logline.log_time(stamp))
    reason = F.when(~parsed, "pattern").when(F.col("timestamp").isNull(), "time")
    columns = [c for c, name in zip(typed, logline.FIELDS) if name != "timestamp_str"]
    return timed.select(*lines.columns, *columns, "timestamp", reason.alias("reason"))


def line_counts() -> list[Column]:
    """Counts over ``split_lines``, for an aggregate or an observation."""
    return [
        F.count(F.lit(1)).alias("lines_read"),
        F.count_if(logline.is_parsed(F.col(_FIELDS))).alias("lines_parsed"),
    ]


def parse_funnel(lines: DataFrame) -> DataFrame:
    """Lines read, parsed, rejected and kept after the time check, in one pass."""
    fields = F.col(_FIELDS)
    time = F.when(
        logline.is_parsed(fields),
        logline.log_time(F.get(fields, F.lit(logline.FIELDS.index("timestamp_str")))),
    )
    counts = split_lines(lines).agg(*line_counts(), F.count(time).alias("rows_enriched"))
    return counts.select(
        "lines_read",
        "lines_parsed",
        (F.col("lines_read") - F.col("lines_parsed")).alias("lines_rejected"),
        "rows_enriched",
    )
