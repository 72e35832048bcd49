"""Parsed rows -> the columns of ``access_logs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hitledger.functions import derived
from hitledger.operators.parsing import parse_lines, with_timestamp
from hitledger.schemas import ACCESS_LOGS

_AGENT = "_lower_agent"


def enrich(parsed: DataFrame) -> DataFrame:
    """All columns of ``access_logs`` in declared order; columns nobody reads cost nothing."""
    return with_derived(with_timestamp(parsed)).select(*ACCESS_LOGS.columns)


def with_derived(timed: DataFrame) -> DataFrame:
    """Parsed rows with their instant -> the same with all derived columns."""
    lowered = timed.withColumn(_AGENT, F.lower("user_agent"))
    agent, url, status = F.col(_AGENT), F.col("url"), F.col("status_code")
    return lowered.withColumns(
        {
            **derived.calendar(F.col("timestamp")),
            "device_type": derived.device_type(agent),
            "status_category": derived.status_category(status),
            "url_path": derived.url_path(url),
            "file_extension": derived.file_extension(url),
            "is_bot": derived.is_bot(agent),
            "processed_timestamp": F.current_timestamp(),
        }
    ).drop(_AGENT)


def access_logs(lines: DataFrame) -> DataFrame:
    """Raw lines to enriched rows."""
    return enrich(parse_lines(lines))
