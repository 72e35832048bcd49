"""The table of dropped lines: what gave no row, why, and from which file.

Its rows come from the staging table of a load, so the archive is read and parsed once. A load
puts a file's dropped lines in the place of those the table has of that file; other files stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hitledger.schemas import DROPPED_LINES
from hitledger.sinks import writers
from hitledger.sinks.catalog import LogDatabase
from hitledger.sources.text_logs import file_day


def store(staged: DataFrame, database: LogDatabase) -> None:
    """Replace the dropped lines of the staged files; every line of them must be staged.

    ``staged``: ``value`` and ``reason``, NULL for lines that gave a row, and ``file_path``. A
    file without any line leaves no trace here, so what the table has of it stays.
    """
    database.create([DROPPED_LINES])
    day = file_day(F.col("file_path")).alias("file_day")
    files = staged.select("file_path", day).distinct()
    days = files.select("file_day").distinct()
    # partitions that are written; there are no more than days in the load
    owned = [tuple(row) for row in days.collect()]
    before = database.table(DROPPED_LINES)
    others = before.where(F.col("file_day").isin([value for (value,) in owned])).join(
        files.select("file_path"), "file_path", "left_anti"
    )
    new = staged.where("reason IS NOT NULL").select("value", "reason", "file_path", day)
    name = database.new_staging_name(DROPPED_LINES)
    try:
        writers.stage(new.unionByName(others), database, DROPPED_LINES, name)
        rows = database.spark.table(database.qualified(name))
        writers.replace_owned({DROPPED_LINES: rows}, {DROPPED_LINES: owned}, database)
    finally:
        writers.drop_staged(database, name)


def kept_lines(database: LogDatabase) -> DataFrame:
    """The dropped lines as a scan by file gives them."""
    database.create([DROPPED_LINES])
    return database.table(DROPPED_LINES).select("value", "file_path")
