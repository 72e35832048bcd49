"""Loads that can be repeated: a list of loaded files decides what is still to be read.

Every load that ends adds its files to the list, with size and time as they were listed before
anything was read, as soon as its rows are published. The next load lists the directory again and
reads what the list lacks. A file that has another size or time than when it was loaded is
reported and left alone, because some of its lines are in the table; replacing its day puts it
right. If a load dies between publishing and listing, its files count as new: replace their days.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame, Row, functions as F

from hitledger.plans import batch
from hitledger.schemas import LOADED_FILES
from hitledger.session import configure_session
from hitledger.sinks import writers
from hitledger.sinks.catalog import LogDatabase
from hitledger.sources import text_logs


@dataclass
class NewFilesReport(batch.LoadReport):
    """Counts of a load of new files. Files already loaded as they are now are ``known_files``."""

    new_files: list[str] = field(default_factory=list)
    changed_files: list[str] = field(default_factory=list)
    known_files: int = 0


def with_state(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Listed files with ``state``: new, known, or changed since the load that counts last."""
    last = loaded.groupBy("path").agg(
        F.max_by(F.struct("bytes", "modified"), F.struct("loaded_at", "modified")).alias("was")
    )
    same = (F.col("was.bytes") == F.col("bytes")) & (F.col("was.modified") == F.col("modified"))
    state = F.when(F.col("was").isNull(), "new").when(same, "known").otherwise("changed")
    return files.join(last, "path", "left").select("path", "bytes", "modified", state.alias("state"))


def record_files(database: LogDatabase, files: list[Row]) -> None:
    """Add files with ``path``, ``bytes`` and ``modified`` to the list."""
    if not files:
        return
    database.create([LOADED_FILES])
    rows = database.spark.createDataFrame(
        [(f["path"], f["bytes"], f["modified"]) for f in files], "path string, bytes long, modified timestamp"
    )
    stamped = rows.withColumns({"loaded_at": F.current_timestamp(), "loaded_on": F.current_date()})
    writers.append(stamped, database, LOADED_FILES)


def append_new_files(
    database: LogDatabase,
    path: str,
    options: batch.LoadOptions | None = None,
    spread_above: int | None = None,
) -> NewFilesReport:
    """Append the lines of files that match ``path`` and were not loaded before."""
    options = options or batch.LoadOptions()
    if options.mode != "append":
        raise ValueError("new files are appended; a day is replaced as a whole")
    spark = configure_session(database.spark)
    database.create([LOADED_FILES])
    listed = with_state(text_logs.list_files(spark, path), database.table(LOADED_FILES))
    # as long as the listing that Spark itself makes of the same directory
    found = listed.orderBy("path").collect()
    new = [row for row in found if row["state"] == "new"]
    report = NewFilesReport(
        new_files=[row["path"] for row in new],
        changed_files=[row["path"] for row in found if row["state"] == "changed"],
        known_files=sum(row["state"] == "known" for row in found),
    )
    if new:
        lines = text_logs.scan_lines(
            spark,
            [text_logs.literal_path(row["path"]) for row in new],
            by_file=options.keep_dropped,
            spread_above=spread_above,
        )
        load = batch.run(lines, database, options, lambda _: record_files(database, new))
        report = replace(report, **vars(load))
    return report


def replace_days(
    database: LogDatabase,
    path: str,
    days: list[date],
    options: batch.LoadOptions | None = None,
    hive_layout: bool = False,
    **how,
) -> batch.LoadReport:
    """Replace days by what their directories and those next to them hold, and list their files.

    ``how`` goes to ``scan_lines``.
    """
    options = replace(options or batch.LoadOptions(), mode="replace", replace_days=tuple(days))
    spark = configure_session(database.spark)
    own = [text_logs.day_path(path, day, hive_layout) for day in days]
    files = text_logs.list_files(spark, own).collect()
    lines = text_logs.scan_around_days(spark, path, days, hive_layout, by_file=options.keep_dropped, **how)
    return batch.run(lines, database, options, lambda _: record_files(database, files))
