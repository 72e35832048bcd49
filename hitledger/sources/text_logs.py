"""Gzipped log files in day directories: scanning and exporting."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, timedelta
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LOG_FILES = "*.log.gz"
DAY_KEYS = ("year", "month", "day")


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path``, ``bytes`` and ``modified`` of the files that match, which are not opened."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def literal_path(path: str) -> str:
    """A file's path as a pattern that no other file matches."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _read(spark: SparkSession, path: str | list[str], by_file: bool) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    if by_file:
        return lines.select("value", F.col("_metadata.file_path").alias("file_path"))
    return lines.select("value")


def scan_lines(
    spark: SparkSession,
    path: str | list[str],
    spread: bool = False,
    by_file: bool = False,
    spread_above: int | None = None,
) -> DataFrame:
    """One row per line of the files that match ``path``, split at line feeds only.

    Gzip is recognised by the file name. A gzip file is read by one task, so the file
    count of the archive bounds how wide the scan can be. When a few files hold most of
    the lines, ``spread`` deals the raw lines out evenly before anything is parsed; it
    shuffles the text, so it is not the default. ``spread_above`` does so for files larger
    than that many bytes only; the lines of all others are parsed where they are read.

    ``by_file`` adds ``file_path``, to trace lines and to keep the dropped ones by file.
    """
    if spread_above is None or spread:
        lines = _read(spark, path, by_file)
        return lines.hint("rebalance") if spread else lines
    # as long as Spark's own listing of the same files
    large, small = [], []
    for file in list_files(spark, path).select("path", "bytes").toLocalIterator():
        (large if file["bytes"] > spread_above else small).append(literal_path(file["path"]))
    parts = [_read(spark, small, by_file)] if small else []
    if large:
        parts.append(_read(spark, large, by_file).hint("rebalance"))
    return reduce(DataFrame.unionByName, parts) if parts else _read(spark, path, by_file)


def scan_lines_by_file(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with the file each came from, to trace rejected lines."""
    return scan_lines(spark, path, by_file=True)


def file_day(file_path: Column) -> Column:
    """Day of the directory that a file is in, as text, in either layout; else ``other``."""
    plain = F.regexp_extract(file_path, r"/([0-9]{4}/[0-9]{2}/[0-9]{2})/[^/]*$", 1)
    hive = F.regexp_extract(file_path, r"/year=([0-9]{4}/month=[0-9]{2}/day=[0-9]{2})/[^/]*$", 1)
    found = F.regexp_replace(F.when(plain != "", plain).otherwise(hive), "/(month=|day=)?", "-")
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("other"))


def parse_day(text: str) -> date:
    """A day given as YYYY-MM-DD."""
    try:
        if re.fullmatch(r"\d{4}-\d{2}-\d{2}", text, re.ASCII):
            return date.fromisoformat(text)
    except ValueError:
        pass
    raise ValueError(f"Invalid date {text!r}, use YYYY-MM-DD")


def _fits(level: str, name: str) -> bool:
    """Whether a path level, which may be a pattern, can stand for a directory name."""
    return "{" in level or fnmatchcase(name, level)


def day_path(path: str, day: date, hive_layout: bool = False, neighbour: bool = False) -> str:
    """``path`` with its three day levels, those before the file, set to one day.

    Everything else of a glob stays as it is given. A path without any pattern is taken for
    an archive's root. Directories are ``YYYY/MM/DD``, or ``year=YYYY/month=MM/day=DD`` as
    this module's export and other Hive-style writers lay them out. A ``neighbour`` of a day
    that the glob holds need not be in the glob's month or year itself.
    """
    names = [f"{day:%Y}", f"{day:%m}", f"{day:%d}"]
    if hive_layout:
        names = [f"{key}={name}" for key, name in zip(DAY_KEYS, names)]
    if not any(sign in path for sign in "*?[{"):
        return "/".join([path.rstrip("/"), *names, "*.gz" if hive_layout else LOG_FILES])
    *before, year, month, day_level, files = path.split("/")
    held = neighbour or all(map(_fits, (year, month, day_level), names))
    if len(before) < 1 or not held:
        raise ValueError(
            f"{path!r} does not end in levels for year, month, day and file that hold {day}"
        )
    return "/".join([*before, *names, files])


def scan_one_day(
    spark: SparkSession, path: str, day: date, hive_layout: bool = False, spread: bool = False, **how
) -> DataFrame:
    """Lines of one day's directory only; ``how`` goes to ``scan_lines``."""
    return scan_lines(spark, day_path(path, day, hive_layout), spread, **how)


def scan_around_days(
    spark: SparkSession,
    path: str,
    days: Iterable[date],
    hive_layout: bool = False,
    spread: bool = False,
    **how,
) -> DataFrame:
    """Lines of the directories that can hold rows of the days, for a load that replaces them.

    An offset moves a row over midnight by up to a day, so the directories next to a day are
    read as well, also where the glob names one month or year and they lie in another. Those
    of the days themselves must exist and be in the glob, their neighbours need not.
    """
    wanted = set(days)
    for day in wanted:
        day_path(path, day, hive_layout)
    near = {day + timedelta(days=i) for day in wanted for i in (-1, 0, 1)}
    parts = []
    for day in sorted(near):
        try:
            near_path = day_path(path, day, hive_layout, neighbour=True)
            parts.append(scan_lines(spark, near_path, spread, **how))
        except AnalysisException as error:
            if day in wanted or error.getCondition() != "PATH_NOT_FOUND":
                raise
    return reduce(DataFrame.unionByName, parts)


def export_lines(lines: DataFrame, day: str, path: str, lines_per_file: int = 500_000) -> None:
    """Write ``value`` as gzip text, one directory per value of the date column ``day``.

    Rows are gathered by day, and a day too large for one task is divided. No file gets
    more than ``lines_per_file`` lines, because whoever reads it does so in one task.
    """
    if lines_per_file < 1:
        raise ValueError(f"lines_per_file must be at least 1, not {lines_per_file}")
    keys = {
        "year": F.date_format(day, "yyyy"),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
    }
    (
        lines.select("value", *(expr.alias(name) for name, expr in keys.items()))
        .hint("rebalance", *DAY_KEYS)
        .write.partitionBy(*DAY_KEYS)
        .option("compression", "gzip")
        .option("lineSep", "\n")
        .option("maxRecordsPerFile", lines_per_file)
        .text(path)
    )
