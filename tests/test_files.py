"""Loads of new files, large files, dropped lines in one pass, and compaction."""

from __future__ import annotations

import datetime as dt
import gzip
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hitledger import cli
from hitledger.operators import parsing
from hitledger.plans import batch, dropped, newfiles
from hitledger.plans.batch import LoadOptions
from hitledger.schemas import ACCESS_LOGS, DAILY_TOP_IPS, DROPPED_LINES, LOADED_FILES
from hitledger.sinks import compaction, writers
from hitledger.sinks.audit import AuditError
from hitledger.sinks.catalog import LogDatabase
from hitledger.sources import text_logs
from tests.compare import plan
from tests.test_pipeline import database, line, lines_of, ordered, rows_of, stored  # noqa: F401

JUNK = "not a line of the format"


def put(folder, day: int, name: str, texts) -> str:
    place = Path(folder, f"2025/01/{day:02d}")
    place.mkdir(parents=True, exist_ok=True)
    with gzip.open(place / name, "wt") as file:
        file.writelines(text + "\n" for text in texts)
    return str(place / name)


def stamp(day: int) -> str:
    return f"{day:02d}/Jan/2025"


def dropped_rows(database):
    rows = database.table(DROPPED_LINES).collect()
    return sorted((row.file_day, Path(row.file_path).name, row.reason, row.value) for row in rows)


def test_new_files_are_loaded_once(spark, database, tmp_path):
    first = put(tmp_path, 5, "a [1].log.gz", [line(stamp(5)), JUNK, line(stamp(5))])
    put(tmp_path, 6, "b.log.gz", [line(stamp(6), "2.2.2.2")])
    path = f"{tmp_path}/*/*/*/*.log.gz"
    options = LoadOptions(keep_dropped=True)
    report = newfiles.append_new_files(database, path, options)
    assert (len(report.new_files), report.known_files, report.changed_files) == (2, 0, [])
    assert (report.lines_read, report.rows_enriched, report.days) == (4, 3, [dt.date(2025, 1, 5), dt.date(2025, 1, 6)])
    once = stored(database)
    report = newfiles.append_new_files(database, path, options)
    assert (report.new_files, report.known_files, report.lines_read) == ([], 2, 0)
    assert stored(database) == once
    put(tmp_path, 6, "c.log.gz", [line(stamp(6), "2.2.2.2")])
    put(tmp_path, 5, "a [1].log.gz", [line(stamp(5))] * 30)
    report = newfiles.append_new_files(database, path, options)
    assert [Path(p).name for p in report.new_files] == ["c.log.gz"]
    assert [Path(p).name for p in report.changed_files] == [Path(first).name] and report.known_files == 1
    assert len(rows_of(database, ACCESS_LOGS)) == 4
    # replacing its day puts a grown file right, and the list knows it as it is now
    newfiles.replace_days(database, path, [dt.date(2025, 1, 5)], options)
    report = newfiles.append_new_files(database, path, options)
    assert (report.new_files, report.changed_files, report.known_files) == ([], [], 3)
    assert [row[2] for row in rows_of(database, DAILY_TOP_IPS)] == [30, 2]
    assert dropped_rows(database) == []
    with pytest.raises(ValueError):
        newfiles.append_new_files(database, path, LoadOptions(mode="replace", replace_days=(dt.date(2025, 1, 5),)))


def test_a_failed_load_lists_no_files(spark, database, tmp_path, monkeypatch):
    put(tmp_path, 5, "a.log.gz", [JUNK, JUNK, line(stamp(5))])
    path = f"{tmp_path}/*/*/*/*.log.gz"
    with pytest.raises(AuditError):
        newfiles.append_new_files(database, path)
    assert database.table(LOADED_FILES).count() == 0
    with monkeypatch.context() as patch:  # rows are there and the rankings are not
        patch.setattr(batch, "audit_top_tables", lambda *_: (_ for _ in ()).throw(ValueError("no")))
        with pytest.raises(batch.RefreshError):
            newfiles.append_new_files(database, path, LoadOptions(max_dropped_share=0.9))
    assert newfiles.append_new_files(database, path).known_files == 1
    assert len(rows_of(database, ACCESS_LOGS)) == 1


def test_dropped_lines_are_kept_by_file(spark, database, tmp_path):
    put(tmp_path, 5, "a.log.gz", [line(stamp(5)), JUNK, line("99/Jan/2025")])
    put(tmp_path, 5, "b.log.gz", [line(stamp(5)), "other junk"])
    put(tmp_path, 6, "c.log.gz", [line(stamp(6)), "more junk"])
    path = f"{tmp_path}/*/*/*/*.log.gz"
    options = LoadOptions(keep_dropped=True, max_dropped_share=0.9)
    lines = text_logs.scan_lines(spark, path, by_file=True)
    report = batch.run(lines, database, options)
    assert (report.lines_read, report.lines_rejected, report.bad_times, report.rows_enriched) == (7, 3, 1, 3)
    want = [
        ("2025-01-05", "a.log.gz", "pattern", JUNK), ("2025-01-05", "a.log.gz", "time", line("99/Jan/2025")),
        ("2025-01-05", "b.log.gz", "pattern", "other junk"), ("2025-01-06", "c.log.gz", "pattern", "more junk"),
    ]
    assert dropped_rows(database) == want
    both = parsing.dropped_lines(lines).select("reason", "value").collect()
    assert sorted(map(tuple, both)) == sorted((reason, value) for _, _, reason, value in want)
    # one file again, with other lines: only its lines are replaced
    put(tmp_path, 5, "b.log.gz", [line(stamp(5))])
    batch.run(text_logs.scan_lines(spark, f"{tmp_path}/2025/01/05/b.log.gz", by_file=True), database, options)
    assert dropped_rows(database) == [want[0], want[1], want[3]]
    put(tmp_path, 6, "c.log.gz", [line(stamp(6))])
    days = (dt.date(2025, 1, 6),)
    around = text_logs.scan_around_days(spark, path, days, by_file=True)
    for _ in range(2):  # reads the files of 5 January too, and doubles nothing
        batch.run(around, database, LoadOptions(mode="replace", replace_days=days, keep_dropped=True, max_dropped_share=0.9))
        assert dropped_rows(database) == want[:2]
    assert {tuple(row) for row in database.partitions(DROPPED_LINES).collect()} == {("2025-01-05",)}
    with pytest.raises(ValueError):
        batch.run(text_logs.scan_lines(spark, path), database, options)


def test_dropped_lines_can_be_replayed(spark, database, tmp_path, monkeypatch):
    put(tmp_path, 5, "a.log.gz", [line(stamp(5)), JUNK, line("06/Foo/2025", "3.3.3.3")])
    lines = text_logs.scan_lines(spark, f"{tmp_path}/*/*/*/*.log.gz", by_file=True)
    batch.run(lines, database, LoadOptions(keep_dropped=True, max_dropped_share=0.9))
    rule = parsing.logline.log_time
    monkeypatch.setattr(parsing.logline, "log_time", lambda text: rule(F.regexp_replace(text, "Foo", "Jan")))
    report = batch.replay_dropped(database)
    assert (report.lines_read, report.rows_enriched, report.days) == (2, 1, [dt.date(2025, 1, 6)])
    assert [row[1] for row in rows_of(database, DAILY_TOP_IPS)] == ["1.1.1.1", "3.3.3.3"]
    assert [row[2:] for row in dropped_rows(database)] == [("pattern", JUNK)]
    assert batch.replay_dropped(database).rows_enriched == 0
    assert len(rows_of(database, ACCESS_LOGS)) == 2


def test_one_scan_gives_rows_and_dropped_lines(spark, database, tmp_path, monkeypatch):
    put(tmp_path, 5, "a.log.gz", [line(stamp(5)), JUNK])
    scans = []
    monkeypatch.setattr(writers, "stage_rows", lambda df, *rest, go=writers.stage_rows: (scans.append(plan(df)), go(df, *rest)))
    monkeypatch.setattr(dropped, "file_day", lambda c, go=dropped.file_day: go(c))
    lines = text_logs.scan_lines(spark, f"{tmp_path}/*/*/*/*.log.gz", by_file=True)
    batch.run(lines, database, LoadOptions(keep_dropped=True))
    text_scans = [text for text in scans if "Scan text" in text]
    assert len(text_scans) == 1 and text_scans[0].count("regexp_replace(") == 1
    assert text_scans[0].count("gettimestamp(") == 1 and "Exchange" not in text_scans[0]


@pytest.mark.parametrize(("path", "want"), [
    ("file:/x/2025/01/05/a.log.gz", "2025-01-05"), ("/x/year=2025/month=01/day=05/p.gz", "2025-01-05"),
    ("/x/a.gz", "other"), ("/2025/01/05/more/a.gz", "other"), (None, "other"),
])
def test_day_of_a_file(spark, path, want):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(text_logs.file_day(F.col("p"))).first()[0] == want


def test_only_large_files_are_spread(spark, database, tmp_path):
    many = [line(stamp(5), f"10.{i // 250}.0.{i % 250}") for i in range(20_000)]
    large = put(tmp_path, 5, "large.log.gz", many)
    for i in range(100):
        put(tmp_path, 5 + i % 3, f"small-{i}.log.gz", [line(stamp(5 + i % 3), f"1.1.1.{i}")])
    path = f"{tmp_path}/*/*/*/*.log.gz"
    limit = os.path.getsize(large) - 1
    got = text_logs.scan_lines(spark, path, spread_above=limit)
    text = plan(got)
    assert got.count() == 20_100 and ordered(got.collect()) == ordered(text_logs.scan_lines(spark, path).collect())
    dealt = text[text.index("== Physical Plan ==") : text.index("(1) ")]
    assert dealt.count("Scan text") == 2 and dealt.count("Exchange") == 1
    files = text_logs.list_files(spark, path)
    assert files.count() == 101 and files.where(F.col("bytes") > limit).count() == 1
    assert "content" not in plan(files.select("path", "bytes")).split("ReadSchema", 1)[1]
    rows = text_logs.scan_lines(spark, path, spread_above=limit, by_file=True).groupBy("file_path").count()
    assert rows.count() == 101
    for other in (0, 10**9):
        assert text_logs.scan_lines(spark, path, spread_above=other).count() == 20_100
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        text_logs.scan_lines(spark, f"{tmp_path}/none/*", spread_above=limit)


def test_files_of_many_appends_are_put_together(spark, database):
    database.create()
    source = spark.range(0, 4000, 1, 4).select(
        F.concat(
            F.lit("10.0.0."), (F.col("id") % 9).cast("string"), F.lit(" - - ["),
            F.lpad((F.col("id") % 3 + 5).cast("string"), 2, "0"), F.lit("/Jan/2025:"),
            F.lpad((F.col("id") % 24).cast("string"), 2, "0"),
            F.lit(':00:00 +0000] "GET /'), F.xxhash64("id").cast("string"), F.lit(' HTTP/1.1" 200 10 "-" "curl"'),
        ).alias("value"), (F.col("id") % 8).alias("part"),
    )
    from hitledger.operators.enrich import access_logs

    for part in range(8):
        writers.append(access_logs(source.where(F.col("part") == part)), database, ACCESS_LOGS)
    writers.append(access_logs(lines_of(spark, [line(stamp(20))])), database, ACCESS_LOGS)
    before = rows_of(database, ACCESS_LOGS)
    untouched = sorted(Path(database.path(ACCESS_LOGS), "date=2025-01-20").glob("*.parquet"))
    sizes = {r["date"].day: r for r in compaction.file_sizes(database, ACCESS_LOGS).collect()}
    assert sizes[5]["files"] >= 8 and sizes[20]["files"] == 1
    target = sizes[5]["bytes"] // 3 + 1
    report = compaction.compact(database, ACCESS_LOGS, target)
    assert (report.partitions, report.rows, report.files_after) == (3, 4000, 9)
    assert rows_of(database, ACCESS_LOGS) == before
    assert sorted(Path(database.path(ACCESS_LOGS), "date=2025-01-20").glob("*.parquet")) == untouched
    # files are ranges of the time: a reader of an hour opens one of a day's three
    spans = spark.table(database.qualified(ACCESS_LOGS.name)).where("date = '2025-01-05'").groupBy(
        F.input_file_name().alias("f")).agg(F.min("hour").alias("a"), F.max("hour").alias("b")).orderBy("a").collect()
    assert len(spans) == 3 and all(x["b"] <= y["a"] for x, y in zip(spans, spans[1:]))
    assert compaction.compact(database, ACCESS_LOGS, target) == compaction.CompactionReport()
    report = compaction.compact(database, ACCESS_LOGS)
    assert (report.partitions, report.files_after) == (3, 3) and rows_of(database, ACCESS_LOGS) == before
    assert database.staged_tables() == []


def test_published_files_have_the_size_that_was_measured(spark, database, monkeypatch):
    """A hot day with a third of the rows gets more files than the others, and more tasks."""
    database.create()
    lines = spark.range(0, 30_000, 1, 6).select(
        F.concat(
            F.lit("10.0.0.1 - - ["), F.when(F.col("id") % 3 == 0, "05").otherwise(
                F.lpad((F.col("id") % 10 + 6).cast("string"), 2, "0")),
            F.lit("/Jan/2025:"), F.lpad((F.xxhash64("id") % 12 + 12).cast("string"), 2, "0"),
            F.lit(':00:00 +0000] "GET /'), F.xxhash64("id").cast("string"), F.lit(' HTTP/1.1" 200 10 "-" "curl"'),
        ).alias("value")
    )
    target = 60 * 1024
    monkeypatch.setattr(batch, "ACCESS_LOGS", type(ACCESS_LOGS)(
        ACCESS_LOGS.name, ACCESS_LOGS.schema, ACCESS_LOGS.partition_by, target, ACCESS_LOGS.order_by))
    batch.run(lines, database)
    sizes = {r["date"].day: r for r in compaction.file_sizes(database, ACCESS_LOGS).collect()}
    assert sizes[5]["files"] >= 3 and max(sizes[day]["files"] for day in sizes if day != 5) <= sizes[5]["files"] - 2
    assert all(0.2 * target < r["bytes"] / r["files"] < 2 * target for r in sizes.values())
    assert len(rows_of(database, ACCESS_LOGS)) == 30_000
    days = tuple(dt.date(2025, 1, day) for day in sizes)
    batch.run(lines, database, LoadOptions(mode="replace", replace_days=days))
    assert {r["date"].day: r["files"] for r in compaction.file_sizes(database, ACCESS_LOGS).collect()} == {
        day: r["files"] for day, r in sizes.items()
    }


def test_compaction_of_a_weekly_table_and_of_nothing(spark, database):
    assert compaction.compact(database.create(), ACCESS_LOGS) == compaction.CompactionReport()
    for i in range(3):
        batch.run(lines_of(spark, [line(stamp(5 + i), f"1.1.1.{i}")]), database)
    report = compaction.compact(database, DAILY_TOP_IPS)
    assert report == compaction.CompactionReport()  # every partition was overwritten whole


def test_command_line_of_new_files(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    put(tmp_path, 5, "a.log.gz", [line(stamp(5)), JUNK, line(stamp(5))])
    path = f"{tmp_path}/*/*/*/*.log.gz"
    name = f"files_{os.path.basename(tmp_path).replace('-', '_')}"
    base = ["--input-path", path, "--warehouse", f"{tmp_path}/tables", "--database", name]
    more = ["--new-files", "--keep-dropped", "--spread-above", "10", "--summaries", "--compact"]
    for _ in range(2):
        assert cli.main([*base, *more]) == 0
    database = LogDatabase(spark, f"{tmp_path}/tables", name)
    assert len(rows_of(database, ACCESS_LOGS)) == 2 and len(dropped_rows(database)) == 1
    assert cli.main([*base, "--replay-dropped"]) == 0
    put(tmp_path, 5, "a.log.gz", [JUNK[:3]])
    day = ["--process-date", "2025-01-05", "--mode", "replace", "--max-dropped-share", "1"]
    with pytest.raises(AuditError):
        cli.main([*base, *day, "--empty-days", "refuse"])
    capsys.readouterr()
    assert cli.main([*base, *day]) == 0
    assert "days without rows now: 2025-01-05" in capsys.readouterr().out
    assert rows_of(database, ACCESS_LOGS) == []
    with pytest.raises(SystemExit):
        cli.main([*base, *day, "--new-files"])
