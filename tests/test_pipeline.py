"""Catalog, writes, audits and the batch load."""

from __future__ import annotations

import datetime as dt
import gzip
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hitledger import cli
from hitledger.operators import parsing
from hitledger.operators.topn import top_requests
from hitledger.plans import batch
from hitledger.plans.batch import LoadOptions
from hitledger.schemas import ACCESS_LOGS, ALL_TABLES, DAILY_TOP_IPS, TOP_TABLES, WEEKLY_TOP_IPS
from hitledger.session import scratch_dir
from hitledger.sinks import writers
from hitledger.sinks.audit import AuditError, audit_top_tables
from hitledger.sinks.catalog import LogDatabase, list_databases, list_tables
from hitledger.sources import text_logs


def ordered(rows):
    """Rows as tuples in a fixed order; NULLs last, dates by time."""
    return sorted(map(tuple, rows), key=lambda row: [(v is None, str(v)) for v in row])


def line(day: str, ip: str = "1.1.1.1", time: str = "10:00:00 +0000", agent: str = "curl") -> str:
    return f'{ip} - - [{day}:{time}] "GET /a.css HTTP/1.1" 200 10 "-" "{agent}"'


def lines_of(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


@pytest.fixture
def database(spark):
    run_id = uuid.uuid4().hex
    return LogDatabase(spark, f"{scratch_dir(spark)}/{run_id}", f"db_{run_id}")


def rows_of(database, spec):
    columns = [name for name in spec.columns if name != "processed_timestamp"]
    return ordered(database.table(spec).select(*columns).collect())


def stored(database):
    return {spec.name: rows_of(database, spec) for spec in ALL_TABLES}


def staging_tables(database):
    tables = list_tables(database.spark, database.name).collect()
    return [row.tableName for row in tables if row.tableName.startswith("staged_")]


def test_create_is_repeatable_and_lists_tables(spark, database):
    database.create().create()
    assert database.name in [row.namespace for row in list_databases(spark).collect()]
    names = [row.tableName for row in list_tables(spark, database.name).collect()]
    assert sorted(names) == sorted(spec.name for spec in ALL_TABLES)
    database.use()
    assert spark.catalog.currentDatabase() == database.name
    spark.catalog.setCurrentDatabase("default")
    for spec in ALL_TABLES:
        assert [(f.name, f.dataType) for f in database.table(spec).schema] == [
            (f.name, f.dataType) for f in spec.schema
        ]


def test_a_fresh_catalog_finds_stored_data(spark, database):
    batch.run(lines_of(spark, [line("05/Jan/2025")]), database)
    again = LogDatabase(spark, database.location, database.name + "_again").create()
    assert stored(again) == stored(database)


def test_load_counts_and_tables(spark, database):
    texts = [line("05/Jan/2025"), line("05/Jan/2025"), line("06/Jan/2025", "2.2.2.2"),
             line("99/Jan/2025"), "nonsense", ""]
    report = batch.run(lines_of(spark, texts), database)
    assert (report.lines_read, report.lines_parsed, report.lines_rejected) == (6, 4, 2)
    assert report.rows_enriched == 3
    assert report.days == [dt.date(2025, 1, 5), dt.date(2025, 1, 6)]
    assert report.stored == {name: len(rows) for name, rows in stored(database).items()}
    assert rows_of(database, DAILY_TOP_IPS) == [
        (dt.date(2025, 1, 5), "1.1.1.1", 2, 1), (dt.date(2025, 1, 6), "2.2.2.2", 1, 1)
    ]
    assert staging_tables(database) == []


@pytest.mark.parametrize("texts", [[], ["nonsense"], [line("99/Jan/2025")]])
def test_nothing_to_load(spark, database, texts):
    report = batch.run(lines_of(spark, texts), database, LoadOptions(max_dropped_share=1.0))
    assert report.stored == {} and report.rows_enriched == 0
    assert all(rows == [] for rows in stored(database).values())
    assert staging_tables(database) == []


def test_append_twice_doubles_and_replace_does_not(spark, database):
    lines = lines_of(spark, [line("05/Jan/2025"), line("06/Jan/2025")])
    batch.run(lines, database)
    once = stored(database)
    batch.run(lines, database)
    assert rows_of(database, ACCESS_LOGS) == ordered(once["access_logs"] * 2)
    assert {row[2] for row in rows_of(database, DAILY_TOP_IPS)} == {2}
    days = (dt.date(2025, 1, 5), dt.date(2025, 1, 6))
    batch.run(lines, database, LoadOptions(mode="replace", replace_days=days))
    assert stored(database) == once


def test_replace_leaves_other_days_alone(spark, database):
    batch.run(lines_of(spark, [line("05/Jan/2025"), line("20/Jan/2025", "3.3.3.3")]), database)
    day = lines_of(spark, [line("05/Jan/2025", "9.9.9.9")])
    options = LoadOptions(mode="replace", replace_days=(dt.date(2025, 1, 5),))
    batch.run(day, database, options)
    assert [(row[0], row[1]) for row in rows_of(database, DAILY_TOP_IPS)] == [
        (dt.date(2025, 1, 5), "9.9.9.9"), (dt.date(2025, 1, 20), "3.3.3.3")
    ]


def test_replacing_a_day_touches_no_other(spark, database):
    """Rows that an offset moves to another day are left out, and that day stays whole."""
    both = [line(f"{day:02d}/Jan/2025", f"1.1.1.{i}") for day in (5, 6) for i in range(12)]
    batch.run(lines_of(spark, both), database)
    before = stored(database)
    shifted = [line("05/Jan/2025", "7.7.7.7"), line("05/Jan/2025", time="23:30:00 -0530")]
    options = LoadOptions(mode="replace", replace_days=(dt.date(2025, 1, 5),))
    report = batch.run(lines_of(spark, shifted), database, options)
    assert (report.other_days, report.rows_enriched) == (1, 1)
    rows = rows_of(database, ACCESS_LOGS)
    sixth = [row for row in before["access_logs"] if dt.date(2025, 1, 6) in row]
    assert len(sixth) == 12 and [row for row in rows if dt.date(2025, 1, 6) in row] == sixth
    assert [row[0] for row in rows if dt.date(2025, 1, 5) in row] == ["7.7.7.7"]
    again = batch.run(lines_of(spark, shifted), database)
    assert again.days == [dt.date(2025, 1, 5), dt.date(2025, 1, 6)]


def test_replacing_reads_the_neighbours(spark, database, tmp_path):
    for day, times in {5: ["10:00:00 +0000", "23:30:00 -0530"], 6: ["00:10:00 +0900", "10:00:00 +0000"]}.items():
        folder = tmp_path / f"2025/01/{day:02d}"
        folder.mkdir(parents=True)
        with gzip.open(folder / "x.gz", "wt") as file:
            file.writelines(line(f"{day:02d}/Jan/2025", time=time) + "\n" for time in times)
    path = f"{tmp_path}/*/*/*/*.gz"
    batch.run(text_logs.scan_lines(spark, path), database)
    before = stored(database)
    for day in (dt.date(2025, 1, 5), dt.date(2025, 1, 6)):
        lines = text_logs.scan_around_days(spark, path, [day])
        batch.run(lines, database, LoadOptions(mode="replace", replace_days=(day,)))
        assert stored(database) == before


@pytest.mark.parametrize("glob", ["2025/01/*/*.gz", "2025/01/31/*.gz", "2025/*/*/*.gz"])
def test_replacing_reads_neighbours_that_the_glob_excludes(spark, database, tmp_path, glob):
    for day, times in {"2025/01/31": ["10:00:00 +0000"], "2025/02/01": ["00:10:00 +0900", "10:00:00 +0000"]}.items():
        folder = tmp_path / day
        folder.mkdir(parents=True)
        with gzip.open(folder / "x.gz", "wt") as file:
            stamp = dt.date.fromisoformat(day.replace("/", "-")).strftime("%d/%b/%Y")
            file.writelines(line(stamp, time=time) + "\n" for time in times)
    last = dt.date(2025, 1, 31)
    lines = text_logs.scan_around_days(spark, f"{tmp_path}/{glob}", [last])
    report = batch.run(lines, database, batch.LoadOptions(mode="replace", replace_days=(last,)))
    assert (report.lines_read, report.rows_enriched, report.other_days) == (3, 2, 1)
    with pytest.raises(ValueError):
        text_logs.scan_around_days(spark, f"{tmp_path}/2025/02/*/*.gz", [last])


@pytest.mark.parametrize("texts", [["x", "y"], ["99"] * 2])
def test_too_many_dropped_lines_publish_nothing(spark, database, texts):
    texts = [line("05/Jan/2025"), *(line("99/Jan/2025") if text == "99" else text for text in texts)]
    with pytest.raises(AuditError):
        batch.run(lines_of(spark, texts), database)
    assert all(rows == [] for rows in stored(database).values())
    assert staging_tables(database) == []
    batch.run(lines_of(spark, texts), database, LoadOptions(max_dropped_share=0.7))
    assert len(rows_of(database, ACCESS_LOGS)) == 1


def test_every_line_is_accounted_for(spark, database, tmp_path):
    texts = [line("05/Jan/2025"), line("05/Jan/2025"), line("99/Jan/2025"), "junk"]
    report = batch.run(lines_of(spark, texts), database)
    assert (report.lines_rejected, report.bad_times, report.other_days, report.rows_enriched) == (1, 1, 0, 2)
    batch.store_dropped(lines_of(spark, texts), f"{tmp_path}/dropped")
    dropped = spark.read.parquet(f"{tmp_path}/dropped").collect()
    assert sorted((row.reason, row.value) for row in dropped) == [("pattern", "junk"), ("time", texts[2])]


def test_a_failed_refresh_can_be_made_up_for(spark, database, monkeypatch):
    lines = lines_of(spark, [line("05/Jan/2025"), line("06/Jan/2025")])
    with monkeypatch.context() as patch:
        patch.setattr(batch, "audit_top_tables", lambda *_: (_ for _ in ()).throw(ValueError("no")))
        with pytest.raises(batch.RefreshError) as error:
            batch.run(lines, database)
    assert len(rows_of(database, ACCESS_LOGS)) == 2 and rows_of(database, DAILY_TOP_IPS) == []
    batch.refresh(database, days=error.value.report.days)
    once = stored(database)
    assert len(once["daily_top_ips"]) == 2
    batch.refresh(database)
    assert stored(database) == once


def test_days_and_staging_tables_come_from_the_catalog(spark, database):
    batch.run(lines_of(spark, [line("05/Jan/2025"), line("07/Jan/2025")]), database)
    listed = database.days(ACCESS_LOGS)
    assert sorted(row.date for row in listed.collect()) == [dt.date(2025, 1, 5), dt.date(2025, 1, 7)]
    with pytest.raises(ValueError):
        database.days(WEEKLY_TOP_IPS)
    name = database.new_staging_name(DAILY_TOP_IPS)
    writers.stage_rows(spark.range(2), database, name)
    assert database.staged_tables() == [name] == database.drop_staged_tables()
    assert database.staged_tables() == []


def test_a_quote_in_the_location(spark, tmp_path):
    run_id = uuid.uuid4().hex
    database = LogDatabase(spark, f"{tmp_path}/it's", f"quoted_{run_id}")
    batch.run(lines_of(spark, [line("05/Jan/2025")]), database)
    assert len(rows_of(database, ACCESS_LOGS)) == 1


def test_refreshing_touched_periods_equals_refreshing_all(spark, database):
    first = [line(day, ip) for day in ("03/Jan/2024", "30/Dec/2024", "01/Jan/2025", "10/Feb/2025")
             for ip in ("1.1.1.1", "2.2.2.2")]
    batch.run(lines_of(spark, first), database)
    more = lines_of(spark, [line("31/Dec/2024", "2.2.2.2")] * 3)
    batch.run(more, database, LoadOptions(refresh="touched"))
    touched = stored(database)
    for spec in TOP_TABLES:
        logs = database.table(ACCESS_LOGS)
        want = ordered(top_requests(logs, spec).collect())
        assert touched[spec.name] == want


def test_options():
    for bad in (
        {"mode": "merge"}, {"refresh": "some"}, {"mode": "replace"},
        {"replace_days": (dt.date(2025, 1, 5),)},
    ):
        with pytest.raises(ValueError):
            LoadOptions(**bad)


def test_days_of_weeks():
    days = batch.days_of_weeks([dt.date(2024, 12, 30)])
    assert days == [dt.date(2024, 1, d) for d in range(1, 8)] + [
        dt.date(2024, 12, 30), dt.date(2024, 12, 31)
    ]
    assert batch.days_of_weeks([dt.date(2024, 12, 30)], "iso") == [
        dt.date(2024, 12, 30) + dt.timedelta(i) for i in range(7)
    ]


def top_rows(spark, rows):
    return spark.createDataFrame(
        [(*row, None) for row in rows], ",".join(f"`{f.name}` {f.dataType.simpleString()}"
                                                  for f in DAILY_TOP_IPS.schema)
    )


@pytest.mark.parametrize("rows", [
    [],
    [(None, "a", 1, 1)],
    [(dt.date(2025, 1, 1), "a", 1, 6)],
    [(dt.date(2025, 1, 1), "a", 1, None)],
    [(dt.date(2025, 1, 1), "a", 1, 1), (dt.date(2025, 1, 1), "b", 1, 1)],
])
def test_audit_of_top_tables(spark, rows):
    with pytest.raises(AuditError):
        audit_top_tables({DAILY_TOP_IPS: top_rows(spark, rows)}, 5)


def test_overwrite_partitions_of_a_weekly_table(spark, database):
    database.create()
    def week(number, ip, count):
        return (dt.date(2025, 1, 6), dt.date(2025, 1, 12), 2025, number, ip, count, 1, None)
    ddl = ",".join(f"`{f.name}` {f.dataType.simpleString()}" for f in WEEKLY_TOP_IPS.schema)
    for rows in ([week(2, "a", 1), week(3, "b", 1)], [week(2, "c", 2)]):
        writers.overwrite_partitions(
            {WEEKLY_TOP_IPS: spark.createDataFrame(rows, ddl)}, database
        )
    assert [(row[3], row[4]) for row in rows_of(database, WEEKLY_TOP_IPS)] == [(2, "c"), (3, "b")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_large_day_is_written_by_several_tasks(spark, database, monkeypatch):
    database.create()
    monkeypatch.setattr(writers, "SHUFFLE_BYTES_PER_FILE_BYTE", 1)
    small = type(ACCESS_LOGS)(
        ACCESS_LOGS.name, ACCESS_LOGS.schema, ACCESS_LOGS.partition_by, 64 * 1024
    )
    source = spark.range(0, 60000, 1, 8).select(
        F.concat(
            F.lit("10.0."), (F.col("id") % 251).cast("string"), F.lit("."),
            F.xxhash64("id").cast("string"),
            F.when(F.col("id") % 3 == 0, " - - [05").otherwise(F.concat(
                F.lit(" - - ["), F.lpad((F.col("id") % 20 + 6).cast("string"), 2, "0"))),
            F.lit('/Jan/2025:10:00:00 +0000] "GET /a HTTP/1.1" 200 10 "-" "curl"'),
        ).alias("value")
    )
    from hitledger.operators.enrich import access_logs

    writers.append(access_logs(source), database, small)
    logs = database.table(ACCESS_LOGS)
    files = {
        path.name: len(list(path.glob("*.parquet")))
        for path in Path(database.location, ACCESS_LOGS.name).glob("date=*")
    }
    assert logs.count() == 60000
    assert files["date=2025-01-05"] > 1
    assert sum(files.values()) < 8 * len(files)


@pytest.fixture
def archive(tmp_path):
    """Two days of gzip files in plain YYYY/MM/DD directories."""
    days = {"2025/01/05": [line("05/Jan/2025")] * 2, "2025/01/06": [line("06/Jan/2025"), "junk"]}
    for day, texts in days.items():
        folder = tmp_path / "logs" / "web" / day
        folder.mkdir(parents=True)
        with gzip.open(folder / "part-20250105T000000_000000.log.gz", "wt") as file:
            file.writelines(text + "\n" for text in texts)
    return f"{tmp_path}/logs/web/*/*/*/*.log.gz"


def test_scan_of_plain_day_directories(spark, archive):
    assert text_logs.scan_lines(spark, archive).count() == 4
    day = text_logs.parse_day("2025-01-05")
    assert text_logs.scan_one_day(spark, archive, day).count() == 2
    rejected = parsing.rejected_lines(text_logs.scan_lines_by_file(spark, archive)).collect()
    assert [row.value for row in rejected] == ["junk"]
    assert "/2025/01/06/" in rejected[0].file_path


@pytest.mark.parametrize(("path", "hive", "want"), [
    ("s3a://b/logs/app/*/*/*/*.log.gz", False, "s3a://b/logs/app/2025/01/05/*.log.gz"),
    ("/logs/app/", True, "/logs/app/year=2025/month=01/day=05/*.gz"),
    ("/x/web/*/*/*/*.gz", False, "/x/web/2025/01/05/*.gz"),
    ("/logs/*/2025/*/*/a*.gz", False, "/logs/*/2025/01/05/a*.gz"),
    ("/x/web/2025/01/*/*.log.gz", False, "/x/web/2025/01/05/*.log.gz"),
    ("/x/year=*/month=*/day=*/*", True, "/x/year=2025/month=01/day=05/*"),
    ("/x/{2024,2025}/*/0?/*.gz", False, "/x/2025/01/05/*.gz"),
])
def test_day_paths_keep_the_glob(path, hive, want):
    assert text_logs.day_path(path, dt.date(2025, 1, 5), hive) == want


@pytest.mark.parametrize("path", ["/x/*.gz", "/x/2024/*/*/*.gz", "/x/app/*/*.gz"])
def test_day_paths_without_day_levels_are_refused(path):
    with pytest.raises(ValueError):
        text_logs.day_path(path, dt.date(2025, 1, 5))


def test_days_as_text():
    for bad in ("2025-1-5", "2025-02-30", "05/01/2025", ""):
        with pytest.raises(ValueError):
            text_logs.parse_day(bad)


def test_export_and_scan_round_trip(spark, tmp_path):
    texts = ["a", "", "b\r", 'x "y" z', "é"]
    rows = [(dt.date(2025, 1, 5 + i % 2), text) for i, text in enumerate(texts)]
    path = f"{tmp_path}/out"
    text_logs.export_lines(spark.createDataFrame(rows, "day date, value string"), "day", path)
    got = text_logs.scan_lines(spark, f"{path}/*/*/*/*.gz").collect()
    assert sorted(row.value for row in got) == sorted(texts)
    day = text_logs.scan_one_day(spark, path, dt.date(2025, 1, 6), hive_layout=True)
    assert sorted(row.value for row in day.collect()) == ["", 'x "y" z']


def test_export_bounds_the_lines_of_a_file(spark, tmp_path):
    lines = spark.range(1000).select(
        F.lit(dt.date(2025, 1, 5)).alias("day"), F.col("id").cast("string").alias("value")
    )
    path = f"{tmp_path}/out"
    text_logs.export_lines(lines, "day", path, lines_per_file=300)
    assert len(list(Path(path).glob("*/*/*/*.gz"))) >= 4
    for spread in (False, True):
        got = text_logs.scan_lines(spark, f"{path}/*/*/*/*.gz", spread)
        assert sorted(int(row.value) for row in got.collect()) == list(range(1000))
    with pytest.raises(ValueError):
        text_logs.export_lines(lines, "day", path, lines_per_file=0)


def test_spread_lines_load_the_same(spark, database, archive):
    report = batch.run(text_logs.scan_lines(spark, archive, spread=True), database)
    assert (report.lines_read, report.lines_parsed, report.rows_enriched) == (4, 3, 3)
    assert len(rows_of(database, ACCESS_LOGS)) == 3


def test_command_line(spark, archive, tmp_path, capsys, monkeypatch):
    assert cli.main(["--input-path", archive, "--warehouse", "/none",
                     "--process-date", "2025-13-01"]) == 1
    assert "Invalid date" in capsys.readouterr().err
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    name = f"cli_{uuid.uuid4().hex}"
    code = cli.main(["--input-path", archive, "--warehouse", f"{tmp_path}/tables",
                     "--database", name, "--process-date", "2025-01-06",
                     "--spread-lines", "--dropped-path", f"{tmp_path}/dropped"])
    assert code == 0
    assert [row.reason for row in spark.read.parquet(f"{tmp_path}/dropped").collect()] == ["pattern"]
    shown = capsys.readouterr().out
    assert "lines read 2, parsed 1" in shown and "daily_top_devices" in shown
    assert [row[0] for row in rows_of(LogDatabase(spark, "", name), DAILY_TOP_IPS)] == [
        dt.date(2025, 1, 6)
    ]
    for more in (["--mode", "replace"], ["--refresh-only"]):
        assert cli.main(["--input-path", archive, "--warehouse", f"{tmp_path}/tables",
                         "--database", name, "--process-date", "2025-01-06", *more]) == 0
        assert len(rows_of(LogDatabase(spark, "", name), ACCESS_LOGS)) == 1
    with pytest.raises(SystemExit):
        cli.main(["--input-path", archive, "--warehouse", "/none", "--mode", "replace"])


def test_scratch_folder(spark, monkeypatch):
    """The setting, else the folder of setCheckpointDir, else a clear error in any mode."""
    class Session:
        conf = type("", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("", (), {"getCheckpointDir": staticmethod(lambda: "file:/shared/c/1-2")})

    assert scratch_dir(Session) == "file:/shared/c"
    monkeypatch.setattr(Session.sparkContext, "getCheckpointDir", staticmethod(lambda: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session)
