"""The stored tables: the five that users read, and those that keep loads cheap and repeatable."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MIB = 1024 * 1024


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "decimal": T.DecimalType(38, 0),
}


def _struct(columns: str) -> T.StructType:
    """Schema from ``name type, ...``; needs no running session, unlike a DDL string."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PARSED = _struct(
    "ip_address string, timestamp_str string, method string, url string, protocol string,"
    " status_code int, response_size bigint, referer string, user_agent string"
)


def text_literal(text: str) -> str:
    """SQL literal of any text."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True, eq=False)
class TableSpec:
    """A stored table. ``schema`` keeps the declared order; Spark stores partition keys last."""

    name: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    target_file_bytes: int
    #: Columns that rows of a partition are sorted by, so that row groups have narrow ranges.
    order_by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def create_statement(self, database: str, location: str) -> str:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        keys = ", ".join(f"`{key}`" for key in self.partition_by)
        return (
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{self.name}` ({columns})"
            f" USING parquet PARTITIONED BY ({keys})"
            f" OPTIONS (compression 'snappy') LOCATION {text_literal(location)}"
        )


# Names, order and types of the columns of the five tables.
ACCESS_LOGS = TableSpec(
    "access_logs",
    _struct(
        "ip_address string, timestamp timestamp, method string, url string, protocol string,"
        " status_code int, response_size bigint, referer string, user_agent string,"
        " device_type string, date date, hour int, year int, month int, day int,"
        " week_of_year int, status_category string, url_path string, file_extension string,"
        " is_bot boolean, processed_timestamp timestamp"
    ),
    ("date",),
    128 * MIB,
    ("timestamp",),
)


@dataclass(frozen=True, eq=False)
class TopTableSpec(TableSpec):
    """A top-N table of ``item`` ranked inside its partition keys."""

    item: str = ""

    @property
    def weekly(self) -> bool:
        return "week_of_year" in self.partition_by


def _daily(name: str, item: str) -> TopTableSpec:
    schema = _struct(
        f"date date, {item} string, request_count bigint, rank int, processed_timestamp timestamp"
    )
    return TopTableSpec(name, schema, ("date",), 64 * MIB, ("rank",), item)


def _weekly(name: str, item: str) -> TopTableSpec:
    schema = _struct(
        "week_start_date date, week_end_date date, year int, week_of_year int,"
        f" {item} string, request_count bigint, rank int, processed_timestamp timestamp"
    )
    return TopTableSpec(name, schema, ("year", "week_of_year"), 64 * MIB, ("rank",), item)


DAILY_TOP_IPS = _daily("daily_top_ips", "ip_address")
DAILY_TOP_DEVICES = _daily("daily_top_devices", "device_type")
WEEKLY_TOP_IPS = _weekly("weekly_top_ips", "ip_address")
WEEKLY_TOP_DEVICES = _weekly("weekly_top_devices", "device_type")

TOP_TABLES = (DAILY_TOP_IPS, DAILY_TOP_DEVICES, WEEKLY_TOP_IPS, WEEKLY_TOP_DEVICES)
ALL_TABLES = (ACCESS_LOGS, *TOP_TABLES)

# Tables of our own. They are made when they are first needed.

#: Requests per day and item; ``kind`` is the column of ``access_logs`` that the item is from.
REQUEST_COUNTS = TableSpec(
    "request_counts",
    _struct("date date, kind string, item string, request_count bigint"),
    ("date", "kind"),
    64 * MIB,
    ("item",),
)
#: Requests per day, device and status, with the number and the sum of the sizes that are set.
DAILY_TRAFFIC = TableSpec(
    "daily_traffic",
    _struct(
        "date date, device_type string, status_category string, status_code int,"
        " requests bigint, sized_requests bigint, bytes decimal"
    ),
    ("date",),
    64 * MIB,
    ("device_type", "status_code"),
)
#: Numbers of the addresses seen per day and device, as bitmaps of 32,768 numbers each.
DAILY_ADDRESSES = TableSpec(
    "daily_addresses",
    _struct("date date, device_type string, bucket bigint, numbers binary"),
    ("date",),
    64 * MIB,
    ("device_type", "bucket"),
)
#: Numbers given to addresses that are not IPv4; every run of the numbering adds a partition.
ADDRESS_NUMBERS = TableSpec(
    "address_numbers",
    _struct("run int, ip_address string, number bigint"),
    ("run",),
    64 * MIB,
    ("ip_address",),
)
#: Files whose lines are loaded, as they were when they were read.
LOADED_FILES = TableSpec(
    "loaded_files",
    _struct("path string, bytes bigint, modified timestamp, loaded_at timestamp, loaded_on date"),
    ("loaded_on",),
    64 * MIB,
    ("path",),
)
#: Lines that gave no row, by the day of the directory that their file is in.
DROPPED_LINES = TableSpec(
    "dropped_lines",
    _struct("value string, reason string, file_path string, file_day string"),
    ("file_day",),
    64 * MIB,
    ("file_path",),
)

#: Tables derived from the rows of a day, which a change of that day makes stale.
DERIVED_BY_DAY = (REQUEST_COUNTS, DAILY_TRAFFIC, DAILY_ADDRESSES)
