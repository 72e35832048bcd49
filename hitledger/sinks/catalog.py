"""The database that holds the five tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitledger.schemas import ALL_TABLES, TableSpec, text_literal
from hitledger.session import scoped_conf

DEFAULT_DATABASE = "web_logs"
STAGED = "staged_"


class SchemaError(Exception):
    """A table of the catalog cannot hold the rows of its specification."""

    def __init__(self, table: str, faults: list[str]):
        super().__init__(f"{table}: {'; '.join(faults)}")
        self.table, self.faults = table, faults


@dataclass(frozen=True)
class LogDatabase:
    """A catalog database below one shared location.

    Tables have explicit locations, so a session with a fresh catalog finds the data of
    earlier sessions again: a table new to the catalog takes over the partitions that
    are there. A table of ``locations`` lies at its own path.
    """

    spark: SparkSession
    location: str
    name: str = DEFAULT_DATABASE
    locations: dict[str, str] = field(default_factory=dict, hash=False)

    def create(self, specs: Iterable[TableSpec] = ALL_TABLES) -> LogDatabase:
        """Create the database and tables where they do not exist yet.

        A table that exists gets the columns it lacks, and is refused if it is partitioned in
        another way or has a column of another type. Columns it has beyond ours stay, and
        are NULL in the rows we write.
        """
        place = text_literal(self.location.rstrip("/"))
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.name}` LOCATION {place}")
        for spec in specs:
            if self.exists(spec):
                self._match(spec)
                continue
            path = self.path(spec)
            self.spark.sql(spec.create_statement(self.name, path))
            # Writing no rows makes the directory that the recovery lists.
            none = self.spark.createDataFrame([], spec.schema)
            none.write.partitionBy(*spec.partition_by).mode("append").parquet(path)
            self.spark.catalog.recoverPartitions(self.qualified(spec.name))
        return self

    def path(self, spec: TableSpec) -> str:
        return self.locations.get(spec.name, f"{self.location.rstrip('/')}/{spec.name}")

    def exists(self, spec: TableSpec) -> bool:
        return self.spark.catalog.tableExists(self.qualified(spec.name))

    def _match(self, spec: TableSpec) -> None:
        name = self.qualified(spec.name)
        listed = {column.name.lower(): column for column in self.spark.catalog.listColumns(name)}
        kept_by = tuple(key for key, column in listed.items() if column.isPartition)
        faults = []
        if kept_by != spec.partition_by:
            faults.append(f"partitioned by {kept_by}, not {spec.partition_by}")
        lacking = []
        for want in spec.schema:
            column, kind = listed.get(want.name), want.dataType.simpleString()
            if column is None:
                lacking.append(f"`{want.name}` {kind}")
            elif column.dataType != kind:
                faults.append(f"{want.name} is {column.dataType}, not {kind}")
        if faults:
            raise SchemaError(spec.name, faults)
        if lacking:
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(lacking)})")

    def use(self) -> None:
        self.spark.catalog.setCurrentDatabase(self.name)

    def qualified(self, table: str) -> str:
        return f"`{self.name}`.`{table}`"

    def table(self, spec: TableSpec) -> DataFrame:
        """The stored table in its declared column order."""
        return self.spark.table(self.qualified(spec.name)).select(*spec.columns)

    def tables(self) -> dict[str, DataFrame]:
        return {spec.name: self.table(spec) for spec in ALL_TABLES}

    def days(self, spec: TableSpec) -> DataFrame:
        """``date`` of every partition of a daily table, from the catalog alone.

        No file is opened and none is listed. A partition stays listed as long as it exists,
        and writes only make partitions that have rows.
        """
        if spec.partition_by != ("date",):
            raise ValueError(f"{spec.name} is not partitioned by date")
        listed = self.spark.sql(f"SHOW PARTITIONS {self.qualified(spec.name)}")
        value = F.substring_index("partition", "=", -1)
        return listed.select(value.try_cast("date").alias("date")).where("date IS NOT NULL")

    def partitions(self, spec: TableSpec) -> DataFrame:
        """Partition keys of every partition of a table, typed, from the catalog alone."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.qualified(spec.name)}")
        kinds = {field.name: field.dataType for field in spec.schema}
        keys = [
            F.regexp_extract("partition", f"(?:^|/){key}=([^/]*)", 1).try_cast(kinds[key]).alias(key)
            for key in spec.partition_by
        ]
        return listed.select(*keys).dropna()

    def drop_partitions(self, spec: TableSpec, values: Iterable[Sequence]) -> None:
        """Remove partitions with their files.

        A value of the first keys only stands for all partitions that begin with it. The tables
        have locations of their own, so that dropping a partition from the catalog leaves its
        files. Overwriting it with no rows removes them.
        """
        name, keys = self.qualified(spec.name), spec.partition_by
        kinds = {field.name: field.dataType.simpleString() for field in spec.schema}
        values = sorted({tuple(value) for value in values})
        if not values:
            return

        def given(value: tuple) -> list[str]:
            pairs = zip(keys, value, strict=False)
            return [f"`{key}` = {_literal(kinds[key], v)}" for key, v in pairs]

        columns = [
            f"CAST(NULL AS {field.dataType.simpleString()}) AS `{field.name}`"
            for field in self.spark.table(name).schema
        ]

        def empty(value: tuple) -> None:
            open_keys = [f"`{key}`" for key in keys[len(value) :]]
            picked = [c for c in columns if not any(c.endswith(f" AS `{key}`") for key in keys[: len(value)])]
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {name} PARTITION ({', '.join(given(value) + open_keys)})"
                f" SELECT {', '.join(picked)} WHERE FALSE"
            )

        with scoped_conf(self.spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
            for value in values:  # writes to one table share a folder, so one after another
                empty(value)
        listed = ", ".join(f"PARTITION ({', '.join(given(value))})" for value in values)
        self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {listed}")

    def new_staging_name(self, spec: TableSpec) -> str:
        return f"{STAGED}{spec.name}_{uuid.uuid4().hex}"

    def staged_tables(self) -> list[str]:
        """Staging tables that are there: of running loads, and of loads that were killed."""
        tables = list_tables(self.spark, self.name).collect()
        return sorted(row.tableName for row in tables if row.tableName.startswith(STAGED))

    def drop_staged_tables(self) -> list[str]:
        """Remove all staging tables. Only for a time when no load runs."""
        names = self.staged_tables()
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(name)}")
        return names


def _literal(kind: str, value) -> str:
    """SQL literal of a partition's value."""
    if kind in ("int", "bigint"):
        return str(int(value))
    return f"DATE {text_literal(str(value))}" if kind == "date" else text_literal(str(value))


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`")
