"""Writes to the stored tables: append, partition overwrite, and staging before either."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, functions as F

from hitledger.schemas import TableSpec
from hitledger.session import at_once, scoped_conf
from hitledger.sinks.catalog import LogDatabase
from hitledger.sinks.layout import Files, by_files

# Rows take about this many times more bytes in a shuffle than in a snappy parquet file. Only
# writes of rows that were not staged rely on it; for staged ones sizes are measured.
SHUFFLE_BYTES_PER_FILE_BYTE = 3

def in_stored_order(df: DataFrame, database: LogDatabase, spec: TableSpec) -> DataFrame:
    """Columns by name in the order of the catalog's table; what only that has is NULL.

    ``insertInto`` goes by position, and a table that others made or extended may have
    another order than the specification.
    """
    have = {name.lower() for name in spec.columns}
    stored = database.spark.table(database.qualified(spec.name)).schema
    return df.select(
        *[
            F.col(column.name).cast(column.dataType).alias(column.name)
            if column.name.lower() in have
            else F.lit(None).cast(column.dataType).alias(column.name)
            for column in stored
        ]
    )


def _gathered(df: DataFrame, database: LogDatabase, spec: TableSpec) -> DataFrame:
    """Rows gathered by partition key, columns in stored order.

    Unlike a repartition by the key, rebalancing divides a key that is larger than the
    advisory size among several tasks and puts small keys together, from the sizes the
    shuffle measured.
    """
    keys = spec.partition_by
    rows = in_stored_order(df, database, spec)
    return rows.hint("rebalance", *keys).sortWithinPartitions(*keys, *spec.order_by)


def _insert_settings(
    database: LogDatabase, specs: Iterable[TableSpec]
) -> AbstractContextManager[None]:
    file_bytes = max(spec.target_file_bytes for spec in specs)
    settings = {
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(
            file_bytes * SHUFFLE_BYTES_PER_FILE_BYTE
        ),
    }
    return scoped_conf(database.spark, settings)


def _insert(
    df: DataFrame, database: LogDatabase, spec: TableSpec, overwrite: bool, files: Files | None = None
) -> None:
    if files:
        rows = by_files(in_stored_order(df, database, spec), spec, files)
    else:
        rows = _gathered(df, database, spec)
    rows.write.insertInto(database.qualified(spec.name), overwrite=overwrite)


def append(
    df: DataFrame, database: LogDatabase, spec: TableSpec, files: Files | None = None
) -> None:
    """Add rows; columns are matched by name with those of the catalog's table.

    ``files`` has all partitions of the rows with the number of files each gets.
    """
    with _insert_settings(database, [spec]):
        _insert(df, database, spec, overwrite=False, files=files)


def overwrite_partitions(
    results: dict[TableSpec, DataFrame],
    database: LogDatabase,
    files: dict[TableSpec, Files] | None = None,
) -> None:
    """In each table replace the partitions that occur in its rows, and leave the others.

    Each partition is replaced on its own: plain parquet has no transaction over several,
    so a reader may see some new and some old ones while the job commits.
    """
    with _insert_settings(database, results):
        at_once(
            database.spark,
            lambda spec: _insert(results[spec], database, spec, True, (files or {}).get(spec)),
            results,
        )


def replace_owned(
    results: dict[TableSpec, DataFrame],
    owned: dict[TableSpec, Iterable[Sequence]],
    database: LogDatabase,
    files: dict[TableSpec, Files] | None = None,
) -> dict[TableSpec, list[tuple]]:
    """Make the owned partitions of each table hold its rows and nothing else.

    Partitions with rows are overwritten; owned ones without are dropped, where they are
    there. Gives the dropped ones. Partitions that are not owned stay as they are, so rows of
    such partitions must not be among the results.
    """
    overwrite_partitions(results, database, files)
    dropped = {}
    for spec, rows in results.items():
        wanted = {tuple(value) for value in owned[spec]}
        there = {tuple(row) for row in database.partitions(spec).collect()}
        stale = wanted & there
        if stale:  # one row for each partition that was written
            written = rows.select(*spec.partition_by).distinct().collect()
            stale -= {tuple(row) for row in written}
        dropped[spec] = sorted(stale)
        database.drop_partitions(spec, dropped[spec])
    return dropped


def stage(df: DataFrame, database: LogDatabase, spec: TableSpec, name: str) -> None:
    """Write ``df`` unpartitioned into a new table ``name`` of the database.

    The write adds no shuffle. What it stores is the cut in the lineage: losing an
    executor later re-reads parquet, which splits, instead of gzip text, which does not.
    """
    stage_rows(df.select(*spec.columns), database, name)


def stage_rows(df: DataFrame, database: LogDatabase, name: str) -> None:
    """Write rows of any columns into a new table ``name`` of the database."""
    rows = df.write.format("parquet").option("compression", "snappy")
    rows.saveAsTable(database.qualified(name))


def drop_staged(database: LogDatabase, name: str) -> None:
    database.spark.sql(f"DROP TABLE IF EXISTS {database.qualified(name)}")
