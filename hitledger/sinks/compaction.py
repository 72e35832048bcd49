"""Puts the small files of many loads together, partition by partition.

Sizes come from a listing that opens no file. Only partitions with at least twice the files that
their bytes need are written again. Their rows are staged first, and the numbers of rows are
compared before and after, so a rewrite that goes wrong leaves a copy behind.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hitledger.schemas import TableSpec
from hitledger.session import configure_session, scoped_conf
from hitledger.sinks import writers
from hitledger.sinks.audit import AuditError
from hitledger.sinks.catalog import LogDatabase
from hitledger.sinks.layout import by_files


@dataclass(frozen=True)
class CompactionReport:
    partitions: int = 0
    files_before: int = 0
    files_after: int = 0
    rows: int = 0


def file_sizes(database: LogDatabase, spec: TableSpec) -> DataFrame:
    """Partition keys, ``files`` and ``bytes`` of every partition with files."""
    listed = (
        database.spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(database.path(spec))
    )
    kinds = {field.name: field.dataType for field in spec.schema}
    keys = [
        F.regexp_extract("path", f"/{key}=([^/]*)/", 1).try_cast(kinds[key]).alias(key)
        for key in spec.partition_by
    ]
    return (
        listed.select(*keys, "length")
        .groupBy(*spec.partition_by)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .dropna()
    )


def needed_files(target_bytes: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int")


def fragmented(sizes: DataFrame, target_bytes: int) -> DataFrame:
    """Partitions with twice the files they need or more, with ``needed``."""
    judged = sizes.withColumn("needed", needed_files(target_bytes))
    return judged.where((F.col("files") > 1) & (F.col("files") >= 2 * F.col("needed")))


def _is_one_of(spec: TableSpec, chosen: list) -> Column:
    """Whether a row is in one of the partitions, by literals, so that no other is listed."""
    if len(spec.partition_by) == 1:
        (key,) = spec.partition_by
        return F.col(key).isin([row[key] for row in chosen])
    each = (
        reduce(Column.__and__, [F.col(key) == F.lit(row[key]) for key in spec.partition_by])
        for row in chosen
    )
    return reduce(Column.__or__, each)


def compact(database: LogDatabase, spec: TableSpec, target_bytes: int | None = None) -> CompactionReport:
    """Rewrite the fragmented partitions of a table into files of about ``target_bytes``.

    No load may write to the table meanwhile. Rows stay as they are, and so do all other
    partitions.
    """
    spark = configure_session(database.spark)
    target = target_bytes or spec.target_file_bytes
    keys = list(spec.partition_by)
    # one row for each partition to be rewritten, no more than the catalog lists
    chosen = fragmented(file_sizes(database, spec), target).orderBy(*keys).collect()
    if not chosen:
        return CompactionReport()
    table = spark.table(database.qualified(spec.name))
    rows = table.where(_is_one_of(spec, chosen))
    name = database.new_staging_name(spec)
    writers.stage_rows(rows, database, name)
    staged = spark.table(database.qualified(name))
    count = staged.count()
    files = [(tuple(row[key] for key in keys), row["needed"]) for row in chosen]
    with scoped_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        gathered = by_files(staged.select(*table.columns), spec, files)
        gathered.write.insertInto(database.qualified(spec.name), overwrite=True)
    after = spark.table(database.qualified(spec.name)).where(_is_one_of(spec, chosen)).count()
    if after != count:
        raise AuditError(spec.name, [f"rows changed; they are kept in {name}"], {"before": count, "after": after})
    writers.drop_staged(database, name)
    left = file_sizes(database, spec).where(_is_one_of(spec, chosen)).agg(F.sum("files")).first()[0]
    return CompactionReport(len(chosen), sum(row["files"] for row in chosen), left, count)
