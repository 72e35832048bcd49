"""Which file of which partition a row goes to, from measured sizes.

Nothing is guessed: the bytes of a row are those it has in files that are there already, and the
rows of each partition are counted. Each file is one task's work, so a hot partition is written
by as many tasks as it has files.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from math import ceil

from pyspark.sql import DataFrame, functions as F

from hitledger.schemas import TableSpec

#: A partition: its key values and the number of files it gets.
Files = Sequence[tuple[tuple, int]]

#: Ranges that a partition's rows are divided into before they are put together into files.
RANGES = 32


def bytes_per_row(stored: DataFrame, rows: int) -> float:
    """Bytes that a row of stored files takes; opens their footers only."""
    files = stored.select("_metadata.file_path", "_metadata.file_size").distinct()
    total = files.agg(F.sum("file_size")).first()[0]
    return (total or 0) / max(1, rows)


def files_for(counts: Iterable[tuple[tuple, int]], row_bytes: float, target_bytes: int) -> Files:
    """Files for partitions with so many rows."""
    return [(key, max(1, ceil(rows * row_bytes / target_bytes))) for key, rows in counts]


def by_files(rows: DataFrame, spec: TableSpec, files: Files) -> DataFrame:
    """Rows of the given partitions, each file's in a task of its own and sorted.

    The files of a partition are ranges of the first column it is sorted by where that is a
    time, so that a reader of some hours opens few; otherwise rows are dealt out by a hash.
    """
    keys = list(spec.partition_by)
    kinds = {field.name: field.dataType.simpleString() for field in spec.schema}
    plan, total = [], 0
    for key, needed in files:
        plan.append((*key, needed, total))
        total += needed
    ddl = ", ".join(f"`{key}` {kinds[key]}" for key in keys) + ", _needed int, _first int"
    planned = rows.join(F.broadcast(rows.sparkSession.createDataFrame(plan, ddl)), keys)
    number = F.lit(0)
    if any(needed > 1 for _, needed in files):
        needed = F.col("_needed")
        number = F.pmod(F.xxhash64(*spec.columns), needed)
        if spec.order_by and kinds[spec.order_by[0]] == "timestamp":
            at = F.unix_micros(spec.order_by[0])
            shares = [i / RANGES for i in range(1, RANGES)]
            # one row for each partition
            edges = planned.where("_needed > 1").groupBy(*keys).agg(F.percentile_approx(at, shares).alias("_edges"))
            planned = planned.join(F.broadcast(edges), keys, "left")
            below = F.size(F.filter(F.coalesce("_edges", F.array().cast("array<bigint>")), lambda edge: edge < at))
            number = F.when(needed <= RANGES, F.floor(below * needed / RANGES)).otherwise(number)
    numbered = planned.withColumn("_file", (F.col("_first") + number).cast("int"))
    gathered = numbered.repartitionById(max(1, total), F.col("_file"))
    return gathered.sortWithinPartitions(*keys, *spec.order_by).select(*rows.columns)
