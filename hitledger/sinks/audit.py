"""Checks a staged write must pass before it is published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hitledger.schemas import TopTableSpec


class AuditError(Exception):
    """A staged write broke a rule; nothing of it was published."""

    def __init__(self, table: str, broken: list[str], counts: dict[str, int]):
        super().__init__(f"{table}: {'; '.join(broken)} ({counts})")
        self.table, self.broken, self.counts = table, broken, counts


def check(table: str, rules: dict[str, bool], counts: dict[str, int]) -> None:
    """Raise with the faults whose rule does not hold."""
    broken = [rule for rule, holds in rules.items() if not holds]
    if broken:
        raise AuditError(table, broken, counts)


def _any_null(columns: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, (F.col(name).isNull() for name in columns))


def _top_table_counts(staged: DataFrame, spec: TopTableSpec, n: int) -> DataFrame:
    keys = spec.partition_by
    rows, rank = F.col("rows"), F.col("rank")
    return (
        staged.groupBy(*keys, "rank")
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            F.coalesce(F.sum(rows), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(_any_null(keys), rows)), F.lit(0)).alias("null_keys"),
            F.count_if(~F.coalesce(rank.between(1, n), F.lit(False))).alias("bad_ranks"),
            F.count_if(rows > 1).alias("repeated_ranks"),
        )
        .select(F.lit(spec.name).alias("table"), "*")
    )


def audit_top_tables(
    staged: dict[TopTableSpec, DataFrame], n: int, may_be_empty: bool = False
) -> dict[str, int]:
    """Check top-N tables: some rows, keys set, ranks 1..n, each rank once per group.

    All tables are counted in one job, and all must pass. Returns their row counts.
    """
    counts = [_top_table_counts(rows, spec, n) for spec, rows in staged.items()]
    found = {row["table"]: row.asDict() for row in reduce(DataFrame.unionByName, counts).collect()}
    for table, count in found.items():
        rules = {
            "no rows": may_be_empty or count["rows"] > 0,
            "partition key is NULL": count["null_keys"] == 0,
            f"rank outside 1..{n}": count["bad_ranks"] == 0,
            "rank repeated in a group": count["repeated_ranks"] == 0,
        }
        check(table, rules, count)
    return {table: count["rows"] for table, count in found.items()}
