"""Connected components of an edge table, by alternating large and small stars.

Every round replaces edges so that nodes point at smaller nodes; rounds are written to the
shared scratch folder and read back, so lineage stays short and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hitledger.llm.tables import discard, stored

#: Rounds grow with the logarithm of the longest path; a graph that needs more is an error.
MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.where(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours its smallest neighbour.

    Edges come in as (larger, smaller).
    """
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    handed = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return handed.unionByName(own).where(F.col("a") != F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.crc32(F.hex("b").cast("binary")))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node that the edges a - b connect each node with.

    Nodes without an edge have no row. Edges may repeat, run both ways or be loops.
    """
    current = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    state = _state(current)
    for _ in range(MOST_ROUNDS):
        if not state[0]:
            break
        superseded, current = current, stored(_small_star(_large_star(current)), "edges")
        discard(superseded)
        previous, state = state, _state(current)
        if state == previous:
            break
    else:
        raise RuntimeError("components did not settle")
    found = current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
    found.scratch = current.scratch  # whoever has used it may discard it
    return found
