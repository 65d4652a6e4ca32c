"""Connected components of an edge table, without collecting edges or components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

EDGES_A_PART = 1 << 18  # few edges are written to few files, one for each core at least


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node points its larger (or its smaller and itself) neighbours at its least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` for every node of an edge: the root is the least node it can reach.

    Alternating large-star and small-star steps (each one aggregation and one join); the number of rounds grows with
    the logarithm of the longest path.  Each round is checkpointed.  Self-loops and repeated edges do no harm; an
    empty edge table gives an empty result.  Null ends are dropped.
    """
    parts = max(edges.sparkSession.sparkContext.defaultParallelism, -(-edges.count() // EDGES_A_PART))
    edges = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .where("u <> v")
        .distinct()
    )
    edges = checkpoint(edges, parts)
    before = _state(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        edges = checkpoint(_star(_star(edges, True), False), parts)
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
