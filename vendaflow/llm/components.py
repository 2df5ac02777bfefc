"""Connected components of an edge table by alternating large-star and small-star steps.

Every step groups by a vertex with a plain minimum (combined before the shuffle) and joins the minima back; both
sides of that join are read from files, so a vertex with very many edges is split by adaptive execution. Each step
is written to the shared folder, which cuts the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaflow.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    low = materialize(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "estrela")
    joined = both.join(low, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select("u", F.col("m").alias("v")))
    return materialize(moved.where("u <> v").distinct(), "arestas")


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge to another one; component is the smallest node reachable.

    Edges with a null end and loops are ignored; direction and repetition do not matter."""
    now = materialize(edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
                      .where("u <> v and v is not null").distinct(), "arestas")
    before = None
    while True:
        now = _star(_star(now, True), False)
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            break
        before = state
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component")))
