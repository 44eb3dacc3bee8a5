"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

A node's neighbourhood minimum is a grouped aggregate with map-side combining, attached again by
a join that AQE may split, so a node with very many neighbours never meets in one task.  Each
step is written to the shared folder; nothing but one count and one checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def _minima(pairs: DataFrame) -> DataFrame:
    """(u, v) to (u, v, m) with m the least of u and its neighbours."""
    m = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(m, "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Undirected links to (node, root): one row per node other than its component's least node.

    Null ends and self-links are ignored; repeated links count once; no links give no rows.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    edges = staged(edges, "links")
    state = _state(edges)
    if not state[0]:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _minima(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        small = _minima(large)
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        edges = staged(small, "links")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
