"""Connected components over a links table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import cut, heavy_join, packed


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each linked node can reach. Nodes without links are left out.

    Links that are null or lead back to their node are dropped; repeated ones count once. Every round is two
    aggregations with map-side combining and two equi-joins, in which hubs with a great share of all links are joined where
    their links stand, not gathered. The links shrink to stars in O(log^2 n) rounds; lineage is cut after each.
    """
    state = cut(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
        .distinct()
    )
    deep, rows = _shape(state)
    while deep:  # a large star has no more links than it is made of, a small one at most twice as many
        large = packed(cut(_large_star(packed(state, rows))), rows)
        state = packed(cut(_small_star(large)), 2 * rows)
        deep, rows = _shape(state)
    state = packed(state, rows)
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _shape(state: DataFrame) -> tuple[bool, int]:
    """Whether some u has two v or a v is a u; and the number of links."""
    ends = state.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("top")).unionByName(
        state.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("top"))
    )
    per_node = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("top").alias("top"))
    row = per_node.agg(F.max((F.col("up") + F.col("top") > 1).cast("int")).alias("deep"), F.sum("up").alias("rows")).first()
    return bool(row["deep"]), row["rows"] or 0


def _with_least(links: DataFrame) -> DataFrame:
    """links with m, the least v of their u."""
    least = cut(links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("times")))
    total, nodes = least.agg(F.sum("times"), F.count("*")).first()
    return heavy_join(links, packed(least, nodes), ["u"], "times", total or 0).drop("times")


def _large_star(state: DataFrame) -> DataFrame:
    both = state.select("u", "v").unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(state: DataFrame) -> DataFrame:
    known = _with_least(state.select("u", "v"))
    moved = known.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(known.select("u", F.col("m").alias("v"))).distinct()
