"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyledger.llm.common import staged

ROUNDS = 64


def _with_least(edges: DataFrame, within: str | None) -> DataFrame:
    """Edges (u, v) in both directions, each with the least node around u.

    The least nodes are combined before they are shuffled, and stored, so that the
    join with a hub's edges can be split.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "component-least", within)
    return both.join(least, "u")


def _large_star(edges: DataFrame, within: str | None) -> DataFrame:
    return _with_least(edges, within).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, within: str | None) -> DataFrame:
    """Every edge points down; each node and its smaller neighbours go to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = staged(down.groupBy("u").agg(F.min("v").alias("m")), "component-least", within)
    return down.join(least, "u").select("v", "m").union(least.select(F.col("u").alias("v"), "m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))


def components(links: DataFrame, within: str | None = None) -> DataFrame:
    """For links (u, v): every linked node with the least node it reaches (node, root).

    Nodes may have any ordered type. Links of a node with itself are ignored.
    Each round is a written table, in ``within`` if it is given; the loop ends when the links no longer change.
    """
    edges = staged(links.where("u <> v").select("u", "v").distinct(), "component-edges", within)
    seen = None
    for _ in range(ROUNDS):
        edges = _large_star(edges, within).where("u <> v").distinct()
        edges = staged(_small_star(edges, within).where("u <> v").distinct(), "component-edges", within)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).head()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        seen = now
    raise RuntimeError("the components have not settled")
