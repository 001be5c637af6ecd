"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum (with partial aggregation) and an equi-join, so no node's
links meet in one task and nothing is collected.  Every round is written to the shared
scratch space, by as many tasks as its counted links are worth; it ends when a round leaves
the links as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.llm.common import few_tasks, stored


def _large_star(links: DataFrame, rows: int) -> DataFrame:
    """Link each larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = few_tasks(links.union(links.select("v", "u")), 2 * rows)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame, rows: int) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; every link of
    ``links`` goes from a larger node to a smaller one."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    met = links.join(least, "u")
    return few_tasks(met.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.toDF("u", "v")), 2 * rows)


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (two columns); the component is named
    by its smallest node.  NULL ends and self-links are dropped; no links give no rows."""
    links = links.toDF("u", "v").filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = stored(links.distinct(), "components")
    before = _mark(links)
    for _ in range(most_rounds):
        rows = before[0]  # the large star gives no more, nor do both parts of the small star
        links = stored(few_tasks(_small_star(_large_star(links, rows), rows).distinct(), 2 * rows), "components")
        now = _mark(links)
        if now == before:
            roots = links.select(F.col("v").alias("u"), "v")
            return stored(few_tasks(links.union(roots), 2 * now[0]).distinct().toDF("node", "component"), "components")
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def joined_further(joined: DataFrame, links: DataFrame) -> DataFrame:
    """``joined`` (node, component) with more links: only the components that the links
    connect are worked on, not their nodes."""
    ends = links.toDF("a", "b")
    for end in ("a", "b"):
        ends = ends.join(joined.toDF(end, f"{end}_component"), end, "left")
    ends = stored(ends.select(
        "a", "b", F.coalesce("a_component", "a").alias("ca"), F.coalesce("b_component", "b").alias("cb")), "joined-ends")
    if ends.isEmpty():
        return joined
    new = components(ends.select("ca", "cb")).toDF("component", "renamed")
    nodes = ends.select(F.col("a").alias("node"), F.col("ca").alias("component")).union(
        ends.select("b", "cb")).union(joined.select("node", "component")).distinct()
    renamed = nodes.join(new, "component", "left").select("node", F.coalesce("renamed", "component").alias("component"))
    return stored(renamed, "joined")
