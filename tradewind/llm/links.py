"""Connected components of links between ids, by alternating star contraction.

Each round rewrites the links twice: all larger neighbours of a node are linked to its smallest one
(large star), then all smaller ones (small star), until nothing changes and every node is linked to
the smallest of its component. The number of links never grows; rounds are logarithmic in practice.
Each round is a written table, so no lineage builds up. Only whether it is done reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.storage import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links``: distinct (a, b) with a < b. Link neighbours to the smallest of each neighbourhood."""
    if large:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        near = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    pairs = near.join(least, "u")
    if large:
        moved = pairs.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        moved = pairs.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
    return moved.filter("a < b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none to a smaller one."""
    ends = links.select(F.col("a").alias("u"), F.lit(0).alias("low")).unionByName(
        links.select(F.col("b").alias("u"), F.lit(1).alias("low"))
    )
    roles = ends.groupBy("u").agg(F.sum("low").alias("up"), F.min("low").alias("down"))
    return roles.filter("up > 1 OR (up = 1 AND down = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every id in ``links`` (a, b)."""
    links = links.select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b"))
    links = stored(links.filter("a < b").distinct(), "links")
    while not _settled(links):
        links = stored(_star(_star(links, large=True), large=False), "links")
    rest = links.select(F.col("b").alias("id"), F.col("a").alias("component"))
    roots = links.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return rest.unionByName(roots)


def joined_by(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known`` (id, component of every id) after more ``links`` between its ids."""
    of = known.select(F.col("id").alias("a"), F.col("component").alias("from"))
    to = known.select(F.col("id").alias("b"), F.col("component").alias("to"))
    between = links.join(of, "a").join(to, "b").select(F.col("from").alias("a"), F.col("to").alias("b"))
    moved = components(between).select(F.col("id").alias("component"), F.col("component").alias("moved"))
    return known.join(moved, "component", "left").select("id", F.coalesce("moved", "component").alias("component"))
