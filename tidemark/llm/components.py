"""Connected components by alternating large-star and small-star steps, each a stored table.

A node with more than ``1 / HUB_SHARE`` of all edges is a hub: at most ``2 * HUB_SHARE`` exist, so their least neighbours are
broadcast and their edges stay where they are; the others meet theirs by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

HUB_SHARE = 500


def _stamp(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _with_least(pairs: DataFrame, edges: int) -> DataFrame:
    """``pairs`` (u, v) with m: the least of u's neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    hub = F.col("n") > max(edges // HUB_SHARE, 1)
    known = pairs.join(F.broadcast(least.filter(hub).select("u", "m")), "u", "left")
    rest = known.filter("m IS NULL").select("u", "v").join(least.filter(~hub).select("u", "m"), "u")
    return known.filter("m IS NOT NULL").unionByName(rest)


def _step(now: DataFrame, edges: int) -> DataFrame:
    # each greater neighbour of a node to the least of the node and its neighbours
    both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _with_least(both, edges).filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
    # every node's lesser neighbours, and itself, to the least of them
    small = _with_least(large, edges).select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
    return small.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Undirected ``edges`` (u, v) to (node, component): the least node that can be reached."""
    now = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc", light=True)
    stamp, before = _stamp(now), None
    while stamp != before:
        before = stamp
        now = staged(_step(now, stamp[0]), "cc", light=True)
        stamp = _stamp(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def merged(tied: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) after further ``edges`` (u, v), nodes of no component yet among them: only the components that these tie are worked on."""
    own = lambda side: tied.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
    ends = edges.join(own("u"), "u", "left").join(own("v"), "v", "left").select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    moved = components(ends).select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = tied.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    new = moved.join(tied.select(F.col("node").alias("component")), "component", "left_anti").select(F.col("component").alias("node"), F.col("to").alias("component"))
    return staged(old.unionByName(new), "cc-merged", light=True)
