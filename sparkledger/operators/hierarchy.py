"""Ancestors and descendants along parent links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkledger.session import snapshot

# Fixed value: the id that stands for no parent.
NO_PARENT = 0


# Levels that are walked one by one from seeds before distances are doubled.
STEPS = 12


def ancestor_pairs(links: DataFrame, node: str, parent: str, seeds: DataFrame | None = None) -> DataFrame:
    """All (root_id, descendant_id, depth) pairs below the parent links; optionally only for seed descendants.

    Each round doubles the depth that is known: a node's ancestors beyond its 2^k-th one are the known ancestors
    of that one. That is one join a round, in which only nodes that still have an ancestor at 2^k take part, so
    that a hierarchy of depth d takes log2(d) joins and depth is not limited. A path that meets itself stops
    there. A parent that is 0, the node itself or not a node is none; a node has one parent.

    From seeds, pairs are made for the seeds only: see `_seed_pairs`.
    """
    nodes = links.select(F.col(node).alias("root_id"))
    edges = links.select(F.col(node).alias("descendant_id"), F.col(parent).alias("root_id")).where(
        (F.col("root_id") != NO_PARENT) & (F.col("root_id") != F.col("descendant_id"))
    )
    edges = snapshot(edges.join(nodes, "root_id", "left_semi").select("root_id", "descendant_id", F.lit(1).alias("depth")))
    if seeds is not None:
        return _seed_pairs(edges, seeds.select(F.col(node).alias("descendant_id")).distinct())
    known = edges
    reach, jumps = 1, known
    while not jumps.isEmpty():
        beyond = _beyond(jumps, known, reach)
        # A node that meets itself is on a cycle; from there on, paths have to be cut where they repeat.
        if not beyond.where("root_id = descendant_id").isEmpty():
            beyond = snapshot(_without_repeats(beyond, known))
        reach *= 2
        known, jumps = known.unionByName(beyond), beyond.where(F.col("depth") == reach)
    return known.select("root_id", "descendant_id", "depth")


def _seed_pairs(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Pairs whose descendant is a seed.

    The first `STEPS` levels are one join of the last level's pairs with the links each, so that a shallow hierarchy
    writes nothing but the result. Of what is deeper, the 2^k-th ancestors of all nodes are kept, a row for each node,
    and the pairs so far are carried that far up; what was reached before is dropped, which ends cycles.
    """
    known, last = None, seeds.select(F.col("descendant_id").alias("root_id"), "descendant_id", F.lit(0).alias("depth"))
    for _ in range(STEPS):
        last = _carried(last, edges, 1, known)
        if last.isEmpty():
            return _pairs(known, last)
        known = last if known is None else known.unionByName(last)
    reach, jumps, bases = 1, edges.select("descendant_id", "root_id"), last
    while True:
        more = _carried(bases, jumps, reach, known)
        if more.isEmpty():
            return known
        known, bases = known.unionByName(more), bases.unionByName(more)
        further = jumps.select(F.col("descendant_id").alias("root_id"), F.col("root_id").alias("_far"))
        jumps = snapshot(jumps.join(further, "root_id").select("descendant_id", F.col("_far").alias("root_id")).distinct())
        reach *= 2


def _pairs(known: DataFrame | None, empty: DataFrame) -> DataFrame:
    return empty if known is None else known


def _carried(pairs: DataFrame, jumps: DataFrame, reach: int, known: DataFrame | None) -> DataFrame:
    """The pairs moved `reach` links up, at their least depth, less those known before and those of a node with itself. A snapshot."""
    first = pairs.select("descendant_id", F.col("root_id").alias("_at"), "depth")
    second = jumps.select(F.col("descendant_id").alias("_at"), "root_id")
    moved = first.join(second, "_at").where("root_id <> descendant_id")
    moved = moved.groupBy("root_id", "descendant_id").agg((F.min("depth") + reach).alias("depth"))
    if known is not None:
        moved = moved.join(known, ["root_id", "descendant_id"], "left_anti")
    return snapshot(moved.select("root_id", "descendant_id", "depth"))


def _beyond(jumps: DataFrame, known: DataFrame, reach: int) -> DataFrame:
    """Pairs of a depth over `reach` and up to twice that. A snapshot."""
    first = jumps.select("descendant_id", F.col("root_id").alias("_at"))
    second = known.select(F.col("descendant_id").alias("_at"), "root_id", (F.col("depth") + reach).alias("depth"))
    return snapshot(first.join(second, "_at").select("root_id", "descendant_id", "depth"))


def _without_repeats(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs at their least depth, less those known before and those of a node with itself."""
    keys = ["root_id", "descendant_id"]
    least = pairs.where("root_id <> descendant_id").groupBy(*keys).agg(F.min("depth").alias("depth"))
    return least.join(known, keys, "left_anti").select(*keys, "depth")
