"""Connected components of an edge table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import materialize


def _downward(edges: DataFrame) -> DataFrame:
    """Distinct edges (u, v) with u > v."""
    return edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v), u > v: hang nodes on their
    smallest neighbour.  Large: a node hangs its larger neighbours (and
    through them itself) there; small: its smaller ones.  The minimum per
    node is aggregated map-side, and the join that brings it back is a plain
    equality join, which adaptive execution splits on a hot node.  The large
    one makes at most a row per edge, so only the small one's are made distinct."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.join(least, "u")
    if large:
        return hung.where("v > u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u != v")
    return _downward(hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(least.select("u", F.col("m").alias("v"))))


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root and no root hangs on another."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root")).where("up + root > 1").isEmpty()


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of
    ``edges`` (u, v).  Nodes without an edge don't appear.  Alternating star
    operations; every round is written to the shared checkpoint folder.

    ``known`` is this function's result for other edges, which count too:
    each of its components is then one node of the rounds."""
    if known is not None:
        end = lambda x: known.select(F.col("node").alias(x), F.col("component").alias(f"_{x}"))
        edges = edges.join(end("u"), "u", "left").join(end("v"), "v", "left").select(
            F.coalesce("_u", "u").alias("u"), F.coalesce("_v", "v").alias("v"))
    now = materialize(_downward(edges), "stars")
    while not _settled(now):
        now = materialize(_stars(_stars(now, large=True), large=False), "stars")
    tied = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    if known is None:
        return tied.unionByName(roots)
    moved = known.join(tied.select(F.col("node").alias("component"), F.col("component").alias("_to")), "component", "left")
    old = moved.select("node", F.coalesce("_to", "component").alias("component"))
    # ends that no known component holds; those it holds are listed above
    new = tied.unionByName(roots).join(known.select("node"), "node", "left_anti")
    return old.unionByName(new)
