"""Connected components of edge tables of any size, in two ways.

Both take edges ``(u, v)`` of bigints in any direction, with repeats and self edges, and give
``(node, root)`` for each node that has an edge to another; ``root`` is one node of the component,
the same for all its nodes.  NULL ends and self edges are left out; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch


def _clean(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v")).where("u <> v")


def seed_tree_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components by pruning to seeds: each round a vertex connects its neighbours to the least of them;
    a vertex that no neighbour chose drops out below its own least, into a propagation forest; the
    vertices that remain when no edge is left are the seeds, whose ids then flow down the forest.

    A round is two aggregations and two joins over the edges left, which shrink quickly.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "seedtree")
    e = _clean(edges)
    e = scratch.cut(e.select("u", "v").union(e.select("v", "u")).distinct(), "edges")
    forest: list[DataFrame] = []
    for _ in range(max_rounds):
        if e.isEmpty():
            break
        least = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        told = e.join(least, "u").select(F.col("v").alias("node"), "m").union(least.select(F.col("u").alias("node"), "m"))
        told = scratch.cut(told.distinct(), "told")
        own = told.groupBy("node").agg(F.min("m").alias("low"), F.max("m").alias("high"), F.max(F.col("m") == F.col("node")).alias("stays"))
        own = scratch.cut(own, "own")
        forest.append(own.where(~F.col("stays")).select("node", F.col("low").alias("parent")))
        left = told.join(own.where("low < high").select("node", "low"), "node").where("m <> low").select(F.col("m").alias("u"), F.col("low").alias("v"))
        nxt = scratch.cut(left.union(left.select("v", "u")).distinct(), "edges")
        scratch.drop(e, told)
        e = nxt
    else:
        raise RuntimeError("components did not converge")
    if not forest:
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    flat: DataFrame | None = None  # (node, root) of all below the seeds, from the last round to the first
    for layer in reversed(forest):
        if flat is None:
            flat = layer.select("node", F.col("parent").alias("root"))
        else:
            up = flat.select(F.col("node").alias("parent"), F.col("root").alias("seed"))
            new = layer.join(up, "parent", "left").select("node", F.coalesce("seed", "parent").alias("root"))
            flat = scratch.cut(flat.union(new), "flat")
    assert flat is not None
    return flat.union(flat.select(F.col("root").alias("node"), "root").distinct())


def hooking_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components over a table of parents: each round every root with an edge to a smaller root hooks
    onto the least such root, the hooks are shortcut by joining the table of parents with itself
    until all point at roots, and the edges are renamed by it; edges inside one tree vanish.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "hooking")
    e = _clean(edges).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    e = scratch.cut(e.distinct(), "edges")
    parents: DataFrame | None = None
    for _ in range(max_rounds):
        if e.isEmpty():
            break
        hooks = scratch.cut(e.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root")), "hooks")
        while True:  # shortcut
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("above"))
            hop = hooks.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
            hop = scratch.cut(hop, "hop")
            moved = not hop.where("moved").isEmpty()
            scratch.drop(hooks)
            hooks = hop
            if not moved:
                break
        hooks = hooks.select("node", "root")
        to_u, to_v = (hooks.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in "uv")
        named = e.join(to_u, "u", "left").join(to_v, "v", "left").select(F.coalesce("u_root", "u").alias("a"), F.coalesce("v_root", "v").alias("b")).where("a <> b")
        nxt = scratch.cut(named.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
        if parents is None:
            parents = hooks
        else:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("above"))
            moved_up = parents.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
            parents = scratch.cut(moved_up.union(hooks), "parents")
        scratch.drop(e)
        e = nxt
    else:
        raise RuntimeError("components did not converge")
    if parents is None:
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return parents.union(parents.select(F.col("root").alias("node"), "root").distinct())
