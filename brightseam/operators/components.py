"""Connected components over paths, their groups, and the edges they come from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import split_list
from ..schemas import LABELS
from ..scratch import Scratch


def retained(edges: DataFrame, manifest: DataFrame) -> DataFrame:
    """Edges (left, right, source) with both ends in the manifest."""
    m = manifest.select("path").distinct()
    return edges.join(m.withColumnRenamed("path", "left"), "left", "left_semi").join(m.withColumnRenamed("path", "right"), "right", "left_semi")


def exact_edges(exact: DataFrame, manifest: DataFrame) -> DataFrame:
    """(left, right, source): from the first retained member of each group to each other retained one."""
    m = manifest.select("path").distinct()
    e = exact.select(F.xxhash64("paths").alias("g"), F.posexplode(split_list(F.col("paths"))).alias("pos", "path"))
    e = e.join(m, "path", "left_semi")
    first = e.groupBy("g").agg(F.min_by("path", "pos").alias("left"))
    return e.join(first, "g").where("path <> left").select("left", F.col("path").alias("right"), F.lit("exact_duplicate").alias("source")).distinct()


def pair_edges(pairs: DataFrame, source: str = "dedup_group_pair") -> DataFrame:
    return pairs.select(F.col("path_a").alias("left"), F.col("path_b").alias("right"), F.lit(source).alias("source"))


def unsafe_near_pairs(near: DataFrame, explicit: DataFrame, manifest: DataFrame) -> DataFrame:
    """Retained near pairs (lo, hi) that no explicit pair names, in either order."""
    norm = lambda df: df.select(F.least("path_a", "path_b").alias("lo"), F.greatest("path_a", "path_b").alias("hi"))
    kept = retained(near.select(F.col("path_a").alias("left"), F.col("path_b").alias("right"), F.lit("near").alias("source")), manifest)
    return kept.select(F.least("left", "right").alias("lo"), F.greatest("left", "right").alias("hi")).distinct().join(norm(explicit), ["lo", "hi"], "left_anti")


def constraint_counts(exact: DataFrame, pairs: DataFrame, near: DataFrame, manifest: DataFrame) -> dict[str, int]:
    """How many exact groups and pairs there are, and how many of them the manifest retains."""
    m = manifest.select("path").distinct()
    cells = exact.select(F.monotonically_increasing_id().alias("g"), F.explode(split_list(F.col("paths"))).alias("path"))
    more = lambda df: df.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()
    kept = lambda df: retained(df.select(F.col("path_a").alias("left"), F.col("path_b").alias("right")), manifest).count()
    return {
        "exact_duplicate_groups_total": more(cells), "exact_duplicate_groups_retained_multi_path": more(cells.join(m, "path", "left_semi")),
        "dedup_group_pairs_total": pairs.count(), "dedup_group_pairs_retained": kept(pairs), "retained_near_duplicate_pairs": kept(near),
    }


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of each node of ``edges`` (left, right); the root is the least node of the component.

    Large-star and small-star rounds (Kiveris et al. 2014) until the edges stop changing; each is one aggregation and
    one join.  Lineage is cut in the shared folder each round.
    """
    scratch = Scratch(edges.sparkSession, "components")
    e = edges.select(F.least("left", "right").alias("u"), F.greatest("left", "right").alias("v")).where("u <> v").distinct()
    e = scratch.cut(e, "edges")
    alone = edges.where("left = right").select(F.col("left").alias("node"))
    before = None
    for _ in range(max_rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a").select(F.col("b").alias("a"), "m").where("a <> m").union(low2.select("a", "m")).distinct()
        nxt = scratch.cut(small.select(F.col("m").alias("u"), F.col("a").alias("v")), "edges")
        mark = tuple(nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(e)
        e = nxt
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not converge")
    tree = e.select(F.col("v").alias("node"), F.col("u").alias("root"))
    known = tree.union(e.select(F.col("u").alias("node"), F.col("u").alias("root"))).distinct()
    return known.union(alone.join(known, "node", "left_anti").select("node", F.col("node").alias("root")).distinct())


def component_groups(manifest: DataFrame, edges: DataFrame, labels: list[str] = LABELS) -> tuple[DataFrame, DataFrame]:
    """(members, groups).  members: path, label, root; groups: group_id, root, group_size, n0, n1, n2 (n and each of ``labels``), sources.

    Paths without an edge are groups of their own with source ``singleton``.  Ids are numbered by root; the numbering
    is spread over ranges, so no task holds all roots.
    """
    scratch = Scratch(manifest.sparkSession, "groups")
    comp = scratch.cut(connected_components(edges), "components")
    rows = manifest.select("path", F.col("current_label").alias("label")).join(comp.withColumnRenamed("node", "path"), "path", "left").withColumn("root", F.coalesce("root", "path"))
    members = scratch.cut(rows, "members")
    g = members.groupBy("root").agg(F.count(F.lit(1)).alias("group_size"), *[F.count_if(F.col("label") == k).alias(f"n{k}") for k in labels])
    src = edges.join(comp.withColumnRenamed("node", "left"), "left").groupBy("root").agg(F.array_join(F.array_sort(F.collect_set("source")), "|").alias("sources"))
    g = scratch.cut(g.join(src, "root", "left").withColumn("sources", F.coalesce("sources", F.lit("singleton"))), "groups")
    return members, number_by(g, ["root"], "group_no").withColumn("group_id", F.format_string("G%05d", "group_no")).drop("group_no")


def number_by(df: DataFrame, columns: list[str], out: str, rows_per_task: int = 200_000) -> DataFrame:
    """Rows numbered from 1 in the order of ``columns`` (NULL first): ranges of about ``rows_per_task`` rows, cut at quantiles, are numbered
    apart and moved up by the rows before, so no task holds all rows.  Rows equal in all columns are numbered in any order."""
    scratch = Scratch(df.sparkSession, "number")
    src = df if hasattr(df, "_scratch_path") else scratch.cut(df, "rows")
    ranges = -(-src.count() // rows_per_task)
    if ranges <= 1:
        return src.withColumn(out, F.row_number().over(Window.orderBy(*columns)).cast("bigint"))  # at most rows_per_task rows
    parts = scratch.cut(src.repartitionByRange(ranges, *columns).withColumn("__p", F.spark_partition_id()), "ranges")
    w_before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    before = parts.groupBy("__p").agg(F.count(F.lit(1)).alias("__c")).withColumn("__b", F.coalesce(F.sum("__c").over(w_before), F.lit(0)))
    w = Window.partitionBy("__p").orderBy(*columns)
    return parts.withColumn("__i", F.row_number().over(w)).join(before, "__p").withColumn(out, F.col("__i") + F.col("__b")).drop("__p", "__c", "__b", "__i")
