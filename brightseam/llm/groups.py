"""Consolidating pairwise matches into groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch
from .graph import seed_tree_components
from .images import image_id, known_images, only_known, pair_edges, table


def match_groups(images: DataFrame, edges: DataFrame, components=seed_tree_components) -> DataFrame:
    """(id, path, root, group_path, group_size) of each image linked with another.

    ``images``: (id, path), one row an id.  ``edges``: (u, v); a vertex that is no image (a cell that
    lists images) links those at its other ends.  ``group_path`` is the least path of the group by code
    point.  Images without a link have no row; a lone image of a cell has none either.
    """
    scratch = Scratch(images.sparkSession, "groups")
    comp = components(edges)
    members = scratch.cut(comp.withColumnRenamed("node", "id").join(images.select("id", "path"), "id"), "members")
    heads = members.groupBy("root").agg(F.min("path").alias("group_path"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    return members.join(heads, "root").select("id", "path", "root", "group_path", "group_size")


def list_edges(lists: DataFrame, column: str, images: DataFrame) -> DataFrame:
    """(u, v): an edge from each known image of a pipe-joined cell to a vertex for the cell."""
    cell = F.xxhash64(F.col(column), F.lit("cell"))
    each = lists.where(F.col(column).contains("|")).select(F.explode(F.split(column, r"\|")).alias("p"), cell.alias("v"))
    return only_known(each.select(image_id(F.col("p")).alias("u"), "v").where("u is not null").distinct(), images, "u")


def linked_images(spark: SparkSession, folder: str) -> DataFrame:
    """Groups over near pairs, reviewed pairs and exact lists.  Pairs with a blank or unknown path, and of
    an image with itself, don't count; repeated rows change nothing."""
    scratch = Scratch(spark, "links")
    images = scratch.cut(known_images(table(spark, folder, "image_audit")), "images")
    pairs = pair_edges(table(spark, folder, "near_duplicate_pairs"), "path_a", "path_b").union(pair_edges(table(spark, folder, "dedup_group_pairs"), "path_a", "path_b"))
    pairs = only_known(pairs.distinct(), images, "u", "v")
    lists = list_edges(table(spark, folder, "exact_duplicates"), "paths", images)
    return match_groups(images, pairs.union(lists))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return linked_images(spark, folder).select("path", "group_path")


def p2_group_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """How many groups there are of each size."""
    g = linked_images(spark, folder).groupBy("root").agg(F.max("group_size").alias("group_size"))
    return g.groupBy("group_size").agg(F.count(F.lit(1)).alias("groups"))
