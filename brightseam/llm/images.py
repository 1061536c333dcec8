"""Images of the curation tables: one id and one true spelling for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dirt import image_key, is_blank

#: Seed of the image ids.  Two images with one id end the job with an error that asks for another seed.
ID_SEED = 17


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def image_id(path: Column, seed: int = ID_SEED) -> Column:
    """A bigint for an image, however its path is written; NULL for a blank path."""
    return F.when(~is_blank(path), F.xxhash64(image_key(path), F.lit(seed)))


def one_spelling(path: Column) -> Column:
    """Aggregate: the path of a group of equal ids; an error if they are not one image."""
    lo, hi = F.min(path), F.max(path)
    same = F.lower(lo) == F.lower(hi)
    return F.when(same, lo).otherwise(F.raise_error(F.lit("two images share an id; choose another ID_SEED")))


def known_images(audit: DataFrame) -> DataFrame:
    """(id, path) of each image that ``image_audit`` holds, spelled as there."""
    return audit.select(image_id(F.col("path")).alias("id"), "path").where("id is not null").groupBy("id").agg(one_spelling(F.col("path")).alias("path"))


def only_known(edges: DataFrame, images: DataFrame, *ends: str) -> DataFrame:
    """Edges each of whose ends is a known image."""
    for e in ends:
        edges = edges.join(images.select(F.col("id").alias(e)), e, "left_semi")
    return edges


def pair_edges(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(u, v) ids of each pair, smaller first; pairs with a blank end or of an image with itself are left out."""
    e = pairs.select(image_id(F.col(a)).alias("x"), image_id(F.col(b)).alias("y")).where("x <> y")
    return e.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))
