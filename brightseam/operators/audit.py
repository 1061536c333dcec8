"""Integrity audit and exact duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import fixed6, ordered_list, ratio6, split_list


def audit_rows(df: DataFrame, key: str, digest: Column, width: Column, height: Column, error: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """(path, width, height, aspect_ratio, sha256, error, columns to ``keep``) as text; all blank but the error where there is one."""
    ok = F.coalesce(error, F.lit("")) == ""
    blank = lambda c: F.when(ok, F.coalesce(c.cast("string"), F.lit(""))).otherwise("")
    return df.select(
        F.col(key).cast("string").alias("path"), blank(width).alias("width"), blank(height).alias("height"), blank(fixed6(ratio6(width, height))).alias("aspect_ratio"), blank(digest).alias("sha256"), F.coalesce(error, F.lit("")).alias("error"), *keep
    )


def exact_groups(df: DataFrame, digest: str, path: str, order: str) -> DataFrame:
    """(sha256, count, paths) of each digest with several members; the cell lists them in order, as the contract asks."""
    rows = df.where(F.coalesce(digest, F.lit("")) != "")
    many = rows.groupBy(digest).agg(F.count(F.lit(1)).alias("count")).where("`count` > 1")
    j = rows.join(many, digest)
    return j.groupBy(F.col(digest).alias("sha256")).agg(F.count(F.lit(1)).alias("count"), ordered_list(F.col(path).cast("string"), F.col(order)).alias("paths"))


def exact_rows(df: DataFrame, digest: str, path: str, order: str) -> DataFrame:
    """(sha256, count, pos, path): the members of each digest with several, one a row, in order from 0.  The same as ``exact_groups`` without a
    cell that grows with the group."""
    rows = df.where(F.coalesce(digest, F.lit("")) != "")
    many = rows.groupBy(digest).agg(F.count(F.lit(1)).alias("count")).where("`count` > 1")
    w = Window.partitionBy(digest).orderBy(order)  # row_number streams through its sorted, spilling input
    j = rows.join(many, digest).withColumn("pos", F.row_number().over(w) - 1)
    return j.select(F.col(digest).alias("sha256"), "count", "pos", F.col(path).cast("string").alias("path"))


def exact_members(exact: DataFrame) -> DataFrame:
    """(sha256, pos, path): the members of each cell, one a row."""
    return exact.select("sha256", F.posexplode(split_list(F.col("paths"))).alias("pos", "path"))


def audit_summary(audit: DataFrame) -> DataFrame:
    """One row of totals."""
    ok = F.coalesce("error", F.lit("")) == ""
    groups = audit.where(ok & (F.coalesce("sha256", F.lit("")) != "")).groupBy("sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("exact_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("exact_rows"))
    total = audit.agg(F.count(F.lit(1)).alias("total"), F.count_if(~ok).alias("corrupt"), F.count_distinct(F.when(ok, F.struct("width", "height"))).alias("distinct_sizes"))
    return total.crossJoin(groups)  # one row by one row


def class_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.coalesce(column, F.lit("")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def most_common_sizes(audit: DataFrame, order: str, n: int = 10) -> DataFrame:
    """The n most frequent (width, height) of images that could be opened, ties by first appearance."""
    g = audit.where(F.coalesce("error", F.lit("")) == "").groupBy("width", "height").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return g.orderBy(F.desc("n"), "first").limit(n).select("width", "height", "n")
