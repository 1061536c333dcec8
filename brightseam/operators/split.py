"""Seeded train/validation split of groups, per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import bankers_target, unit_draw
from ..schemas import LABELS
from ..scratch import Scratch


def is_mixed(labels: list[str] = LABELS) -> Column:
    """A group with images of more than one class."""
    return sum(((F.col(f"n{k}") > 0).cast("int") for k in labels), F.lit(0)) > 1


def val_targets(manifest: DataFrame, share: float) -> DataFrame:
    """(label, n, target): half to even."""
    return manifest.groupBy(F.col("current_label").alias("label")).agg(F.count(F.lit(1)).alias("n")).withColumn("target", bankers_target(F.col("n"), share))


def mixed_draw(groups: DataFrame, share: float, seed: int, labels: list[str] = LABELS) -> DataFrame:
    """Mixed groups with their draw; those below the share go to validation."""
    m = groups.where(is_mixed(labels)).withColumn("draw", unit_draw(seed, F.col("group_id")))
    return m.withColumn("in_val", F.col("draw") < share)


def running_sum(df: DataFrame, part: str, order: str, value: str, out: str, rows: int, rows_per_task: int = 50_000) -> DataFrame:
    """Sum of ``value`` over the rows of a ``part`` up to this one in the order of an even column in [0, 1), ties by ``group_id``, spread
    over ranges of about ``rows_per_task`` of at most ``rows`` rows."""
    ranges = max(1, -(-rows // rows_per_task))
    if ranges == 1:
        return df.withColumn(out, F.sum(value).over(Window.partitionBy(part).orderBy(order, "group_id").rowsBetween(Window.unboundedPreceding, 0)))  # at most rows_per_task rows
    parts = df.withColumn("__p", F.floor(F.col(order) * ranges).cast("int"))
    w = Window.partitionBy(part).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    before = parts.groupBy(part, "__p").agg(F.sum(value).alias("__s")).withColumn("__b", F.coalesce(F.sum("__s").over(w), F.lit(0)))
    own = F.sum(value).over(Window.partitionBy(part, "__p").orderBy(order, "group_id").rowsBetween(Window.unboundedPreceding, 0))
    return parts.withColumn("__o", own).join(before, [part, "__p"]).withColumn(out, F.col("__o") + F.col("__b")).drop("__p", "__o", "__s", "__b")


def first_fits(groups: DataFrame, targets: dict[str, int]) -> DataFrame:
    """(label, group_id) of the groups chosen for each label by walking its groups in the order of ``draw`` and taking each that still fits its target.

    ``groups``: label, group_id, group_size, draw.  Done in rounds over all rows and labels at once: up to the first group that doesn't fit all
    are taken; then only later groups no larger than what is left can be, and so on.  Each round lowers what is left
    below the size of the group that stopped it, so there are at most as many rounds as different sizes.  Then
    at most one more group of each label is taken if the overshoot strictly lowers the gap: the one with the least gap, ties by id.
    """
    spark = groups.sparkSession
    scratch = Scratch(spark, "fit")
    state = {k: (int(n), -1.0) for k, n in targets.items() if n > 0}  # what is left, and the draw of the group that stopped the last round
    pool = scratch.cut(groups.select("label", "group_id", "group_size", "draw"), "pool")
    rows = pool.count()
    chosen = spark.createDataFrame([], "label string, group_id string")
    left = {}
    while state:
        fits = F.lit(False)
        room = F.lit(0).cast("bigint")
        for k, (n, after) in state.items():
            own = F.col("label") == k
            fits = fits | (own & (F.col("draw") > after) & (F.col("group_size") <= n))
            room = F.when(own, n).otherwise(room)
        summed = scratch.cut(running_sum(pool.where(fits), "label", "draw", "group_size", "cum", rows).withColumn("fits", F.col("cum") <= room), "summed")
        chosen = chosen.unionByName(summed.where("fits").select("label", "group_id"))
        # sums grow with the order, so the rows that fit are those before the first that doesn't
        got = {r["label"]: r for r in summed.groupBy("label").agg(F.min(F.when(~F.col("fits"), F.col("draw"))).alias("stop"), F.coalesce(F.max(F.when(F.col("fits"), F.col("cum"))), F.lit(0)).alias("got")).collect()}
        nxt = {}
        for k, (n, _) in state.items():
            r = got.get(k)
            n -= int(r["got"]) if r else 0
            if r and r["stop"] is not None and n > 0:
                nxt[k] = (n, r["stop"])
            else:
                left[k] = n
        state = nxt
    short = [k for k, n in left.items() if n > 0]
    if short:
        chosen = scratch.cut(chosen, "chosen")
        gap = F.lit(None).cast("bigint")
        for k in short:
            gap = F.when((F.col("label") == k) & (F.abs(F.col("group_size") - left[k]) < left[k]), F.abs(F.col("group_size") - left[k])).otherwise(gap)
        rest = pool.withColumn("gap", gap).where("gap is not null").join(chosen, ["label", "group_id"], "left_anti")
        more = rest.groupBy("label").agg(F.min(F.struct("gap", "group_id")).alias("s")).select("label", F.col("s.group_id").alias("group_id"))
        chosen = chosen.unionByName(more)
    return chosen


def first_fit(groups: DataFrame, target: int) -> DataFrame:
    """(group_id) of ``first_fits`` for groups of one label."""
    return first_fits(groups.withColumn("label", F.lit("")), {"": int(target)}).select("group_id")


def assign_splits(groups: DataFrame, targets: dict[str, int], share: float = 0.2, seed: int = 63, labels: list[str] = LABELS) -> DataFrame:
    """(group_id, split) of every group: mixed groups by their draw, then single-class groups by first fit to what the
    class still lacks; all others train."""
    scratch = Scratch(groups.sparkSession, "assign")
    g = scratch.cut(groups.select("group_id", "group_size", *[f"n{k}" for k in labels], is_mixed(labels).alias("mixed"), unit_draw(seed, F.col("group_id")).alias("draw")), "groups")
    val = g.where(F.col("mixed") & (F.col("draw") < share))
    have = val.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(k) for k in labels]).first()
    label, draw = F.lit(None).cast("string"), F.lit(None).cast("double")
    for k in labels:
        own = F.col(f"n{k}") > 0
        label, draw = F.when(own, k).otherwise(label), F.when(own, unit_draw(f"{seed}:{k}", F.col("group_id"))).otherwise(draw)
    single = g.where(~F.col("mixed")).select("group_id", "group_size", label.alias("label"), draw.alias("draw")).where("label is not null")
    fitted = first_fits(single, {k: max(0, targets.get(k, 0) - have[k]) for k in labels})
    picked = scratch.cut(val.select("group_id").unionByName(fitted.select("group_id")).withColumn("split", F.lit("val")), "picked")
    return g.join(picked, "group_id", "left").select("group_id", F.coalesce("split", F.lit("train")).alias("split"))


def split_rows(members: DataFrame, groups: DataFrame, splits: DataFrame) -> DataFrame:
    """Each path with group and split."""
    g = groups.join(splits, "group_id").select("root", "group_id", "group_size", "sources", "split")
    return members.join(g, "root").select("group_id", "split", "group_size", F.col("sources").alias("group_sources"), "path", "label")


def split_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split", "label").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("group_id").alias("groups"))


def collect_targets(targets: DataFrame, labels: list[str] = LABELS) -> dict[str, int]:
    """One row a class."""
    return {r["label"]: int(r["target"]) for r in targets.where(F.col("label").isin(*labels)).collect()}


def fixed_sample(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """Exactly ``size`` rows (all if there are fewer), the least by SHA-256 of ``seed:key``."""
    return df.withColumn("__h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)).orderBy("__h", key).limit(size).drop("__h")


