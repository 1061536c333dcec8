"""Samples that match target category proportions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dirt import class_label
from ..functions.ranking import spread_row_number, unit_hash
from ..scratch import Scratch
from .images import image_id, known_images, table


def divisor_quotas(rows: list[tuple[str, float, int, int]], size: int, strict: bool = False) -> dict[str, int]:
    """How many of each category the divisor method takes: ``rows`` are (category, target share, available, minimum).

    The k-th record of a category has priority (k - 1/2) / share; records within the minimum come first, then
    the smallest priorities until ``size`` are taken, ties by category.  A category that runs out gives
    its places to the others.  A share of zero gives the minimum only.  Minima that add up to more than ``size`` are
    all taken, or with ``strict`` those of the smallest priorities, a share of zero last, until ``size`` are.
    """
    cats = sorted({(c, max(0.0, s or 0.0), max(0, n), max(0, m)) for c, s, n, m in rows})
    take = {c: min(n, m) for c, _, n, m in cats}
    left = size - sum(take.values())
    if strict and left < 0:
        got = divisor_quotas([(c, s, take[c], 0) for c, s, _, _ in cats], size)
        left = size - sum(got.values())
        for c, s, _, _ in cats:
            if s == 0:
                got[c] = min(take[c], left)
                left -= got[c]
        return got
    if left <= 0:
        return take
    room = {c: (s, n) for c, s, n, _ in cats if s > 0 and n > take[c]}

    def upto(limit: float) -> dict[str, int]:
        """Records of each category with priority of at most ``limit``."""
        got = {}
        for c, (s, n) in room.items():
            k = min(n, int(limit * s + 1.5))
            while k > 0 and (k - 0.5) / s > limit:
                k -= 1
            got[c] = max(take[c], k)
        return got

    lo, hi = 0.0, max(((n + 1) / s for s, n in room.values()), default=0.0)
    if sum(n - take[c] for c, (_, n) in room.items()) <= left:
        return take | {c: n for c, (_, n) in room.items()}
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        if sum(upto(mid)[c] - take[c] for c in room) <= left:
            lo = mid
        else:
            hi = mid
    got = upto(lo)
    left -= sum(got[c] - take[c] for c in room)
    for _, c in sorted(((got[c] + 0.5) / s, c) for c, (s, n) in room.items() if got[c] < n)[: max(0, left)]:
        got[c] += 1
    return take | got


REPORT = "request_id bigint, label string, need bigint, available bigint, taken bigint, missing bigint, reason string"


def sampling_report(available: DataFrame, targets: DataFrame) -> DataFrame:
    """One row for each request and label: what it needs, what there is, what is taken and what is missing, with the reason.

    ``available``: (label, n), one row a label.  ``targets``: request_id, label, target_share, sample_size, min_rows.
    The need is the larger of share times size, rounded, and the minimum.  A sample never exceeds its size.  Reasons: ``too few``
    records; ``minima above size``, if the minima of the request don't fit; ``crowded out`` by the minima of others or by
    rounding; empty if nothing is missing.  Requests are small groups of rows and are
    worked out one by one on the executors.  NULL shares, sizes and minima count as 0.
    """
    t = targets.select(
        F.col("request_id").cast("bigint").alias("request_id"), F.col("label").cast("string").alias("label"), F.coalesce("target_share", F.lit(0.0)).cast("double").alias("share"),
        F.coalesce("sample_size", F.lit(0)).cast("bigint").alias("size"), F.coalesce("min_rows", F.lit(0)).cast("bigint").alias("least"),
    ).distinct()
    t = t.join(available.select("label", F.col("n").alias("available")), "label", "left").withColumn("available", F.coalesce("available", F.lit(0)).cast("bigint"))

    def one(pdf):
        size = int(pdf["size"].max())
        got = divisor_quotas(list(zip(pdf["label"], pdf["share"], pdf["available"], pdf["least"], strict=True)), size, strict=True)
        pdf["taken"] = [got[x] for x in pdf["label"]]
        pdf["need"] = [max(round(s * z), m) for s, z, m in zip(pdf["share"], pdf["size"], pdf["least"], strict=True)]
        pdf["missing"] = (pdf["need"] - pdf["taken"]).clip(lower=0)
        other = "minima above size" if pdf["least"].sum() > size else "crowded out"
        pdf["reason"] = ["" if not x else "too few" if n > a else other for x, n, a in zip(pdf["missing"], pdf["need"], pdf["available"], strict=True)]
        return pdf[["request_id", "label", "need", "available", "taken", "missing", "reason"]]

    return t.groupBy("request_id").applyInPandas(one, REPORT)


def manifest_labels(spark: SparkSession, folder: str, known_only: bool = True) -> DataFrame:
    """(id, label), one row for each image of the manifest and class its rows denote."""
    m = table(spark, folder, "manifest_clean").select(image_id(F.col("path")).alias("id"), class_label(F.col("current_label")).alias("label"))
    m = m.where("id is not null and label is not null").distinct()
    return m.join(known_images(table(spark, folder, "image_audit")), "id") if known_only else m


def drawn_sample(records: DataFrame, targets: DataFrame, seed: int = 63) -> tuple[DataFrame, DataFrame]:
    """(sample, report): ``proportional_sample`` and what ``sampling_report`` says of it."""
    scratch = Scratch(records.sparkSession, "sample")
    rest = [c for c in records.columns if c not in ("id", "label", "request_id")]
    pool = records.select("id", "label", F.struct(F.lit(0).alias("_"), *rest).alias("__rest"), unit_hash("id", "label", seed=seed).alias("u"))
    pool = scratch.cut(pool, "pool")
    counts = pool.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    report = scratch.cut(sampling_report(counts, targets), "report")
    quota = report.where("taken > 0").select("request_id", "label", "taken")
    ranked = spread_row_number(pool, ["label"], ["id"], "rank", u="u", sizes=counts.withColumnRenamed("n", "__n"))
    sample = ranked.join(quota, "label").where("rank <= taken")
    return sample.select("request_id", "id", "label", *[F.col(f"__rest.`{c}`").alias(c) for c in rest]), report


def proportional_sample(records: DataFrame, targets: DataFrame, seed: int = 63) -> DataFrame:
    """(request_id, label, id..) of the records drawn for each request.

    ``records``: distinct (id, label) and further columns, kept unless named request_id.  A label's records are put in one random order, the same
    for each request; a request takes the first of each label as far as the report says.
    """
    return drawn_sample(records, targets, seed)[0]


def shortages(records: DataFrame, targets: DataFrame) -> DataFrame:
    """(request_id, label, need, available, drawn, missing, reason) of each label of which the drawn sample has fewer than needed."""
    sample, report = drawn_sample(records, targets)
    drawn = sample.groupBy("request_id", "label").agg(F.count(F.lit(1)).alias("drawn"))
    r = report.join(drawn, ["request_id", "label"], "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)).cast("bigint"))
    return r.where("drawn < need").select("request_id", "label", "need", "available", "drawn", (F.col("need") - F.col("drawn")).alias("missing"), "reason")


def p6_report(spark: SparkSession, folder: str) -> DataFrame:
    counts = manifest_labels(spark, folder).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return sampling_report(counts, table(spark, folder, "sample_targets"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Labels that the drawn sample lacks because there are too few of them."""
    return shortages(manifest_labels(spark, folder), table(spark, folder, "sample_targets")).where("reason = 'too few'").select("request_id", "label")


def p6_sample(spark: SparkSession, folder: str) -> DataFrame:
    s = proportional_sample(manifest_labels(spark, folder), table(spark, folder, "sample_targets"))
    return s.select("request_id", "label", "path")


def p6_check(spark: SparkSession, folder: str) -> DataFrame:
    """(request_id, label, rows, images, wrong) of the sample: its rows, its different images, and those whose manifest rows don't name the label."""
    s = p6_sample(spark, folder)
    have = manifest_labels(spark, folder).select("path", "label", F.lit(True).alias("right"))
    j = s.join(have, ["path", "label"], "left")
    return j.groupBy("request_id", "label").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("path").alias("images"), F.count_if(F.col("right").isNull()).alias("wrong"))
