"""Reports on clusters: composition, profile, representatives, coverage; and classification scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import coverage_note, fixed6


def composition(a: DataFrame, first: str, second: str, share: str) -> DataFrame:
    """Counts of two keys and the share within the first."""
    n = a.groupBy(first, second).agg(F.count(F.lit(1)).alias("count"))
    return n.select(first, second, "count", fixed6(F.col("count") / F.sum("count").over(Window.partitionBy(first))).alias(share))


def label_composition(a: DataFrame) -> DataFrame:
    return composition(a, "cluster_id", "label", "proportion_within_cluster")


def label_cluster_distribution(a: DataFrame) -> DataFrame:
    return composition(a, "label", "cluster_id", "proportion_within_label")


def cluster_summary(train: DataFrame, val: DataFrame, spine: DataFrame) -> DataFrame:
    """One row for each cluster of ``spine`` (cluster_id), also without members; distances are those of the training rows
    as written, to 6 places."""
    n = train.groupBy("cluster_id", "label").agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy("cluster_id").agg(
        F.sum("n").alias("train_count"), F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("top"), F.collect_list("n").alias("ns")
    )  # at most one number for each class
    p = F.transform("ns", lambda x: x / F.col("train_count"))
    entropy = -F.aggregate(p, F.lit(0.0), lambda s, x: s + x * F.ln(x))
    dist = train.groupBy("cluster_id").agg(F.median(F.col("distance_to_centroid").cast("double")).alias("med"), F.percentile(F.col("distance_to_centroid").cast("double"), F.lit(0.95)).alias("p95"))
    v = val.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("val_count"))
    j = spine.join(total, "cluster_id", "left").join(dist, "cluster_id", "left").join(v, "cluster_id", "left")
    return j.select(
        "cluster_id", F.coalesce("train_count", F.lit(0)).alias("train_count"), F.coalesce("val_count", F.lit(0)).alias("val_count"), F.coalesce("top.label", F.lit("")).alias("dominant_train_label"),
        fixed6(-F.col("top.n") / F.col("train_count")).alias("dominant_train_label_proportion"), F.when(F.col("train_count").isNull(), "0.000000").otherwise(fixed6(entropy + 0.0)).alias("label_entropy"),
        fixed6(F.col("med")).alias("assigned_centroid_distance_median"), fixed6(F.col("p95")).alias("assigned_centroid_distance_p95"), F.lit("").alias("notes"),
    )


def representatives(a: DataFrame, n: int, order: str = "_ord") -> DataFrame:
    """The n nearest and the n farthest of each split and cluster, ties by the row's place, of the farthest the later first; a row may be both.
    Ranks are limited before the shuffle."""
    x = a.withColumn("d", F.col("distance_to_centroid").cast("double"))
    near = x.withColumn("rank", F.row_number().over(Window.partitionBy("split", "cluster_id").orderBy("d", order))).where(F.col("rank") <= n)
    far = x.withColumn("rank", F.row_number().over(Window.partitionBy("split", "cluster_id").orderBy(F.desc("d"), F.desc(order)))).where(F.col("rank") <= n)
    cols = ["cluster_id", "split", "path", "label", "distance_to_centroid", "rank"]
    return near.select(*cols, F.lit("nearest").alias("representative_type")).unionByName(far.select(*cols, F.lit("farthest").alias("representative_type")))


def validation_coverage(train: DataFrame, val: DataFrame, spine: DataFrame) -> DataFrame:
    t, v = (df.groupBy("cluster_id").agg(F.count(F.lit(1)).alias(c)) for df, c in ((train, "train_count"), (val, "val_count")))
    tt, vv = train.agg(F.count(F.lit(1)).alias("tt")), val.agg(F.count(F.lit(1)).alias("vv"))
    j = spine.join(t, "cluster_id", "left").join(v, "cluster_id", "left").crossJoin(tt).crossJoin(vv)  # one row each
    j = j.withColumn("train_count", F.coalesce("train_count", F.lit(0))).withColumn("val_count", F.coalesce("val_count", F.lit(0)))
    ts, vs = F.coalesce(F.col("train_count") / F.nullif("tt", F.lit(0)), F.lit(0.0)), F.coalesce(F.col("val_count") / F.nullif("vv", F.lit(0)), F.lit(0.0))
    return j.select("cluster_id", "train_count", fixed6(ts).alias("train_proportion"), "val_count", fixed6(vs).alias("val_proportion"), coverage_note(ts, vs, F.col("val_count")).alias("coverage_note"))


def macro_f1(pairs: DataFrame, labels: list[str], truth: str = "truth", guess: str = "guess") -> DataFrame:
    """One row (macro_f1): the mean over ``labels`` of F1; a class never true nor guessed counts 0."""
    aggs = []
    for k in labels:
        tp, t, g = F.count_if((F.col(truth) == k) & (F.col(guess) == k)), F.count_if(F.col(truth) == k), F.count_if(F.col(guess) == k)
        aggs.append(F.when(t + g > 0, 2.0 * tp / (t + g)).otherwise(0.0).alias(f"f_{k}"))
    one = pairs.agg(*aggs)
    return one.select(F.round(sum((F.col(f"f_{k}") for k in labels), F.lit(0.0)) / len(labels), 6).alias("macro_f1"))


def ordered_submission(template: DataFrame, predictions: DataFrame, key: str, order: str) -> DataFrame:
    """Predictions in the template's rows; one without a prediction has NULL."""
    return template.select(key, order).join(predictions, key, "left").orderBy(order)
