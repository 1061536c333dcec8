"""k-means diagnostics over vectors: fitting, stability, silhouette, choice of k, assignments."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import ContractError
from ..functions.scalars import cluster_id, fixed6
from .split import fixed_sample


def _matrix(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def nearest_centroid(df: DataFrame, key: str, vector: str, centroids: np.ndarray, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, columns to ``keep``, cluster, distance): Euclidean, ties to the smaller cluster.  The k centroids go to every task."""
    c = np.asarray(centroids, np.float64)

    def assign(batches):
        for b in batches:
            own, near = _nearest(_matrix(b.column(b.num_columns - 1)), c)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(own, pa.int32()), pa.array(near)], [key, *keep, "cluster", "distance"])

    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in (key, *keep))
    return df.select(key, *keep, vector).mapInArrow(assign, f"{schema}, cluster int, distance double")


def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest row of ``c`` for each row of ``x``, and how far it is; some thousand rows at a time."""
    own, near = np.zeros(len(x), np.int32), np.zeros(len(x))
    step = max(1, int(4e6 // max(1, c.size)))
    for at in range(0, len(x), step):
        d = np.sqrt(((x[at : at + step, None, :] - c[None]) ** 2).sum(2))
        own[at : at + step] = d.argmin(1)
        near[at : at + step] = d.min(1)
    return own, near


def nearest_of_each(df: DataFrame, key: str, vector: str, fits: list[np.ndarray]) -> DataFrame:
    """(key, vector, c0, c1, ..): the nearest centroid of several sets, in one pass."""

    def assign(batches):
        for b in batches:
            x = _matrix(b.column(1))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(_nearest(x, c)[0], pa.int32()) for c in fits]], [key, vector, *[f"c{i}" for i in range(len(fits))]])

    kinds = dict(df.dtypes)
    return df.select(key, vector).mapInArrow(assign, f"`{key}` {kinds[key]}, `{vector}` {kinds[vector]}, " + ", ".join(f"c{i} int" for i in range(len(fits))))


def cluster_means(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """(cluster, i, mean): one Lloyd update, one row a coordinate; partial sums before the shuffle."""
    each = df.select(cluster, F.posexplode(vector).alias("i", "x"))
    return each.groupBy(cluster, "i").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def fit_kmeans(df: DataFrame, vector: str, k: int, seeds: Iterable[int], max_iter: int = 300) -> KMeansModel:
    """The fit of least cost over the seeds."""
    v = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features")).persist()
    try:
        return min(fit_each(v, k, seeds, max_iter), key=lambda m: m.summary.trainingCost)
    finally:
        v.unpersist()


def fit_each(features: DataFrame, k: int, seeds: Iterable[int], max_iter: int = 300) -> list[KMeansModel]:
    return [KMeans(k=k, seed=s, maxIter=max_iter, featuresCol="features").fit(features) for s in seeds]


def relabel_by_size(assigned: DataFrame, k: int, cluster: str = "cluster") -> DataFrame:
    """(cluster, new): clusters numbered from 0 by size, largest first, ties by old number; empty ones last."""
    spine = assigned.sparkSession.range(k).select(F.col("id").cast("int").alias(cluster))
    n = spine.join(assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("n")), cluster, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return n.withColumn("new", F.row_number().over(Window.orderBy(F.desc("n"), cluster)) - 1).select(cluster, "new", "n")  # k rows


def assignments(assigned: DataFrame, k: int, version: str) -> DataFrame:
    """The contract's table from (path, label, cluster, distance)."""
    new = relabel_by_size(assigned, k)
    return assigned.join(F.broadcast(new), "cluster").select("path", "label", cluster_id(F.col("new"), k).alias("cluster_id"), fixed6(F.col("distance")).alias("distance_to_centroid"), F.lit(version).alias("cluster_system_version"))  # k rows


def adjusted_rand(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row (ari) of two labellings of the same rows; 1 for identical ones, also where chance explains all."""
    two = lambda n: n * (n - 1) / 2
    cells = pairs.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("n"))
    total = cells.agg(F.sum(two(F.col("n"))).alias("s"), F.sum("n").alias("all"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(two(F.col("n"))).alias("sa"))
    cols = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(two(F.col("n"))).alias("sb"))
    one = total.crossJoin(rows).crossJoin(cols)  # one row each
    expect = F.col("sa") * F.col("sb") / F.nullif(two(F.col("all")), F.lit(0.0))
    most = (F.col("sa") + F.col("sb")) / 2
    return one.select(F.when(most - expect == 0, 1.0).otherwise((F.col("s") - expect) / (most - expect)).alias("ari"))


def silhouette(df: DataFrame, key: str, vector: str, cluster: str, sample_size: int = 5000, seed: int = 63) -> float:
    """Mean Euclidean silhouette of a fixed sample of at most ``sample_size`` rows; NaN for fewer than two clusters.

    The sample (bounded by the parameter) goes to every task; its rows are compared with it in blocks.
    """
    rows = fixed_sample(df.select(key, vector, cluster), key, sample_size, seed)
    t = rows.toArrow()
    x, (names, lab) = _matrix(t[vector]), np.unique(np.array(t[cluster].to_pylist()), return_inverse=True)
    if len(names) < 2:
        return float("nan")
    size = np.bincount(lab, minlength=len(names)).astype(np.float64)
    hot = np.eye(len(names))[lab]

    def score(batches):
        for b in batches:
            y, own = _matrix(b.column(0)), b.column(1).to_numpy()
            out = np.zeros(len(y))
            for at in range(0, len(y), 250):
                d = np.sqrt(np.maximum(0, ((y[at : at + 250, None, :] - x[None]) ** 2).sum(2))) if x.size < 4e5 else np.sqrt(np.maximum(0, (y[at : at + 250] ** 2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * y[at : at + 250] @ x.T))
                s, o = d @ hot, own[at : at + 250]
                i = np.arange(len(o))
                a = s[i, o] / np.maximum(size[o] - 1, 1)
                m = s / size
                m[i, o] = np.inf
                bb = m.min(1)
                out[at : at + 250] = np.where(size[o] > 1, (bb - a) / np.maximum(np.maximum(a, bb), 1e-300), 0)
            yield pa.RecordBatch.from_arrays([pa.array(out)], ["s"])

    spark = df.sparkSession
    part = spark.createDataFrame(pa.table({"v": t[vector], "own": pa.array(lab, pa.int64())})).repartition(8)
    return float(part.mapInArrow(score, "s double").agg(F.avg("s")).first()[0])


def k_diagnostics(df: DataFrame, key: str, vector: str, ks: Iterable[int], seeds: Iterable[int], max_iter: int = 300, sample_size: int = 5000, sample_seed: int = 63, tiny: int = 25) -> DataFrame:
    """One row for each k: cost over the seeds, silhouette and sizes of the first seed's fit, agreement of all pairs of fits."""
    spark: SparkSession = df.sparkSession
    n = df.count()
    ks, seeds = list(ks), list(seeds)
    bad = [k for k in ks if not 1 < k < n]
    if bad:
        raise ContractError("candidate k outside 1 < k < rows", [str(k) for k in bad])
    data = df.select(key, vector, array_to_vector(F.col(vector).cast("array<double>")).alias("features")).persist()
    out = []
    try:
        for k in ks:
            fits = fit_each(data, k, seeds, max_iter)
            j = nearest_of_each(data, key, vector, [np.array(m.clusterCenters()) for m in fits]).persist()
            aris = [adjusted_rand(j, f"c{a}", f"c{b}").first()[0] for a in range(len(fits)) for b in range(a + 1, len(fits))] or [1.0]
            sizes = j.groupBy("c0").agg(F.count(F.lit(1)).alias("n")).agg(F.min("n"), F.max("n"), F.median("n"), F.count_if(F.col("n") < tiny)).first()
            sil = silhouette(j, key, vector, "c0", sample_size, sample_seed)
            j.unpersist()
            cost = np.array([m.summary.trainingCost for m in fits])
            out.append((k, float(cost.mean()), float(cost.std()), sil, min(n, sample_size), sample_seed, sizes[0], sizes[1], float(sizes[2]), sizes[3], float(np.mean(aris)), float(min(aris)), len(fits)))
    finally:
        data.unpersist()
    return spark.createDataFrame(out, "k int, inertia_mean double, inertia_std double, silhouette double, silhouette_sample_size int, silhouette_sample_seed int, min_cluster_size bigint, max_cluster_size bigint, median_cluster_size double, tiny_cluster_count bigint, stability_ari_mean double, stability_ari_min double, n_stability_runs int")


#: Why a k was chosen, with candidates that pass the gate and without.
RATIONALE = {
    True: "chosen without labels: highest silhouette among candidates without tiny clusters whose mean stability ARI is at least {}",
    False: "chosen without labels: no candidate passes the gate on tiny clusters and stability, so the best compromise of tiny clusters, silhouette and stability",
}


def select_k(diagnostics: DataFrame, min_ari: float = 0.75) -> DataFrame:
    """The row of the chosen k, with ``rationale``: stable ones without tiny clusters if there are any, else all; fewest tiny clusters, then
    silhouette (NaN counts as -1), agreement, smallest k."""
    stable = (F.col("tiny_cluster_count") == 0) & (F.col("stability_ari_mean") >= min_ari)
    sil = F.when(F.isnan("silhouette"), -1.0).otherwise(F.col("silhouette"))
    best = diagnostics.withColumn("stable", stable).orderBy(F.desc("stable"), "tiny_cluster_count", sil.desc(), F.desc("stability_ari_mean"), "k").limit(1)
    return best.withColumn("rationale", F.when(F.col("stable"), RATIONALE[True].format(min_ari)).otherwise(RATIONALE[False]))
