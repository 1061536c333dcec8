"""Grouping records into similarity clusters by the density of a grid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dirt import class_label, cluster_name, strip
from ..scratch import Scratch
from .images import image_id, known_images, table
from .vectors import DIM, Grid, learn_grid_of_all, matrix, valid_manifest_rows, valid_vectors

#: A cell is dense from this share of all vectors on, and from LEAST vectors on.
DENSITY, LEAST = 0.004, 4
#: Vectors whose cosine with every mean is below this are clustered again among themselves.
FAR = 0.4


def quantise(vectors: DataFrame, grid: Grid) -> DataFrame:
    """(row, vec, cell): the cell is a text with one of ``-0+`` for each axis."""
    signs = np.frombuffer(b"-0+", dtype=np.uint8)

    def cells(batches):
        for b in batches:
            lv = signs[grid.levels(matrix(b.column("vec"))) + 1]
            names = pa.array([bytes(r).decode() for r in lv], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec"), names], ["row", "vec", "cell"])

    return vectors.select("row", "vec").mapInArrow(cells, "row bigint, vec array<float>, cell string")


def dense_cells(counted: DataFrame, total: int, density: float = DENSITY, least: int = LEAST) -> DataFrame:
    """(cell, n, cluster): dense cells, numbered by the least cell they are joined to through adjacent dense cells.

    Two cells are adjacent if they differ by one level in one feature: each cell is joined on itself with that feature
    masked.  The cell in which no feature stands out is the background: it touches all others and is never dense.  The least name spreads along the joins until nothing changes.  There are at most 1 / density dense cells.
    """
    spark = counted.sparkSession
    scratch = Scratch(spark, "cells")
    limit = max(least, density * total)
    labels = scratch.cut(counted.where((F.col("n") >= limit) & F.col("cell").rlike("[+-]")).select("cell", "n", F.col("cell").alias("cluster")), "dense")
    masked = "explode(transform(sequence(1, greatest(1, length(cell))), i -> struct(i, concat(substring(cell, 1, i - 1), '*', substring(cell, i + 1)) as mask, instr('-0+', substring(cell, i, 1)) as lv)))"
    sides = labels.where("length(cell) > 0").select("cell", F.expr(masked).alias("m")).select("cell", "m.mask", "m.i", "m.lv")
    a, b = sides.alias("a"), sides.alias("b")
    next_to = a.join(b, (F.col("a.mask") == F.col("b.mask")) & (F.col("a.i") == F.col("b.i")) & (F.abs(F.col("a.lv") - F.col("b.lv")) == 1))
    next_to = scratch.cut(next_to.select(F.col("a.cell").alias("cell"), F.col("b.cell").alias("other")).distinct(), "adjacent")
    while not next_to.isEmpty():
        low = next_to.join(labels.select(F.col("cell").alias("other"), F.col("cluster").alias("c")), "other").groupBy("cell").agg(F.min("c").alias("low"))
        new = labels.join(low, "cell", "left").select("cell", "n", F.least("cluster", F.coalesce("low", "cluster")).alias("cluster"), (F.col("low") < F.col("cluster")).alias("moved"))
        new = scratch.cut(new, "labels")
        moved = not new.where("moved").isEmpty()
        scratch.drop(labels)
        labels = new.drop("moved")
        if not moved:
            break
    return labels


def density_clusters(vectors: DataFrame, density: float = DENSITY) -> DataFrame:
    """(row, cluster, distance, cell_size): every vector in exactly one cluster, numbered from 0, largest first.

    ``vectors``: (row unique, vec of DIM finite numbers, not all zero).  Axes are learned from all vectors, and all
    are quantised and counted.  A vector of a dense cell belongs to that cell's cluster.  Vectors far from the
    mean of every cluster are quantised and counted again among themselves, until that finds no dense cell: so a cluster
    too small for an axis or a dense cell among all vectors is found among those left over.  Any other vector belongs
    to the cluster whose mean points nearest to it.  ``distance`` is Euclidean, between unit vector and mean direction.
    Only dense cells (at most 1 / density a round) and their sums come to the driver.  Without any dense cell all
    vectors form cluster 0; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "density")
    rest = scratch.cut(vectors, "vectors")
    total = rest.count()
    if not total:
        return spark.createDataFrame([], "row bigint, cluster int, distance double, cell_size bigint")
    means, sizes, settled, noise = np.zeros((0, DIM), np.float32), [], [], None
    while total:
        grid = learn_grid_of_all(rest, total, noise=noise)
        noise = grid.noise
        celled = scratch.cut(quantise(rest, grid), "celled")
        labels = dense_cells(celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), total, density)
        order = labels.groupBy("cluster").agg(F.sum("n").alias("size")).orderBy(F.desc("size"), "cluster").collect()
        number = {r["cluster"]: len(sizes) + i for i, r in enumerate(order)}
        of_cell = {r["cell"]: (number[r["cluster"]], r["n"]) for r in labels.collect()}
        first = not sizes
        if not order and not first:
            settled.append(celled.select("row", "vec", F.lit(-1).alias("own"), F.lit(0).cast("bigint").alias("n")))
            break
        means = np.concatenate((means, cell_means(celled, of_cell, len(sizes), max(1, len(order)))))
        sizes += [r["size"] for r in order]
        marked = mark_far(celled, of_cell, means)
        settled.append(marked.where("not far").drop("far"))
        if not order:
            settled.append(marked.where("far").drop("far"))
            break
        rest = scratch.cut(marked.where("far").select("row", "vec"), "far")
        total = rest.count()
    best = np.argsort(-np.array(sizes), kind="stable") if sizes else np.zeros(1, np.int64)
    every = settled[0]
    for s in settled[1:]:
        every = every.unionByName(s)
    return nearest(every, means, np.argsort(best))


def cell_means(celled: DataFrame, of_cell: dict[str, tuple[int, int]], start: int, n: int) -> np.ndarray:
    """Mean directions of the ``n`` clusters numbered from ``start``; without any, of all vectors."""

    def sums(batches):
        acc = np.zeros((n, DIM), np.float64)
        for b in batches:
            x = matrix(b.column("vec"))
            own = np.array([of_cell.get(c, (start - 1 if of_cell else start, 0))[0] - start for c in b.column("cell").to_pylist()], np.int64)
            np.add.at(acc, own[own >= 0], x[own >= 0])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(acc)), pa.int32()), pa.array(acc.tolist(), pa.list_(pa.float64()))], ["cluster", "total"])

    parts = celled.select("vec", "cell").mapInArrow(sums, "cluster int, total array<double>")
    each = parts.select("cluster", F.posexplode("total").alias("i", "x")).groupBy("cluster", "i").agg(F.sum("x").alias("x")).collect()
    means = np.zeros((n, DIM))
    for r in each:
        means[r["cluster"], r["i"]] = r["x"]
    norm = np.linalg.norm(means, axis=1, keepdims=True)
    return (means / np.where(norm > 0, norm, 1)).astype(np.float32)


def mark_far(celled: DataFrame, of_cell: dict[str, tuple[int, int]], means: np.ndarray) -> DataFrame:
    """(row, vec, own, n, far): the cluster and size of the dense cell, or -1 and 0; far from all means and in none."""

    def mark(batches):
        for b in batches:
            hits = [of_cell.get(c, (-1, 0)) for c in b.column("cell").to_pylist()]
            own, n = (np.array([h[i] for h in hits], np.int64) for i in (0, 1))
            far = (own < 0) & ((matrix(b.column("vec")) @ means.T).max(1) < FAR)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec"), pa.array(own, pa.int32()), pa.array(n, pa.int64()), pa.array(far)], ["row", "vec", "own", "n", "far"])

    return celled.mapInArrow(mark, "row bigint, vec array<float>, own int, n bigint, far boolean")


def nearest(marked: DataFrame, means: np.ndarray, number: np.ndarray) -> DataFrame:
    """(row, cluster, distance, cell_size): the own cluster or that of the nearest mean, as numbered."""

    def assign(batches):
        for b in batches:
            own = b.column("own").to_numpy()
            cos = matrix(b.column("vec")) @ means.T
            own = np.where(own >= 0, own, cos.argmax(1))
            near = cos[np.arange(len(own)), own].astype(np.float64)
            cols = [b.column("row"), pa.array(number[own], pa.int32()), pa.array(np.sqrt(np.maximum(0, 2 - 2 * near))), b.column("n")]
            yield pa.RecordBatch.from_arrays(cols, ["row", "cluster", "distance", "cell_size"])

    return marked.mapInArrow(assign, "row bigint, cluster int, distance double, cell_size bigint")


def image_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """(image, cluster, distance, cell_size), one row for each image with a valid row: that of its least row."""
    scratch = Scratch(spark, "images")
    found = scratch.cut(density_clusters(valid_vectors(spark, folder)), "found")
    rows = valid_manifest_rows(spark, folder).where("image is not null").distinct()
    s = F.min(F.struct("row", "cluster", "distance", "cell_size")).alias("s")
    return rows.join(found, "row").groupBy("image").agg(s).select("image", "s.cluster", "s.distance", "s.cell_size")


def earlier_names(spark: SparkSession, folder: str) -> DataFrame:
    """(image, name) of the latest run; the run's date is in its version."""
    a = table(spark, folder, "cluster_assignments").select(
        image_id(F.col("path")).alias("image"), cluster_name(F.col("cluster_id")).alias("name"), F.regexp_extract(strip(F.col("cluster_system_version")), r"_(\d{8})(?:_|$)", 1).alias("day")
    )
    day = a.agg(F.max("day").alias("day"))
    return a.join(F.broadcast(day), "day").where("image is not null and name is not null").select("image", "name").distinct()  # one row: the latest day


def named_clusters(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Clusters of images and (cluster, cluster_id): the name most members carry in the latest run, of equals the least."""
    scratch = Scratch(spark, "named")
    own = scratch.cut(image_clusters(spark, folder), "own")
    votes = own.join(earlier_names(spark, folder), "image").groupBy("cluster", "name").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("cluster").agg(F.min(F.struct((-F.col("n")).alias("n"), "name")).alias("b")).select("cluster", F.col("b.name").alias("cluster_id"))
    return own, best


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    own, names = named_clusters(spark, folder)
    images = known_images(table(spark, folder, "image_audit"))
    return own.join(names, "cluster").join(images, own["image"] == images["id"]).select("path", "cluster_id")


def p5_clusters(spark: SparkSession, folder: str, typical: int = 5) -> DataFrame:
    """Each cluster's size, images by class, and most typical members: of the densest cell, nearest to the mean."""
    own, names = named_clusters(spark, folder)
    scratch = Scratch(spark, "report")
    audit = table(spark, folder, "image_audit").select(image_id(F.col("path")).alias("image"), "path", class_label(F.col("current_label")).alias("label"), "audited_at")
    info = audit.where("image is not null").groupBy("image").agg(F.max("path").alias("path"), F.max_by("label", F.when(F.col("label").isNotNull(), F.col("audited_at"))).alias("label"))
    full = scratch.cut(own.join(info, "image"), "members")
    w = Window.partitionBy("cluster").orderBy(F.desc("cell_size"), "distance", "path")
    top = full.withColumn("i", F.row_number().over(w)).where(F.col("i") <= typical)
    top = top.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "path"))), lambda x: x["path"]).alias("typical"))
    count = full.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), *[F.count_if(F.col("label") == k).alias(f"label_{k}") for k in "012"], F.round(F.avg("distance"), 6).alias("mean_distance"))
    return count.join(top, "cluster").join(names, "cluster", "left").select("cluster", "cluster_id", "size", "label_0", "label_1", "label_2", "mean_distance", F.array_join("typical", "|").alias("typical"))


def p5_check(spark: SparkSession, folder: str) -> DataFrame:
    """(path, clusters, fits) of each image: how many clusters it is in, and whether its cluster's name is the one most of the
    cluster's images carry in the latest run."""
    found = Scratch(spark, "check").cut(p5_found(spark, folder), "found")
    earlier = earlier_names(spark, folder).join(known_images(table(spark, folder, "image_audit")).select(F.col("id").alias("image"), "path"), "image")
    votes = found.join(earlier, "path").groupBy("cluster_id", "name").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("cluster_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "name")).alias("b")).select("cluster_id", (F.col("b.name") == F.col("cluster_id")).alias("fits"))
    return found.join(best, "cluster_id").groupBy("path").agg(F.count(F.lit(1)).alias("clusters"), F.min("fits").alias("fits"))
