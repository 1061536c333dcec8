"""Usable vectors of the curation tables, and the axes learned from them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dirt import flag, whole_number
from ..functions.ranking import unit_hash
from .images import image_id, table

DIM = 64


def squared_norm(v: Column) -> Column:
    """NULL, NaN or infinite if any part of the vector is."""
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def usable(v: Column, dim: int = DIM) -> Column:
    """``dim`` finite numbers, not all zero."""
    n = squared_norm(v)
    return (F.size(v) == dim) & (n > 0) & (n < F.lit(float("inf")))


def valid_manifest_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(row, image) of each manifest row flagged as valid; repeated rows stay."""
    m = table(spark, folder, "embedding_manifest")
    return m.where(flag(F.col("valid_embedding"))).select(whole_number(F.col("embedding_row")).alias("row"), image_id(F.col("path")).alias("image")).where("row is not null")


def valid_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(row, vec), one for each valid row.  Of repeated rows with different usable vectors the greatest holds."""
    rows = valid_manifest_rows(spark, folder).select("row")
    v = table(spark, folder, "image_vectors").select(F.col("embedding_row").alias("row"), F.col("embedding").alias("vec")).where(usable(F.col("vec")))
    return v.join(rows, "row", "left_semi").groupBy("row").agg(F.max("vec").alias("vec"))


def matrix(col: pa.ChunkedArray | pa.Array, dim: int = DIM) -> np.ndarray:
    """An Arrow list column of ``dim`` floats as rows of length 1."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.list_(pa.float32()))
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32) if len(x) else x.astype(np.float32)


def sample_matrix(vectors: DataFrame, total: int, bound: int, seed: int = 63) -> np.ndarray:
    """About ``bound`` of the ``total`` vectors, chosen by a hash of their row; all of them if there are fewer."""
    part = vectors.where(unit_hash("row", seed=seed) < bound / total) if total > bound else vectors
    return matrix(part.select("vec").toArrow()["vec"])


@dataclass
class Grid:
    """Axes (dim x q), the noise's second moment, and the half-open levels -1, 0, 1 that a coordinate has below -h, between, and from h on."""

    axes: np.ndarray
    h: float
    noise: float = 0.0

    def levels(self, x: np.ndarray) -> np.ndarray:
        y = x @ self.axes
        return (y >= self.h).astype(np.int8) - (y <= -self.h).astype(np.int8)


def sum_over_rows(vectors: DataFrame, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``part`` of all rows of ``vec``, a matrix of ``shape``: one partial sum a task, added block by block on the executors."""
    high, wide = shape
    step = max(1, (1 << 16) // max(1, wide))
    edges = list(range(0, high, step))

    def run(batches):
        acc = np.zeros(shape)
        for b in batches:
            x = matrix(b.column("vec"))
            if len(x):
                acc += part(x)
        blocks = [acc[e : e + step].ravel() for e in edges]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.list_(pa.float64()))], ["i", "x"])

    def add(t: pa.Table) -> pa.Table:
        x = t["x"].combine_chunks()
        total = x.flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1).sum(0)
        return pa.table([t["i"].slice(0, 1), pa.array([total], pa.list_(pa.float64()))], names=["i", "x"])

    kind = "i int, x array<double>"
    got = vectors.select("vec").mapInArrow(run, kind).groupBy("i").applyInArrow(add, kind).toArrow()
    out = np.zeros(shape)
    for i, x in zip(got["i"].to_pylist(), got["x"].to_pylist(), strict=True):
        out[edges[i] : edges[i] + step] = np.reshape(x, (-1, wide))
    return out


def standing_out(second: np.ndarray, n: int, floor: float, noise: float | None) -> tuple[np.ndarray, float]:
    """(principal axes that stand out of the noise, the noise's second moment) from the mean second moments of ``n`` rows."""
    w, v = np.linalg.eigh(second)
    w, v = w[::-1], v[:, ::-1]
    low = max(float(np.median(w[len(w) // 2 :])), 1e-12) if noise is None else noise
    q = max(1, int((w > floor * (low if noise is None else noise * (1 + np.sqrt(len(w) / n)) ** 2)).sum()))
    return v[:, :q], low


def learn_grid_of_all(vectors: DataFrame, total: int, h: float = 0.45, floor: float = 1.5, noise: float | None = None) -> Grid:
    """``learn_grid`` over every row, in two passes: the second moments give the axes, and the moments of second to fourth order along
    those q axes hold all that the rotation needs.  A task sends q^4 / 4 numbers at most."""
    if not total:
        return Grid(np.zeros((DIM, 0), np.float32), h)
    second = sum_over_rows(vectors, lambda x: x.astype(np.float64).T @ x.astype(np.float64), (DIM, DIM)) / total
    axes, low = standing_out(second, total, floor, noise)
    q = axes.shape[1]
    a, b = np.triu_indices(q)

    def moments(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(a), len(a) + q))
        for at in range(0, len(x), 4096):
            z = x[at : at + 4096].astype(np.float64) @ axes
            pairs = z[:, a] * z[:, b]
            out += pairs.T @ np.hstack((pairs, z))
        return out

    m = sum_over_rows(vectors, moments, (len(a), len(a) + q)) / total
    fourth, third = m[:, : len(a)], m[:, len(a) :]
    twice = np.where(a == b, 1.0, 2.0)
    r = np.eye(q)
    for _ in range(300):
        s = twice[:, None] * r[a] * r[b]  # the square of each coordinate, in products of two axes
        u = fourth @ s
        full = np.empty((q, q, q))
        full[a, b], full[b, a] = u, u
        left, _, right = np.linalg.svd(np.einsum("abj,bj->aj", full, r))
        done = np.abs(left @ right - r).max() < 1e-6
        r = left @ right
        if done:
            break
    skew = np.einsum("pj,pc,cj->j", twice[:, None] * r[a] * r[b], third, r)
    return Grid((axes @ r * np.where(skew < 0, -1, 1)).astype(np.float32), h, low)


def learn_grid(sample: np.ndarray, h: float = 0.45, floor: float = 1.5, noise: float | None = None) -> Grid:
    """Principal axes that stand out of the noise, rotated so that each points at a dense region.

    An axis stands out if its second moment is ``floor`` times the median of the lower half; with a known ``noise``, if it
    is ``floor`` times the greatest that so many vectors of noise have.  The rotation is the
    fixed point of Y -> polar(Z' Y^3), which makes the coordinates' fourth moments as large as can be: for
    separate regions each region then has one axis of its own, and a level cut at ``h`` tells them apart.
    """
    if not len(sample):
        return Grid(np.zeros((DIM, 0), np.float32), h)
    s = sample.astype(np.float64)
    v, low = standing_out(s.T @ s / len(s), len(s), floor, noise)
    q = v.shape[1]
    z = s @ v
    r = np.eye(q)
    for _ in range(300):
        y = z @ r
        a, _, b = np.linalg.svd(z.T @ y**3)
        if np.abs(a @ b - r).max() < 1e-6:
            break
        r = a @ b
    axes = v @ r
    axes = axes * np.where(((s @ axes) ** 3).sum(0) < 0, -1, 1)
    return Grid(axes.astype(np.float32), h, low)
