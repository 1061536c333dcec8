"""Embeddings: pluggable encoder, manifest, cache check."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import l2_unit
from ..sources.images import resize, rgb
from .components import number_by


def extract(images: DataFrame, load: Callable[[], Callable[[bytes], list[float]]]) -> DataFrame:
    """(path, embedding, embedding_error) of (path, content).  ``load`` makes the encoder, once in each task; an encoder's
    error becomes the row's text and leaves the embedding NULL."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load()
        for b in batches:
            vec, err = [], []
            for content in b["content"]:
                try:
                    vec.append([float(x) for x in encode(content)])
                    err.append("")
                except Exception as e:  # noqa: BLE001 - any failure belongs to the row
                    vec.append(None)
                    err.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"path": b["path"], "embedding": vec, "embedding_error": err})

    return images.select("path", "content").mapInPandas(run, "path string, embedding array<float>, embedding_error string")


def load_encoder(name: str, size: int) -> Callable[[], Callable[[bytes], list[float]]]:
    """What ``extract`` takes, from ``module:factory``; the factory gets the input size and returns the encoder of one file's bytes."""
    module, _, factory = name.partition(":")
    return lambda: getattr(importlib.import_module(module), factory)(size)


def rgb_input(content: bytes, size: int) -> np.ndarray:
    """(size, size, 3) of a file: RGB, resampled, numbers from 0 to 1."""
    return resize(rgb(content), size, size).astype(np.float32) / 255


def thumbnail_encoder(size: int) -> Callable[[bytes], list[float]]:
    """A stand-in that needs no model: the colours of an 8 x 8 thumbnail, less their mean."""

    def encode(content: bytes) -> list[float]:
        x = rgb_input(content, size)
        cut = size // 8 * 8
        t = x[:cut, :cut].reshape(8, cut // 8, 8, cut // 8, 3).mean((1, 3))
        return (t - t.mean()).ravel().tolist()

    return encode


def embedding_rows(manifest: DataFrame, extracted: DataFrame, source: str) -> DataFrame:
    """The embedding manifest with ``embedding`` of length 1 and ``_ord``: one row a manifest row, valid ones numbered in order.

    ``manifest``: path, current_label, _ord; ``extracted``: path, embedding, embedding_error.  An image without bytes is ``file not found``.
    """
    j = manifest.select("path", F.col("current_label").alias("label"), "_ord").join(extracted, "path", "left")
    j = j.withColumn("embedding_error", F.coalesce("embedding_error", F.lit("file not found"))).withColumn("ok", F.col("embedding").isNotNull())
    n = number_valid(j, "ok", "_ord", "embedding_row")
    return n.select("embedding_row", "path", F.lit(source).alias("source_manifest"), F.when(F.col("ok"), "1").otherwise("0").alias("valid_embedding"), "embedding_error", "label", l2_unit(F.col("embedding")).alias("embedding"), "_ord")


def cache_problems(manifest: DataFrame, cached: DataFrame, vectors: int) -> list[str]:
    """Why cached embeddings don't belong to a manifest: other paths or another order, or another number of vectors than valid rows.

    Both tables: path, _ord; ``cached`` has valid_embedding too."""
    both = manifest.select("_ord", "path").join(cached.select("_ord", F.col("path").alias("had")), "_ord", "full")
    other = both.where(~F.col("path").eqNullSafe(F.col("had"))).count()
    valid = cached.where("valid_embedding = '1'").count()
    return ([f"{other} rows name another path"] if other else []) + ([f"{valid} valid rows, {vectors} vectors"] if valid != vectors else [])


def number_valid(rows: DataFrame, valid: str, order: str, out: str = "row_no") -> DataFrame:
    """Rows with a number from 0 over the valid ones in order, NULL for the others."""
    numbered = number_by(rows.where(F.col(valid)), [order], out).withColumn(out, F.col(out) - 1)
    return numbered.unionByName(rows.where(~F.coalesce(F.col(valid), F.lit(False))).withColumn(out, F.lit(None).cast("bigint")))


def fingerprint(manifest: DataFrame, path: str = "path") -> DataFrame:
    """One row (rows, digest): equal for equal sets of paths with equal repeats, whatever the order."""
    h = F.xxhash64(F.col(path)).cast("decimal(38,0)")
    return manifest.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("digest"))


def cache_state(manifest: DataFrame, cached: DataFrame) -> DataFrame:
    """(state, n): paths that the cache covers, lacks, or holds without need."""
    m, c = manifest.select("path").distinct(), cached.select("path").distinct()
    part = lambda df, s: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(s).alias("state"), "n")
    return part(m.join(c, "path", "left_semi"), "cached").unionByName(part(m.join(c, "path", "left_anti"), "missing")).unionByName(part(c.join(m, "path", "left_anti"), "stale"))


