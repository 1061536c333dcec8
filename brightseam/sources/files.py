"""Reading manifests, listings, bytes and matrices."""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ContractError, MissingInputError
from ..operators.components import number_by
from ..schemas import TABLES
from .images import verified_size


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the cluster's storage."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def require(spark: SparkSession, path: str) -> None:
    if not exists(spark, path):
        raise MissingInputError(path)


def read_manifest(spark: SparkSession, path: str, name: str, order: bool = False, exact_header: bool = False) -> DataFrame:
    """A CSV table of ``TABLES``: all text, missing as empty.  ``order`` adds ``_ord``, the row's place from 0: files by name,
    then rows of the file.

    Columns are taken by the header's names.  ``exact_header`` demands the contract's columns in its order; else
    further columns are dropped and missing ones are an error.
    """
    require(spark, path)
    want = TABLES[name]
    raw = spark.read.csv(path, header=True, inferSchema=False, escape='"', multiLine=True)
    if (exact_header and raw.columns != want) or not set(want) <= set(raw.columns):
        raise ContractError(f"{path}: wrong columns", [f"expected {want}", f"found {raw.columns}"])
    if not order:
        return raw.select(*want).na.fill("")
    placed = raw.select(*want, F.col("_metadata.file_path").alias("__f"), F.monotonically_increasing_id().alias("__m"))  # grows within a file, which one task reads
    return number_by(placed, ["__f", "__m"], "_ord").withColumn("_ord", F.col("_ord") - 1).drop("__f", "__m").na.fill("", want)


def file_digests(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file; of a folder, of its files' digests in the order of their names."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path).select("path", F.sha2("content", 256).alias("d"))
    one = f.agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "d"))), lambda x: x["d"]), "").alias("d")).first()
    return one["d"] if one["n"] == 1 else hashlib.sha256(one["d"].encode()).hexdigest()


def list_files(spark: SparkSession, root: str, keep: int = 3) -> DataFrame:
    """(path) of the files exactly two levels below ``root``, as the last ``keep`` parts; contents are not read."""
    require(spark, root)
    f = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/*").select("path")
    return f.select(F.array_join(F.slice(F.split("path", "/"), -keep, keep), "/").alias("path"))


def read_bytes(spark: SparkSession, pattern: str, keep: int = 3) -> DataFrame:
    """(path, content)."""
    f = spark.read.format("binaryFile").load(pattern)
    return f.select(F.array_join(F.slice(F.split("path", "/"), -keep, keep), "/").alias("path"), "content")


def image_info(images: DataFrame) -> DataFrame:
    """(path, sha256, width, height, error) of (path, content), in one pass over the bytes, which go no further.  Pillow verifies a
    picture where it is installed; else the headers of PNG, GIF and JPEG are read here."""

    def run(batches):
        for b in batches:
            out = []
            for c in b["content"]:
                try:
                    out.append((*verified_size(bytes(c)), ""))
                except Exception as e:  # noqa: BLE001 - any failure belongs to the row
                    out.append((None, None, str(e) or type(e).__name__))
            yield pd.DataFrame({"path": b["path"], "sha256": b["sha256"], "width": pd.array([o[0] for o in out], "Int32"), "height": pd.array([o[1] for o in out], "Int32"), "error": [o[2] for o in out]})

    return images.select("path", "content", F.sha2("content", 256).alias("sha256")).mapInPandas(run, "path string, sha256 string, width int, height int, error string")


def read_npy(spark: SparkSession, pattern: str) -> DataFrame:
    """(file, pos, vector) of two-dimensional ``.npy`` files, a file a task."""

    def run(batches):
        for b in batches:
            for p, c in zip(b["path"], b["content"], strict=True):
                m = np.load(io.BytesIO(c), allow_pickle=False)
                yield pd.DataFrame({"file": p, "pos": np.arange(len(m)), "vector": [r.astype(np.float32).tolist() for r in m]})

    return spark.read.format("binaryFile").load(pattern).select("path", "content").mapInPandas(run, "file string, pos bigint, vector array<float>")
