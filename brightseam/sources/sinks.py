"""Writing tables, summaries and copies, all to the cluster's storage."""

from __future__ import annotations

import io
import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ContractError
from ..schemas import TABLES
from .files import exists, hadoop_path


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """One small file."""
    fs, p = hadoop_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def write_table(df: DataFrame, path: str, name: str, order: list | None = None, one_file: bool = False) -> None:
    """A CSV of the contract's columns, in its order: RFC 4180 quotes, CRLF, bare empties.

    With ``order`` rows are sorted over all files, whose names keep that order.  ``one_file`` puts all rows in one task: for small tables only.
    """
    out = df.orderBy(*order) if order else df
    out = out.select(*[F.col(c).cast("string") for c in TABLES[name]]).na.fill("")
    out = out.coalesce(1) if one_file else out
    out.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", lineSep="\r\n")


def write_json(spark: SparkSession, data: dict, path: str) -> dict:
    write_bytes(spark, path, (json.dumps(data, indent=2, default=str) + "\n").encode())
    return data


def write_summary(one_row: DataFrame, path: str, **more) -> dict:
    """A one-row table and further entries as indented JSON."""
    rows = one_row.limit(2).collect()
    if len(rows) != 1:
        raise ContractError("a summary has one row", [f"found {len(rows)}"])
    return write_json(one_row.sparkSession, rows[0].asDict(recursive=True) | more, path)


def write_review_summary(actions: DataFrame, path: str, source: str) -> None:
    """What a duplicate review decided, as Markdown: totals, then counts by type and by decision, of which there are a few each."""
    one = actions.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(F.col("remove_path") != "", F.col("remove_path"))).alias("gone"), F.count_if(F.coalesce("group_paths", F.lit("")) != "").alias("kept")).first()
    lines = ["# Duplicate Review Summary", "", f"Source: `{source}`", "", "## Counts", ""]
    lines += [f"- Review rows: `{one['n']}`", f"- Unique remove paths: `{one['gone']}`", f"- Group-only pairs: `{one['kept']}`"]
    for column in ("type", "decision"):
        counts = actions.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(column).collect()
        lines += ["", f"By {column}:", "", *[f"- `{r[column]}`: `{r['n']}`" for r in counts]]
    write_bytes(actions.sparkSession, path, ("\n".join(lines) + "\n").encode())


def replace_queue(queue: DataFrame, path: str, order: list | None = None) -> None:
    """Overwrite a review queue, unless the one in place has decisions filled in."""
    spark = queue.sparkSession
    if exists(spark, path):
        old = spark.read.csv(path, header=True, escape='"', multiLine=True)
        if "decision" in old.columns and not old.where(F.trim("decision") != "").isEmpty():
            raise ContractError(f"{path} holds decisions; move it away first", [])
    write_table(queue, path, "duplicate_review", order)


def write_matrix(spark: SparkSession, m: np.ndarray, path: str) -> None:
    """A small matrix, such as centroids, as ``.npy``."""
    out = io.BytesIO()
    np.save(out, m, allow_pickle=False)
    write_bytes(spark, path, out.getvalue())


def copy_images(images: DataFrame, out: str) -> int:
    """Write (name, content) to files below ``out``, a folder or URI that all executors share; returns how many."""

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(out) if "://" in out else (fs.LocalFileSystem(), out)
        for b in batches:
            for n, c in zip(b["name"], b["content"], strict=True):
                to = f"{root.rstrip('/')}/{n}"
                store.create_dir(to.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(to) as f:
                    f.write(c)
            yield b[["name"]]

    return images.select("name", "content").mapInPandas(run, "name string").count()
