"""Cutting lineage of iterative jobs in a folder that all executors share.

The folder is the session's ``spark.checkpoint.dir``.  Where that is unset (tests, a laptop) a
temporary folder is made once and removed when the process ends; that fallback is refused on a
cluster, whose executors would not see it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder for cut lineage, as a URI or path."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    set_dir = spark.sparkContext.getCheckpointDir()
    if set_dir:
        return set_dir.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="brightseam-")
        atexit.register(shutil.rmtree, _LOCAL["dir"], ignore_errors=True)
    return _LOCAL["dir"]


class Scratch:
    """Tables written between the rounds of one job.

    ``cut`` writes a DataFrame as parquet and returns it read again, so its plan starts anew, loses
    unused columns and survives the loss of an executor.  ``drop`` removes a table no longer read.
    Tables that the returned, lazy result still reads are left in the folder for its owner to clean.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def path(self, label: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{label}"

    def cut(self, df: DataFrame, label: str = "t") -> DataFrame:
        where = self.path(label)
        df.write.mode("overwrite").parquet(where)
        out = self.spark.read.schema(df.schema).parquet(where)
        out._scratch_path = where  # type: ignore[attr-defined]
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        for t in tables:
            where = getattr(t, "_scratch_path", None)
            if where:
                jvm = self.spark.sparkContext._jvm
                p = jvm.org.apache.hadoop.fs.Path(where)
                p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
