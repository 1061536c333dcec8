"""Near duplicates by blocked Hamming comparison of three 64-bit signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import bits, hamming


def vector_signatures(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, phash, dhash, whash) of 64-number vectors: above the median, next above this one, above zero; first number first.

    Any other vector gives NULL signatures.
    """

    def sign(batches):
        for b in batches:
            cols: list[list[str | None]] = [[], [], []]
            for v in b.column(1).to_pylist():
                if v is None or len(v) != 64 or None in v:
                    for c in cols:
                        c.append(None)
                    continue
                x = np.array(v, np.float64)
                for c, bit in zip(cols, (x > np.median(x), np.append(x[1:] > x[:-1], False), x > 0), strict=True):
                    c.append(np.packbits(bit).tobytes().hex())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.string()) for c in cols]], [key, "phash", "dhash", "whash"])

    kind = dict(df.dtypes)[key]
    return df.select(key, vector).mapInArrow(sign, f"`{key}` {kind}, phash string, dhash string, whash string")


HASHES = ("phash", "dhash", "whash")


def near_pairs(items: DataFrame, prefix: int = 4, limit: int = 4, votes: int = 2) -> DataFrame:
    """Pairs of equal phash prefix, different content, whose signatures differ by at most ``limit`` bits in ``votes`` of three.

    ``items``: ord (unique), path, label, class_name, sha256, phash, dhash, whash.  The member with the smaller ``ord`` is
    A.  Of any 4 - ``votes`` of the hashes one is among those that agree, and of ``limit`` + 1 bands of its bits one is equal: so items
    meet only where a band is equal too, which loses no pair.  Prefix, hash and band are the key of the join, which spills and splits
    like any other; the distances stand in its residual.  A pair found by several bands is one row.
    """
    x = items.where("phash is not null").select(
        "ord", "path", "label", "class_name", "sha256", F.substring("phash", 1, prefix).alias("block"), *[bits(F.col(h)).alias(h) for h in HASHES]
    )
    at = 4 * prefix
    keys = []
    for i, h in enumerate(HASHES[: 4 - votes]):
        first = min(at, 60) if i == 0 else 0  # the block holds the first bits of phash already
        edges = [first + (64 - first) * k // (limit + 1) for k in range(limit + 2)]
        for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
            band = F.shiftrightunsigned(F.shiftleft(F.col(h), lo), 64 - hi + lo) if hi > lo else F.lit(0).cast("bigint")
            keys.append(F.struct(F.lit(i * (limit + 1) + k).alias("k"), band.alias("v")))
    side = x.withColumn("band", F.explode(F.array(*keys))).select("*", "band.k", "band.v").drop("band")
    a, b = side.alias("a"), side.alias("b")
    d = {h: hamming(F.col(f"a.{h}"), F.col(f"b.{h}")) for h in HASHES}
    agree = sum(((v <= limit).cast("int") for v in d.values()), F.lit(0))
    same = (F.col("a.block") == F.col("b.block")) & (F.col("a.k") == F.col("b.k")) & (F.col("a.v") == F.col("b.v"))
    cond = same & (F.col("a.ord") < F.col("b.ord")) & ~F.col("a.sha256").eqNullSafe(F.col("b.sha256")) & (agree >= votes)
    out = a.join(b, cond).select(
        F.col("a.ord").alias("__a"), F.col("b.ord").alias("__b"),
        F.col("a.path").alias("path_a"), F.col("a.label").alias("label_a"), F.col("a.class_name").alias("class_a"), F.col("b.path").alias("path_b"), F.col("b.label").alias("label_b"), F.col("b.class_name").alias("class_b"),
        *[v.alias(f"{h}_distance") for h, v in d.items()], agree.alias("matching_hashes"), F.when(F.col("a.label") != F.col("b.label"), "True").otherwise("False").alias("cross_label"),
    )
    return out.dropDuplicates(["__a", "__b"]).drop("__a", "__b")


def order_keys() -> list:
    """Cross-label first, then the sum of distances, then paths; all ascending."""
    return [(F.col("cross_label") != "True").alias("o"), (F.col("phash_distance") + F.col("dhash_distance") + F.col("whash_distance")).alias("d"), F.col("path_a"), F.col("path_b")]


def near_summary(items: DataFrame, pairs: DataFrame, source: str = "", prefix: int = 4, limit: int = 4, votes: int = 2) -> DataFrame:
    """One row: what was compared, how, and how many pairs came out."""
    n = items.agg(F.lit(source).alias("source"), F.count("phash").alias("images_hashed"))
    n = n.withColumn("method", F.lit(f"phash, dhash and whash; candidates share the first {prefix} hex digits of phash")).withColumn("threshold", F.lit(f"at least {votes} of 3 distances <= {limit}")).withColumn("exact_sha256_duplicates_excluded", F.lit(True))
    return n.crossJoin(pairs.agg(F.count(F.lit(1)).alias("near_duplicate_pairs"), F.count_if(F.col("cross_label") == "True").alias("cross_label_pairs")))  # one row by one row
