"""The most similar vectors for every vector, by multi-index hashing of learned binary codes."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import Scratch
from .vectors import DIM, learn_grid, matrix, sample_matrix, valid_vectors

#: Vectors that centres and rotation are learned from; every vector is indexed.
SAMPLE = 20_000
#: Substrings of a code, and bits of each.
PARTS, BITS = 4, 16
#: Codes within this distance are all retrieved: one of the four substrings then differs by at most 11 // 4 = 2 bits.
RADIUS = 11
#: Retrieved codes farther than this are not compared as floats.
FAR = 20
#: Rows that one task indexes; a larger region is cut by the leading bits of its substrings.
ROWS_PER_TASK = 200_000
#: A vector is also indexed in the second nearest region if that is nearer than this.
MARGIN = 0.1
#: A dense cell is a region of its own only if its vectors' mean cosine with their centre is below this: offsets within a
#: tighter one are noise.  A vector whose cosine with every region is below COMMON belongs to the common region.
TIGHT, COMMON = 0.85, 0.4


class Code:
    """Regions and a rotation: the code of a vector is the sign of its rotated offset from its region's centre."""

    def __init__(self, sample: np.ndarray, rounds: int = 30, regions: int = 64):
        grid = learn_grid(sample)
        lv = grid.levels(sample)
        centres = []
        if len(sample):
            cells, inverse, n = np.unique(lv, axis=0, return_inverse=True, return_counts=True)
            inverse = inverse.ravel()
            dense = np.argsort(-n, kind="stable")[:regions]
            centres = [sample[inverse == c].mean(0) for c in dense if n[c] >= max(4, 0.002 * len(sample))]
        centres = [c for c in centres if np.linalg.norm(c) < TIGHT]
        common = sample.mean(0) if len(sample) else np.zeros(DIM)
        self.centres = np.array([*centres, common], np.float32)
        length = np.linalg.norm(self.centres, axis=1, keepdims=True)
        self.directions = self.centres / np.where(length > 0, length, 1)
        rng = np.random.default_rng(63)
        r = np.linalg.qr(rng.normal(size=(DIM, DIM)))[0]
        if len(sample):
            z = (sample - self.centres[self.regions(sample)[0]]).astype(np.float64)
            for _ in range(rounds):  # rotation that brings the offsets nearest to the corners of a cube
                a, _, b = np.linalg.svd(np.sign(z @ r).T @ z)
                r = (a @ b).T
        self.rotation = r.astype(np.float32)

    def regions(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest region of each row, and the second nearest or -1 if that is clearly farther."""
        cos = x @ self.directions.T
        cos[:, -1] = COMMON
        first = cos.argmax(1)
        if cos.shape[1] == 1 or not len(x):
            return first, np.full(len(x), -1)
        best = cos[np.arange(len(x)), first]
        cos[np.arange(len(x)), first] = -9
        second = cos.argmax(1)
        return first, np.where(best - cos[np.arange(len(x)), second] < MARGIN, second, -1)

    def codes(self, x: np.ndarray, region: np.ndarray) -> np.ndarray:
        bits = ((x - self.centres[region]) @ self.rotation) > 0
        return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def _masks(bits: int, radius: int) -> list[int]:
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _substring(codes: np.ndarray, j: int) -> np.ndarray:
    return ((codes >> np.uint64(BITS * (PARTS - 1 - j))) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, position): for each i the positions lo[i]..hi[i]-1."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    start = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n)
    return which, start + np.arange(len(which))


def code_pairs(codes: np.ndarray, guest: np.ndarray, parts: range, radius: int, far: int = FAR, block: int = 2_000_000):
    """Index pairs (i, j) of codes that agree up to ``radius // PARTS`` bits in a substring of ``parts``, each once.

    A guest (a row whose home is another task) pairs with hosts only.  Its substring is its own, so a mask that reaches a
    host holds the differing leading bits already.
    Yields arrays; a pair comes with the first substring that finds it.
    """
    own_radius = radius // PARTS
    subs = [_substring(codes, j) for j in range(PARTS)]
    hosts = np.flatnonzero(~guest)
    visitors = np.flatnonzero(guest)
    for j in parts:
        s = subs[j]
        order = hosts[np.argsort(s[hosts], kind="stable")]
        edge = np.concatenate(([0], np.cumsum(np.bincount(s[order], minlength=1 << BITS))))

        def found(a: np.ndarray, lo: np.ndarray, hi: np.ndarray, j=j, order=order):
            total = np.cumsum(hi - lo)
            at = 0
            while at < len(a):
                stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + block, side="right")))
                which, pos = _expand(lo[at:stop], hi[at:stop])
                x, y = a[at:stop][which], order[pos]
                near = _popcount(codes[x] ^ codes[y]) <= far
                x, y = x[near], y[near]
                first = np.ones(len(x), bool)
                if len(parts) > 1:
                    for e in range(parts.start, j):
                        first &= _popcount(subs[e][x] ^ subs[e][y]) > own_radius
                yield x[first], y[first]
                at = stop

        for mask in _masks(BITS, own_radius):
            if mask == 0:
                place = np.empty(len(codes), np.int64)
                place[order] = np.arange(len(order))
                yield from found(order, place[order] + 1, edge[s[order] + 1])
            else:
                low = mask & -mask
                a = order[(s[order] & low) == 0]
                yield from found(a, edge[s[a] ^ mask], edge[(s[a] ^ mask) + 1])
            if len(visitors):
                v = visitors[edge[s[visitors] ^ mask] < edge[(s[visitors] ^ mask) + 1]]
                yield from found(v, edge[s[v] ^ mask], edge[(s[v] ^ mask) + 1])


def _best(row: np.ndarray, other: np.ndarray, sim: np.ndarray, k: int):
    """The k greatest similarities of each row, ties by the smaller other."""
    order = np.lexsort((other, -sim, row))
    row, other, sim = row[order], other[order], sim[order]
    first = np.concatenate(([True], row[1:] != row[:-1])) if len(row) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
    keep = rank < k
    return row[keep], other[keep], sim[keep]


OUT = "row bigint, other bigint, similarity double"


def nearest_rows(vectors: DataFrame, k: int = 5, min_similarity: float = 0.92, sample: int = SAMPLE, radius: int = RADIUS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(row, other, similarity, rank): up to ``k`` most similar other rows of each row, by cosine, of at least ``min_similarity``.

    ``vectors``: (row unique, vec of DIM finite numbers, not all zero).  Regions and rotation are learned from a bounded
    sample; every row is indexed.  All pairs of a region whose codes are within ``radius`` bits are retrieved and compared
    as floats; nothing is capped.  What can be missed: pairs farther apart in code than that, and pairs across regions
    beyond MARGIN.  Ties go to the smaller row.  Rows whose unit vectors agree to 5 decimals are copies: of more than
    k + 1 copies all take the k least others as neighbours, and only the k + 1 least are indexed, which changes no result.
    Rows without a neighbour have no output; an empty table gives none.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "nearest")
    coded_schema = "row bigint, vec array<float>, copy bigint, region int, code bigint"
    source = scratch.cut(vectors.select("row", "vec"), "vectors")
    total = source.count()
    if not total:
        return spark.createDataFrame([], OUT + ", rank int")
    code = Code(sample_matrix(source, total, sample))

    def encode(batches):
        for b in batches:
            x = matrix(b.column("vec"))
            if not len(x):
                continue
            rounded = np.ascontiguousarray(np.round(x * 1e5).astype(np.int32))
            mix = np.random.default_rng(7).integers(1, 2**62, size=(1, DIM), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            z = (rounded.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * mix
            z ^= z >> np.uint64(29)
            copy = (z * mix[:, ::-1]).sum(1, dtype=np.uint64).view(np.int64)
            first, second = code.regions(x)
            both = np.flatnonzero(second >= 0)
            at = np.concatenate((np.arange(len(x)), both))
            region = np.concatenate((first, second[both]))
            c = code.codes(x[at], region)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(at) + 1) * DIM, DIM), pa.int32()), pa.array(x[at].ravel(), pa.float32()))
            rows = b.column("row").to_numpy(zero_copy_only=False)[at]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), flat, pa.array(copy[at]), pa.array(region, pa.int32()), pa.array(c.view(np.int64))], ["row", "vec", "copy", "region", "code"])

    coded = scratch.cut(source.mapInArrow(encode, coded_schema), "coded")
    scratch.drop(source)
    hot = scratch.cut(coded.groupBy("copy", "region").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > k + 1).select("copy", "region"), "hot")
    copies: DataFrame | None = None
    if not hot.isEmpty():
        w = Window.partitionBy("copy", "region").orderBy("row")
        members = coded.join(hot, ["copy", "region"])
        heads = scratch.cut(members.withColumn("i", F.row_number().over(w)).where(F.col("i") <= k + 1), "heads")
        coded = coded.join(hot, ["copy", "region"], "left_anti").unionByName(heads.drop("i").select("row", "vec", "copy", "region", "code"))
        late = members.select("row", "copy", "region").join(heads.select("row", "region"), ["row", "region"], "left_anti")
        near = late.join(heads.select("copy", "region", F.col("row").alias("other"), "i"), ["copy", "region"]).where(F.col("i") <= k)
        copies = near.select("row", "other", F.lit(1.0).alias("similarity"))
    sizes = {r["region"]: r["n"] for r in coded.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()}
    lead = {g: min(BITS, max(0, int(np.ceil(np.log2(n / rows_per_task))))) for g, n in sizes.items()}
    own_radius = radius // PARTS

    def place(batches):
        """Which tasks a row goes to: one for a small region; else for each substring the task of its leading bits, and as a guest those of smaller leading bits within reach."""
        for b in batches:
            region = b.column("region").to_numpy()
            c = b.column("code").to_numpy().view(np.uint64)
            at, task, guest = [], [], []
            small = np.array([lead[g] == 0 for g in region], bool)
            at.append(np.flatnonzero(small))
            task.append(region[small].astype(np.int64) << 32)
            guest.append(np.zeros(int(small.sum()), bool))
            for g in {int(x) for x in region[~small]}:
                idx = np.flatnonzero(region == g)
                t = lead[g]
                for j in range(PARTS):
                    top = _substring(c[idx], j) >> (BITS - t)
                    for mask in _masks(t, own_radius):
                        to = top ^ mask
                        go = to <= top
                        at.append(idx[go])
                        task.append((np.int64(g) << 32) | (np.int64(j + 1) << 24) | to[go])
                        guest.append(np.full(int(go.sum()), mask > 0))
            at, task, guest = np.concatenate(at), np.concatenate(task), np.concatenate(guest)
            moved = b.select(["row", "vec", "code"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*moved.columns, pa.array(task, pa.int64()), pa.array(guest)], ["row", "vec", "code", "task", "guest"])

    placed = coded.mapInArrow(place, "row bigint, vec array<float>, code bigint, task bigint, guest boolean")

    def search(t: pa.Table) -> pa.Table:
        task = t["task"][0].as_py()
        j = (task >> 24) & 0xFF
        x = matrix(t["vec"])
        rows = t["row"].to_numpy()
        codes = t["code"].to_numpy().view(np.uint64)
        guest = t["guest"].to_numpy()
        kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        found, waiting = [kept], 0
        parts = range(PARTS) if j == 0 else range(j - 1, j)
        for a, b in code_pairs(codes, guest, parts, radius):
            if not len(a):
                continue
            sim = np.einsum("ij,ij->i", x[a], x[b], dtype=np.float32).astype(np.float64)
            ok = (sim >= min_similarity) & (rows[a] != rows[b])
            a, b, sim = rows[a[ok]], rows[b[ok]], sim[ok]
            found.append((np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((sim, sim))))
            waiting += 2 * len(a)
            if waiting > 4_000_000:
                found, waiting = [_best(*(np.concatenate(c) for c in zip(*found, strict=True)), k)], 0
        row, other, sim = _best(*(np.concatenate(c) for c in zip(*found, strict=True)), k)
        return pa.table([pa.array(row, pa.int64()), pa.array(other, pa.int64()), pa.array(sim, pa.float64())], names=["row", "other", "similarity"])

    near = placed.groupBy("task").applyInArrow(search, OUT)
    if copies is not None:
        near = near.unionByName(copies)
    if copies is not None or any(lead.values()) or len(sizes) > 1:  # a row may have been in several tasks
        near = near.groupBy("row", "other").agg(F.max("similarity").alias("similarity"))
    w = Window.partitionBy("row").orderBy(F.desc("similarity"), "other")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def exact_scan(queries: DataFrame, vectors: DataFrame, k: int = 5, block: int = 20_000) -> DataFrame:
    """(row, other, similarity, rank) of the k most similar rows for each query row, by comparing it with all vectors.

    Queries are taken in blocks of ``block`` (their vectors go to every task, 5 MB a block); each task keeps the k best of
    its own rows for a query, so nothing but those is shuffled.
    """
    spark = vectors.sparkSession
    n = queries.count()
    out: DataFrame | None = None
    blocks = max(1, -(-n // block))
    for i in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == i).select("row", "vec").toArrow()
        ids, q = part["row"].to_numpy(), matrix(part["vec"])

        order_at = np.argsort(ids, kind="stable")
        order_ids = ids[order_at]

        def scan(batches, ids=ids, q=q, order_at=order_at, order_ids=order_ids):
            best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
            least = np.full(len(q), -8.0, np.float32)  # what a query's row must reach to be among its k best so far
            for b in batches:
                x, rows = matrix(b.column("vec")), b.column("row").to_numpy()
                place = np.minimum(np.searchsorted(order_ids, rows), len(order_ids) - 1) if len(q) else np.zeros(0, np.int64)
                column = np.flatnonzero(order_ids[place] == rows) if len(q) else place  # rows that are queries themselves
                asked = order_at[place[column]]
                for at in range(0, len(q) if len(x) else 0, 2_000):
                    s = q[at : at + 2_000] @ x.T
                    own = (asked >= at) & (asked < at + 2_000)
                    s[asked[own] - at, column[own]] = -9
                    floor = least[at : at + 2_000]
                    if s.shape[1] >= 1_000 and floor.min() <= -8:
                        floor = np.maximum(floor, -np.partition(-s[:, :1_000], k - 1, axis=1)[:, k - 1])
                    r, c = np.nonzero(s >= floor[:, None])
                    best = tuple(np.concatenate((u, v)) for u, v in zip(best, (ids[at : at + 2_000][r], rows[c], s[r, c].astype(np.float64)), strict=True))
                best = _best(*best, k)
                place = np.searchsorted(order_ids, best[0])
                full = np.bincount(place, minlength=len(q)) >= k
                low = np.full(len(q), np.inf)
                np.minimum.at(low, place, best[2])
                least[order_at[full]] = low[full]
            row, other, sim = _best(*best, k)
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(other, pa.int64()), pa.array(sim, pa.float64())], ["row", "other", "similarity"])

        near = vectors.select("row", "vec").mapInArrow(scan, OUT)
        out = near if out is None else out.unionByName(near)
    if out is None:
        return spark.createDataFrame([], OUT + ", rank int")
    w = Window.partitionBy("row").orderBy(F.desc("similarity"), "other")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    near = nearest_rows(valid_vectors(spark, folder))
    return near.select(F.least("row", "other").alias("row_a"), F.greatest("row", "other").alias("row_b")).distinct()


def p7_neighbours(spark: SparkSession, folder: str, k: int = 5) -> DataFrame:
    """The k most similar rows for every row divisible by 50: by the index where it finds k, else against all rows."""
    scratch = Scratch(spark, "queries")
    vectors = scratch.cut(valid_vectors(spark, folder), "vectors")
    near = scratch.cut(nearest_rows(vectors, k).where("row % 50 = 0"), "near")
    full = near.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    rest = scratch.cut(vectors.where("row % 50 = 0").join(full, "row", "left_anti"), "rest")
    out = near.join(full.select("row"), "row", "left_semi").unionByName(exact_scan(rest, vectors, k))
    return out.select("row", "other", F.round("similarity", 4).alias("similarity"), "rank")


def p7_check(spark: SparkSession, folder: str, k: int = 5) -> DataFrame:
    """(row, found, near): rows divisible by 50, how many neighbours each has, and how many of them are as similar as its k-th most
    similar of all rows, to 4 places."""
    scratch = Scratch(spark, "check")
    vectors = scratch.cut(valid_vectors(spark, folder), "vectors")
    got = p7_neighbours(spark, folder, k)
    least = exact_scan(vectors.where("row % 50 = 0"), vectors, k).groupBy("row").agg(F.min("similarity").alias("least"))
    j = got.join(least, "row").withColumn("near", F.col("similarity") >= F.round("least", 4) - 1.5e-4)
    return j.groupBy("row").agg(F.count(F.lit(1)).alias("found"), F.count_if("near").alias("near"))
