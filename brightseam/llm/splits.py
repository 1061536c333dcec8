"""Splits that keep related records together."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dirt import class_label, object_entity
from ..functions.ranking import spread_row_number, unit_hash
from ..scratch import Scratch
from .graph import hooking_components
from .images import image_id, known_images, table

#: Sums in the window of a subset-sum table: 2 MB of bits and 64 MB of choices at most.
WINDOW = 1 << 24
#: Sums that are listed one by one where the window is wider than that.
LISTED = 1 << 20


def closest_subset(items: list[tuple[int, int]], target: int, window: int = WINDOW, listed: int = LISTED) -> list[int]:
    """How many of each (size, multiplicity) to take so that the sum is as close to ``target`` as any.

    The sums that can be reached are the set bits of an integer.  A multiplicity is cut into powers of two,
    each one shift; which shift reached a sum first is kept to read the choice back, and the first shift that reaches the target
    ends the search.  Ties go below the target.  Sizes are divided by what they have in common.  Where twice
    the target is still more than ``window``, the sums are listed as long as they are no more than ``listed``; beyond that groups are
    given out, largest first, as many as fit, until the rest fits the window.  Only in that last case can
    the sum be other than the closest, and it is exact there too if the target is met.
    """
    common = math.gcd(*(s for s, m in items if s > 0 and m > 0)) or 1
    if common > 1:
        low, high = (closest_subset([(s // common, m) for s, m in items], t, window, listed) for t in (target // common, -(-target // common)))
        return min(low, high, key=lambda take: (abs(sum(s * n for (s, _), n in zip(items, take, strict=True)) - target), sum(s * n for (s, _), n in zip(items, take, strict=True))))
    target = max(0, min(target, sum(s * m for s, m in items)))
    if min(sum(s * m for s, m in items), 2 * target + 1) <= window:
        return _by_bits(items, target)
    take = _by_list(items, target, listed)
    if take is not None:
        return take
    given = [0] * len(items)
    left = target
    for i in sorted(range(len(items)), key=lambda i: -items[i][0]):
        size, many = items[i]
        if size <= 0:
            continue
        if 2 * left + 1 <= window:
            break
        given[i] = min(many, left // size)
        left -= given[i] * size
    rest = [(s, m - g) if 2 * left + 1 <= window else (s, 0) for (s, m), g in zip(items, given, strict=True)]
    return [g + n for g, n in zip(given, _by_bits(rest, left), strict=True)]


def _steps(items: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """(item, pieces): each multiplicity as powers of two and a rest; those above ``limit`` are left out."""
    out = []
    for i, (size, many) in enumerate(items):
        k = 1
        while many > 0 and size > 0:
            k = min(k, many)
            if size * k <= limit:
                out.append((i, k))
            many -= k
            k *= 2
    return out


def _by_bits(items: list[tuple[int, int]], target: int) -> list[int]:
    limit = min(sum(s * m for s, m in items), 2 * target + 1)
    target = min(target, limit)
    mask = (1 << (limit + 1)) - 1
    steps = _steps(items, limit)
    first = np.full(limit + 1, -1, np.int32)  # the step that reached a sum first
    bits = 1
    for at, (i, k) in enumerate(steps):
        if bits >> target & 1:
            break
        new = (bits << (items[i][0] * k)) & mask & ~bits
        if not new:
            continue
        low = ((new & -new).bit_length() - 1) // 8 * 8
        raw = np.frombuffer((new >> low).to_bytes((max(0, new.bit_length() - low) + 7) // 8, "little"), np.uint8)
        first[low + np.flatnonzero(np.unpackbits(raw, bitorder="little"))] = at
        bits |= new
    low = (bits & ((1 << (target + 1)) - 1)).bit_length() - 1
    above = bits >> target
    high = target + ((above & -above).bit_length() - 1) if above else None
    s = low if high is None or target - low <= high - target else high
    take = [0] * len(items)
    while s:
        i, k = steps[first[s]]
        take[i] += k
        s -= items[i][0] * k
    return take


def _by_list(items: list[tuple[int, int]], target: int, listed: int) -> list[int] | None:
    """The choice from a list of all sums up to twice the target, or None where there are more than ``listed``."""
    steps = _steps(items, 2 * target + 1)
    sums, before = np.zeros(1, np.int64), []
    for i, k in steps:
        before.append(sums)
        more = sums + items[i][0] * k
        sums = np.union1d(sums, more[more <= 2 * target + 1])
        if sum(map(len, before)) + len(sums) > listed:
            return None
    s = int(sums[np.lexsort((sums, np.abs(sums - target)))[0]])
    take = [0] * len(items)
    for (i, k), had in zip(reversed(steps), reversed(before), strict=True):
        at = np.searchsorted(had, s)
        if at == len(had) or had[at] != s:
            take[i] += k
            s -= items[i][0] * k
    return take


def fill_plan(sizes: list[tuple[int, int]], wants: Sequence[tuple[str, int]], rest: str) -> list[tuple[int, int, int, str]]:
    """(size, lo, hi, split): where the groups lo+1..hi of a size go.

    ``sizes``: (size, groups) of one stratum; ``wants``: the records each split still lacks, smallest split first.  Each is filled by
    ``closest_subset``; what is left goes to ``rest``.
    """
    own = sorted(sizes)
    used = [0] * len(own)
    rows = []
    for split, want in wants:
        # no more of a size can matter than fill what is wanted, and one
        items = [(size, min(n - u, max(0, want) // max(1, size) + 1)) for (size, n), u in zip(own, used, strict=True)]
        for i, n in enumerate(closest_subset(items, want)):
            if n:
                rows.append((own[i][0], used[i], used[i] + n, split))
                used[i] += n
    return rows + [(size, u, n, rest) for (size, n), u in zip(own, used, strict=True) if u < n]


def split_slots(groups: DataFrame, names: list[str], shares: Sequence[tuple[str, float]]) -> DataFrame:
    """(names.., group_size, lo, hi, split): where the groups numbered lo+1..hi of each class go.

    A class is a kind of group: the counts of its records by label, ``names``, and its size.  Every class gives each split but the largest its
    even share, rounded down.  What is left of the classes with one dominant label and one size is pooled; the pools fill what the
    splits of that label lack.  Only the pools come to the driver: different sizes times labels, at most the
    root of twice the number of records for each label, since k different sizes take k * (k + 1) / 2 records.
    """
    order = sorted(shares, key=lambda x: x[1])
    small, rest = order[:-1], order[-1][0]
    most = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    k = groups.groupBy(*names, "group_size").agg(F.count(F.lit(1)).alias("c")).withColumn("stratum", F.array_position(F.array(*names), most).cast("int"))
    at: Column = F.lit(0).cast("bigint")
    for i, (_, share) in enumerate(small):
        k = k.withColumn(f"e{i}", F.least(F.floor(F.col("c") * F.lit(float(share))), F.col("c") - at).cast("bigint"))
        at = at + F.col(f"e{i}")
    k = k.withColumn("given", at).withColumn("left", F.col("c") - F.col("given"))
    w = Window.partitionBy("stratum", "group_size").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    k = Scratch(groups.sparkSession, "classes").cut(k.withColumn("before", F.coalesce(F.sum("left").over(w), F.lit(0))), "classes")
    evens = [F.sum(F.col(f"e{i}") * F.col("group_size")).alias(f"e{i}") for i in range(len(small))]
    pools: dict[int, list[tuple[int, int]]] = {}
    for r in k.groupBy("stratum", "group_size").agg(F.sum("left").alias("n")).collect():
        pools.setdefault(r["stratum"], []).append((r["group_size"], r["n"]))
    rows = []
    for r in k.groupBy("stratum").agg(F.sum(F.col("c") * F.col("group_size")).alias("total"), *evens).collect():
        wants = [(name, round(r["total"] * share) - r[f"e{i}"]) for i, (name, share) in enumerate(small)]
        rows += [(r["stratum"], *x) for x in fill_plan(pools[r["stratum"]], wants, rest)]
    pooled = groups.sparkSession.createDataFrame(rows, "stratum int, group_size bigint, plo bigint, phi bigint, split string")
    even = [F.struct(sum((F.col(f"e{j}") for j in range(i)), F.lit(0).cast("bigint")).alias("lo"), sum((F.col(f"e{j}") for j in range(i + 1)), F.lit(0).cast("bigint")).alias("hi"), F.lit(name).alias("split")) for i, (name, _) in enumerate(small)]
    out = k.join(pooled, ["stratum", "group_size"]).where("plo < before + left and phi > before")
    lo, hi = F.greatest("plo", "before"), F.least("phi", F.col("before") + F.col("left"))
    out = out.select(*names, "group_size", (lo - F.col("before") + F.col("given")).alias("lo"), (hi - F.col("before") + F.col("given")).alias("hi"), "split")
    if even:
        out = out.unionByName(k.select(*names, "group_size", F.explode(F.array(*even)).alias("x")).select(*names, "group_size", "x.lo", "x.hi", "x.split"))
    return out.where("lo < hi")


def grouped_split(
    records: DataFrame,
    edges: DataFrame,
    shares: Sequence[tuple[str, float]] = (("train", 0.8), ("val", 0.1), ("test", 0.1)),
    seed: int = 63,
    labels: Sequence[str] = ("0", "1", "2"),
    components=hooking_components,
) -> DataFrame:
    """Each record with ``root``, ``group_size`` and ``split``: records linked directly or not share a split.

    ``records``: id (unique), label (NULL counts as a label of its own) and further columns, which are kept unless
    they are named like a column added here.  ``edges``:
    (u, v) over ids.  The totals of each label follow the shares as closely as whole groups allow.  What comes to the driver
    is bounded as ``split_slots`` says.  Empty tables give no rows.
    """
    spark = records.sparkSession
    scratch = Scratch(spark, "split")
    comp = components(edges)
    rest = [c for c in records.columns if c not in ("id", "label", "root", "group_size", "split")]
    records = records.select("id", "label", F.struct(F.lit(0).alias("_"), *rest).alias("__rest"))
    tagged = records.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    tagged = scratch.cut(tagged, "tagged")
    sig = [F.count_if(F.col("label") == k).alias(f"n{k}") for k in labels] + [F.count_if(~F.coalesce(F.col("label").isin(*labels), F.lit(False))).alias("n_other")]
    names = [f"n{k}" for k in labels] + ["n_other"]
    groups = tagged.groupBy("root").agg(*sig, F.count(F.lit(1)).alias("group_size")).withColumn("u", unit_hash("root", seed=seed))
    groups = scratch.cut(groups, "groups")
    cuts = split_slots(groups, names, shares)
    ranked = spread_row_number(groups, [*names, "group_size"], ["root"], "rank", u="u")
    same = [ranked[n] == cuts[n] for n in [*names, "group_size"]]
    cond = (ranked["rank"] > cuts["lo"]) & (ranked["rank"] <= cuts["hi"])
    for s in same:
        cond = cond & s
    chosen = ranked.join(cuts, cond).select(ranked["root"], ranked["group_size"], "split")
    return tagged.join(chosen, "root").select("id", "label", *[F.col(f"__rest.`{c}`").alias(c) for c in rest], "root", "group_size", "split")


def object_edges(records: DataFrame) -> DataFrame:
    """(u, v): from each record to a vertex for the object its ``entity`` names; none for a NULL entity."""
    return records.where("entity is not null").select(F.col("id").alias("u"), F.xxhash64(F.lit("object"), "entity").alias("v"))


def manifest_images(spark: SparkSession, folder: str) -> DataFrame:
    """(id, path, label, entity) of each known image of ``manifest_clean``; of repeated rows the least readable label holds."""
    known = known_images(table(spark, folder, "image_audit"))
    m = table(spark, folder, "manifest_clean").select(image_id(F.col("path")).alias("id"), class_label(F.col("current_label")).alias("label"))
    m = m.where("id is not null").groupBy("id").agg(F.min("label").alias("label"))
    return m.join(known, "id").select("id", "path", "label", object_entity(F.col("path")).alias("entity"))


def split_images(spark: SparkSession, folder: str) -> DataFrame:
    records = Scratch(spark, "manifest").cut(manifest_images(spark, folder), "images")
    return grouped_split(records, object_edges(records))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return split_images(spark, folder).where("group_size > 1 and entity is not null").select("path", "entity")


def p1_splits(spark: SparkSession, folder: str) -> DataFrame:
    """The split of every image of the manifest."""
    return split_images(spark, folder).select("path", "label", "split")


def p1_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Images and objects of each label and split."""
    s = split_images(spark, folder)
    return s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("images"), F.count_distinct("root").alias("objects"))


def p1_check(spark: SparkSession, folder: str, shares: Sequence[tuple[str, float]] = (("train", 0.8), ("val", 0.1), ("test", 0.1))) -> DataFrame:
    """(label, images, broken, near) of the split: images of each label, objects of them in several splits, and whether each split's images differ
    from its share by no more than the largest group's."""
    s = Scratch(spark, "check").cut(split_images(spark, folder).select("label", "split", "root", "group_size"), "split")
    broken = s.groupBy("root").agg(F.count_distinct("split").alias("k")).where("k > 1").select("root", F.lit(1).alias("bad"))
    largest = s.agg(F.max("group_size").alias("largest"))
    n = s.join(broken, "root", "left").groupBy("label").agg(F.count(F.lit(1)).alias("images"), F.count("bad").alias("broken"), *[F.count_if(F.col("split") == k).alias(k) for k, _ in shares])
    near = F.lit(True)
    for k, share in shares:
        near = near & (F.abs(F.col(k) - F.col("images") * share) <= F.col("largest"))
    return n.crossJoin(largest).select(F.coalesce("label", F.lit("none")).alias("label"), "images", "broken", near.alias("near"))  # one row
