"""Filling containers of fixed capacity with items of varying length."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranking import spread_row_number, unit_hash
from ..scratch import Scratch
from .bpe import token_counts, vocabulary_path
from .images import table


#: Numbers of one size that make one key when items are joined with their places.
BLOCK = 50_000


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, tuple[int, ...]]], dict[int, int]]:
    """Containers fixed by dominance, and the sizes that are left.

    For the largest size j: if no other item fits beside it, it is alone; if the largest that fits fills the
    container, or only one more can fit at all, or at most two more can and no two fill more than the
    largest one does, then j with that one dominates every other container of j.  Otherwise j is left.
    ``counts`` maps size to number.  What fits beside j only gets less as items go, so a dominance that holds once holds until j or
    its partner runs out: all those containers are fixed at once.  Each step uses up a size, or all but one item of it, so
    there are at most twice as many entries as sizes, however many items.
    """
    left = {s: n for s, n in counts.items() if n > 0 and s > 0}
    present = sorted(left)
    fixed: list[tuple[int, tuple[int, ...]]] = []

    def gone(size: int) -> None:
        if not left[size]:
            del present[bisect_left(present, size)]

    for j in sorted(left, reverse=True):
        while left[j]:
            room = capacity - j
            alone = left[j] == 1  # then no second item of size j fits beside it
            fit = present[: bisect_right(present, room)]
            if alone and fit and fit[-1] == j:
                fit.pop()
            if not fit:
                fixed.append((left[j], (j,)))
                left[j] = 0
                gone(j)
                break
            best = fit[-1]
            small: list[int] = []
            for s in fit[:3]:
                small += [s] * min(3 - len(small), left[s] - (s == j))
            most = 0
            while most < len(small) and sum(small[: most + 1]) <= room:
                most += 1
            ok = best == room or most == 1
            if not ok and most == 2:
                lo, hi, two = 0, len(fit) - 1, 0
                while lo <= hi:
                    if lo == hi and left[fit[lo]] - (fit[lo] == j) < 2:
                        break
                    total = fit[lo] + fit[hi]
                    if total <= room:
                        two = max(two, total)
                        lo += 1
                    else:
                        hi -= 1
                ok = two <= best
            if not ok:
                break
            n = left[j] // 2 if best == j else min(left[j], left[best])
            fixed.append((n, (j, best)))
            left[j] -= n
            left[best] -= n
            gone(j)
            if best != j:
                gone(best)
    return fixed, {s: n for s, n in left.items() if n}


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """(containers, ((size, items in each), ..)): best fit, largest sizes first, on numbers of equal items.

    Containers with equal contents are one entry.  The items of a size go to the fullest containers that still hold
    them, as many to each as fit.  Each size splits at most one entry in three.
    """
    room: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = defaultdict(list)
    for size in sorted(counts, reverse=True):
        many = counts[size]
        for r in sorted(x for x in room if x >= size and room[x]):
            if not many:
                break
            entries, room[r] = room[r], []
            each = r // size
            for n, held in entries:
                full = min(n, many // each)
                rest = min(each - 1, many - full * each) if n > full else 0
                if full:
                    room[r - each * size].append((full, (*held, (size, each))))
                if rest:
                    room[r - rest * size].append((1, (*held, (size, rest))))
                if n - full - bool(rest):
                    room[r].append((n - full - bool(rest), held))
                many -= full * each + rest
        if many:
            each = capacity // size
            if many // each:
                room[capacity - each * size].append((many // each, ((size, each),)))
            if many % each:
                room[capacity - many % each * size].append((1, ((size, many % each),)))
    return [e for r in sorted(room) for e in room[r]]


def pack_sizes(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """(containers, contents) of all items; no size is above the capacity."""
    fixed, left = reduce_dominated(counts, capacity)
    plan = []
    for n, held in fixed:
        each: dict[int, int] = defaultdict(int)
        for s in held:
            each[s] += 1
        plan.append((n, tuple(each.items())))
    return plan + best_fit(left, capacity)


def slots(plan: list[tuple[int, tuple[tuple[int, int], ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(size, lo, hi, first container, items of the size in each): where the items numbered lo+1..hi of a size go."""
    out, used, first = [], defaultdict(int), 0
    for n, held in plan:
        for size, each in held:
            out.append((size, used[size], used[size] + n * each, first, each))
            used[size] += n * each
        first += n
    return out


def fill_containers(items: DataFrame, runs: list[tuple[str, int]]) -> DataFrame:
    """(run_name, item, piece, tokens, container): every item in a container of each run.

    ``items``: (item bigint unique, n_tokens).  An item above the capacity is cut into full containers of its own and one
    rest, which is packed like any item; no other is cut.  NULL and 0 tokens take no room and go to container 0.
    The numbers of items of each size come to the driver: at most ``capacity`` sizes a run, however many items.
    """
    spark = items.sparkSession
    scratch = Scratch(spark, "packing")
    items = scratch.cut(items.select("item", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens")), "items")
    outs = []
    for run, capacity in runs:
        if capacity is None or capacity < 1:
            raise ValueError("a container holds at least one token")
        cap = F.lit(int(capacity))
        rest = items.select("item", F.when(F.col("n_tokens") > cap, F.col("n_tokens") % cap).otherwise(F.col("n_tokens")).alias("size"), F.when(F.col("n_tokens") > cap, F.floor(F.col("n_tokens") / cap)).otherwise(F.lit(0)).cast("bigint").alias("fulls"))
        counts = rest.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
        have = {r["size"]: r["n"] for r in counts.collect()}
        plan = pack_sizes({s: n for s, n in have.items() if s > 0}, capacity)
        shared = sum(n for n, _ in plan)
        where = spark.createDataFrame(slots(plan) or [(-1, 0, 0, 0, 1)], "size bigint, lo bigint, hi bigint, first bigint, each bigint")
        small = rest.where("size > 0").withColumn("u", unit_hash("item", seed=9))
        ranked = spread_row_number(small, ["size"], ["item"], "k", u="u", sizes=counts.withColumnRenamed("n", "__n"))
        # both sides are cut into blocks of numbers, so that no size, however frequent, is one key of the join
        block = lambda c: F.floor(c / F.lit(BLOCK))
        where = where.withColumn("block", F.explode(F.sequence(block(F.col("lo")), block(F.greatest(F.col("lo"), F.col("hi") - 1)))))
        same = (ranked["size"] == where["size"]) & (block(ranked["k"] - 1) == where["block"]) & (ranked["k"] > where["lo"]) & (ranked["k"] <= where["hi"])
        placed = ranked.join(where, same).select("item", F.col("fulls").alias("piece"), ranked["size"].alias("tokens"), (F.col("first") + F.floor((F.col("k") - 1 - F.col("lo")) / F.col("each"))).cast("bigint").alias("container"))
        empty = rest.where("size = 0 and fulls = 0").select("item", F.lit(0).cast("bigint").alias("piece"), F.lit(0).cast("bigint").alias("tokens"), F.lit(0).cast("bigint").alias("container"))
        cut = rest.where("fulls > 0").withColumn("u", unit_hash("item", seed=9)).withColumn("one", F.lit(1))
        # full containers are numbered item by item; their order is that of the items' hashes
        wide = spread_row_number(cut, ["fulls"], ["item"], "k", u="u")
        before = wide.groupBy("fulls").agg((F.count(F.lit(1)) * F.col("fulls")).alias("c"))
        w = Window.orderBy("fulls").rowsBetween(Window.unboundedPreceding, -1)  # one row for each number of full containers an item takes
        base = before.select("fulls", (F.lit(shared) + F.coalesce(F.sum("c").over(w), F.lit(0))).alias("base"))
        whole = wide.join(base, "fulls").select("item", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("fulls") - 1)).alias("piece"), "fulls", "k", "base")
        whole = whole.select("item", "piece", cap.cast("bigint").alias("tokens"), (F.col("base") + (F.col("k") - 1) * F.col("fulls") + F.col("piece")).alias("container"))
        outs.append(placed.union(empty).union(whole).select(F.lit(run).alias("run_name"), "item", "piece", "tokens", "container"))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    runs = table(spark, folder, "container_sizes").select("run_name", "tokenizer", "capacity_tokens").distinct().orderBy("run_name").collect()
    scratch = Scratch(spark, "tokens")
    counts: dict[str, DataFrame] = {}
    outs = None
    for r in runs:
        if r["tokenizer"] not in counts:
            n = token_counts(table(spark, folder, "documents"), "doc_id", "text", vocabulary_path(r["tokenizer"]))
            counts[r["tokenizer"]] = scratch.cut(n, "tokens")
        own = fill_containers(counts[r["tokenizer"]].withColumnRenamed("doc_id", "item"), [(r["run_name"], r["capacity_tokens"])])
        outs = own if outs is None else outs.unionByName(own)
    if outs is None:
        return spark.createDataFrame([], "run_name string, doc_id bigint, piece bigint, tokens bigint, container bigint")
    return outs.withColumnRenamed("item", "doc_id")


def p9_usage(spark: SparkSession, folder: str) -> DataFrame:
    """Containers, tokens and share of unused space of each run."""
    size = table(spark, folder, "container_sizes").select("run_name", "capacity_tokens").distinct()
    used = p9_containers(spark, folder).groupBy("run_name").agg(F.count_distinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    return used.join(size, "run_name").select("run_name", "containers", "tokens", F.round(1 - F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("unused"))


def p9_check(spark: SparkSession, folder: str) -> DataFrame:
    """(run_name, documents, overfull, divided, broken, near) of each run: its documents; containers above the capacity; documents divided though
    they fit, or whose pieces don't follow each other from 0; and whether there are at most 2 % and one container more than the tokens fill."""
    size = table(spark, folder, "container_sizes").select("run_name", "capacity_tokens").distinct()
    rows = Scratch(spark, "check").cut(p9_containers(spark, folder), "rows")
    docs = rows.groupBy("run_name", "doc_id").agg(F.sum("tokens").alias("n"), F.count(F.lit(1)).alias("pieces"), F.max("piece").alias("last")).join(size, "run_name")
    d = docs.groupBy("run_name").agg(F.count(F.lit(1)).alias("documents"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= F.col("capacity_tokens"))).alias("divided"), F.count_if(F.col("last") + 1 != F.col("pieces")).alias("broken"))
    boxes = rows.groupBy("run_name", "container").agg(F.sum("tokens").alias("n")).join(size, "run_name")
    c = boxes.groupBy("run_name").agg(F.count_if(F.col("n") > F.col("capacity_tokens")).alias("overfull"), F.count(F.lit(1)).alias("boxes"), F.sum("n").alias("n"), F.first("capacity_tokens").alias("cap"))
    near = F.col("boxes") <= F.ceil(F.col("n") / F.col("cap")) * 1.02 + 1
    return d.join(c, "run_name").select("run_name", "documents", "overfull", "divided", "broken", near.alias("near"))
