"""Row numbers over groups of any size, without one task holding a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unit_hash(*cols: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns and the seed only."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in cols])
    return (F.shiftrightunsigned(h, 11)).cast("double") / F.lit(float(1 << 53))


def spread_row_number(
    df: DataFrame, group: list[str], order: list[str], out: str, rows_per_task: int = 50_000, u: str = "__u", sizes: DataFrame | None = None
) -> DataFrame:
    """``row_number()`` of each row in its group, in the order of column ``u`` in [0, 1), ties by ``order``.

    A group is cut into ranges of ``u`` of about ``rows_per_task`` rows; each range is numbered by
    itself and moved up by the rows of the ranges before it.  The numbers are the same as those of one
    window over the whole group.  The table of ranges has one row for each ``rows_per_task`` rows and
    group, and is joined without a broadcast hint.
    """
    n = sizes if sizes is not None else df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    n = n.withColumn("__k", F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(rows_per_task))))
    same = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    cut = (
        df.alias("a").join(n.alias("b"), cond).select("a.*", "b.__k").withColumn("__r", F.floor(F.col(u) * F.col("__k")).cast("int"))
    )
    counts = cut.groupBy(*group, "__r").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*group).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__c").over(w), F.lit(0))).drop("__c")
    numbered = cut.withColumn("__i", F.row_number().over(Window.partitionBy(*group, "__r").orderBy(u, *order)))
    cond2 = F.col("a.__r") == F.col("b.__r")
    for g in group:
        cond2 = cond2 & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    keep = [c for c in df.columns]
    return (
        numbered.alias("a").join(counts.alias("b"), cond2).select(*[F.col(f"a.{c}") for c in keep], (F.col("a.__i") + F.col("b.__before")).cast("bigint").alias(out))
    )
