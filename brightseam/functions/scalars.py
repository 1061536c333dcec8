"""Scalar expressions of the curation pipeline.  All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_list(c: Column) -> Column:
    """Members of a pipe-joined cell, without blanks."""
    return F.filter(F.split(c, r"\|"), lambda x: x != "")


def join_list(a: Column) -> Column:
    return F.array_join(a, "|")


def ordered_list(value: Column, order: Column) -> Column:
    """Aggregate: a pipe-joined cell of the values in the given order."""
    return join_list(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"]))


def padded_id(prefix: str, n: Column, width: int) -> Column:
    """``G00012``; a number wider than ``width`` is kept whole."""
    return F.format_string(f"{prefix}%0{width}d", n)


def cluster_id(n: Column, k: int) -> Column:
    return padded_id("C", n, max(2, len(str(k - 1))))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def safe_name(path: Column, label: Column, side: Column) -> Column:
    """File name of an image in a review folder."""
    return F.concat(side, F.lit("__label_"), label, F.lit("__"), basename(path))


def ratio6(w: Column, h: Column) -> Column:
    """w / h, half to even at 6 places; NULL where h is 0."""
    return F.bround(w / F.nullif(h.cast("double"), F.lit(0.0)), 6)


def fixed6(x: Column) -> Column:
    """Text with 6 places; ``nan`` for NaN, empty for NULL."""
    return F.when(x.isNull(), "").when(F.isnan(x), "nan").otherwise(F.format_string("%.6f", F.bround(x, 6)))


def bankers_target(n: Column, share: float) -> Column:
    """n times the share, half to even."""
    return F.bround(n.cast("double") * F.lit(share), 0).cast("bigint")


def bits(hex16: Column) -> Column:
    """A 64-bit hash written as 16 hex digits, as a signed bigint."""
    return F.conv(hex16, 16, -10).cast("bigint")


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two bigints."""
    return F.bit_count(a.bitwiseXOR(b))


def unit_draw(seed: int | str, key: Column) -> Column:
    """A number in [0, 1) from the SHA-256 of ``seed:key``; equal on every engine."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(4503599627370496.0)


def python_bool(b: Column) -> Column:
    return F.when(b, "True").otherwise("False")


def coverage_note(train_share: Column, val_share: Column, val_count: Column) -> Column:
    return (
        F.when(val_count == 0, "missing_in_val")
        .when(val_share < train_share * 0.5, "underrepresented_in_val")
        .when((train_share > 0) & (val_share > train_share * 2.0), "overrepresented_in_val")
        .otherwise("ok")
    )


def action_columns(decision: Column, a: Column, b: Column) -> list[Column]:
    """keep_path, remove_path and group_paths of a review decision; an unknown decision ends the job."""
    known = decision.isin("a", "b", "both", "ignore")
    keep = F.when(decision == "a", a).when(decision == "b", b).when(known, "").otherwise(F.raise_error(F.concat(F.lit("unknown decision: "), decision)))
    return [
        keep.alias("keep_path"),
        F.when(decision == "a", b).when(decision == "b", a).otherwise("").alias("remove_path"),
        F.when(decision == "both", F.concat_ws("|", a, b)).otherwise("").alias("group_paths"),
    ]


def l2_unit(v: Column) -> Column:
    """A vector of length 1; a zero vector stays."""
    n = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: x.cast("double") / F.when(n == 0, 1.0).otherwise(n))
