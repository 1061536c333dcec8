"""Best representative of each duplicate group, field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dirt import class_label, is_blank, positive_number, source_code
from ..scratch import Scratch
from .graph import seed_tree_components
from .groups import match_groups
from .images import image_id, pair_edges, table


def latest_rows(df: DataFrame, key: str, stamp: str, columns: list[str]) -> DataFrame:
    """One row a key: that with the greatest stamp, of equal stamps the greatest values in the order of
    ``columns``.  A NULL stamp counts as the oldest."""
    s = F.max(F.struct(F.col(stamp).alias("__stamp"), *[F.col(c) for c in columns]))
    return df.groupBy(key).agg(s.alias("s")).select(key, F.col("s.__stamp").alias(stamp), *[F.col(f"s.{c}").alias(c) for c in columns])


def survivorship(members: DataFrame, group: str, fields: dict[str, tuple[Column, list[Column], list[Column]]]) -> DataFrame:
    """One row a group, with a struct ``(qualifies, ..priorities.., ..values..)`` for each field, by one aggregation.

    ``fields`` maps a name to (does the member qualify, priorities from the first, values to keep).  The
    member with the greatest composite wins; a member that doesn't qualify never beats one that does, and a
    group without any that does has NULL there.
    """
    aggs = []
    for name, (ok, prio, values) in fields.items():
        ok = F.coalesce(ok, F.lit(False))
        parts = [ok.alias("qualifies"), *[p.alias(f"k{i}") for i, p in enumerate(prio)], *[v.alias(f"v{i}") for i, v in enumerate(values)]]
        aggs.append(F.max(F.when(ok, F.struct(*parts))).alias(name))
    return members.groupBy(group).agg(*aggs)


def review_members(spark: SparkSession, folder: str) -> DataFrame:
    """Each image of a review group with its most recent audit row."""
    scratch = Scratch(spark, "survivors")
    acts = table(spark, folder, "duplicate_review_actions")
    edges = scratch.cut(pair_edges(acts, "keep_path", "remove_path").distinct(), "edges")
    audit = table(spark, folder, "image_audit").withColumn("id", image_id(F.col("path")))
    ends = edges.select(F.col("u").alias("id")).union(edges.select(F.col("v").alias("id"))).distinct()
    cols = ["path", "width", "height", "current_label", "capture_source", "error"]
    rows = scratch.cut(latest_rows(audit.join(ends, "id", "left_semi"), "id", "audited_at", cols), "rows")
    known = rows.select("id", "path")
    edges = edges.join(known.select(F.col("id").alias("u")), "u", "left_semi").join(known.select(F.col("id").alias("v")), "v", "left_semi")
    groups = match_groups(known, edges)
    return groups.select("id", "root", "group_path", "group_size").join(rows, "id")


def survivors(members: DataFrame, trust: dict[str, int] | None = None) -> DataFrame:
    """One row a group: the values that survive and the member each came from.

    ``trust`` ranks capture sources: of two members whose value can be read, that of the source with the greater number
    wins before anything else is compared; a source not named, or unreadable, counts 0.  Without it all sources are equal.

    Size: the largest area of unfailed audits with two positive sizes, of equal areas the one audited
    last.  Label and source: the member audited last whose value can be read.  Ties beyond that go to the
    greatest path.  NULL where no member qualifies.
    """
    w, h = positive_number(F.col("width")), positive_number(F.col("height"))
    label, source = class_label(F.col("current_label")), source_code(F.col("capture_source"))
    at, path = F.col("audited_at"), F.col("path")
    rank = F.lit(0)
    if trust:
        rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in trust.items() for x in kv]), source), F.lit(0))
    m = survivorship(
        members,
        "group_path",
        {
            "size": (is_blank(F.col("error")) & w.isNotNull() & h.isNotNull(), [rank, w * h, at], [path, w, h]),
            "label": (label.isNotNull(), [rank, at], [path, label]),
            "source": (source.isNotNull(), [rank, at], [path, source]),
        },
    )
    return m.select(
        "group_path",
        F.col("size.v0").alias("size_path"), F.col("size.v1").alias("width"), F.col("size.v2").alias("height"),
        F.col("label.v0").alias("label_path"), F.col("label.v1").alias("label"),
        F.col("source.v0").alias("source_path"), F.col("source.v1").alias("source"),
    )


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    s = survivors(review_members(spark, folder))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"{f}_path").alias("path")) for f in ("size", "label", "source")]))
    return s.select("group_path", each.alias("x")).select("group_path", "x.field_name", "x.path").where("path is not null")


def p3_survivors(spark: SparkSession, folder: str) -> DataFrame:
    """One surviving record for each review group."""
    return survivors(review_members(spark, folder)).select("group_path", "width", "height", "label", "source")
