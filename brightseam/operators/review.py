"""Review decisions: validation, manifests, and the duplicate-review chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import ContractError
from ..functions.dirt import is_blank, strip
from ..functions.scalars import action_columns, padded_id, safe_name
from ..schemas import LABELS, MANIFEST
from .components import number_by


def union_batches(batches: list[tuple[str, DataFrame]], columns: list[str]) -> DataFrame:
    """Rows of all batches in the declared order (``file_idx``), projected to ``columns``."""
    out = None
    for i, (name, df) in enumerate(batches):
        part = df.select(F.lit(i).alias("file_idx"), F.lit(name).alias("file"), *columns)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ContractError("no batches", [])
    return out


def batch_count_errors(merged: DataFrame, expected: DataFrame) -> DataFrame:
    """(file, expected, found) of each batch whose row count is not the expected one; a missing batch counts 0."""
    got = merged.groupBy("file").agg(F.count(F.lit(1)).alias("found"))
    return expected.join(got, "file", "left").select("file", "expected", F.coalesce("found", F.lit(0)).cast("bigint").alias("found")).where("expected <> found")


def review_errors(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """(rule, path, n): every finding of the review contract.  Text is compared without outer white space.

    Rules: blank_path, bad_status, duplicate_path, unknown_path (not in the listing), unreviewed_path (listed, not
    reviewed), missing_reason (a warning: removed or unsure without a reason).
    """
    r = rows.select(strip(F.col("path")).alias("path"), strip(F.col("review_status")).alias("status"), F.col("reason"))
    files = listing.select("path").distinct()
    named = r.where(F.coalesce("path", F.lit("")) != "").groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    one = F.lit(1).cast("bigint").alias("n")
    return (
        r.where(is_blank(F.col("path"))).groupBy(F.lit("blank_path").alias("rule"), F.lit("").alias("path")).agg(F.count(F.lit(1)).alias("n"))
        .unionByName(r.where(~F.coalesce(F.col("status").isin("0", "1", "2"), F.lit(False))).groupBy(F.lit("bad_status").alias("rule"), F.coalesce("path", F.lit("")).alias("path")).agg(F.count(F.lit(1)).alias("n")))
        .unionByName(named.where("n > 1").select(F.lit("duplicate_path").alias("rule"), "path", "n"))
        .unionByName(named.join(files, "path", "left_anti").select(F.lit("unknown_path").alias("rule"), "path", one))
        .unionByName(files.join(named, "path", "left_anti").select(F.lit("unreviewed_path").alias("rule"), "path", one))
        .unionByName(r.where(F.col("status").isin("1", "2") & is_blank(F.col("reason"))).groupBy(F.lit("missing_reason").alias("rule"), F.coalesce("path", F.lit("")).alias("path")).agg(F.count(F.lit(1)).alias("n")))
    )


def require_no_errors(errors: DataFrame, title: str, warnings: tuple[str, ...] = ("missing_reason",), show: int = 20) -> None:
    """Raise with counts by rule and a few examples; at most ``show`` rows of each rule come to the driver."""
    fatal = errors.where(~F.col("rule").isin(*warnings))
    w = Window.partitionBy("rule").orderBy("path")
    rows = fatal.withColumn("i", F.row_number().over(w)).where(F.col("i") <= show).orderBy("rule", "i").collect()
    if rows:
        raise ContractError(title, [f"{r['rule']}: {r['path']}" for r in rows])


def apply_overrides(rows: DataFrame, overrides: DataFrame) -> DataFrame:
    """Rows with status and reason replaced where ``overrides`` (path, review_status, reason) names the path."""
    o = overrides.select("path", F.col("review_status").alias("o_status"), F.col("reason").alias("o_reason"))
    j = rows.join(o, "path", "left")  # a blank status leaves the row as it is
    j = j.withColumn("o_status", F.nullif("o_status", F.lit(""))).withColumn("o_reason", F.when(F.col("o_status").isNotNull(), F.col("o_reason")))
    return j.withColumn("review_status", F.coalesce("o_status", "review_status")).withColumn("reason", F.coalesce("o_reason", "reason")).select(*rows.columns)


def status_manifest(rows: DataFrame, kind: str) -> DataFrame:
    """The keep (0 and 2), remove (1) or unsure (2) manifest, by status without outer white space."""
    wanted = {"keep": ["0", "2"], "remove": ["1"], "unsure": ["2"]}[kind]
    rest = [c for c in rows.columns if c in ("file_idx", "_ord")]
    return rows.where(strip(F.col("review_status")).isin(*wanted)).select(*MANIFEST, *rest)


def manifest_violations(rows: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """(rule, n): how many findings break the manifest contract: repeated paths, labels outside the classes, and
    paths not listed."""
    dup = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit("duplicate_path").alias("rule"), "n")
    bad = rows.where(~F.coalesce(F.col("current_label").isin(*LABELS), F.lit(False))).agg(F.count(F.lit(1)).alias("n")).select(F.lit("bad_label").alias("rule"), "n")
    out = dup.unionByName(bad)
    if listing is not None:
        gone = rows.join(listing.select("path").distinct(), "path", "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("missing_file").alias("rule"), "n")
        out = out.unionByName(gone)
    return out


#: Fixed values of the review contract: where folders lie, and what the reviewer is told.
REVIEW_ROOT = "duplicate_review"
GUIDE = "a=keep A remove B; b=keep B remove A; both=keep both same split; ignore=false positive"


def exact_folders(exact: DataFrame, order: list[str]) -> DataFrame:
    """(folder, type, path_a, path_b, members) of each group, numbered in the given order, which is that of the file; the
    first two members are the pair, NULL where there is none."""
    e = number_by(exact, order, "i").withColumn("m", F.split("paths", r"\|"))
    folder = F.concat(F.lit(f"{REVIEW_ROOT}/exact/"), padded_id("exact_", F.col("i"), 4))
    return e.select(folder.alias("folder"), F.lit("exact").alias("type"), F.get("m", F.lit(0)).alias("path_a"), F.get("m", F.lit(1)).alias("path_b"), F.size("m").alias("members"))


def near_folders(pairs: DataFrame, order: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """(folder, type, path_a, path_b, members, columns to ``keep``) of each near pair, numbered by kind in the given order, which is that of the file."""
    kind = F.when(F.col("cross_label") == "True", "near_cross").otherwise("near_same")
    p = number_by(pairs.withColumn("type", kind), ["type", *order], "i")
    first = p.groupBy("type").agg(F.min("i").alias("first"))
    p = p.join(F.broadcast(first), "type").withColumn("i", F.col("i") - F.col("first") + 1)  # two kinds
    folder = F.concat(F.lit(f"{REVIEW_ROOT}/"), F.col("type"), F.lit("/"), F.format_string("%s_%04d", "type", "i"))
    return p.select(folder.alias("folder"), "type", "path_a", "path_b", F.lit(2).alias("members"), *keep)


def review_queue(folders: DataFrame) -> DataFrame:
    """Rows for the reviewer: folder, blank decision, guide, notes (the type)."""
    return folders.select("folder", F.lit("").alias("decision"), F.lit(GUIDE).alias("guide"), F.col("type").alias("notes"))


def review_copies(exact: DataFrame, pairs: DataFrame, order: list[str]) -> DataFrame:
    """(path, name): each image to be copied for the reviewer and the file it becomes below the review's root: all members of an exact
    group as sides a, b, c.. with the label ``same``, both images of a near pair with their labels."""
    e = number_by(exact, order, "i").select(padded_id("exact_", F.col("i"), 4).alias("id"), F.posexplode(F.split("paths", r"\|")).alias("pos", "path"))
    e = e.select("path", F.concat(F.lit("exact/"), F.col("id"), F.lit("/"), safe_name(F.col("path"), F.lit("same"), F.char(F.col("pos") + 97))).alias("name"))
    p = near_folders(pairs, order, ("label_a", "label_b")).withColumn("f", F.substring_index("folder", "/", -2))
    sides = [F.struct(F.col(f"path_{x}").alias("path"), F.concat(F.col("f"), F.lit("/"), safe_name(F.col(f"path_{x}"), F.col(f"label_{x}"), F.lit(x))).alias("name")) for x in "ab"]
    return e.unionByName(p.select(F.explode(F.array(*sides)).alias("x")).select("x.path", "x.name"))


def duplicate_actions(decisions: DataFrame, folders: DataFrame) -> DataFrame:
    """Actions of the decided folders, with further columns of ``decisions``; decisions are compared without outer white space,
    unknown folders are left out (see ``unknown_folders``)."""
    rest = [c for c in decisions.columns if c not in ("folder", "decision")]
    j = decisions.select("folder", strip(F.col("decision")).alias("decision"), *rest).join(folders.select("folder", "type", "path_a", "path_b"), "folder")
    return j.select("folder", "type", "decision", *action_columns(F.col("decision"), F.col("path_a"), F.col("path_b")), *rest)


def unknown_folders(decisions: DataFrame, folders: DataFrame) -> DataFrame:
    return decisions.select("folder").distinct().join(folders, "folder", "left_anti")


def missing_folders(decisions: DataFrame, folders: DataFrame) -> DataFrame:
    return folders.select("folder").distinct().join(decisions, "folder", "left_anti")


def last_removal(actions: DataFrame, order: str = "_ord") -> DataFrame:
    """One action a removed path: the last row that removes it."""
    a = actions.where(F.coalesce("remove_path", F.lit("")) != "")
    return a.groupBy(F.col("remove_path").alias("path")).agg(F.max_by("folder", order).alias("source_folder"), F.max_by("decision", order).alias("decision"))


def clean_manifest(kept: DataFrame, actions: DataFrame) -> DataFrame:
    gone = actions.where(F.coalesce("remove_path", F.lit("")) != "").select(F.col("remove_path").alias("path")).distinct()
    return kept.join(gone, "path", "left_anti").select(*kept.columns)


def removed_manifest(kept: DataFrame, actions: DataFrame, order: str = "_ord", reason: str = "removed_by_duplicate_review") -> DataFrame:
    """The removed rows with their last action, and ``_ord`` where the manifest has it."""
    j = kept.join(last_removal(actions, order), "path")
    rest = [c for c in kept.columns if c == "_ord"]
    return j.select("path", F.col("current_label").alias("label"), "class_name", "source_folder", "decision", F.lit(reason).alias("reason"), *rest)


def group_pairs(actions: DataFrame, reason: str = "duplicate_review_both") -> DataFrame:
    """The pair of each action that keeps both."""
    m = actions.where(F.coalesce("group_paths", F.lit("")) != "").withColumn("m", F.split("group_paths", r"\|"))
    rest = [c for c in actions.columns if c == "_ord"]
    return m.select(F.col("folder").alias("source_folder"), F.get("m", F.lit(0)).alias("path_a"), F.get("m", F.lit(1)).alias("path_b"), F.lit(reason).alias("reason"), *rest)


def actions_summary(actions: DataFrame) -> DataFrame:
    """Counts by type and decision, with removals and grouped pairs."""
    return actions.groupBy("type", "decision").agg(
        F.count(F.lit(1)).alias("actions"), F.count_distinct(F.when(F.col("remove_path") != "", F.col("remove_path"))).alias("removed_paths"), F.count_if(F.coalesce("group_paths", F.lit("")) != "").alias("grouped")
    )
