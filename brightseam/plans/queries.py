"""Registered queries over the test tables, each with the SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dirt import class_label, strip, whole_number
from ..functions.scalars import basename, fixed6, hamming, l2_unit, bits
from ..operators import audit, cluster, components, embed, neardup, reports, review, split
from ..schemas import LABELS, UNREADABLE
from ..scratch import Scratch
from . import sql

Query = Callable[[SparkSession, str], DataFrame]
VAL_SHARE, SEED, CENTROIDS = 0.2, 63, 8
#: Images without a readable label are split as a class of their own.
SPLIT_LABELS = [*LABELS, UNREADABLE]


def t(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ordered(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with ``_ord``, the place of each row: file, then row of the file."""
    return t(spark, folder, name).select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("_ord"))


# ---- stand-ins, each the same as its text in sql.py ----


def manifest(spark, folder):
    """One row a path, as the split asks for: that of the least image_id, whatever its label."""
    m = t(spark, folder, "manifest_clean").where("path is not null")
    s = F.min(F.struct(F.col("image_id").cast("bigint").alias("id"), "current_label", "class_name", "review_status", "reason")).alias("s")
    return m.groupBy("path").agg(s).select(F.col("s.id").cast("string").alias("image_id"), "path", "s.current_label", "s.class_name", "s.review_status", "s.reason")


def labelled(spark, folder):
    """The whole manifest with labels 0, 1, 2 by number or name, or UNREADABLE."""
    return manifest(spark, folder).withColumn("current_label", F.coalesce(class_label(F.col("current_label")), F.lit(UNREADABLE)))


def overridden(spark, folder):
    """Rows of the manifest with the status that review actions give their path."""
    gone = review.last_removal(ordered(spark, folder, "duplicate_review_actions")).select("path", F.lit("1").alias("review_status"), F.concat(F.lit("see "), "source_folder").alias("reason"))
    return review.apply_overrides(t(spark, folder, "manifest_clean"), gone)


def vectors_plus(spark, folder):
    v = t(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    last = F.concat(F.slice("embedding", 1, F.lit(63)), F.array(-F.get("embedding", F.lit(63))))
    return v.unionByName(v.where("vec_id % 10 = 0").select((F.col("vec_id") + 1000000).alias("vec_id"), last.alias("embedding"), "label"))


def signatures(spark, folder):
    v = vectors_plus(spark, folder)
    return neardup.vector_signatures(v, "vec_id", "embedding").join(v.select("vec_id", "label"), "vec_id")


def items(spark, folder):
    s = signatures(spark, folder)
    return s.select(F.col("vec_id").alias("ord"), F.col("vec_id").cast("string").alias("path"), (F.col("label") % 3).cast("string").alias("label"), F.lit("c").alias("class_name"), F.col("vec_id").cast("string").alias("sha256"), "phash", "dhash", "whash")


def folders(spark, folder):
    e = review.exact_folders(ordered(spark, folder, "exact_duplicates"), ["_ord"])
    return e.unionByName(review.near_folders(ordered(spark, folder, "near_duplicate_pairs"), ["_ord"]))


def decided(spark, folder):
    """(folders, decisions of most of them); the folders are stored, since both are built on them."""
    f = Scratch(spark, "folders").cut(folders(spark, folder), "folders")
    n = f.select("folder", F.regexp_extract("folder", r"(\d+)$", 1).cast("bigint").alias("n")).where("n % 17 <> 0")
    d = F.when(F.col("n") % 4 == 0, "a").when(F.col("n") % 4 == 1, " b ").when(F.col("n") % 4 == 2, "both").otherwise("ignore")
    return f, n.select("folder", d.alias("decision"))


def edges(spark, folder):
    m = manifest(spark, folder)
    e = components.exact_edges(t(spark, folder, "exact_duplicates"), m)
    return e.unionByName(components.retained(components.pair_edges(t(spark, folder, "dedup_group_pairs")), m)).distinct()


def grouped(spark, folder):
    scratch = Scratch(spark, "edges")
    return components.component_groups(labelled(spark, folder), scratch.cut(edges(spark, folder), "edges"), SPLIT_LABELS)


def centroids(spark, folder) -> np.ndarray:
    """The vectors of the CENTROIDS least ids."""
    rows = t(spark, folder, "embeddings").orderBy("vec_id").limit(CENTROIDS).select("embedding").collect()
    return np.array([r[0] for r in rows], np.float64)


def assigned(spark, folder):
    v = ordered(spark, folder, "embeddings").select("vec_id", "label", F.col("_ord.row").alias("_ord"), "embedding")
    a = cluster.nearest_centroid(v, "vec_id", "embedding", centroids(spark, folder), ("label", "_ord"))
    a = a.select(F.col("vec_id").cast("string").alias("path"), (F.col("label") % 3).cast("string").alias("label"), "cluster", "distance", F.when(F.col("vec_id") % 5 == 0, "val").otherwise("train").alias("split"), "_ord")
    return Scratch(spark, "assigned").cut(a, "assigned")


def assignments(spark, folder):
    a = assigned(spark, folder)
    return a, a.select("path", "label", F.format_string("C%02d", "cluster").alias("cluster_id"), fixed6(F.col("distance")).alias("distance_to_centroid"), "split", "_ord")


def both_sides(spark, folder):
    _, a = assignments(spark, folder)
    spine = spark.range(CENTROIDS + 1).select(F.format_string("C%02d", "id").alias("cluster_id"))
    return a.where("split = 'train'"), a.where("split = 'val'"), spine


# ---- queries ---------------------------------------------------------------------------------------------------


def exact_duplicate_groups(spark, folder):
    d = t(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    return audit.exact_groups(d, "sha", "doc_id", "doc_id")


def exact_duplicate_rows(spark, folder):
    d = t(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    return audit.exact_rows(d, "sha", "doc_id", "doc_id")


def exact_duplicate_members(spark, folder):
    known = t(spark, folder, "image_audit").select("path").distinct()
    return audit.exact_members(t(spark, folder, "exact_duplicates")).join(known, "path", "left_semi").select("sha256", "pos", "path")


def audit_summary(spark, folder):
    return audit.audit_summary(t(spark, folder, "image_audit"))


def audit_rows_with_error(spark, folder):
    d = t(spark, folder, "documents")
    return audit.audit_rows(d, "doc_id", F.sha2("text", 256), F.col("n_chars"), F.length("source"), F.when(F.coalesce("n_chars", F.lit(0)) < 20, "too short"))


def class_counts(spark, folder):
    return audit.class_counts(t(spark, folder, "manifest_clean"), "current_label")


def most_common_sizes_top10(spark, folder):
    return audit.most_common_sizes(ordered(spark, folder, "image_audit").select("width", "height", "error", "_ord"), "_ord")


def manifest_projection(spark, folder):
    return t(spark, folder, "manifest_clean").select("image_id", basename(F.col("path")).alias("file"), F.col("current_label").alias("label"), F.lit("manifest").alias("origin"))


def status(kind):
    return lambda spark, folder: review.status_manifest(overridden(spark, folder), kind)


def batches(spark, folder):
    m = t(spark, folder, "manifest_clean")
    return review.union_batches([(f"batch_{i}", m.where(F.col("image_id").cast("bigint") % 3 == i)) for i in range(3)], ["image_id", "path", "review_status"])


def review_union_with_expected_counts(spark, folder):
    want = spark.createDataFrame([("batch_0", 1000), ("batch_1", 1000), ("batch_3", 5)], "file string, expected bigint")
    return review.batch_count_errors(batches(spark, folder), want)


def review_errors_by_rule(spark, folder):
    e = review.review_errors(t(spark, folder, "manifest_clean"), t(spark, folder, "image_audit"))
    return e.groupBy("rule").agg(F.count(F.lit(1)).alias("findings"), F.sum("n").alias("rows"))


def missing_review_paths(spark, folder):
    e = review.review_errors(t(spark, folder, "manifest_clean"), t(spark, folder, "image_audit"))
    return e.where("rule = 'unreviewed_path'").select("path")


def extra_review_paths(spark, folder):
    e = review.review_errors(t(spark, folder, "manifest_clean"), t(spark, folder, "image_audit"))
    return e.where("rule = 'unknown_path'").select("path")


def override_status(spark, folder):
    return overridden(spark, folder).groupBy("review_status").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("reason").startswith("see ")).alias("overridden"))


def manifest_contract_violations(spark, folder):
    return review.manifest_violations(t(spark, folder, "manifest_clean"), t(spark, folder, "image_audit"))


def existence_anti_join(spark, folder):
    return t(spark, folder, "manifest_clean").join(t(spark, folder, "image_audit").select("path").distinct(), "path", "left_anti").select("image_id", "path")


def signature_hex(spark, folder):
    return signatures(spark, folder).select("vec_id", "phash", "dhash", "whash")


def hamming_distance(spark, folder):
    s = signatures(spark, folder).select("vec_id", bits(F.col("phash")).alias("p"))
    nxt = s.select((F.col("vec_id") - 1).alias("vec_id"), F.col("p").alias("q"))
    return s.join(nxt, "vec_id").select("vec_id", hamming(F.col("p"), F.col("q")).alias("distance"))


def near_duplicate_pairs(spark, folder):
    return neardup.near_pairs(items(spark, folder)).drop("class_a", "class_b")


def near_duplicate_ranking(spark, folder):
    pairs = near_duplicate_pairs(spark, folder)
    return components.number_by(pairs.withColumn("__o", F.struct(*neardup.order_keys())), ["__o"], "place").select("path_a", "path_b", "cross_label", "place")


def near_duplicate_summary(spark, folder):
    i = items(spark, folder)
    return neardup.near_summary(i, neardup.near_pairs(i))


def review_queue(spark, folder):
    return review.review_queue(folders(spark, folder))


def review_copies(spark, folder):
    return review.review_copies(ordered(spark, folder, "exact_duplicates"), ordered(spark, folder, "near_duplicate_pairs"), ["_ord"])


def duplicate_actions(spark, folder):
    f, d = decided(spark, folder)
    return review.duplicate_actions(d, f)


def missing_review_folders(spark, folder):
    f, d = decided(spark, folder)
    return review.missing_folders(d, f)


def actions_summary_counts(spark, folder):
    return review.actions_summary(duplicate_actions(spark, folder))


def clean_manifest(spark, folder):
    return review.clean_manifest(t(spark, folder, "manifest_clean"), t(spark, folder, "duplicate_review_actions"))


def removed_manifest(spark, folder):
    return review.removed_manifest(t(spark, folder, "manifest_clean"), ordered(spark, folder, "duplicate_review_actions"))


def group_pairs(spark, folder):
    return review.group_pairs(t(spark, folder, "duplicate_review_actions"))


def edge_accounting(spark, folder):
    """Groups and pairs, in all and retained."""
    m = manifest(spark, folder)
    pairs = lambda n: t(spark, folder, n).select(F.col("path_a").alias("left"), F.col("path_b").alias("right"), F.lit(n).alias("source"))
    out = components.exact_edges(t(spark, folder, "exact_duplicates"), m).agg(F.lit("exact_edges").alias("kind"), F.count(F.lit(1)).alias("n"))
    for name in ("dedup_group_pairs", "near_duplicate_pairs"):
        out = out.unionByName(pairs(name).agg(F.lit(f"{name}_total").alias("kind"), F.count(F.lit(1)).alias("n")))
        out = out.unionByName(components.retained(pairs(name), m).agg(F.lit(f"{name}_retained").alias("kind"), F.count(F.lit(1)).alias("n")))
    return out


def unsafe_near_pairs(spark, folder):
    return components.unsafe_near_pairs(t(spark, folder, "near_duplicate_pairs"), t(spark, folder, "dedup_group_pairs"), manifest(spark, folder))


def connected_components(spark, folder):
    return components.connected_components(edges(spark, folder))


def component_groups(spark, folder):
    """The images of a group without a readable label are group_size - n0 - n1 - n2."""
    return grouped(spark, folder)[1].drop(f"n{UNREADABLE}")


def mixed_label_groups(spark, folder):
    g = grouped(spark, folder)[1]
    return g.where(split.is_mixed()).select("group_id", "n0", "n1", "n2")


def val_targets(spark, folder):
    return split.val_targets(labelled(spark, folder), VAL_SHARE)


def split_mixed_bernoulli(spark, folder):
    return split.mixed_draw(grouped(spark, folder)[1], VAL_SHARE, SEED, SPLIT_LABELS).select("group_id", F.round("draw", 6).alias("draw"), "in_val")


def split_first_fit(spark, folder):
    g = grouped(spark, folder)[1].where(~split.is_mixed(SPLIT_LABELS) & (F.col("n2") > 0))
    g = Scratch(spark, "fit").cut(g.withColumn("draw", split.unit_draw(f"{SEED}:2", F.col("group_id"))), "groups")
    target = split.collect_targets(val_targets(spark, folder))["2"]
    return split.first_fit(g, target)


def split_groups(spark, folder):
    members, groups = grouped(spark, folder)
    return members, groups, split.assign_splits(groups, split.collect_targets(val_targets(spark, folder), SPLIT_LABELS), VAL_SHARE, SEED, SPLIT_LABELS)


def split_rows(spark, folder):
    return split.split_rows(*split_groups(spark, folder))


def split_assignment(spark, folder):
    return split_groups(spark, folder)[2]


def side(name):
    return lambda spark, folder: split_rows(spark, folder).where(F.col("split") == name).select("path", "label", "group_id")


def split_summary(spark, folder):
    return split.split_summary(split_rows(spark, folder))


def l2_normalized_vectors(spark, folder):
    u = t(spark, folder, "embeddings").select("vec_id", l2_unit(F.transform("embedding", lambda x: x.cast("double") * 3)).alias("u"))
    return u.select("vec_id", F.round(F.aggregate("u", F.lit(0.0), lambda s, x: s + x * x), 6).alias("norm2"), F.round(F.get("u", F.lit(0)), 5).alias("first"))


def fixed_sample(spark, folder):
    return split.fixed_sample(t(spark, folder, "embeddings").select("vec_id"), "vec_id", 100, SEED)


def nearest_centroid_assignment(spark, folder):
    return assignments(spark, folder)[1].select("path", "cluster_id", F.round(F.col("distance_to_centroid").cast("double"), 4).alias("distance"))


def lloyd_step(spark, folder):
    m = cluster.cluster_means(t(spark, folder, "embeddings"), "label", "embedding")
    return m.select("label", "i", F.round("mean", 5).alias("mean"))


def kmeans_fit_sizes(spark, folder):
    v = t(spark, folder, "embeddings")
    m = cluster.fit_kmeans(v, "embedding", CENTROIDS, range(SEED, SEED + 10))
    return cluster.relabel_by_size(cluster.nearest_centroid(v, "vec_id", "embedding", np.array(m.clusterCenters())), CENTROIDS).select("new", "n")


def kmeans_check(spark, folder):
    """Rows the fit assigns, whether all clusters have some, and whether its cost is the sum of the squared distances."""
    v = t(spark, folder, "embeddings")
    m = cluster.fit_kmeans(v, "embedding", CENTROIDS, range(SEED, SEED + 10))
    own = cluster.nearest_centroid(v, "vec_id", "embedding", np.array(m.clusterCenters()))
    cost = m.summary.trainingCost
    total = own.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("cluster").alias("clusters"), F.sum(F.col("distance") ** 2).alias("d"))
    return total.select("rows", "clusters", (F.abs(F.col("d") - cost) <= 1e-4 * cost).alias("same_cost"))


def k_diagnostics(spark, folder):
    return cluster.k_diagnostics(t(spark, folder, "embeddings"), "vec_id", "embedding", [12, 16, 20, 24, 32], [63, 64, 65])


def k_diagnostics_check(spark, folder):
    """What must hold of each candidate's row, whatever the fits."""
    d = k_diagnostics(spark, folder)
    n = t(spark, folder, "embeddings").count()
    sizes = (F.col("min_cluster_size") <= F.col("median_cluster_size")) & (F.col("median_cluster_size") <= F.col("max_cluster_size")) & (F.col("min_cluster_size") * F.col("k") <= n) & (F.col("max_cluster_size") * F.col("k") >= n)
    scores = F.col("silhouette").between(-1, 1) & F.col("stability_ari_mean").between(-1, 1) & (F.col("stability_ari_min") <= F.col("stability_ari_mean")) & (F.col("inertia_mean") > 0) & (F.col("inertia_std") >= 0)
    return d.select("k", F.col("silhouette_sample_size").cast("bigint").alias("sample"), "n_stability_runs", sizes.alias("sizes_fit"), scores.alias("scores_fit"))


#: Diagnostics of invented fits, by which the rule of choice is compared with its SQL: request, k, tiny clusters, silhouette, agreement.
CHOICES = [
    ("gate", 12, 0, 0.20, 0.80), ("gate", 16, 0, 0.30, 0.70), ("gate", 20, 0, 0.25, 0.90), ("gate", 24, 2, 0.90, 0.99),
    ("none", 12, 3, 0.10, 0.20), ("none", 16, 1, float("nan"), 0.30), ("none", 20, 1, -0.50, 0.10), ("none", 24, 1, -0.50, 0.40),
    ("tie", 12, 0, 0.50, 0.90), ("tie", 16, 0, 0.50, 0.90),
]


def select_k(spark, folder):
    return cluster.select_k(k_diagnostics(spark, folder)).select("k", "stable")


def select_k_rule(spark, folder):
    d = spark.createDataFrame(CHOICES, "request string, k int, tiny_cluster_count bigint, silhouette double, stability_ari_mean double")
    out = None
    for name in sorted({c[0] for c in CHOICES}):
        own = cluster.select_k(d.where(F.col("request") == name)).select("request", "k", "stable")
        out = own if out is None else out.unionByName(own)
    return out


def silhouette_by_label(spark, folder):
    s = cluster.silhouette(t(spark, folder, "embeddings"), "vec_id", "embedding", "label")
    return spark.createDataFrame([(round(s, 6),)], "silhouette double")


def adjusted_rand_index(spark, folder):
    return cluster.adjusted_rand(assigned(spark, folder), "label", "cluster").select(F.round("ari", 6).alias("ari"))


def cluster_sizes_relabelled(spark, folder):
    return cluster.relabel_by_size(assigned(spark, folder), CENTROIDS).select("cluster", "new", "n")


def label_composition(spark, folder):
    return reports.label_composition(t(spark, folder, "cluster_assignments").where("label is not null and cluster_id is not null"))


def label_cluster_distribution(spark, folder):
    return reports.label_cluster_distribution(t(spark, folder, "cluster_assignments").where("label is not null and cluster_id is not null"))


def cluster_summary(spark, folder):
    return reports.cluster_summary(*both_sides(spark, folder)).drop("notes")


def cluster_representatives(spark, folder):
    return reports.representatives(assignments(spark, folder)[1], 3).select("cluster_id", "split", "path", "label", "rank", "representative_type")


def validation_coverage(spark, folder):
    return reports.validation_coverage(*both_sides(spark, folder))


def valid_embedding_rows(spark, folder):
    e = t(spark, folder, "embedding_manifest").select(whole_number(F.col("embedding_row")).alias("n"), (F.coalesce("valid_embedding", F.lit("")) == "1").alias("ok"))
    e = e.where("n is not null").groupBy("n").agg(F.max("ok").alias("ok"))
    return embed.number_valid(Scratch(spark, "rows").cut(e, "rows"), "ok", "n").select("n", F.coalesce("row_no", F.lit(-1)).alias("row_no"))


def cache_staleness(spark, folder):
    named = lambda n: t(spark, folder, n).where("path is not null").select("path")
    return embed.cache_state(named("manifest_clean"), named("embedding_manifest"))


def macro_f1(spark, folder):
    a = assigned(spark, folder).select(F.col("label").alias("truth"), (F.col("cluster") % 3).cast("string").alias("guess"))
    return reports.macro_f1(a, LABELS)


def ordered_submission(spark, folder):
    want = t(spark, folder, "manifest_clean").select(F.col("image_id").cast("bigint").alias("id"), strip(F.col("path")).alias("path")).groupBy("path").agg(F.min("id").alias("id"))
    got = t(spark, folder, "cluster_assignments").where("path is not null").groupBy("path").agg(F.min("cluster_id").alias("prediction"))
    return reports.ordered_submission(want.where("path is not null"), got, "path", "id")


def queries() -> dict[str, Query]:
    plain = [
        exact_duplicate_groups, exact_duplicate_rows, exact_duplicate_members, audit_summary, audit_rows_with_error, class_counts, most_common_sizes_top10, manifest_projection,
        review_union_with_expected_counts, review_errors_by_rule, missing_review_paths, extra_review_paths, override_status, manifest_contract_violations, existence_anti_join,
        signature_hex, hamming_distance, near_duplicate_pairs, near_duplicate_ranking, near_duplicate_summary, review_queue, review_copies, duplicate_actions, missing_review_folders, actions_summary_counts,
        clean_manifest, removed_manifest, group_pairs, edge_accounting, unsafe_near_pairs, connected_components, component_groups, mixed_label_groups, val_targets,
        split_mixed_bernoulli, split_first_fit, split_assignment, split_summary, l2_normalized_vectors, fixed_sample, nearest_centroid_assignment, lloyd_step, kmeans_fit_sizes, kmeans_check,
        k_diagnostics, k_diagnostics_check, select_k, select_k_rule, silhouette_by_label, adjusted_rand_index, cluster_sizes_relabelled, label_composition, label_cluster_distribution, cluster_summary,
        cluster_representatives, validation_coverage, valid_embedding_rows, cache_staleness, macro_f1, ordered_submission,
    ]
    named = {f.__name__: f for f in plain}
    named |= {f"status_{k}": status(k) for k in ("keep", "remove", "unsure")}
    named |= {"retained_edges": edges, "folder_pair_map": folders, "train_manifest": side("train"), "val_manifest": side("val")}
    return named


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
