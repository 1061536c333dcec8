"""Command line: each step of the pipeline, with every path and constant as an option."""

from __future__ import annotations

import argparse
import platform
from datetime import UTC, datetime

import numpy as np
import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import ContractError
from .functions.dirt import CLASSES
from .functions.scalars import fixed6
from .operators import audit, cluster, components, embed, neardup, reports, review, signatures, split
from .schemas import LABELS, TABLES
from .sources import files, images, sinks


def ints(text: str) -> list[int]:
    """A comma list of whole numbers; blanks are skipped, an empty list is refused."""
    out = [int(x) for x in text.split(",") if x.strip()]
    if not out:
        raise argparse.ArgumentTypeError("no number given")
    return out


def now() -> str:
    return datetime.now(UTC).isoformat()


def counts(df: DataFrame, column: str) -> dict[str, int]:
    """Rows by value, of a column of few values."""
    return {r[0]: r[1] for r in df.groupBy(column).agg(F.count(F.lit(1))).orderBy(column).collect()}


def make_manifests(spark: SparkSession, a: argparse.Namespace) -> None:
    """``expected``: the rows each batch must have, in the order of the batches.  ``overrides`` has path, review_status, reason, decision; a row
    without a status only notes its decision."""
    batches = [(p, files.read_manifest(spark, p, "review_batch", order=True, exact_header=True)) for p in a.batch]
    merged = review.union_batches(batches, [*TABLES["review_batch"], "_ord"]).persist()
    if a.expected:
        want = spark.createDataFrame(list(zip(a.batch, a.expected, strict=True)), "file string, expected bigint")
        wrong = [f"{r['file']}: expected {r['expected']} rows, found {r['found']}" for r in review.batch_count_errors(merged, want).collect()]
        if wrong:
            raise ContractError("review batches", wrong)
    review.require_no_errors(review.review_errors(merged, files.list_files(spark, a.images)), "review decisions")
    order = ["file_idx", "_ord"]
    sinks.write_table(merged, f"{a.out}/review_decisions_merged", "review_batch", order)
    if a.overrides:
        o = files.read_manifest(spark, a.overrides, "overrides", order=True).persist()
        sinks.write_table(o.where("decision <> ''"), f"{a.out}/exact_duplicate_decisions", "exact_duplicate_decisions", ["_ord"])
        merged = review.apply_overrides(merged, o.select("path", "review_status", "reason"))
    for kind in ("keep", "remove", "unsure"):
        sinks.write_table(review.status_manifest(merged, kind), f"{a.out}/{kind}_manifest", "manifest", order)


def audit_images(spark: SparkSession, a: argparse.Namespace) -> None:
    m = files.read_manifest(spark, a.manifest, "manifest", order=True)
    info = files.image_info(files.read_bytes(spark, f"{a.images}/*/*")).withColumn("found", F.lit(True))
    j = m.join(info, "path", "left")
    err = F.when(F.col("found").isNull(), "file not found").otherwise(F.col("error"))
    rows = audit.audit_rows(j, "path", F.col("sha256"), F.col("width"), F.col("height"), err, ("_ord", "current_label", "class_name")).persist()
    sinks.write_table(rows, f"{a.out}/image_audit", "image_audit", order=["_ord"])
    sinks.write_table(audit.exact_groups(rows, "sha256", "path", "_ord"), f"{a.out}/exact_duplicates", "exact_duplicates", order=["sha256"])
    sizes = [{"width": int(r["width"]), "height": int(r["height"]), "count": r["n"]} for r in audit.most_common_sizes(rows, "_ord").collect()]
    sinks.write_summary(audit.audit_summary(rows), f"{a.out}/audit_summary.json", manifest=a.manifest, created_at=now(), class_counts=counts(rows, "current_label"), most_common_sizes=sizes)


def image_signatures(spark: SparkSession, a: argparse.Namespace) -> None:
    s = signatures.image_signatures(files.read_bytes(spark, f"{a.images}/*/*"))
    s.write.mode("overwrite").parquet(f"{a.out}/signatures")


def near_duplicates(spark: SparkSession, a: argparse.Namespace) -> None:
    """``signatures`` is parquet with path, phash, dhash, whash; images without a signature are counted, and make no pair."""
    rows = files.read_manifest(spark, a.audit, "image_audit", order=True).where("error = ''")
    items = rows.join(spark.read.parquet(a.signatures).select("path", *neardup.HASHES), "path", "left").select(F.col("_ord").alias("ord"), "path", F.col("current_label").alias("label"), "class_name", "sha256", *neardup.HASHES).persist()
    pairs = neardup.near_pairs(items, a.prefix, a.limit, a.votes).persist()
    sinks.write_table(pairs, f"{a.out}/near_duplicate_pairs", "near_duplicate_pairs", order=neardup.order_keys())
    sinks.write_summary(neardup.near_summary(items, pairs, a.audit, a.prefix, a.limit, a.votes), f"{a.out}/near_duplicate_summary.json", images_without_signature=items.where("phash is null").count(), created_at=now())


def review_tables(spark: SparkSession, a: argparse.Namespace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(exact, near, folders), numbered in the order of the files."""
    exact, near = files.read_manifest(spark, a.exact, "exact_duplicates", order=True), files.read_manifest(spark, a.near, "near_duplicate_pairs", order=True)
    return exact, near, review.exact_folders(exact, ["_ord"]).unionByName(review.near_folders(near, ["_ord"])).persist()


def prepare_review(spark: SparkSession, a: argparse.Namespace) -> None:
    """With ``images`` the pictures to compare are copied into the folders; a missing one is an error."""
    exact, near, folders = review_tables(spark, a)
    kinds = F.array_position(F.array(*[F.lit(k) for k in ("exact", "near_cross", "near_same")]), F.col("notes"))
    sinks.replace_queue(review.review_queue(folders), f"{a.out}/duplicate_review", [kinds, F.length("folder"), "folder"])
    if a.images:
        copies = review.review_copies(exact, near, ["_ord"]).persist()
        raw = files.read_bytes(spark, f"{a.images}/*/*")
        gone = copies.join(raw.select("path"), "path", "left_anti").select("path").distinct().limit(20).collect()
        if gone:
            raise ContractError("images to review are missing", [r["path"] for r in gone])
        sinks.copy_images(copies.join(raw, "path"), f"{a.out}/review_images")


def apply_review(spark: SparkSession, a: argparse.Namespace) -> None:
    _, _, f = review_tables(spark, a)
    d, kept = files.read_manifest(spark, a.decisions, "duplicate_review", order=True), files.read_manifest(spark, a.manifest, "manifest", order=True).persist()
    wrong = [f"unknown folder {r[0]}" for r in review.unknown_folders(d, f).limit(20).collect()] + [f"missing folder {r[0]}" for r in review.missing_folders(d, f).limit(20).collect()]
    if wrong:
        raise ContractError("duplicate review", wrong)
    acts = review.duplicate_actions(d.select("folder", "decision", "_ord"), f).persist()
    sinks.write_table(acts, f"{a.out}/duplicate_review_actions", "duplicate_review_actions", order=["_ord"])
    sinks.write_table(kept, f"{a.out}/manifest_kept", "manifest", order=["_ord"])
    sinks.write_table(review.clean_manifest(kept, acts), f"{a.out}/manifest_clean", "manifest", order=["_ord"])
    sinks.write_table(review.removed_manifest(kept, acts), f"{a.out}/dedup_remove_manifest", "dedup_remove_manifest", order=["_ord"])
    sinks.write_table(review.group_pairs(acts), f"{a.out}/dedup_group_pairs", "dedup_group_pairs", order=["_ord"])
    sinks.write_review_summary(acts, f"{a.out}/duplicate_review_summary.md", a.decisions)


def checked_manifest(spark: SparkSession, path: str, images_root: str | None, repeats: bool = False) -> DataFrame:
    """A manifest that keeps the contract: rows, labels, paths without repeats unless allowed, and, with a root, files that exist."""
    m = files.read_manifest(spark, path, "manifest", order=True).persist()
    listing = files.list_files(spark, images_root) if images_root else None
    bad = [f"{r['rule']}: {r['n']}" for r in review.manifest_violations(m, listing).where("n > 0").collect() if not (repeats and r["rule"] == "duplicate_path")]
    if bad or m.isEmpty():
        raise ContractError(path, bad or ["empty manifest"])
    return m


def split_manifest(spark: SparkSession, a: argparse.Namespace) -> None:
    m = checked_manifest(spark, a.manifest, a.images)
    near, pairs, exact = files.read_manifest(spark, a.near_pairs, "near_duplicate_pairs"), files.read_manifest(spark, a.group_pairs, "dedup_group_pairs"), files.read_manifest(spark, a.exact_duplicates, "exact_duplicates")
    unsafe = components.unsafe_near_pairs(near, pairs, m).orderBy("lo", "hi").limit(20).collect()
    if unsafe and not a.allow_ungrouped:
        raise ContractError("near pairs that are neither removed nor grouped", [f"{r['lo']} | {r['hi']}" for r in unsafe])
    edges = components.exact_edges(exact, m).unionByName(components.retained(components.pair_edges(pairs), m)).distinct().persist()
    members, groups = components.component_groups(m, edges)
    targets = split.collect_targets(split.val_targets(m, a.val_fraction))
    splits = split.assign_splits(groups, targets, a.val_fraction, a.seed)
    rows = split.split_rows(members, groups, splits).join(m.select("path", "class_name", "_ord"), "path").persist()
    for s in ("train", "val"):
        sinks.write_table(m.join(rows.where(F.col("split") == s).select("path"), "path", "left_semi"), f"{a.out}/{s}_manifest", "manifest", order=["_ord"])
    sinks.write_table(rows.withColumnRenamed("label", "current_label"), f"{a.out}/split_groups", "split_groups", order=["_ord"])
    each = rows.groupBy("group_id", "split", "group_size").agg(F.count_distinct("label").alias("labels")).persist()
    of = {s: counts(rows.where(F.col("split") == s), "label") for s in ("train", "val")}
    sinks.write_json(spark, {
        "created_at": now(), "source_manifest": a.manifest, "source_manifest_sha256": files.file_digests(spark, a.manifest), "seed": a.seed, "val_fraction": a.val_fraction,
        "row_counts": {"total": sum(sum(c.values()) for c in of.values()), **{s: sum(c.values()) for s, c in of.items()}},
        "class_counts": {"total": counts(rows, "label"), "target_val": targets, "actual_val": of["val"], "actual_train": of["train"]}, "class_names": CLASSES,
        "group_counts": {"total": each.count(), "train": each.where("split = 'train'").count(), "val": each.where("split = 'val'").count(), "non_singleton": each.where("group_size > 1").count(), "mixed_label": each.where("labels > 1").count()},
        "constraint_counts": components.constraint_counts(exact, pairs, near, m),
        "outputs": {k: f"{a.out}/{k}" for k in ("train_manifest", "val_manifest", "split_groups", "split_summary.json")},
    }, f"{a.out}/split_summary.json")


def extract_embeddings(spark: SparkSession, a: argparse.Namespace) -> None:
    """Embeddings of a manifest's images, with ``embedding_row`` in the manifest's order.  Those in place are kept if they belong to the
    manifest, and are an error if not, unless ``force`` is given."""
    m = checked_manifest(spark, a.manifest, a.images, repeats=True)
    table, vectors = f"{a.out}/{a.split}_embedding_manifest", f"{a.out}/{a.split}_embeddings"
    if files.exists(spark, table) and files.exists(spark, vectors) and not a.force:
        wrong = embed.cache_problems(m, files.read_manifest(spark, table, "embedding_manifest", order=True), spark.read.parquet(vectors).count())
        if wrong:
            raise ContractError(f"stale embeddings in {vectors}; extract them again with --force", wrong)
        return
    rows = embed.embedding_rows(m, embed.extract(files.read_bytes(spark, f"{a.images}/*/*"), embed.load_encoder(a.encoder, a.input_size)), a.manifest).persist()
    if rows.where("valid_embedding = '1'").isEmpty():
        raise ContractError(a.manifest, ["no valid embedding"])
    sinks.write_table(rows, table, "embedding_manifest", order=["_ord"])
    rows.where("valid_embedding = '1'").select("embedding_row", "path", "label", "embedding").write.mode("overwrite").parquet(vectors)


def cluster_inputs(spark: SparkSession, a: argparse.Namespace, name: str) -> DataFrame:
    """(path, label, embedding, _ord) of a split; its manifests, where given, must belong to it."""
    v = spark.read.parquet(getattr(a, name))
    manifest, rows = getattr(a, f"{name}_manifest"), getattr(a, f"{name}_embedding_manifest")
    if manifest:
        m = checked_manifest(spark, manifest, a.images, repeats=True)
        if rows:
            wrong = embed.cache_problems(m, files.read_manifest(spark, rows, "embedding_manifest", order=True), v.count())
            if wrong:
                raise ContractError(f"{rows} doesn't match", wrong)
    bad = v.where(~F.coalesce(F.col("label").isin(*LABELS), F.lit(False))).count()
    if bad or v.isEmpty():
        raise ContractError(getattr(a, name), [f"{bad} rows with an invalid label" if bad else "no embeddings"])
    return v.select("path", "label", "embedding", (F.col("embedding_row") if "embedding_row" in v.columns else F.monotonically_increasing_id()).alias("_ord"))


def cluster_diagnostics(spark: SparkSession, a: argparse.Namespace) -> None:
    """``train`` and ``val`` are parquet with path, label, embedding, and embedding_row where the order of rows is to count."""
    train, val = cluster_inputs(spark, a, "train").persist(), cluster_inputs(spark, a, "val")
    diag = cluster.k_diagnostics(train, "path", "embedding", a.candidate_k, a.stability_seeds, a.max_iter, a.silhouette_sample_size, a.silhouette_sample_seed, a.tiny_cluster_threshold).persist()
    written = diag.select(*[fixed6(F.col(c)).alias(c) if t == "double" else c for c, t in diag.dtypes])
    sinks.write_table(written.orderBy("k"), f"{a.out}/k_diagnostics", "k_diagnostics", one_file=True)  # a row a candidate
    if a.diagnostics_only:
        return
    best = cluster.select_k(diag, a.min_stability_ari).first()
    k, why = (a.selected_k, "given by --selected-k") if a.selected_k else (best["k"], best["rationale"])
    if k not in a.candidate_k:
        raise ContractError("the chosen k is no candidate", [str(k)])
    model = cluster.fit_kmeans(train, "embedding", k, range(a.fit_seed, a.fit_seed + a.final_n_init), a.max_iter)
    centres = np.array(model.clusterCenters())
    own = lambda df: cluster.nearest_centroid(df, "path", "embedding", centres, ("label", "_ord"))
    new = cluster.relabel_by_size(own(train), k).collect()  # k rows
    centres = centres[np.argsort([r["new"] for r in sorted(new, key=lambda r: r["cluster"])])]
    sinks.write_matrix(spark, centres.astype(np.float32), f"{a.out}/centroids.npy")
    prints = {s: files.file_digests(spark, p) if (p := getattr(a, f"{s}_manifest")) else embed.fingerprint(df).first()["digest"] for s, df in (("train", train), ("val", val))}
    version = f"{a.system_name}_l2_k{k}_seed{a.fit_seed}_{prints['train'][:8]}"
    width = max(2, len(str(k - 1)))
    named = lambda df, s: own(df).select("path", "label", F.format_string(f"C%0{width}d", "cluster").alias("cluster_id"), fixed6(F.col("distance")).alias("distance_to_centroid"), F.lit(version).alias("cluster_system_version"), F.lit(s).alias("split"), "_ord")
    t, v = named(train, "train").persist(), named(val, "val").persist()
    spine = spark.range(k).select(F.format_string(f"C%0{width}d", "id").alias("cluster_id"))
    for df, s in ((t, "train"), (v, "val")):
        sinks.write_table(df, f"{a.out}/{s}_cluster_assignments", "cluster_assignments", order=["_ord"])
    kind = F.col("representative_type") != "nearest"
    for df, name, order in (
        (reports.label_composition(t), "cluster_label_composition", ["cluster_id", "label"]), (reports.label_cluster_distribution(t), "label_cluster_distribution", ["label", "cluster_id"]), (reports.cluster_summary(t, v, spine), "cluster_summary", ["cluster_id"]),
        (reports.representatives(t.unionByName(v), a.representatives_per_cluster), "cluster_representative_images", ["split", "cluster_id", kind, "rank"]), (reports.validation_coverage(t, v, spine), "validation_coverage", ["cluster_id"]),
    ):
        sinks.write_table(df.orderBy(*order), f"{a.out}/{name}", name, one_file=True)  # some rows a cluster
    sinks.write_json(spark, {
        "cluster_system_version": version, "created_at": now(),
        **{f"source_{s}_manifest": getattr(a, f"{s}_manifest") or getattr(a, s) for s in prints}, **{f"source_{s}_manifest_fingerprint": d for s, d in prints.items()},
        "class_names": CLASSES, "embedding_dim": int(centres.shape[1]), "embedding_normalization": "length 1", "clustering_method": "pyspark.ml.clustering.KMeans", "k": k, "candidate_k_range": a.candidate_k, "selected_k_rationale": why,
        "tiny_cluster_threshold": a.tiny_cluster_threshold, "min_stability_ari": a.min_stability_ari, "fit_seed": a.fit_seed, "diagnostic_n_init": 1, "final_n_init": a.final_n_init, "max_iter": a.max_iter, "stability_seeds": a.stability_seeds,
        "silhouette_sample_size": a.silhouette_sample_size, "silhouette_sample_seed": a.silhouette_sample_seed,
        "library_versions": {"python": platform.python_version(), "pyspark": pyspark.__version__, "numpy": np.__version__, "pillow": getattr(images.Image, "__version__", None)},
        "outputs": {n: f"{a.out}/{n}" for n in ("k_diagnostics", "centroids.npy", "train_cluster_assignments", "val_cluster_assignments", "cluster_summary", "cluster_representative_images", "validation_coverage")},
    }, f"{a.out}/cluster_config.json")


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="brightseam")
    sub = p.add_subparsers(dest="step", required=True)

    def step(name, run, *options, optional=(), **defaults):
        s = sub.add_parser(name)
        s.set_defaults(run=run)
        s.add_argument("--out", required=True)
        for o in options:
            s.add_argument(f"--{o}", required=True)
        for o in optional:
            s.add_argument(f"--{o}")
        for o, d in defaults.items():
            s.add_argument(f"--{o.replace('_', '-')}", **({"action": "store_true"} if d is False else {"type": ints if isinstance(d, list) else type(d) if d is not None else int, "default": d}))
        return s

    s = step("make-manifests", make_manifests, "images", optional=["overrides"])
    s.add_argument("--batch", action="append", required=True)
    s.add_argument("--expected", action="append", type=int)
    step("audit", audit_images, "manifest", "images")
    step("signatures", image_signatures, "images")
    step("near-duplicates", near_duplicates, "audit", "signatures", prefix=4, limit=4, votes=2)
    step("prepare-review", prepare_review, "exact", "near", optional=["images"])
    step("apply-review", apply_review, "manifest", "exact", "near", "decisions")
    step("split", split_manifest, "manifest", "exact-duplicates", "group-pairs", "near-pairs", optional=["images"], val_fraction=0.2, seed=63, allow_ungrouped=False)
    step("extract-embeddings", extract_embeddings, "manifest", "images", "split", encoder="brightseam.operators.embed:thumbnail_encoder", input_size=224, force=False)
    step("cluster-diagnostics", cluster_diagnostics, "train", "val", optional=["images", "train-manifest", "val-manifest", "train-embedding-manifest", "val-embedding-manifest"], system_name="kmeans", candidate_k=[12, 16, 20, 24, 32], selected_k=None, stability_seeds=[63, 64, 65], fit_seed=63, final_n_init=10, max_iter=300, silhouette_sample_size=5000, silhouette_sample_seed=63, tiny_cluster_threshold=25, min_stability_ari=0.75, representatives_per_cluster=8, diagnostics_only=False)
    a = p.parse_args(args)
    a.run(SparkSession.builder.appName(f"brightseam {a.step}").getOrCreate(), a)


if __name__ == "__main__":
    main()
