"""Column lists of the pipeline's tables, in their contractual order; fixed values."""

MANIFEST = ["image_id", "path", "current_label", "class_name", "review_status", "reason"]
TABLES = {
    "review_batch": [*MANIFEST, "encode"],
    "manifest": MANIFEST,
    "exact_duplicate_decisions": ["path", "decision"],
    "image_audit": ["path", "current_label", "class_name", "width", "height", "aspect_ratio", "sha256", "error"],
    "exact_duplicates": ["sha256", "count", "paths"],
    "near_duplicate_pairs": ["path_a", "label_a", "class_a", "path_b", "label_b", "class_b", "phash_distance", "dhash_distance", "whash_distance", "matching_hashes", "cross_label"],
    "duplicate_review": ["folder", "decision", "guide", "notes"],
    "duplicate_review_actions": ["folder", "type", "decision", "keep_path", "remove_path", "group_paths"],
    "dedup_remove_manifest": ["path", "label", "class_name", "source_folder", "decision", "reason"],
    "dedup_group_pairs": ["source_folder", "path_a", "path_b", "reason"],
    "split_groups": ["group_id", "split", "group_size", "group_sources", "path", "current_label", "class_name"],
    "embedding_manifest": ["embedding_row", "path", "source_manifest", "valid_embedding", "embedding_error"],
    "k_diagnostics": ["k", "inertia_mean", "inertia_std", "silhouette", "silhouette_sample_size", "silhouette_sample_seed", "min_cluster_size", "max_cluster_size", "median_cluster_size", "tiny_cluster_count", "stability_ari_mean", "stability_ari_min", "n_stability_runs"],
    "cluster_assignments": ["path", "label", "cluster_id", "distance_to_centroid", "cluster_system_version"],
    "cluster_label_composition": ["cluster_id", "label", "count", "proportion_within_cluster"],
    "label_cluster_distribution": ["label", "cluster_id", "count", "proportion_within_label"],
    "cluster_summary": ["cluster_id", "train_count", "val_count", "dominant_train_label", "dominant_train_label_proportion", "label_entropy", "assigned_centroid_distance_median", "assigned_centroid_distance_p95", "notes"],
    "cluster_representative_images": ["cluster_id", "split", "path", "label", "distance_to_centroid", "rank", "representative_type"],
    "validation_coverage": ["cluster_id", "train_count", "train_proportion", "val_count", "val_proportion", "coverage_note"],
}
TABLES["overrides"] = ["path", "review_status", "reason", "decision"]
LABELS = ["0", "1", "2"]
UNREADABLE = "unreadable"
