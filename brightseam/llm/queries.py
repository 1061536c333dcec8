"""The queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, density, groups, leakage, moderation, neighbours, packing, sampling, splits, survivors


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": splits.p1_found,
        "p1_splits": splits.p1_splits,
        "p1_shares": splits.p1_shares,
        "p1_check": splits.p1_check,
        "p2_found": groups.p2_found,
        "p2_group_sizes": groups.p2_group_sizes,
        "p3_found": survivors.p3_found,
        "p3_survivors": survivors.p3_survivors,
        "p4_found": leakage.p4_found,
        "p4_report": leakage.p4_report,
        "p4_texts": leakage.p4_texts,
        "p5_found": density.p5_found,
        "p5_clusters": density.p5_clusters,
        "p5_check": density.p5_check,
        "p6_found": sampling.p6_found,
        "p6_report": sampling.p6_report,
        "p6_sample": sampling.p6_sample,
        "p6_check": sampling.p6_check,
        "p7_found": neighbours.p7_found,
        "p7_neighbours": neighbours.p7_neighbours,
        "p7_check": neighbours.p7_check,
        "p8_ids": bpe.p8_ids,
        "p8_check": bpe.p8_check,
        "p9_containers": packing.p9_containers,
        "p9_usage": packing.p9_usage,
        "p9_check": packing.p9_check,
        "p10_found": moderation.p10_found,
        "p10_scores": moderation.p10_scores,
        "p10_rates": moderation.p10_rates,
        "p10_check": moderation.p10_check,
    }
