"""Relationship score, type, confidence and evidence of photo pairs, from whatever evidence a pair has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lensgraph.config import Relationship
from lensgraph.functions import scalars as S


def with_pair_attributes(pairs: DataFrame, images: DataFrame, *attributes: str) -> DataFrame:
    """Each attribute of both images of a pair, suffixed _a and _b; pairs of unknown images keep nulls."""
    for side in "ab":
        own = images.select(F.col("image_id").alias(f"image_{side}"), *(F.col(a).alias(f"{a}_{side}") for a in attributes))
        pairs = pairs.join(own, f"image_{side}", "left")
    return pairs


def score_pairs(pairs: DataFrame, cfg: Relationship = Relationship()) -> DataFrame:
    """``pairs`` with the partial scores, relationship_score (6 decimals), relationship_type, duplicate_confidence and duplicate_evidence.

    Evidence that is missing is left out of the mean, but a missing feature match
    counts as 0.  Types and confidence follow the unrounded score.
    """
    have = set(pairs.columns)
    col = lambda name, kind: F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)
    phash = col("phash_distance", "int")
    parts = pairs.withColumns(
        {
            "__emb": F.col("embedding_similarity").cast("double"),
            "__feature": F.coalesce(col("feature_match_score", "double"), F.lit(0.0)),
            "__phash": F.when(phash.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(F.lit(0.0), 1.0 - phash.cast("double") / cfg.phash_range)),
            "__gps": S.step_score(col("gps_distance_meter", "double"), cfg.gps_same_meter, cfg.gps_near_meter, cfg.near_step),
            "__time": S.step_score(col("time_difference_second", "double"), cfg.time_same_second, cfg.time_near_second, cfg.near_step),
        }
    )
    emb, feature, gps, time = (F.col(f"__{x}") for x in ("emb", "feature", "gps", "time"))
    score = S.weighted_mean([(emb, cfg.weight_embedding), (feature, cfg.weight_feature), (F.col("__phash"), cfg.weight_phash), (gps, cfg.weight_gps), (time, cfg.weight_time)])
    parts = parts.withColumn("__score", score)
    s = F.col("__score")
    level = lambda x, same, near, name: F.when(x.isNull(), f"{name}_unknown").when(x >= 1, same).when(x > 0, near).otherwise(f"{name}_far")
    evidence = [
        F.when(emb >= cfg.evidence_embedding_high, "embedding_high").when(emb >= cfg.evidence_embedding_medium, "embedding_medium").otherwise("embedding_low"),
        F.when(feature >= cfg.evidence_feature_high, "feature_match_high").otherwise("feature_match_low"),
        F.when(phash.isNull(), "phash_unknown").when(phash <= cfg.evidence_phash_low, "phash_low_distance").when(phash <= cfg.evidence_phash_near, "phash_near_distance").otherwise("phash_far_distance"),
        level(gps, "gps_same", "gps_near", "gps"),
        level(time, "time_close", "time_near", "time"),
    ]
    same_file = (F.col("image_hash_a") == F.col("image_hash_b")) & (F.col("image_hash_a") != "") if {"image_hash_a", "image_hash_b"} <= have else F.lit(False)
    relation = (
        F.when(same_file, "EXACT_DUPLICATE")
        .when((emb >= cfg.near_duplicate_embedding) & (phash <= cfg.near_duplicate_phash_distance), "NEAR_DUPLICATE")
        .when((s >= cfg.same_capture_score) & ((time == 1.0) | (gps == 1.0)), "SAME_CAPTURE")
        .when((s >= cfg.same_object_score) & (feature >= cfg.same_object_feature), "SAME_OBJECT")
        .when(s >= cfg.related_score, "RELATED_ONLY")
        .otherwise("UNRELATED")
    )
    out = parts.withColumns(
        {
            "phash_score": F.round("__phash", 6),
            "gps_proximity_score": gps,
            "time_proximity_score": time,
            "relationship_score": F.round(s, 6),
            "relationship_type": relation,
            "duplicate_confidence": S.banded(s, [(cfg.very_high, "VERY_HIGH"), (cfg.high, "HIGH"), (cfg.medium, "MEDIUM")], "LOW"),
            "duplicate_evidence": F.array_join(F.array(*evidence), ";"),
        }
    )
    return out.drop("__emb", "__feature", "__phash", "__gps", "__time", "__score")


def edges(scored: DataFrame, cfg: Relationship = Relationship()) -> DataFrame:
    return scored.where((F.col("relationship_type") != "UNRELATED") & (F.col("relationship_score") >= cfg.edge_threshold))
