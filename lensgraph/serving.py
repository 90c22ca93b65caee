"""Lookups of a portal: filters are Columns that the planner pushes into the scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = 50
LAST_PAGE = 100_000


def numbered(pairs: DataFrame) -> DataFrame:
    """Pairs with their row number in the order they are listed: most similar first."""
    return pairs.withColumn("id", F.row_number().over(Window.orderBy(F.desc("embedding_similarity"), "image_a", "image_b")))


def with_group(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs with the cluster that holds both of their images, or null."""
    side = lambda s: members.select(F.col("image_id").alias(f"image_{s}"), F.col("duplicate_group_id").alias(f"__{s}"))
    joined = pairs.join(side("a"), "image_a", "left").join(side("b"), "image_b", "left")
    return joined.withColumn("group_id", F.when(F.col("__a") == F.col("__b"), F.col("__a"))).drop("__a", "__b")


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def query_pairs(pairs: DataFrame, group: str | None = None, type: str | None = None, confidence: str | None = None, q: str | None = None) -> DataFrame:
    """Pairs that meet every filter given; q is looked for in either image id, in any case."""
    wanted = [F.col(c) == v for c, v in (("group_id", group), ("relationship_type", type), ("duplicate_confidence", confidence)) if v]
    if q:
        wanted.append(F.lower("image_a").contains(q.lower()) | F.lower("image_b").contains(q.lower()))
    return pairs.where(_all(wanted))


def page(rows: DataFrame, number: int, size: int = PAGE, order: str = "id") -> DataFrame:
    """One page, with the total before paging in each row; page numbers are clamped."""
    at = max(0, min(number, LAST_PAGE))
    total = rows.agg(F.count("*").alias("total"))
    return rows.orderBy(order).offset(at * size).limit(size).crossJoin(total)


def cluster_listing(clusters: DataFrame, members: DataFrame) -> DataFrame:
    """Clusters with their regions and the code of their canonical image."""
    regions = members.groupBy("duplicate_group_id").agg(F.array_sort(F.collect_set("ultg")).alias("regions"), F.array_join(F.array_sort(F.collect_list("nama_file")), " ").alias("names"))
    code = members.where("is_canonical = 'YA'").select("duplicate_group_id", F.col("kode_l1").alias("kode_l1_canonical"))
    return clusters.join(regions, "duplicate_group_id").join(code, "duplicate_group_id", "left").withColumn("ultg", F.array_join("regions", "; "))


def query_clusters(listing: DataFrame, status: str | None = None, confidence: str | None = None, type: str | None = None, code: str | None = None, ultg: str | None = None, q: str | None = None) -> DataFrame:
    """Clusters that meet every filter given; q is looked for in the group, its canonical image and its members' names."""
    wanted = [F.col(c) == v for c, v in (("cluster_status", status), ("cluster_confidence", confidence), ("relationship_type_dominant", type), ("kode_l1_canonical", code)) if v]
    if ultg:
        wanted.append(F.array_contains("regions", ultg))
    if q:
        wanted.append(F.lower(F.concat_ws(" ", "duplicate_group_id", "canonical_image", "names")).contains(q.lower()))
    return listing.where(_all(wanted))


def cluster_counts(found: DataFrame) -> DataFrame:
    """(cluster_status, n, members): clusters found by status, and the images in them."""
    return found.groupBy("cluster_status").agg(F.count("*").alias("n"), F.sum("jumlah_gambar").alias("members"))


def cluster_detail(clusters: DataFrame, members: DataFrame, group: str) -> DataFrame:
    """One row a member of a cluster, with the cluster's columns; empty if there is no such cluster."""
    own = members.where(F.col("duplicate_group_id") == group)
    return clusters.where(F.col("duplicate_group_id") == group).join(own, "duplicate_group_id").orderBy("image_id")


def touching(clusters: DataFrame, members: DataFrame, pairs: DataFrame, type: str) -> DataFrame:
    """Clusters with a member that any pair of the type touches."""
    ends = pairs.where(F.col("relationship_type") == type).select(F.explode(F.array("image_a", "image_b")).alias("image_id"))
    groups = members.join(ends, "image_id", "left_semi").select("duplicate_group_id")
    return clusters.join(groups, "duplicate_group_id", "left_semi")


def executive_summary(l1: DataFrame, l2: DataFrame, pairs: DataFrame, clusters: DataFrame, members: DataFrame) -> DataFrame:
    """(layer, metric, value) in long form."""
    one = lambda layer, metric, df: df.agg(F.count("*").alias("value")).select(F.lit(layer).alias("layer"), F.lit(metric).alias("metric"), "value")
    by = lambda layer, prefix, df, column: df.groupBy(column).agg(F.count("*").alias("value")).select(F.lit(layer).alias("layer"), F.concat(F.lit(prefix), F.col(column)).alias("metric"), "value")
    gaps = l2.agg(F.coalesce(F.sum("jumlah_belum_dinilai"), F.lit(0)).cast("long").alias("value")).select(F.lit("l2").alias("layer"), F.lit("gap_cells").alias("metric"), "value")
    parts = [
        one("l1", "total", l1),
        by("l1", "code:", l1, "kode"),
        one("l1", "review", l1.where("perlu_review_manual = 'YA'")),
        one("l2", "with_gaps", l2.where("jumlah_belum_dinilai > 0")),
        gaps,
        one("l3", "pairs", pairs),
        by("l3", "type:", pairs, "relationship_type"),
        by("l3", "confidence:", pairs, "duplicate_confidence"),
        one("l3", "clusters", clusters),
        one("l3", "members", members),
        by("l3", "status:", clusters, "cluster_status"),
    ]
    return reduce(DataFrame.unionByName, parts)


def review_queue(l1: DataFrame, pairs: DataFrame, clusters: DataFrame, members: DataFrame) -> DataFrame:
    """(image_id, reasons): photos for a person to look at, with every reason that holds."""
    tag = lambda df, reason: df.select("image_id", F.lit(reason).alias("reason"))
    in_status = lambda status: members.join(clusters.where(F.col("cluster_status") == status).select("duplicate_group_id"), "duplicate_group_id", "left_semi")
    both = lambda df: df.select(F.explode(F.array("image_a", "image_b")).alias("image_id"))
    parts = [
        tag(l1.where("confidence = 'rendah'"), "low_confidence"),
        tag(l1.where("kode = 'O'"), "wrong_object"),
        tag(in_status("SPLIT_RECOMMENDED"), "cluster_split"),
        tag(in_status("NEED_REVIEW"), "cluster_review"),
        tag(both(pairs.where("relationship_type = 'NEAR_DUPLICATE' AND relationship_score < 0.70")), "near_duplicate_with_low_score"),
        tag(both(pairs.where("relationship_type = 'SAME_OBJECT' AND duplicate_confidence = 'MEDIUM'")), "same_object_uncertain"),
    ]
    return reduce(DataFrame.union, parts).groupBy("image_id").agg(F.array_join(F.array_sort(F.collect_set("reason")), ";").alias("reasons"))


def master_result(l1: DataFrame, l2: DataFrame, pairs: DataFrame, members: DataFrame) -> DataFrame:
    """One row a photo: its code, features, cluster, closest partner, and whether it is an exact or near copy."""
    both = pairs.select(F.col("image_a").alias("image_id"), F.col("image_b").alias("other"), "relationship_score", "relationship_type").union(pairs.select("image_b", "image_a", "relationship_score", "relationship_type"))
    best = both.groupBy("image_id").agg(
        F.min_by("other", F.struct(-F.col("relationship_score"), "other")).alias("best_partner"),
        F.max("relationship_score").alias("best_score"),
        F.when(F.count_if(F.col("relationship_type") == "EXACT_DUPLICATE") > 0, "YA").otherwise("TIDAK").alias("exact_duplicate_flag"),
        F.when(F.count_if(F.col("relationship_type") == "NEAR_DUPLICATE") > 0, "YA").otherwise("TIDAK").alias("near_duplicate_flag"),
    )
    return (
        l1.select("image_id", "kode", "confidence")
        .join(l2.select("image_id", "cakupan_foto", "jumlah_belum_dinilai"), "image_id")
        .join(best, "image_id", "left")
        .join(members.select("image_id", "duplicate_group_id", "is_canonical"), "image_id", "left")
        .na.fill("TIDAK", ["exact_duplicate_flag", "near_duplicate_flag"])
    )
