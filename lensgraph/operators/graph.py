"""Duplicate clusters: connected components, their validation, members and canonical images."""

from __future__ import annotations

import gc
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lensgraph.config import RELATION_TYPES, ClusterValidation, Relationship
from lensgraph.functions.scalars import quality_score


CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder named by spark.checkpoint.dir.

    A folder of our own is made in local mode alone, where driver and executors
    are one machine; on a cluster a missing setting is an error.  The files of a
    checkpoint go once no plan refers to it any more, unless the session says
    otherwise, and so do the shuffle files behind earlier cuts.
    """
    context = df.sparkSession.sparkContext
    # Spark looks at this setting whenever it checkpoints.
    context._jsc.sc().conf().setIfMissing("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a shared folder")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    # Spark deletes what no plan needs once the driver has collected the plans.
    gc.collect()
    context._jvm.System.gc()
    # Its own shuffle files go as soon as it is written.
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_SHUFFLES, None)
    conf.set(CLEAN_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        conf.set(CLEAN_SHUFFLES, before) if before is not None else conf.unset(CLEAN_SHUFFLES)


def connected_components(edges: DataFrame, a: str = "image_a", b: str = "image_b") -> DataFrame:
    """(image_id, component) of every image with an edge; the component is its smallest image id.

    Minimum labels spread along edges and are followed to their own labels in
    each round, so the rounds grow with the logarithm of the longest path.
    Labels move by joins and combinable minima; nothing is collected but one count.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    both = cut_lineage(both.union(both.select("v", "u")).distinct())
    labels = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("image_id"), F.least("u", "m").alias("component")))
    while True:
        met = both.join(labels.withColumnRenamed("image_id", "v"), "v").groupBy("u").agg(F.min("component").alias("met"))
        lowered = labels.join(met, labels["image_id"] == met["u"]).select("image_id", F.col("component").alias("old"), F.least("component", "met").alias("low"))
        jump = labels.select(F.col("image_id").alias("low"), F.col("component").alias("far"))
        moved = cut_lineage(lowered.join(jump, "low", "left").select("image_id", "old", F.least("low", F.coalesce("far", "low")).alias("component")))
        changed = moved.where("old != component").limit(1).count()
        labels = moved.drop("old")
        if not changed:
            return labels


def _distances(edges: list[tuple[int, int]], n: int) -> int:
    """Longest shortest path of a connected graph: breadth-first search from every node at once, on boolean rows."""
    near = np.eye(n, dtype=bool)
    adjacent = np.zeros((n, n), dtype=bool)
    for i, j in edges:
        adjacent[i, j] = adjacent[j, i] = True
    steps = 0
    reached = near
    while not reached.all():
        wider = reached | (reached @ adjacent)
        if (wider == reached).all():
            break
        reached, steps = wider, steps + 1
    return steps


def diameters(grouped: DataFrame, limit: int = 4096) -> DataFrame:
    """(component, diameter) of each component's edges (component, image_a, image_b).

    Components go to one task each as their edges alone; one of more than
    ``limit`` images is measured by frontier joins instead.
    """
    sizes = grouped.select("component", F.explode(F.array("image_a", "image_b")).alias("i")).distinct().groupBy("component").count()
    small = grouped.join(sizes.where(F.col("count") <= limit).select("component"), "component", "left_semi")
    big = grouped.join(sizes.where(F.col("count") > limit).select("component"), "component", "left_semi")

    def measure(frame: pd.DataFrame) -> pd.DataFrame:
        names, codes = np.unique(np.concatenate((frame["image_a"], frame["image_b"])), return_inverse=True)
        pairs = codes.reshape(2, -1).T
        return pd.DataFrame({"component": [frame["component"].iloc[0]], "diameter": [_distances([tuple(p) for p in pairs], len(names))]})

    found = small.groupBy("component").applyInPandas(measure, "component string, diameter long")
    if big.isEmpty():
        return found
    return found.union(_frontier_diameters(big))


def _frontier_diameters(grouped: DataFrame) -> DataFrame:
    both = grouped.select("component", F.col("image_a").alias("u"), F.col("image_b").alias("v"))
    both = both.union(both.select("component", "v", "u")).distinct()
    seen = cut_lineage(both.select("component", F.col("u").alias("s"), F.col("u").alias("t")).distinct().withColumn("d", F.lit(0).cast("long")))
    step = 0
    while True:
        front = seen.where(F.col("d") == step)
        nxt = front.join(both.withColumnRenamed("u", "t"), ["component", "t"]).select("component", "s", F.col("v").alias("t")).distinct().join(seen, ["component", "s", "t"], "left_anti").withColumn("d", F.lit(step + 1).cast("long"))
        nxt = cut_lineage(nxt)
        if nxt.isEmpty():
            return seen.groupBy("component").agg(F.max("d").alias("diameter"))
        seen = cut_lineage(seen.unionByName(nxt))
        step += 1


def cluster_tables(scored: DataFrame, images: DataFrame, relationship: Relationship = Relationship(), validation: ClusterValidation = ClusterValidation()) -> tuple[DataFrame, DataFrame]:
    """(clusters, members) of scored pairs.

    Ties: the canonical image has the highest quality, then the smallest id; the
    dominant relation the highest count, then the order of RELATION_TYPES.
    Clusters are numbered in order of their smallest image.
    """
    linked = scored.where((F.col("relationship_type") != "UNRELATED") & (F.col("relationship_score") >= relationship.edge_threshold))
    linked = linked.select("image_a", "image_b", "relationship_score", "relationship_type")
    labels = connected_components(linked)
    inside = linked.join(labels.select(F.col("image_id").alias("image_a"), "component"), "image_a")
    stats = inside.groupBy("component").agg(
        F.avg("relationship_score").alias("avg_sim"),
        F.min("relationship_score").alias("min_sim"),
        (F.count_if(F.col("relationship_score") >= relationship.strong_edge_threshold) / F.count("*")).alias("strong"),
    )
    place = F.array_position(F.array(*map(F.lit, RELATION_TYPES)), F.col("relationship_type"))
    dominant = inside.groupBy("component", "relationship_type").count().groupBy("component").agg(F.max_by("relationship_type", F.struct("count", -place)).alias("relationship_type_dominant"))
    numbers = labels.select("component").distinct().withColumn("duplicate_group_id", F.format_string("DUP-%05d", F.row_number().over(Window.orderBy("component"))))
    rated = labels.join(images, "image_id").withColumn("quality_score", quality_score(F.col("kode_l1"), F.col("file_size")))
    own = rated.groupBy("component").agg(
        F.count("*").alias("jumlah_gambar"),
        F.array_join(F.array_sort(F.collect_list("image_id")), "; ").alias("member_images"),
        F.max("quality_score").alias("best"),
    )
    canonical = rated.join(own.select("component", "best"), "component").where("quality_score = best").groupBy("component").agg(F.min("image_id").alias("canonical_image"))
    clusters = own.join(canonical, "component").join(stats, "component").join(dominant, "component").join(diameters(inside.select("component", "image_a", "image_b")), "component").join(numbers, "component")
    norm = F.col("diameter") / F.greatest(F.lit(1), F.col("jumlah_gambar") - 1)
    clusters = clusters.withColumn("__norm", norm).withColumns(
        {
            "__low": F.col("min_sim") < validation.split_minimum_similarity,
            "__wide": F.col("__norm") > validation.max_diameter,
            "__sound": (F.col("avg_sim") >= validation.valid_average_similarity) & (F.col("min_sim") >= validation.valid_minimum_similarity) & (F.col("strong") >= validation.min_strong_edge_ratio),
        }
    )
    status = F.when(F.col("__low") | F.col("__wide"), "SPLIT_RECOMMENDED").when(F.col("__sound"), "VALID").otherwise("NEED_REVIEW")
    notes = F.when(F.col("__low"), "minimum_similarity_too_low").when(F.col("__wide"), "cluster_diameter_high").when(F.col("__sound"), "internal_similarity_consistent").otherwise("borderline_similarity_or_weak_edge_ratio")
    table = clusters.withColumn("cluster_status", status).select(
        "duplicate_group_id",
        "canonical_image",
        "jumlah_gambar",
        "member_images",
        F.round("avg_sim", 6).alias("average_similarity"),
        F.round("min_sim", 6).alias("minimum_similarity"),
        F.when(F.col("cluster_status") == "VALID", "HIGH").when(F.col("cluster_status") == "NEED_REVIEW", "MEDIUM").otherwise("LOW").alias("cluster_confidence"),
        "cluster_status",
        notes.alias("cluster_validation_notes"),
        F.round("strong", 6).alias("strong_edge_ratio"),
        F.round("__norm", 6).alias("cluster_diameter"),
        "relationship_type_dominant",
    )
    members = (
        rated.join(numbers, "component")
        .join(canonical, "component")
        .select("duplicate_group_id", "image_id", "nama_file", "path_rel", "ultg", "kode_l1", F.when(F.col("image_id") == F.col("canonical_image"), "YA").otherwise("TIDAK").alias("is_canonical"), "quality_score")
    )
    return table, members
