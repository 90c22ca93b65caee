"""First layer: can a photo be judged at all?  One ordered cascade of Columns, no UDF."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lensgraph.config import CODE_NAMES, REASONS


@dataclass(frozen=True)
class Thresholds:
    noise_edge: float = 55
    noise_sky: float = 0.12
    noise_chroma: float = 25
    noise_edge_alone: float = 70
    noise_dark: float = 0.45
    object_green: int = 4
    object_comp: int = 8
    object_dark: float = 0.035
    object_green_tiny: int = 2
    object_comp_tiny: int = 4
    object_dark_tiny: float = 0.018
    blur_edge_green: float = 18.5
    blur_green: int = 20
    blur_dark_green: float = 0.015
    blur_edge_comp: float = 17
    blur_comp: int = 20
    blur_dark_comp: float = 0.03
    blur_sure: float = 16
    glare_clip: float = 0.12
    glare_luma: float = 205
    gloom_luma: float = 88
    gloom_dark: float = 0.35
    glare_clip_sure: float = 0.22
    glare_luma_sure: float = 220
    hidden_vegetation: float = 0.14
    hidden_dark: float = 0.18
    hidden_sky: float = 0.10
    hidden_sure: float = 0.22
    far_green: int = 18
    far_comp: int = 28
    far_green_dim: int = 12
    far_dark_dim: float = 0.06
    far_green_sure: int = 9
    far_comp_sure: int = 16
    cropped_long: int = 25
    cropped_short: int = 20
    cropped_area: int = 1200
    fit_green: int = 35
    fit_edge: float = 24
    fit_clip: float = 0.05
    fair_green: int = 22
    fair_edge: float = 21


def predicates(t: Thresholds) -> list[tuple[str, Column, Column]]:
    """(code, predicate, confidence) in order of priority.  A null metric makes its comparisons unknown, which do not match."""
    c = F.col
    vegetation = F.coalesce(F.expr("try_cast(vegetasi_ratio AS double)"), F.lit(0.0))
    sure = lambda when: F.when(when, F.lit("tinggi")).otherwise(F.lit("sedang"))
    noise = (c("edge_mean") > t.noise_edge) & (c("sky_ratio") < t.noise_sky) & (c("chroma_std") > t.noise_chroma)
    return [
        ("D", ~c("status_baca").eqNullSafe(F.lit("OK")) | (noise & ((c("edge_mean") > t.noise_edge_alone) | (c("dark_ratio") > t.noise_dark))), F.lit("tinggi")),
        (
            "O",
            ((c("green_long") <= t.object_green) & (c("comp_long") <= t.object_comp) & (c("dark_ratio") > t.object_dark))
            | ((c("green_long") <= t.object_green_tiny) & (c("comp_long") <= t.object_comp_tiny) & (c("dark_ratio") > t.object_dark_tiny)),
            F.lit("rendah"),
        ),
        (
            "B",
            ((c("edge_mean") < t.blur_edge_green) & (c("green_long") >= t.blur_green) & (c("dark_ratio") >= t.blur_dark_green))
            | ((c("edge_mean") < t.blur_edge_comp) & (c("comp_long") >= t.blur_comp) & (c("dark_ratio") >= t.blur_dark_comp)),
            sure(c("edge_mean") < t.blur_sure),
        ),
        (
            "K",
            (c("clip_terang") >= t.glare_clip) | (c("mean_luma") >= t.glare_luma) | ((c("mean_luma") < t.gloom_luma) & (c("dark_ratio") > t.gloom_dark)),
            sure((c("clip_terang") >= t.glare_clip_sure) | (c("mean_luma") >= t.glare_luma_sure)),
        ),
        ("H", (vegetation >= t.hidden_vegetation) & (c("dark_ratio") >= t.hidden_dark) & (c("sky_ratio") >= t.hidden_sky), sure(vegetation >= t.hidden_sure)),
        (
            "J",
            ((c("green_long") < t.far_green) & (c("comp_long") < t.far_comp)) | ((c("green_long") < t.far_green_dim) & (c("dark_ratio") < t.far_dark_dim)),
            sure((c("green_long") < t.far_green_sure) & (c("comp_long") < t.far_comp_sure)),
        ),
        ("P", (c("green_touch") == 1) & (c("green_long") >= t.cropped_long) & (c("green_short") <= t.cropped_short) & (c("green_area") <= t.cropped_area), F.lit("sedang")),
    ]


def decision(t: Thresholds = Thresholds()) -> Column:
    """struct(kode, confidence, alasan): the first predicate that holds, else S."""
    fit = F.when((F.col("green_long") >= t.fit_green) & (F.col("edge_mean") >= t.fit_edge) & (F.col("clip_terang") < t.fit_clip), "tinggi").when((F.col("green_long") >= t.fair_green) & (F.col("edge_mean") >= t.fair_edge), "sedang").otherwise("rendah")
    result = lambda code, confidence: F.struct(F.lit(code).alias("kode"), confidence.alias("confidence"), F.lit(REASONS[code]).alias("alasan"))
    chain = None
    for code, holds, confidence in predicates(t):
        chain = F.when(holds, result(code, confidence)) if chain is None else chain.when(holds, result(code, confidence))
    return chain.otherwise(result("S", fit))


def classify(metrics: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """``metrics`` with kode, nama_keputusan, prioritas, confidence, perlu_review_manual and alasan."""
    names = F.create_map(*(F.lit(x) for code, (name, _) in CODE_NAMES.items() for x in (code, name)))
    priorities = F.create_map(*(F.lit(x) for code, (_, p) in CODE_NAMES.items() if p is not None for x in (code, p)))
    decided = metrics.withColumn("__d", decision(thresholds)).select("*", "__d.*").drop("__d")
    return decided.withColumns(
        {
            "nama_keputusan": F.element_at(names, F.col("kode")),
            "prioritas": F.try_element_at(priorities, F.col("kode")),
            "perlu_review_manual": F.when(F.col("confidence") == "rendah", "YA").otherwise("TIDAK"),
        }
    )


# The result's columns in order.
OUTPUT = [
    "ultg", "nama_file", "path_rel", "kode", "nama_keputusan", "prioritas",
    "confidence", "perlu_review_manual", "alasan", "lebar", "tinggi", "ukuran_byte",
    "mean_luma", "clip_gelap", "clip_terang", "edge_mean", "dark_ratio", "sky_ratio",
    "vegetasi_ratio", "green_long", "green_short", "green_touch", "comp_long", "comp_short",
    "chroma_std", "status_baca",
]
# End of the fixed values.


def result_table(metrics: DataFrame) -> DataFrame:
    """The 26 ordered output columns; a metric that the input lacks is null."""
    decided = classify(metrics)
    vegetation = F.coalesce(F.expr("try_cast(vegetasi_ratio AS double)"), F.lit(0.0)).alias("vegetasi_ratio")
    return decided.select(*(vegetation if c == "vegetasi_ratio" else F.col(c) if c in decided.columns else F.lit(None).cast("string").alias(c) for c in OUTPUT))
