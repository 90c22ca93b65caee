"""Second layer: eleven descriptive features of a photo, as Columns; the first layer's code never changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lensgraph.config import FEATURES, SEMANTIC_FEATURES, UNASSESSED

#: What a missing metric stands for, where that is not 0.
DEFAULTS = {"mean_luma": 127.0, "thumb_h": 213.0}
_METRICS = "green_long comp_long green_short sky_ratio dark_ratio vegetasi_ratio mean_luma edge_mean clip_terang chroma_std green_area candidate_ratio green_touch green_w green_h comp_w comp_h thumb_h".split()


def number(name: str) -> Column:
    """A metric as a double, null and NaN replaced by its default."""
    value = F.expr(f"try_cast({name} AS double)")
    return F.when(value.isNull() | F.isnan(value), F.lit(DEFAULTS.get(name, 0.0))).otherwise(value)


def first_of(*arms: tuple[Column, str], default: str) -> Column:
    chain = reduce(lambda acc, arm: acc.when(arm[0], arm[1]) if acc is not None else F.when(arm[0], arm[1]), arms, None)
    return chain.otherwise(F.lit(default))


def _is(name: str, *values: str) -> Column:
    return F.col(name).isin(*values)


def features(photos: DataFrame) -> DataFrame:
    """``photos`` (with kode, confidence and the metrics) with the features and their status columns."""
    ready = photos.withColumns({f"__{m}": number(m) if m in photos.columns else F.lit(DEFAULTS.get(m, 0.0)) for m in _METRICS})
    v = lambda name: F.col(f"__{name}")
    green_box = (v("green_long") >= v("comp_long")) & (v("green_w") * v("green_h") != 0)
    sized = ready.withColumns(
        {
            "__size": F.greatest(v("green_long"), v("comp_long")) / F.greatest(v("thumb_h"), F.lit(1.0)),
            "__bw": F.when(green_box, v("green_w")).otherwise(v("comp_w")),
            "__bh": F.when(green_box, v("green_h")).otherwise(v("comp_h")),
            "__touch": v("green_touch").cast("int") != 0,
        }
    )
    size, sky, dark = v("size"), v("sky_ratio"), v("dark_ratio")
    close = (size >= 0.40) & (sky < 0.55)
    coverage = first_of(
        (close & (v("green_area") < 1100), "closeup_1_renteng"),
        (close, "closeup_beberapa_renteng"),
        (size >= 0.27, "closeup_beberapa_renteng"),
        (size >= 0.17, "setengah_tower"),
        (size >= 0.09, "tower_penuh"),
        (sky >= 0.52, "tower_dan_lanskap"),
        default="tower_penuh",
    )
    described = sized.withColumn("cakupan_foto", coverage).withColumns(
        {
            "ragu2": first_of(((F.col("confidence") == "rendah") & _is("kode", "S", "J"), "ya"), default="tidak"),
            "jumlah_renteng_terbaca": first_of((_is("kode", "O", "D"), "0"), (_is("kode", "S") & (F.col("cakupan_foto") == "closeup_1_renteng"), "1"), default=UNASSESSED),
            "arah_isolator": first_of((_is("kode", "D", "O") | (F.least("__bw", "__bh") < 3), "NA"), (v("bh") >= 2.0 * v("bw"), "vertikal"), (v("bw") >= 2.0 * v("bh"), "horizontal"), default="miring"),
            "bahan_isolator": F.lit("tidak_jelas"),
            "cahaya": first_of(
                (v("mean_luma") < 85, "terlalu_gelap"),
                ((v("clip_terang") >= 0.11) | (v("mean_luma") >= 205), "terlalu_terang"),
                ((v("clip_terang") >= 0.025) & (sky >= 0.22), "flare"),
                ((sky >= 0.38) & (dark >= 0.19) & (v("mean_luma") < 145), "backlit"),
                ((v("mean_luma") < 135) & (v("edge_mean") < 22) & (sky >= 0.20), "berkabut"),
                default="normal",
            ),
            "ketajaman": first_of((_is("kode", "B") | (v("edge_mean") < 17), "blur"), (v("edge_mean") < 25, "sedikit_blur"), default="tajam"),
            "noise": first_of(((v("chroma_std") > 35) & (dark > 0.30), "banyak_noise"), ((v("chroma_std") > 25) & (dark > 0.18), "sedikit_noise"), default="bersih"),
            "halangan": first_of((_is("kode", "H") & (v("vegetasi_ratio") >= 0.14), "pohon"), (_is("kode", "H"), UNASSESSED), default="tidak_ada"),
            "isi_frame_terbanyak": first_of(
                ((sky >= 0.67) & (dark < 0.18), "langit_lanskap"),
                ((dark >= 0.38) & (sky < 0.35), "rangka_tower"),
                ((v("candidate_ratio") >= 0.16) & (sky < 0.25), "piringan_isolator"),
                ((sky >= 0.38) & (dark >= 0.18), "seimbang"),
                default=UNASSESSED,
            ),
            "bagian_renteng_terlihat": first_of(
                (_is("kode", "D", "O"), "NA"),
                (_is("kode", "P") & F.col("__touch"), UNASSESSED),
                (F.col("__touch") & (size >= 0.12), UNASSESSED),
                (_is("kode", "S") & (size >= 0.20), "utuh"),
                default=UNASSESSED,
            ),
        }
    )
    named = lambda names: F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names))
    missing = F.transform(F.filter(named(FEATURES), lambda f: f["value"] == UNASSESSED), lambda f: f["name"])
    described = described.withColumn("__missing", missing)
    out = described.withColumns(
        {
            "status_lapis2": F.lit("PERLU_VALIDASI"),
            "metode": F.lit("proksi_metrik_lapis1"),
            "jumlah_belum_dinilai": F.size("__missing"),
            "ciri_belum_dinilai": F.array_join("__missing", ", "),
            "ciri_semantik_perlu_verifikasi": F.array_join(F.array_except(F.array(*map(F.lit, SEMANTIC_FEATURES)), F.col("__missing")), ", "),
        }
    )
    return out.drop(*(c for c in out.columns if c.startswith("__")))


def long_form(described: DataFrame, *keep: str) -> DataFrame:
    """(keep..., ciri, nilai): one row for each photo and feature."""
    return described.unpivot(list(keep), list(FEATURES), "ciri", "nilai")
