"""Queries over the two photo layers, the register, samples and profiles, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lensgraph.config import CODE_NAMES, FEATURES, REASONS, SEMANTIC_FEATURES, UNASSESSED
from lensgraph.operators import expectations, l1, l2, profile, reconcile, sampling
from lensgraph.plans import fixtures

CODES = list(CODE_NAMES)
METRICS = list(fixtures.METRICS)


def _l1(spark: SparkSession, d: str) -> DataFrame:
    return l1.classify(fixtures.photos(spark, d))


def _l2(spark: SparkSession, d: str) -> DataFrame:
    return l2.features(_l1(spark, d))


def _case(rows: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in rows) + f" ELSE {default} END"


_VEG = "coalesce(vegetasi_ratio, 0)"
_SURE = "CASE WHEN {} THEN 'tinggi' ELSE 'sedang' END"
_RULES = [
    ("D", "status_baca <> 'OK' OR (edge_mean > 55 AND sky_ratio < 0.12 AND chroma_std > 25 AND (edge_mean > 70 OR dark_ratio > 0.45))", "'tinggi'"),
    ("O", "(green_long <= 4 AND comp_long <= 8 AND dark_ratio > 0.035) OR (green_long <= 2 AND comp_long <= 4 AND dark_ratio > 0.018)", "'rendah'"),
    ("B", "(edge_mean < 18.5 AND green_long >= 20 AND dark_ratio >= 0.015) OR (edge_mean < 17 AND comp_long >= 20 AND dark_ratio >= 0.03)", _SURE.format("edge_mean < 16")),
    ("K", "clip_terang >= 0.12 OR mean_luma >= 205 OR (mean_luma < 88 AND dark_ratio > 0.35)", _SURE.format("clip_terang >= 0.22 OR mean_luma >= 220")),
    ("H", f"{_VEG} >= 0.14 AND dark_ratio >= 0.18 AND sky_ratio >= 0.10", _SURE.format(f"{_VEG} >= 0.22")),
    ("J", "(green_long < 18 AND comp_long < 28) OR (green_long < 12 AND dark_ratio < 0.06)", _SURE.format("green_long < 9 AND comp_long < 16")),
    ("P", "green_touch = 1 AND green_long >= 25 AND green_short <= 20 AND green_area <= 1200", "'sedang'"),
]
_FIT = "CASE WHEN green_long >= 35 AND edge_mean >= 24 AND clip_terang < 0.05 THEN 'tinggi' WHEN green_long >= 22 AND edge_mean >= 21 THEN 'sedang' ELSE 'rendah' END"
_L1_ONLY = f"""l1a AS (SELECT *, {_case([(w, f"'{c}'") for c, w, _ in _RULES], "'S'")} AS kode FROM photos),
l1 AS (SELECT *, {_case([(f"kode = '{c}'", f"({conf})") for c, _, conf in _RULES], _FIT)} AS confidence,
  {_case([(f"kode = '{c}'", f"'{r}'") for c, r in REASONS.items()], "NULL")} AS alasan,
  {_case([(f"kode = '{c}'", f"'{n}'") for c, (n, _) in CODE_NAMES.items()], "NULL")} AS nama_keputusan,
  {_case([(f"kode = '{c}'", str(p)) for c, (_, p) in CODE_NAMES.items() if p is not None], "NULL")} AS prioritas FROM l1a),
r1 AS (SELECT *, CASE WHEN confidence = 'rendah' THEN 'YA' ELSE 'TIDAK' END AS perlu_review_manual FROM l1)"""
L1_SQL = f"WITH {fixtures.PHOTOS_SQL}, {_L1_ONLY} "


def _n(name: str) -> str:
    return f"coalesce({name}, {l2.DEFAULTS.get(name, 0.0)})::DOUBLE"


_F2 = [
    ("ragu2", "CASE WHEN confidence = 'rendah' AND kode IN ('S', 'J') THEN 'ya' ELSE 'tidak' END"),
    ("jumlah_renteng_terbaca", f"CASE WHEN kode IN ('O', 'D') THEN '0' WHEN kode = 'S' AND cakupan_foto = 'closeup_1_renteng' THEN '1' ELSE '{UNASSESSED}' END"),
    ("arah_isolator", "CASE WHEN kode IN ('D', 'O') OR least(bw, bh) < 3 THEN 'NA' WHEN bh >= 2 * bw THEN 'vertikal' WHEN bw >= 2 * bh THEN 'horizontal' ELSE 'miring' END"),
    ("bahan_isolator", "'tidak_jelas'"),
    ("cahaya", f"CASE WHEN {_n('mean_luma')} < 85 THEN 'terlalu_gelap' WHEN {_n('clip_terang')} >= 0.11 OR {_n('mean_luma')} >= 205 THEN 'terlalu_terang' WHEN {_n('clip_terang')} >= 0.025 AND {_n('sky_ratio')} >= 0.22 THEN 'flare' WHEN {_n('sky_ratio')} >= 0.38 AND {_n('dark_ratio')} >= 0.19 AND {_n('mean_luma')} < 145 THEN 'backlit' WHEN {_n('mean_luma')} < 135 AND {_n('edge_mean')} < 22 AND {_n('sky_ratio')} >= 0.20 THEN 'berkabut' ELSE 'normal' END"),
    ("ketajaman", f"CASE WHEN kode = 'B' OR {_n('edge_mean')} < 17 THEN 'blur' WHEN {_n('edge_mean')} < 25 THEN 'sedikit_blur' ELSE 'tajam' END"),
    ("noise", f"CASE WHEN {_n('chroma_std')} > 35 AND {_n('dark_ratio')} > 0.30 THEN 'banyak_noise' WHEN {_n('chroma_std')} > 25 AND {_n('dark_ratio')} > 0.18 THEN 'sedikit_noise' ELSE 'bersih' END"),
    ("halangan", f"CASE WHEN kode = 'H' AND {_n('vegetasi_ratio')} >= 0.14 THEN 'pohon' WHEN kode = 'H' THEN '{UNASSESSED}' ELSE 'tidak_ada' END"),
    ("isi_frame_terbanyak", f"CASE WHEN {_n('sky_ratio')} >= 0.67 AND {_n('dark_ratio')} < 0.18 THEN 'langit_lanskap' WHEN {_n('dark_ratio')} >= 0.38 AND {_n('sky_ratio')} < 0.35 THEN 'rangka_tower' WHEN {_n('candidate_ratio')} >= 0.16 AND {_n('sky_ratio')} < 0.25 THEN 'piringan_isolator' WHEN {_n('sky_ratio')} >= 0.38 AND {_n('dark_ratio')} >= 0.18 THEN 'seimbang' ELSE '{UNASSESSED}' END"),
    ("bagian_renteng_terlihat", f"CASE WHEN kode IN ('D', 'O') THEN 'NA' WHEN kode = 'P' AND {_n('green_touch')} <> 0 THEN '{UNASSESSED}' WHEN {_n('green_touch')} <> 0 AND size >= 0.12 THEN '{UNASSESSED}' WHEN kode = 'S' AND size >= 0.20 THEN 'utuh' ELSE '{UNASSESSED}' END"),
]
_GREEN_BOX = f"{_n('green_long')} >= {_n('comp_long')} AND {_n('green_w')} * {_n('green_h')} <> 0"
L2_SQL = f"""{L1_SQL}, s2 AS (SELECT *, greatest({_n('green_long')}, {_n('comp_long')}) / greatest({_n('thumb_h')}, 1) AS size,
  CASE WHEN {_GREEN_BOX} THEN {_n('green_w')} ELSE {_n('comp_w')} END AS bw, CASE WHEN {_GREEN_BOX} THEN {_n('green_h')} ELSE {_n('comp_h')} END AS bh FROM r1),
c2 AS (SELECT *, CASE WHEN size >= 0.40 AND {_n('sky_ratio')} < 0.55 AND {_n('green_area')} < 1100 THEN 'closeup_1_renteng' WHEN size >= 0.40 AND {_n('sky_ratio')} < 0.55 THEN 'closeup_beberapa_renteng'
  WHEN size >= 0.27 THEN 'closeup_beberapa_renteng' WHEN size >= 0.17 THEN 'setengah_tower' WHEN size >= 0.09 THEN 'tower_penuh' WHEN {_n('sky_ratio')} >= 0.52 THEN 'tower_dan_lanskap' ELSE 'tower_penuh' END AS cakupan_foto FROM s2),
f2 AS (SELECT *, {", ".join(f"{e} AS {n}" for n, e in _F2)} FROM c2),
l2 AS (SELECT *, list_filter([{", ".join(f"CASE WHEN {f} = '{UNASSESSED}' THEN '{f}' END" for f in FEATURES)}], lambda x: x IS NOT NULL) AS gaps FROM f2) """
_LONG_SQL = f"{L2_SQL}, long AS (UNPIVOT (SELECT doc_id, kode, {', '.join(FEATURES)} FROM l2) ON {', '.join(FEATURES)} INTO NAME ciri VALUE nilai) "


def l1_decision(spark, d):
    return _l1(spark, d).select("path_rel", "kode", "nama_keputusan", "prioritas", "confidence", "perlu_review_manual", "alasan")


def l1_by_code(spark, d):
    return _l1(spark, d).groupBy("kode").agg(F.count("*").alias("n"), F.count_if(F.col("perlu_review_manual") == "YA").alias("review"))


def l1_by_region_code(spark, d):
    return _l1(spark, d).groupBy("ultg", "kode").agg(F.count("*").alias("n"))


def l1_review_queue(spark, d):
    return _l1(spark, d).where("perlu_review_manual = 'YA'").select("path_rel", "kode", "alasan")


def l1_pass_rate(spark, d):
    per = _l1(spark, d).groupBy("ultg").agg(F.count("*").alias("total"), F.count_if(F.col("kode") == "S").alias("sesuai"))
    return per.select("ultg", "total", "sesuai", F.round(F.col("sesuai") / F.col("total"), 6).alias("rate"), F.round(F.col("total") / F.sum("total").over(Window.partitionBy()), 6).alias("share"))


def l1_result_table(spark, d):
    return l1.result_table(fixtures.photos(spark, d))


def l2_features(spark, d):
    return _l2(spark, d).select("path_rel", *FEATURES, "status_lapis2", "metode", "jumlah_belum_dinilai", "ciri_belum_dinilai", "ciri_semantik_perlu_verifikasi")


def l2_feature_counts(spark, d):
    return l2.long_form(_l2(spark, d), "doc_id").groupBy("ciri", "nilai").agg(F.count("*").alias("n"))


def l2_feature_code_matrix(spark, d):
    return profile.feature_code_matrix(l2.long_form(_l2(spark, d), "kode"), CODES)


def l2_gap_stats(spark, d):
    gaps = F.col("jumlah_belum_dinilai")
    return _l2(spark, d).groupBy("ultg").agg(F.count("*").alias("total"), F.count_if(gaps > 0).alias("with_gaps"), F.sum(gaps).alias("gap_cells"))


def l2_composition(spark, d):
    v = F.col("nilai")
    return l2.long_form(_l2(spark, d), "doc_id").groupBy("ciri").agg(F.count_if(~v.isin(UNASSESSED, "tidak_jelas")).alias("filled"), F.count_if(v == UNASSESSED).alias("pending"), F.count_if(v == "tidak_jelas").alias("unclear"))


def _photos_with_master(spark, d):
    return reconcile.in_scope(reconcile.lookup(_l1(spark, d), fixtures.master(spark, d), ["ultg", "nama_file"]))


def scope_join(spark, d):
    return _photos_with_master(spark, d).select("path_rel", "kode", "asset_norm", "file_id")


def master_unmatched_anti(spark, d):
    return reconcile.unmatched(fixtures.master(spark, d), _l1(spark, d), ["ultg", "nama_file"]).select("ultg", "nama_file")


def master_match_profile(spark, d):
    return reconcile.match_profile(_l1(spark, d), fixtures.master(spark, d), ["ultg", "nama_file"])


def master_status_map(spark, d):
    return reconcile.mapped(fixtures.master(spark, d), "kelompok", {"LENGKAP": "LENGKAP_DI_MASTER", "SEBAGIAN": "PERLU_LENGKAPI"}, "PERLU_CEK").select("file_id", "kelompok", F.col("mapped").alias("status_master"))


def code_change_check(spark, d):
    changed = _l2(spark, d).select("path_rel", F.when(F.pmod("doc_id", F.lit(50)) == 7, "X").otherwise(F.col("kode")).alias("kode"))
    return reconcile.edits(_l1(spark, d).select("path_rel", "kode"), changed, ["path_rel"], ["kode"])


def edits_detected(spark, d):
    base = fixtures.master(spark, d).select("file_id", "in_scope", "kelompok")
    edited = base.withColumns({"in_scope": F.when(F.col("kelompok") == "LAIN", F.lit(None)).otherwise(F.col("in_scope")), "kelompok": F.when(F.col("in_scope").isNull(), "BARU").otherwise(F.col("kelompok"))})
    return reconcile.edits(base, edited, ["file_id"], ["in_scope", "kelompok"])


def key_duplicates(spark, d):
    return reconcile.duplicate_keys(fixtures.master(spark, d).select("ultg", "asset_norm"), ["ultg", "asset_norm"])


def border_optional_join(spark, d):
    border = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", (F.pmod("doc_id", F.lit(40)) * 3).alias("green_border_pixels"))
    return reconcile.optional_join(_l1(spark, d), border, ["doc_id"], {"green_border_pixels": 0}).select("path_rel", "kode", "green_border_pixels")


def column_guard(spark, d):
    return reconcile.public_columns(_photos_with_master(spark, d).select("path_rel", "kode", "in_scope", "kelompok", "asset_norm", "file_id"), {"in_scope", "kelompok", "asset_norm", "file_id"})


STRATA = ["ultg", "kode"]


def sample_greedy(spark, d):
    photos = _l1(spark, d)
    return sampling.stratified(photos, STRATA, photos.count() * 8 // 10, "greedy").select("path_rel", "ultg", "kode", "place")


def sample_round_robin(spark, d):
    return sampling.stratified(_l1(spark, d), STRATA, 260, "round_robin").select("path_rel", "ultg", "kode", "place")


def sample_per_group_hash(spark, d):
    return sampling.pick(_l1(spark, d), ["ultg"], F.lit(25)).select("path_rel", "ultg", "place")


def sample_seeded(spark, d):
    return sampling.seeded_sample(fixtures.photos(spark, d), 25, 11).select("path_rel")


def calibration_slices(spark, d):
    return profile.calibration_slices(fixtures.photos(spark, d))


def quantile_table(spark, d):
    return profile.quantiles(fixtures.photos(spark, d), ["edge_mean", "dark_ratio", "clip_terang"], profile.QUANTILES)


def lineitem_quantiles(spark, d):
    return profile.quantiles(spark.read.parquet(f"{d}/lineitem.parquet"), ["l_quantity", "l_extendedprice"], profile.QUANTILES)


def profile_nulls(spark, d):
    return profile.null_counts(fixtures.photos(spark, d).select("doc_id", "ultg", *METRICS)).orderBy(F.desc("nulls"), "column").limit(25)


def crosstab_code_asset(spark, d):
    return profile.crosstab(_photos_with_master(spark, d), "kode", "asset_norm", [f"A{i}" for i in range(5)])


def describe_metrics(spark, d):
    return profile.describe(fixtures.photos(spark, d), ["mean_luma", "edge_mean"])


def value_counts_head(spark, d):
    return fixtures.photos(spark, d).groupBy("green_long").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "green_long").limit(15)


def layer_expectations(spark, d):
    return expectations.run(
        [
            expectations.unique("photo path", _l1(spark, d), ["path_rel"]),
            expectations.unique("register key", fixtures.master(spark, d), ["ultg", "nama_file"]),
            expectations.references("register has photo", fixtures.master(spark, d), _l1(spark, d), ["ultg", "nama_file"]),
            expectations.domain("code", _l1(spark, d), "kode", CODES),
            expectations.domain("confidence", _l1(spark, d), "confidence", ["tinggi", "sedang", "rendah"]),
            expectations.within("dark ratio", _l1(spark, d), "dark_ratio", 0.0, 0.5),
            expectations.filled("features", l2.long_form(_l2(spark, d), "doc_id"), "nilai"),
            expectations.row_count("photos", _l1(spark, d), spark.read.parquet(f"{d}/documents.parquet").count()),
            expectations.unit_norm("embeddings", spark.read.parquet(f"{d}/embeddings.parquet"), "embedding", 64),
        ]
    )


def _quota_sql(target: str, least: int, method: str) -> str:
    order = "p DESC, first_seen" if method == "greedy" else "k, p DESC, first_seen"
    return f"""{L1_SQL}, g AS (SELECT ultg, kode, count(*) AS n, min(path_rel) AS first_seen, least(count(*), greatest({least}, round(2 * sqrt(count(*)))))::BIGINT AS fl FROM r1 GROUP BY ALL),
    seats AS (SELECT ultg, kode, first_seen, k, (n - fl - k) / sqrt(n) AS p FROM (SELECT *, unnest(range(0, n - fl)) AS k FROM g WHERE n > fl)),
    dealt AS (SELECT ultg, kode, count(*) AS extra FROM (SELECT * FROM seats ORDER BY {order} LIMIT greatest(0, {target} - (SELECT sum(fl) FROM g))::BIGINT) GROUP BY ALL),
    q AS (SELECT g.ultg, g.kode, fl + coalesce(extra, 0) AS quota FROM g LEFT JOIN dealt USING (ultg, kode))
    SELECT path_rel, ultg, kode, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY ultg, kode ORDER BY sha256(path_rel), path_rel) AS place FROM r1) JOIN q USING (ultg, kode) WHERE place <= quota"""


#: Written out by hand, so that a wrong table of slices cannot be right on both sides.
_CALIBRATION_SQL = """, q AS (SELECT quantile_cont(dark_ratio, 0.65) AS dark65, quantile_cont(comp_long, 0.15) AS comp15, quantile_cont(comp_long, 0.45) AS comp45, quantile_cont(comp_long, 0.55) AS comp55,
    quantile_cont(comp_long, 0.65) AS comp65, quantile_cont(green_long, 0.20) AS green20, quantile_cont(green_long, 0.45) AS green45, quantile_cont(green_long, 0.55) AS green55 FROM photos),
p AS (SELECT * FROM photos, q)
SELECT * FROM (SELECT 'edge_low' AS slice, path_rel FROM p WHERE edge_mean IS NOT NULL ORDER BY edge_mean, path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'edge_low_close', path_rel FROM p WHERE dark_ratio >= dark65 ORDER BY edge_mean, path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'bright_high', path_rel FROM p WHERE clip_terang IS NOT NULL ORDER BY clip_terang DESC, path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'dark_high', path_rel FROM p WHERE clip_gelap IS NOT NULL ORDER BY clip_gelap DESC, path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'candidate_low', path_rel FROM p WHERE comp_long IS NOT NULL ORDER BY comp_long, path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'candidate_small', path_rel FROM p WHERE comp_long > 0 AND comp_long <= comp15 ORDER BY sha256('11:' || path_rel), path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'candidate_mid', path_rel FROM p WHERE comp_long BETWEEN comp45 AND comp55 ORDER BY sha256('12:' || path_rel), path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'candidate_large', path_rel FROM p WHERE comp_long IS NOT NULL ORDER BY comp_long DESC, path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'touch_large', path_rel FROM p WHERE comp_touch = 1 AND comp_long >= comp65 ORDER BY sha256('13:' || path_rel), path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'vegetation_high', path_rel FROM p WHERE vegetasi_ratio IS NOT NULL ORDER BY vegetasi_ratio DESC, path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'no_candidate_dark', path_rel FROM p WHERE comp_long <= 8 AND dark_ratio >= 0.08 ORDER BY dark_ratio DESC, path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'chroma_high', path_rel FROM p WHERE chroma_std IS NOT NULL ORDER BY chroma_std DESC, path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'green_small', path_rel FROM p WHERE green_long > 0 AND green_long <= green20 ORDER BY sha256('14:' || path_rel), path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'green_mid', path_rel FROM p WHERE green_long BETWEEN green45 AND green55 ORDER BY sha256('15:' || path_rel), path_rel LIMIT 25)
UNION ALL SELECT * FROM (SELECT 'green_large', path_rel FROM p WHERE green_long IS NOT NULL ORDER BY green_long DESC, path_rel LIMIT 25)"""
_SCOPED = f"{L1_SQL}, {fixtures.MASTER_SQL}, sc AS (SELECT r1.*, asset_norm, file_id, kelompok FROM r1 JOIN master USING (ultg, nama_file) WHERE in_scope) "

QUERIES = {f.__name__: f for f in (l1_decision, l1_by_code, l1_by_region_code, l1_review_queue, l1_pass_rate, l1_result_table, l2_features, l2_feature_counts, l2_feature_code_matrix, l2_gap_stats, l2_composition, scope_join, master_unmatched_anti, master_match_profile, master_status_map, code_change_check, edits_detected, key_duplicates, border_optional_join, column_guard, sample_greedy, sample_round_robin, sample_per_group_hash, sample_seeded, calibration_slices, quantile_table, lineitem_quantiles, profile_nulls, crosstab_code_asset, describe_metrics, value_counts_head, layer_expectations)}

ORACLE_SQL = {
    "l1_decision": L1_SQL + "SELECT path_rel, kode, nama_keputusan, prioritas, confidence, perlu_review_manual, alasan FROM r1",
    "l1_by_code": L1_SQL + "SELECT kode, count(*) AS n, count(*) FILTER (perlu_review_manual = 'YA') AS review FROM r1 GROUP BY 1",
    "l1_by_region_code": L1_SQL + "SELECT ultg, kode, count(*) AS n FROM r1 GROUP BY ALL",
    "l1_review_queue": L1_SQL + "SELECT path_rel, kode, alasan FROM r1 WHERE perlu_review_manual = 'YA'",
    "l1_pass_rate": L1_SQL + "SELECT ultg, count(*) AS total, count(*) FILTER (kode = 'S') AS sesuai, round(count(*) FILTER (kode = 'S') / count(*), 6) AS rate, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM r1 GROUP BY 1",
    "l1_result_table": L1_SQL + "SELECT ultg, nama_file, path_rel, kode, nama_keputusan, prioritas, confidence, perlu_review_manual, alasan, lebar, tinggi, ukuran_byte, mean_luma, clip_gelap, clip_terang, edge_mean, dark_ratio, sky_ratio, coalesce(vegetasi_ratio, 0) AS vegetasi_ratio, green_long, green_short, green_touch, comp_long, comp_short, chroma_std, status_baca FROM r1",
    "l2_features": L2_SQL
    + f"SELECT path_rel, {', '.join(FEATURES)}, 'PERLU_VALIDASI' AS status_lapis2, 'proksi_metrik_lapis1' AS metode, len(gaps)::INT AS jumlah_belum_dinilai, array_to_string(gaps, ', ') AS ciri_belum_dinilai, array_to_string(list_filter([{', '.join(repr(f) for f in SEMANTIC_FEATURES)}], lambda x: NOT list_contains(gaps, x)), ', ') AS ciri_semantik_perlu_verifikasi FROM l2",
    "l2_feature_counts": _LONG_SQL + "SELECT ciri, nilai, count(*) AS n FROM long GROUP BY ALL",
    "l2_feature_code_matrix": _LONG_SQL + f"SELECT ciri, nilai, {', '.join(f'''count(*) FILTER (kode = '{c}') AS {c}''' for c in CODES)} FROM long GROUP BY ciri, nilai",
    "l2_gap_stats": L2_SQL + "SELECT ultg, count(*) AS total, count(*) FILTER (len(gaps) > 0) AS with_gaps, sum(len(gaps))::BIGINT AS gap_cells FROM l2 GROUP BY 1",
    "l2_composition": _LONG_SQL + f"SELECT ciri, count(*) FILTER (nilai NOT IN ('{UNASSESSED}', 'tidak_jelas')) AS filled, count(*) FILTER (nilai = '{UNASSESSED}') AS pending, count(*) FILTER (nilai = 'tidak_jelas') AS unclear FROM long GROUP BY 1",
    "scope_join": _SCOPED + "SELECT path_rel, kode, asset_norm, file_id FROM sc",
    "master_unmatched_anti": _SCOPED + "SELECT ultg, nama_file FROM master ANTI JOIN r1 USING (ultg, nama_file)",
    "master_match_profile": _SCOPED + "SELECT CASE WHEN p.nama_file IS NULL THEN 'right_only' WHEN m.nama_file IS NULL THEN 'left_only' ELSE 'both' END AS side, count(*) AS n FROM r1 p FULL JOIN master m ON p.ultg = m.ultg AND p.nama_file = m.nama_file GROUP BY 1",
    "master_status_map": f"WITH {fixtures.MASTER_SQL} SELECT file_id, kelompok, CASE kelompok WHEN 'LENGKAP' THEN 'LENGKAP_DI_MASTER' WHEN 'SEBAGIAN' THEN 'PERLU_LENGKAPI' ELSE 'PERLU_CEK' END AS status_master FROM master",
    "code_change_check": L1_SQL + "SELECT path_rel, 'kode' AS field, kode AS before, 'X' AS after FROM r1 WHERE doc_id % 50 = 7",
    "edits_detected": f"WITH {fixtures.MASTER_SQL} SELECT file_id, 'in_scope' AS field, in_scope::VARCHAR AS before, NULL AS after FROM master WHERE kelompok = 'LAIN' AND in_scope IS NOT NULL UNION ALL SELECT file_id, 'kelompok', kelompok, 'BARU' FROM master WHERE in_scope IS NULL",
    "key_duplicates": f"WITH {fixtures.MASTER_SQL} SELECT ultg, asset_norm, count(*) AS n FROM master GROUP BY ALL HAVING count(*) > 1",
    "border_optional_join": L1_SQL + "SELECT path_rel, kode, CASE WHEN l.doc_id IS NULL THEN 0 ELSE (l.doc_id % 40) * 3 END AS green_border_pixels FROM r1 LEFT JOIN labels l USING (doc_id)",
    "column_guard": _SCOPED + "SELECT path_rel, kode FROM sc",
    "sample_greedy": _quota_sql("(SELECT count(*) * 8 // 10 FROM photos)", 4, "greedy"),
    "sample_round_robin": _quota_sql("260", 8, "round_robin"),
    "sample_per_group_hash": L1_SQL + "SELECT path_rel, ultg, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY ultg ORDER BY sha256(path_rel), path_rel) AS place FROM r1) WHERE place <= 25",
    "sample_seeded": f"WITH {fixtures.PHOTOS_SQL} SELECT path_rel FROM photos ORDER BY sha256('11:' || path_rel), path_rel LIMIT 25",
    "calibration_slices": f"WITH {fixtures.PHOTOS_SQL} {_CALIBRATION_SQL}",
    "quantile_table": f"WITH {fixtures.PHOTOS_SQL} " + profile.quantile_sql("photos", ["edge_mean", "dark_ratio", "clip_terang"]),
    "lineitem_quantiles": profile.quantile_sql("lineitem", ["l_quantity", "l_extendedprice"]),
    "profile_nulls": f'WITH {fixtures.PHOTOS_SQL} SELECT "column", nulls FROM (' + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM photos" for c in ("doc_id", "ultg", *METRICS)) + ') ORDER BY nulls DESC, "column" LIMIT 25',
    "crosstab_code_asset": _SCOPED + f"SELECT kode, {', '.join(f'''count(*) FILTER (asset_norm = 'A{i}') AS A{i}''' for i in range(5))} FROM sc GROUP BY kode",
    "describe_metrics": f"WITH {fixtures.PHOTOS_SQL} " + profile.describe_sql("photos", ["mean_luma", "edge_mean"]),
    "value_counts_head": f"WITH {fixtures.PHOTOS_SQL} SELECT green_long, count(*) AS n FROM photos GROUP BY 1 ORDER BY n DESC, green_long NULLS FIRST LIMIT 15",
    "layer_expectations": _SCOPED.replace("sc AS", "sc AS", 1)
    + """SELECT 'unique: photo path' AS check_name, (SELECT count(*) FROM (SELECT path_rel FROM r1 GROUP BY 1 HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'unique: register key', (SELECT count(*) FROM (SELECT ultg FROM master GROUP BY ultg, nama_file HAVING count(*) > 1))
    UNION ALL SELECT 'references: register has photo', (SELECT count(*) FROM master ANTI JOIN r1 USING (ultg, nama_file))
    UNION ALL SELECT 'domain: code', 0 UNION ALL SELECT 'domain: confidence', 0
    UNION ALL SELECT 'within: dark ratio', (SELECT count(*) FROM r1 WHERE dark_ratio IS NULL OR dark_ratio NOT BETWEEN 0 AND 0.5)
    UNION ALL SELECT 'filled: features', 0 UNION ALL SELECT 'row count: photos', 0
    UNION ALL SELECT 'unit norm: embeddings', (SELECT count(*) FROM embeddings WHERE abs(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) - 1) > 0.001 OR len(embedding) <> 64)""",
}
