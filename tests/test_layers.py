import math
import random

import pytest
from pyspark.sql import functions as F

from lensgraph.config import CODE_NAMES, load
from lensgraph.operators import l1, l2, sampling

# A photo that passes with high confidence; each case changes what it needs.
GOOD = dict(status_baca="OK", edge_mean=30.0, sky_ratio=0.5, chroma_std=10.0, dark_ratio=0.1, green_long=40, comp_long=40, green_short=30, green_area=2000, green_touch=0, clip_terang=0.01, mean_luma=120.0, vegetasi_ratio=0.0, green_w=10, green_h=40, comp_w=10, comp_h=40, thumb_h=213, candidate_ratio=0.05)
CASES = [
    ({}, "S", "tinggi"),
    ({"status_baca": "ERROR"}, "D", "tinggi"),
    ({"status_baca": None}, "D", "tinggi"),
    ({"edge_mean": 71.0, "sky_ratio": 0.11, "chroma_std": 26.0}, "D", "tinggi"),
    ({"edge_mean": 56.0, "sky_ratio": 0.11, "chroma_std": 26.0, "dark_ratio": 0.46}, "D", "tinggi"),
    ({"edge_mean": 55.0, "sky_ratio": 0.11, "chroma_std": 26.0, "dark_ratio": 0.46}, "S", "tinggi"),
    ({"green_long": 4, "comp_long": 8, "dark_ratio": 0.036}, "O", "rendah"),
    ({"green_long": 2, "comp_long": 4, "dark_ratio": 0.019}, "O", "rendah"),
    ({"edge_mean": 18.4, "green_long": 20, "dark_ratio": 0.015}, "B", "sedang"),
    ({"edge_mean": 15.9, "green_long": 5, "comp_long": 20, "dark_ratio": 0.03}, "B", "tinggi"),
    ({"clip_terang": 0.12}, "K", "sedang"),
    ({"clip_terang": 0.22}, "K", "tinggi"),
    ({"mean_luma": 205.0}, "K", "sedang"),
    ({"mean_luma": 87.9, "dark_ratio": 0.36}, "K", "sedang"),
    ({"vegetasi_ratio": 0.14, "dark_ratio": 0.18, "sky_ratio": 0.10}, "H", "sedang"),
    ({"vegetasi_ratio": 0.22, "dark_ratio": 0.18, "sky_ratio": 0.10}, "H", "tinggi"),
    ({"green_long": 17, "comp_long": 27}, "J", "sedang"),
    ({"green_long": 8, "comp_long": 15, "dark_ratio": 0.01}, "J", "tinggi"),
    ({"green_long": 11, "dark_ratio": 0.05}, "J", "sedang"),
    ({"green_touch": 1, "green_long": 25, "green_short": 20, "green_area": 1200}, "P", "sedang"),
    ({"green_long": 22, "edge_mean": 21.0}, "S", "sedang"),
    ({"green_long": 21}, "S", "rendah"),
    # An earlier rule wins where several hold.
    ({"status_baca": "ERROR", "clip_terang": 0.5, "green_long": 1, "comp_long": 1}, "D", "tinggi"),
    ({"clip_terang": 0.5, "vegetasi_ratio": 0.3, "dark_ratio": 0.3}, "K", "tinggi"),
    # Nothing is known: no comparison holds.
    ({k: None for k in GOOD if k != "status_baca"}, "S", "rendah"),
]
TYPES = {k: "string" if k == "status_baca" else "int" if isinstance(v, int) else "double" for k, v in GOOD.items()}
SCHEMA = "i int, " + ", ".join(f"{k} {t}" for k, t in TYPES.items())


def _photos(spark, changes):
    return spark.createDataFrame([(i, *{**GOOD, **c}.values()) for i, c in enumerate(changes)], SCHEMA)


def test_every_arm_of_the_first_layer(spark):
    rows = l1.classify(_photos(spark, [c for c, _, _ in CASES])).orderBy("i").collect()
    for row, (change, code, confidence) in zip(rows, CASES, strict=True):
        assert (row["kode"], row["confidence"]) == (code, confidence), change
        assert (row["nama_keputusan"], row["prioritas"]) == CODE_NAMES[code]
        assert row["perlu_review_manual"] == ("YA" if confidence == "rendah" else "TIDAK")


def test_result_table_has_its_26_columns(spark):
    assert len(l1.result_table(_photos(spark, [{}]).withColumns({"ultg": F.lit("U"), "nama_file": F.lit("a"), "path_rel": F.lit("U/a")})).columns) == 26


FEATURE_CASES = [
    ({}, "cakupan_foto", "setengah_tower"),
    ({"green_long": 90, "green_area": 1000}, "cakupan_foto", "closeup_1_renteng"),
    ({"green_long": 90, "green_area": 1100}, "cakupan_foto", "closeup_beberapa_renteng"),
    ({"green_long": 90, "sky_ratio": 0.6}, "cakupan_foto", "closeup_beberapa_renteng"),
    ({"green_long": 20, "comp_long": 29}, "cakupan_foto", "tower_penuh"),
    ({"green_long": 5, "comp_long": 5, "sky_ratio": 0.52}, "cakupan_foto", "tower_dan_lanskap"),
    ({"green_long": 5, "comp_long": 5}, "cakupan_foto", "tower_penuh"),
    ({"green_long": 90, "green_area": 1000}, "jumlah_renteng_terbaca", "1"),
    ({"status_baca": "ERROR"}, "jumlah_renteng_terbaca", "0"),
    ({"green_w": 2}, "arah_isolator", "NA"),
    ({"green_w": 20}, "arah_isolator", "vertikal"),
    ({"green_w": 80}, "arah_isolator", "horizontal"),
    ({"green_w": 30}, "arah_isolator", "miring"),
    ({"green_w": 0, "comp_w": 80}, "arah_isolator", "horizontal"),
    ({"mean_luma": 84.0}, "cahaya", "terlalu_gelap"),
    ({"mean_luma": 205.0}, "cahaya", "terlalu_terang"),
    ({"clip_terang": 0.025}, "cahaya", "flare"),
    ({"dark_ratio": 0.19}, "cahaya", "backlit"),
    ({"edge_mean": 21.0}, "cahaya", "berkabut"),
    ({"mean_luma": None}, "cahaya", "normal"),
    ({"edge_mean": 16.0}, "ketajaman", "blur"),
    ({"edge_mean": 24.0}, "ketajaman", "sedikit_blur"),
    ({"chroma_std": 36.0, "dark_ratio": 0.31}, "noise", "banyak_noise"),
    ({"chroma_std": 26.0, "dark_ratio": 0.19}, "noise", "sedikit_noise"),
    ({"vegetasi_ratio": 0.14, "dark_ratio": 0.18}, "halangan", "pohon"),
    ({"sky_ratio": 0.67}, "isi_frame_terbanyak", "langit_lanskap"),
    ({"sky_ratio": 0.3, "dark_ratio": 0.38}, "isi_frame_terbanyak", "rangka_tower"),
    ({"sky_ratio": 0.2, "candidate_ratio": 0.16}, "isi_frame_terbanyak", "piringan_isolator"),
    ({"dark_ratio": 0.18}, "isi_frame_terbanyak", "seimbang"),
    ({}, "isi_frame_terbanyak", "belum_dinilai"),
    ({"green_long": 43}, "bagian_renteng_terlihat", "utuh"),
    ({"green_touch": 1, "green_long": 43}, "bagian_renteng_terlihat", "belum_dinilai"),
    ({"status_baca": "ERROR"}, "bagian_renteng_terlihat", "NA"),
    ({"green_long": 21}, "ragu2", "ya"),
]


def test_arms_of_the_second_layer(spark):
    rows = l2.features(l1.classify(_photos(spark, [c for c, _, _ in FEATURE_CASES]))).orderBy("i").collect()
    for row, (change, name, value) in zip(rows, FEATURE_CASES, strict=True):
        assert row[name] == value, (change, name)
        gaps = [f for f in l2.FEATURES if row[f] == "belum_dinilai"]
        assert row["jumlah_belum_dinilai"] == len(gaps) and row["ciri_belum_dinilai"] == ", ".join(gaps)


def test_configuration():
    assert load({"relationship": {"edge_threshold": 0.5}}).relationship.edge_threshold == 0.5
    with pytest.raises(ValueError):
        load({"nothing": {}})


def _dealt(sizes, target, method, least):
    quota = [min(n, max(least, round(2 * math.sqrt(n)))) for n in sizes]
    priority = lambda i: (sizes[i] - quota[i]) / math.sqrt(sizes[i])
    rest = target - sum(quota)
    while rest > 0:
        free = [i for i in range(len(sizes)) if quota[i] < sizes[i]]
        if not free:
            break
        for i in [max(free, key=priority)] if method == "greedy" else sorted(free, key=lambda i: -priority(i)):
            if rest > 0:
                quota[i] += 1
                rest -= 1
    return quota


@pytest.mark.parametrize("method,least", [("greedy", 4), ("round_robin", 8)])
def test_quotas_equal_dealing_in_a_loop(spark, method, least):
    rng = random.Random(3)
    for _ in range(4):
        sizes = [rng.randint(1, 120) for _ in range(rng.randint(1, 9))]
        target = sum(sizes) if rng.random() < 0.2 else rng.randint(sum(_dealt(sizes, 0, method, least)), sum(sizes))
        photos = spark.createDataFrame([(f"g{g}", f"{g:03d}/{i:03d}") for g, n in enumerate(sizes) for i in range(n)], "g string, path_rel string")
        found = {r["g"]: r["quota"] for r in sampling.quotas(sampling.strata(photos, ["g"], least), target, method).collect()}
        assert [found[f"g{g}"] for g in range(len(sizes))] == _dealt(sizes, target, method, least)


def test_greedy_quotas_refuse_what_cannot_be(spark):
    photos = spark.createDataFrame([("a", str(i)) for i in range(10)], "g string, path_rel string")
    for target in (3, 11):
        with pytest.raises(ValueError):
            sampling.quotas(sampling.strata(photos, ["g"], 4), target, "greedy")
