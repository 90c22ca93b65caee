"""Every threshold of the engine, with its default.  All are plain values, so a run may replace any of them."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

# Decision codes with their names and priorities, the labels and sentences of the two photo layers.
CODE_NAMES = {
    "S": ("SESUAI", None),
    "D": ("BERKAS_RUSAK", 0),
    "O": ("SALAH_OBJEK", 1),
    "B": ("BLUR", 2),
    "K": ("SILAU", 3),
    "H": ("TERHALANG", 4),
    "J": ("TERLALU_JAUH", 5),
    "P": ("OBJEK_UTAMA_TERPOTONG", 6),
    "L": ("LAINNYA", 7),
}
REASONS = {
    "D": "Pola noise warna atau kerusakan data menutup detail foto.",
    "O": "Tidak ditemukan bentuk renteng yang terbaca pada area objek.",
    "B": "Ketajaman tepi objek rendah sehingga detail piringan tidak stabil.",
    "K": "Paparan ekstrem atau area terang terpotong menghilangkan detail piringan.",
    "H": "Vegetasi atau objek depan menutup bagian penting area penilaian.",
    "J": "Renteng terlalu kecil untuk memastikan detail piringan satu per satu.",
    "P": "Kandidat renteng utama menyentuh tepi frame dan berpotensi terpotong.",
    "S": "Renteng terlihat dan ukuran serta ketajamannya cukup untuk penilaian foto.",
}
FEATURES = (
    "ragu2",
    "cakupan_foto",
    "jumlah_renteng_terbaca",
    "arah_isolator",
    "bahan_isolator",
    "cahaya",
    "ketajaman",
    "noise",
    "halangan",
    "isi_frame_terbanyak",
    "bagian_renteng_terlihat",
)
SEMANTIC_FEATURES = (
    "jumlah_renteng_terbaca",
    "arah_isolator",
    "bahan_isolator",
    "halangan",
    "isi_frame_terbanyak",
    "bagian_renteng_terlihat",
)
RELATION_TYPES = ("EXACT_DUPLICATE", "NEAR_DUPLICATE", "SAME_CAPTURE", "SAME_OBJECT", "RELATED_ONLY", "UNRELATED")
CLUSTER_STATUSES = ("VALID", "NEED_REVIEW", "SPLIT_RECOMMENDED")
UNASSESSED = "belum_dinilai"
# End of the fixed values.


@dataclass(frozen=True)
class Relationship:
    weight_embedding: float = 0.35
    weight_feature: float = 0.25
    weight_phash: float = 0.20
    weight_gps: float = 0.10
    weight_time: float = 0.10
    edge_threshold: float = 0.70
    strong_edge_threshold: float = 0.85
    near_duplicate_embedding: float = 0.95
    near_duplicate_phash_distance: int = 8
    same_capture_score: float = 0.82
    same_object_score: float = 0.72
    same_object_feature: float = 0.02
    related_score: float = 0.55
    gps_same_meter: float = 5.0
    gps_near_meter: float = 20.0
    time_same_second: float = 60.0
    time_near_second: float = 300.0
    near_step: float = 0.6
    phash_range: float = 16.0
    very_high: float = 0.95
    high: float = 0.85
    medium: float = 0.70
    evidence_embedding_high: float = 0.95
    evidence_embedding_medium: float = 0.80
    evidence_feature_high: float = 0.25
    evidence_phash_low: int = 4
    evidence_phash_near: int = 8


@dataclass(frozen=True)
class ClusterValidation:
    valid_average_similarity: float = 0.82
    valid_minimum_similarity: float = 0.65
    split_minimum_similarity: float = 0.50
    max_diameter: float = 0.50
    min_strong_edge_ratio: float = 0.25


@dataclass(frozen=True)
class Retrieval:
    top_k: int = 20


@dataclass(frozen=True)
class LocalFeatures:
    nfeatures: int = 1500
    ratio_test: float = 0.75
    min_good_matches: int = 8
    ransac_reproj_threshold: float = 5.0
    max_dimension: int = 1024


@dataclass(frozen=True)
class Embedding:
    dimension: int = 384
    image_size: int = 224
    batch_size: int = 32
    model_name: str = "pluggable"


@dataclass(frozen=True)
class Config:
    relationship: Relationship = field(default_factory=Relationship)
    cluster_validation: ClusterValidation = field(default_factory=ClusterValidation)
    retrieval: Retrieval = field(default_factory=Retrieval)
    local_features: LocalFeatures = field(default_factory=LocalFeatures)
    embedding: Embedding = field(default_factory=Embedding)


def load(values: dict) -> Config:
    """A configuration from nested plain values; unknown names are errors, missing ones keep their defaults."""
    out = Config()
    for section, own in values.items():
        if section not in {f.name for f in fields(Config)}:
            raise ValueError(f"unknown section {section}")
        out = replace(out, **{section: replace(getattr(out, section), **own)})
    return out
