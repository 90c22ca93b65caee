"""Photo folders as tables: scanned and decoded by Spark, measured once a photo in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lensgraph.functions import local_features, pixels
from lensgraph.functions.scalars import base_name, path_part

DOUBLES = "mean_luma std_luma clip_gelap clip_terang edge_mean edge_std dark_ratio sky_ratio vegetasi_ratio candidate_ratio chroma_std".split()
INTS = [f"{kind}_{part}" for kind in ("comp", "green") for part in ("area", "w", "h", "long", "short", "touch")] + ["thumb_w", "thumb_h", "green_border_pixels", "green_border_side_max"]
_MEASURES = [("phash", pa.string()), ("dhash", pa.string()), *((d, pa.float64()) for d in DOUBLES), *((i, pa.int32()) for i in INTS)]
_DDL = {pa.string(): "string", pa.float64(): "double", pa.int32(): "int"}


def scan(spark: SparkSession, folders: list[str], pattern: str = "*.jpg") -> DataFrame:
    """One row a file: path, size, SHA-256 and decoded pixels; files that do not decode have status ERROR and null pixels."""
    files, pixels_of = [], []
    for folder in folders:
        reader = lambda kind: spark.read.format(kind).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        files.append(reader("binaryFile").load(folder).select("path", F.col("length").alias("ukuran_byte"), F.sha2("content", 256).alias("image_hash")))
        pixels_of.append(reader("image").option("dropInvalid", False).load(folder).select(F.col("image.origin").alias("path"), "image.height", "image.width", "image.nChannels", "image.data"))
    every, decoded = reduce(DataFrame.union, files), reduce(DataFrame.union, pixels_of)
    # Readers may spell the same file as file:/x or file:///x.
    plain = lambda c: F.regexp_replace(c, "^([a-z]+):/+", "$1:/")
    joined = every.withColumn("__p", plain("path")).join(decoded.withColumn("__p", plain("path")).drop("path"), "__p", "left").drop("__p")
    ok = (F.col("height") > 0) & (F.col("width") > 0)
    return joined.select(
        path_part(F.col("path"), 3).alias("ultg"),
        base_name(F.col("path")).alias("nama_file"),
        F.col("path").alias("path_rel"),
        "ukuran_byte",
        "image_hash",
        F.when(ok, "OK").otherwise("ERROR").alias("status_baca"),
        F.when(ok, F.col("width")).alias("lebar"),
        F.when(ok, F.col("height")).alias("tinggi"),
        F.col("nChannels").alias("channels"),
        F.when(ok, F.col("data")).alias("data"),
    )


def to_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Pixels of Spark's image rows, which are blue first."""
    raw = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return np.repeat(raw, 3, axis=2) if channels == 1 else raw[:, :, 2::-1]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[dict] = []
        errors: list[str | None] = []
        names = batch.schema.names
        for data, h, w, c in zip(*(batch.column(names.index(n)) for n in ("data", "tinggi", "lebar", "channels")), strict=True):
            try:
                if not data.is_valid:
                    raise ValueError("the photo does not decode")
                rgb = to_rgb(data.as_py(), h.as_py(), w.as_py(), c.as_py())
                rows.append(pixels.metrics(rgb) | pixels.green_border(rgb) | {"phash": pixels.phash(rgb), "dhash": pixels.dhash(rgb)})
                errors.append(None)
            except Exception as error:  # a broken photo is a row with its error, never a failed job
                rows.append({})
                errors.append(f"{type(error).__name__}: {error}")
        kept = [i for i, n in enumerate(names) if n not in ("data", "channels")]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *(pa.array([r.get(n) for r in rows], t) for n, t in _MEASURES), pa.array(errors, pa.string())], names=[*(names[i] for i in kept), *(n for n, _ in _MEASURES), "error"])


def measure(photos: DataFrame) -> DataFrame:
    """Scanned photos with every metric, hash and border count, without their pixels."""
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in photos.schema.fields if f.name not in ("data", "channels"))
    return photos.mapInArrow(_measure, f"{kept}, {', '.join(f'{n} {_DDL[t]}' for n, t in _MEASURES)}, error string").withColumn("status_baca", F.when(F.col("error").isNull(), F.col("status_baca")).otherwise("ERROR"))


def encode(photos: DataFrame, encoder: Callable[[list[np.ndarray]], np.ndarray], key: str = "path_rel") -> DataFrame:
    """(key, image_hash, embedding): unit vectors of a pluggable encoder, in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [to_rgb(*r) for r in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)]
            if rows:
                v = np.asarray(encoder(rows), dtype=np.float64)
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(v.astype(np.float32)), pa.list_(pa.float32()))], names=[key, "image_hash", "embedding"])

    return photos.where("status_baca = 'OK'").select(key, "image_hash", "data", "tinggi", "lebar", "channels").mapInArrow(run, f"{key} string, image_hash string, embedding array<float>")


def grid_encoder(images: list[np.ndarray]) -> np.ndarray:
    """A deterministic encoder for tests: colours of an 8 x 8 grid."""
    return np.stack([pixels.resize(x, 8, 8).astype(np.float64).ravel() + 1.0 for x in images])


def pending(photos: DataFrame, cache: DataFrame, key: str = "path_rel") -> DataFrame:
    """Photos that the cache lacks or holds with another content."""
    return photos.join(cache.select(key, "image_hash"), [key, "image_hash"], "left_anti")


def describe(photos: DataFrame, longest: int = 1024) -> DataFrame:
    """(path_rel, points, descriptors): local features, once for each photo."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [local_features.extract(pixels.shrink(pixels.luma(to_rgb(*r)), longest)) for r in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p.ravel() for p, _ in found], pa.list_(pa.float64())), pa.array([d.tobytes() for _, d in found], pa.binary())], names=["path_rel", "points", "descriptors"])

    return photos.where("status_baca = 'OK'").select("path_rel", "data", "tinggi", "lebar", "channels").mapInArrow(run, "path_rel string, points array<double>, descriptors binary")


_VERIFIED = "keypoints_image_a int, keypoints_image_b int, total_matches int, good_matches int, geometrically_consistent_matches int, feature_match_score double"


def verify(pairs: DataFrame, described: DataFrame) -> DataFrame:
    """Pairs (image_a, image_b) with the columns of their feature match; a pair that fails keeps zeros and its error in orb_status."""
    for side in "ab":
        pairs = pairs.join(described.select(F.col("path_rel").alias(f"image_{side}"), F.col("points").alias(f"p{side}"), F.col("descriptors").alias(f"d{side}")), f"image_{side}", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [f.strip().split() for f in _VERIFIED.split(",")]
        for batch in batches:
            rows, status = [], []
            for pa_, da, pb, db in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                try:
                    side = lambda p, d: (np.array(p).reshape(-1, 2), np.frombuffer(d, np.uint8).reshape(-1, local_features.BITS // 8))
                    rows.append(local_features.compare(side(pa_, da), side(pb, db)))
                    status.append("OK")
                except Exception as error:
                    rows.append({n: 0 for n, _ in fields})
                    status.append(f"ERROR: {error}")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[n] for r in rows], pa.float64() if t == "double" else pa.int32()) for n, t in fields), pa.array(status)], names=["image_a", "image_b", *(n for n, _ in fields), "orb_status"])

    return pairs.select("image_a", "image_b", "pa", "da", "pb", "db").mapInArrow(run, f"image_a string, image_b string, {_VERIFIED}, orb_status string")


def resume(candidates: DataFrame, verified: DataFrame) -> DataFrame:
    """The candidates that are not verified yet, whatever their order."""
    return candidates.join(verified.select("image_a", "image_b"), ["image_a", "image_b"], "left_anti")
