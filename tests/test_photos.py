import json
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lensgraph.functions import local_features, pixels, scalars
from lensgraph.operators import l1
from lensgraph.sources import photos, tables
from lensgraph.streaming import photos as streaming
from lensgraph.plans import fixtures


def png(rgb: np.ndarray) -> bytes:
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    h, w = rgb.shape[:2]
    raw = b"".join(b"\0" + rgb[y].tobytes() for y in range(h))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def flat(h, w, colour):
    return np.broadcast_to(np.array(colour, dtype=np.uint8), (h, w, 3)).copy()


def textured(seed=0, h=120, w=160):
    rng = np.random.default_rng(seed)
    return np.repeat(np.repeat(rng.integers(0, 256, (h // 8, w // 8, 3), dtype=np.uint8), 8, 0), 8, 1)


def test_flat_photo():
    m = pixels.metrics(flat(213, 160, (120, 120, 120)))
    assert m["mean_luma"] == 120 and m["std_luma"] == 0 and m["edge_mean"] == 0 and m["comp_long"] == 0 and m["dark_ratio"] == 0
    bright = pixels.metrics(flat(213, 160, (255, 255, 255)))
    assert bright["clip_terang"] == 1.0 and bright["clip_gelap"] == 0.0
    sky = pixels.metrics(flat(213, 160, (60, 120, 200)))
    assert sky["sky_ratio"] == round(float(pixels.usable((213, 160)).mean()), 6)


def test_green_bar_at_the_frame():
    image = flat(213, 160, (40, 40, 40))
    image[100:200, 155:160] = (30, 160, 30)
    m = pixels.metrics(image)
    assert m["green_touch"] == 1 and m["green_long"] == 104 and m["green_short"] == 7
    border = pixels.green_border(image)
    assert border == {"green_border_pixels": 300, "green_border_side_max": 300}


def test_largest_component_against_flood_fill():
    rng = np.random.default_rng(2)
    for _ in range(40):
        mask = rng.random((17, 23)) < 0.45
        seen, best = np.zeros_like(mask), None
        for y, x in zip(*np.nonzero(mask), strict=True):
            if not seen[y, x]:
                stack, own = [(y, x)], []
                seen[y, x] = True
                while stack:
                    a, b = stack.pop()
                    own.append((a, b))
                    for i in range(max(0, a - 1), min(17, a + 2)):
                        for j in range(max(0, b - 1), min(23, b + 2)):
                            if mask[i, j] and not seen[i, j]:
                                seen[i, j] = True
                                stack.append((i, j))
                if best is None or len(own) > len(best):
                    best = own
        found = pixels.largest_component(mask)
        ys, xs = zip(*best, strict=True)
        assert (found["area"], found["h"], found["w"]) == (len(best), max(ys) - min(ys) + 1, max(xs) - min(xs) + 1)
    two = np.zeros((5, 9), dtype=bool)
    two[1:3, 5:8] = two[2:4, 1:4] = True
    assert pixels.largest_component(two)["touch"] == 0 and pixels.largest_component(np.zeros((3, 3), bool))["area"] == 0


def test_resize_and_hashes():
    image = textured()
    assert pixels.thumbnail(image).shape == image.shape and pixels.thumbnail(np.repeat(image, 4, 1)).shape[1] == 160
    assert (pixels.resize(flat(50, 70, (9, 99, 199)), 20, 30) == (9, 99, 199)).all()
    brighter = np.clip(image.astype(int) + 4, 0, 255).astype(np.uint8)
    distance = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    for hashed in (pixels.phash, pixels.dhash):
        assert len(hashed(image)) == 16 and distance(hashed(image), hashed(brighter)) <= 6 < distance(hashed(image), hashed(textured(1)))
    assert abs(pixels.shrink(pixels.luma(image), 40).mean() - pixels.luma(image).mean()) < 0.5


def test_local_features():
    grey = pixels.luma(textured(3, 200, 240))
    own = local_features.extract(grey)
    moved = local_features.extract(np.roll(grey, 8, axis=1))
    other = local_features.extract(pixels.luma(textured(9, 200, 240)))
    assert len(own[0]) > 50
    same, shifted, none = (local_features.compare(own, x) for x in (own, moved, other))
    assert same["feature_match_score"] > 0.9 and shifted["feature_match_score"] > 0.5 and none["feature_match_score"] < 0.05
    assert local_features.compare(own, (np.zeros((0, 2)), np.zeros((0, 32), np.uint8)))["feature_match_score"] == 0


def test_folder_to_decision(spark, tmp_path):
    folder = tmp_path / "region" / "sub"
    folder.mkdir(parents=True)
    for i in range(3):
        (folder / f"p{i}.png").write_bytes(png(textured(i)))
    (folder / "copy.png").write_bytes(png(textured(0)))
    (folder / "broken.png").write_bytes(png(textured(5))[:60])
    scanned = photos.scan(spark, [str(tmp_path)], "*.png")
    measured = photos.measure(scanned)
    rows = {r["nama_file"]: r for r in l1.classify(measured).collect()}
    assert len(rows) == 5 and rows["broken.png"]["kode"] == "D" and rows["broken.png"]["error"] and rows["p1.png"]["status_baca"] == "OK"
    assert rows["p0.png"]["ultg"] == "region" and rows["p0.png"]["image_hash"] == rows["copy.png"]["image_hash"] and rows["p0.png"]["phash"] == rows["copy.png"]["phash"]
    expected = pixels.metrics(textured(2))
    assert all(rows["p2.png"][k] == pytest.approx(v) for k, v in expected.items())
    cache = photos.encode(scanned, photos.grid_encoder)
    norms = [np.linalg.norm(r["embedding"]) for r in cache.collect()]
    assert len(norms) == 4 and np.allclose(norms, 1, atol=1e-3)
    assert photos.pending(scanned, cache).count() == 1
    names = {r["nama_file"]: r["path_rel"] for r in rows.values()}
    pairs = spark.createDataFrame([(names["p0.png"], names["copy.png"]), (names["p0.png"], names["p1.png"]), (names["p0.png"], names["broken.png"])], "image_a string, image_b string")
    verified = {r["image_b"]: r for r in photos.verify(pairs, photos.describe(scanned)).collect()}
    assert verified[names["copy.png"]]["feature_match_score"] > 0.9 and verified[names["broken.png"]]["orb_status"].startswith("ERROR")
    assert photos.resume(pairs, spark.createDataFrame(list(verified.values())).limit(1)).count() == 2


def test_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿k,v\n1,NA\n2,\n", encoding="utf-8")
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "a.csv"), "k int, v string").collect()] == [(1, "NA"), (2, None)]
    (tmp_path / "a.json").write_text('[{"k": 1, "v": "x"}, {"k": 2, "v": null}]')
    assert tables.read_json(spark, str(tmp_path / "a.json"), "k int, v string").count() == 2
    assert tables.read_json(spark, str(tmp_path / "none.json"), "k int, v string", optional=True).count() == 0
    (tmp_path / "broken.json").write_text('[{"k": 1, "v":')
    assert tables.read_json(spark, str(tmp_path / "broken.json"), "k int, v string", optional=True).count() == 0
    (tmp_path / "typed.json").write_text('[{"k": "x", "v": "b"}, {"k": 2, "v": null}, {"k": null, "v": null}]')
    assert sorted(map(tuple, tables.read_json(spark, str(tmp_path / "typed.json"), "k int, v string", optional=True).collect()), key=str) == [(2, None), (None, "b"), (None, None)]
    (tmp_path / "c.jsonl").write_text('{"k": 1, "t": 1, "v": "old"}\n{"k": 1, "t": 2, "v": "new"}\n')
    assert tables.read_cache(spark, str(tmp_path / "c.jsonl"), "k int, t int, v string", "k", "t").first()["v"] == "new"
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    tables.append_new(df, str(tmp_path / "t"), ["k"])
    tables.append_new(df.union(spark.createDataFrame([(3, "z")], df.schema)), str(tmp_path / "t"), ["k"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    tables.write_once(df.limit(1), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    tables.write_csv(df, str(tmp_path / "o"), ["v", "k"], single=True)
    assert tables.read_csv(spark, str(tmp_path / "o")).columns == ["v", "k"]
    tables.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert json.loads(tables.manifest(df, ["v"], stage="x"))["counts"]["v"] == {"x": 1, "y": 1}
    assert tables.manifest(df, []) == tables.manifest(df.orderBy(F.desc("k")), [])
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", '<workbook><sheets><sheet name="A" sheetId="1"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", "<row r='1'><c>#REF!</c></row><row r='2'/>")
    assert tables.probe_workbook(str(tmp_path / "b.xlsx")) == {"broken": None, "sheets": ["A"], "rows": {"xl/worksheets/sheet1.xml": 2}, "errors": 1}
    assert "<" not in tables.report_page("t", spark.createDataFrame([("</script>",)], "v string")).split("const rows = ")[1].split(";")[0]


def test_scalars(spark):
    row = spark.sql("SELECT 'x\\\\y/z.jpg' AS p, 'ffffffffffffffff' AS a, '0000000000000001' AS b").select(
        scalars.base_name(F.col("p")), scalars.path_part(F.col("p"), 3), scalars.path_part(F.col("p"), 9), scalars.hamming(F.col("a"), F.col("b")), scalars.hamming(F.col("a"), F.lit(None).cast("string"))
    ).first()
    assert tuple(row) == ("z.jpg", "x", None, 63, None)
    steps = spark.createDataFrame([(5.0,), (5.1,), (20.1,), (None,), (float("nan"),)], "x double").select(scalars.step_score(F.col("x"), 5, 20)).collect()
    assert [r[0] for r in steps] == [1.0, 0.6, 0.0, None, None]
    assert spark.range(1).select(scalars.banded(F.lit(None).cast("double"), [(0.9, "a")], "b", "UNKNOWN")).first()[0] == "UNKNOWN"


def test_stream_equals_batch(spark, tmp_path):
    metrics = fixtures.photos(spark, "/root/testdata/sf0.001").withColumn("arrived", F.timestamp_seconds(F.col("doc_id") * 60 + 1_000_000))
    metrics.union(metrics).repartition(3).write.parquet(str(tmp_path / "in"))
    stream = streaming.classified(streaming.metrics_stream(spark, str(tmp_path / "in"), metrics.schema), "doc_id", "arrived")
    streaming.into_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "doc_id").awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).select("doc_id", "kode", "cahaya")
    batch = streaming.classified(metrics).select("doc_id", "kode", "cahaya")
    assert got.count() == metrics.count() and got.exceptAll(batch).isEmpty()
