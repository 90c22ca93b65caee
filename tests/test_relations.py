import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lensgraph import serving
from lensgraph.functions import scalars
from lensgraph.operators import expectations, graph, overlap, reconcile, relationship, similarity
from lensgraph.plans import fixtures
from lensgraph.sources import tables

PAIR = "image_a string, image_b string, embedding_similarity double, phash_distance int, feature_match_score double, gps_distance_meter double, time_difference_second double, image_hash_a string, image_hash_b string"
CASES = [
    ((0.95, 8, 0.0, None, None, "x", "y"), "NEAR_DUPLICATE", 0.540625, "LOW"),
    ((0.2, None, None, None, None, "x", "x"), "EXACT_DUPLICATE", 0.116667, "LOW"),
    ((0.2, None, None, None, None, "", ""), "UNRELATED", 0.116667, "LOW"),
    ((0.94, 0, 0.9, 5.0, 60.0, "x", "y"), "SAME_CAPTURE", 0.954, "VERY_HIGH"),
    ((0.94, 0, 0.9, 20.0, 300.0, "x", "y"), "SAME_OBJECT", 0.874, "HIGH"),
    ((0.94, 0, 0.01, 20.1, 301.0, "x", "y"), "UNRELATED", 0.5315, "LOW"),
    ((0.90, 2, 0.3, None, None, "x", "y"), "RELATED_ONLY", 0.70625, "MEDIUM"),
]


def test_relationship_types(spark):
    rows = [("a", f"b{i}", *c) for i, (c, *_) in enumerate(CASES)]
    for row, (_, kind, score, band) in zip(relationship.score_pairs(spark.createDataFrame(rows, PAIR)).orderBy("image_b").collect(), CASES, strict=True):
        assert (row["relationship_type"], row["duplicate_confidence"]) == (kind, band) and abs(row["relationship_score"] - score) < 2e-6, row


def test_evidence(spark):
    row = relationship.score_pairs(spark.createDataFrame([("a", "b", 0.8, 5, 0.25, 6.0, 301.0, "x", "y")], PAIR)).first()
    assert row["duplicate_evidence"] == "embedding_medium;feature_match_high;phash_near_distance;gps_near;time_far"


def _scored(spark, edges):
    return spark.createDataFrame([(a, b, float(s), t) for a, b, s, t in edges], "image_a string, image_b string, relationship_score double, relationship_type string")


def _images(spark, names):
    return spark.createDataFrame([(n, n, n, "U0", "S", 1000) for n in names], "image_id string, nama_file string, path_rel string, ultg string, kode_l1 string, file_size long")


def test_clusters(spark):
    near, same = "NEAR_DUPLICATE", "SAME_OBJECT"
    edges = [("a", "b", 0.9, near)]  # a pair
    edges += [("c", "d", 0.9, near), ("d", "e", 0.9, same)]  # a path of three
    edges += [("f", "g", 0.9, near), ("g", "h", 0.9, near), ("f", "h", 0.9, same)]  # a sound triangle
    edges += [("i", "j", 0.71, same), ("j", "k", 0.71, same), ("i", "k", 0.71, same)]  # a weak triangle
    edges += [("z", f"y{i}", 0.9, near) for i in range(6)]  # a star
    edges += [("p", "q", 0.69, near), ("q", "r", 0.99, "UNRELATED")]  # no edges
    names = {x for a, b, *_ in edges for x in (a, b)}
    clusters, members = graph.cluster_tables(_scored(spark, edges), _images(spark, names))
    found = {r["member_images"]: r for r in clusters.collect()}
    assert {k: r["cluster_status"] for k, r in found.items()} == {"a; b": "SPLIT_RECOMMENDED", "c; d; e": "SPLIT_RECOMMENDED", "f; g; h": "VALID", "i; j; k": "NEED_REVIEW", "y0; y1; y2; y3; y4; y5; z": "VALID"}
    assert found["c; d; e"]["relationship_type_dominant"] == near and found["c; d; e"]["canonical_image"] == "c" and found["c; d; e"]["cluster_diameter"] == 1.0
    assert [r["duplicate_group_id"] for r in sorted(found.values(), key=lambda r: r["member_images"])] == [f"DUP-{i:05d}" for i in range(1, 6)]
    assert members.where("is_canonical = 'YA'").count() == 5
    checks = expectations.run([expectations.declared_size("clusters", clusters, members, "duplicate_group_id", "jumlah_gambar"), expectations.references("members", members, _images(spark, names), ["image_id"])])
    expectations.enforce(checks)


def test_components_and_diameters_of_random_graphs(spark):
    rng = np.random.default_rng(4)
    n = 120
    edges = {tuple(sorted(map(int, rng.choice(n, 2, replace=False)))) for _ in range(100)} | {(i, i + 1) for i in range(0, 30)}
    near = {i: {i} for i in range(n)}
    for a, b in edges:
        near[a].add(b), near[b].add(a)
    reach = {}
    for s in range(n):
        d, front = {s: 0}, [s]
        while front:
            front = [d.setdefault(y, d[x] + 1) and y for x in front for y in near[x] if y not in d]
        reach[s] = d
    name = lambda i: f"n{i:03d}"
    df = spark.createDataFrame([(name(a), name(b)) for a, b in edges], "image_a string, image_b string")
    labels = {r["image_id"]: r["component"] for r in graph.connected_components(df).collect()}
    assert labels == {name(i): name(min(reach[i])) for i in range(n) if len(reach[i]) > 1}
    grouped = df.join(graph.connected_components(df).withColumnRenamed("image_id", "image_a"), "image_a").select("component", "image_a", "image_b")
    expected = {name(min(reach[i])): max(max(reach[j].values()) for j in reach[i]) for i in range(n) if len(reach[i]) > 1}
    for limit in (4096, 5):
        assert {r["component"]: r["diameter"] for r in graph.diameters(grouped, limit).collect()} == expected


def test_no_edges(spark):
    assert graph.connected_components(_scored(spark, [])).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 8))
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    x = x.astype(np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    queries = df.where("vec_id % 20 = 0")
    exact = similarity.knn_exact(queries, df, 5)
    got = {}
    for r in exact.collect():
        got.setdefault(r["src"], []).append((r["rank"], r["dst"]))
    for q in range(0, 300, 20):
        sims = np.round(np.clip(x @ x[q], 0, 1), 6)
        order = [int(i) for i in np.lexsort((np.arange(300), -sims))[:6]]
        assert sorted(got[q]) == [(k, i) for k, i in enumerate(order, 1) if i != q]
    found = similarity.knn_index(queries, df, 5, cells=6, probes=4)
    assert found.join(exact, ["src", "dst"]).count() >= 0.9 * exact.count()
    pairs = similarity.pair_table(exact)
    expectations.enforce(expectations.run([expectations.ordered_pair("pairs", pairs), expectations.unique("pairs", pairs, ["image_a", "image_b"])]))


def test_reconcile(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (9, None)], "k int, v string")
    with pytest.raises(ValueError):
        reconcile.one_to_one(left, right.withColumnRenamed("v", "w"), ["k"])
    with pytest.raises(ValueError):
        reconcile.complete_lookup(left, right.withColumnRenamed("v", "w"), ["k"])
    assert {r["side"]: r["n"] for r in reconcile.match_profile(left, right, ["k"]).collect()} == {"both": 3, "left_only": 1, "right_only": 1}
    assert [tuple(r) for r in reconcile.edits(left, right.distinct(), ["k"], ["v"]).collect()] == [(2, "v", None, "b")]
    assert reconcile.optional_join(left, None, ["k"], {"n": 0}).select("n").distinct().first()[0] == 0
    assert reconcile.same_rows(left, left) and not reconcile.same_rows(left, right)
    with pytest.raises(ValueError):
        expectations.required_columns(left, {"k", "x"})


def test_portal(spark):
    rows = [(i, f"IMG{i:03d}", f"IMG{j:03d}", 1 - (i + j) / 1000, "NEAR_DUPLICATE") for i, j in itertools.combinations(range(20), 2)]
    pairs = serving.numbered(spark.createDataFrame(rows, "k int, image_a string, image_b string, embedding_similarity double, relationship_type string"))
    first, second = (serving.page(pairs, n, 50).collect() for n in (0, 1))
    assert len(first) == len(second) == 50 and not {r["id"] for r in first} & {r["id"] for r in second} and first[0]["total"] == 190
    assert serving.query_pairs(pairs, q="img001").where(~(F.col("image_a").contains("001") | F.col("image_b").contains("001"))).count() == 0
    assert serving.page(pairs, -5, 50).first()["id"] == 1


def test_totals_digests_and_manifests(spark, tmp_path):
    checked = lambda c: c.first()["violations"]
    counts = spark.createDataFrame([("f", "a", 2), ("f", "b", 1), ("g", "a", 4)], "feature string, code string, n long")
    assert checked(expectations.totals("t", counts, ["feature"], "n", 3)) == 1
    assert checked(expectations.least_size("s", counts, "n")) == 1
    assert checked(expectations.manifest_count("m", counts, tables.manifest(counts, ["feature"]))) == 0
    assert checked(expectations.manifest_count("m", counts.limit(2), tables.manifest(counts, ["feature"]))) == 1
    for name in "ab":
        (tmp_path / name).write_text(name)
    before = spark.createDataFrame(tables.file_digests(spark, str(tmp_path)).collect())
    assert checked(expectations.unchanged("u", before, tables.file_digests(spark, str(tmp_path)), ["path"])) == 0
    (tmp_path / "a").write_text("other")
    (tmp_path / "c").write_text("new")
    assert checked(expectations.unchanged("u", before, tables.file_digests(spark, str(tmp_path)), ["path"])) == 2


def test_cluster_counts(spark):
    found = spark.createDataFrame([("VALID", 2), ("VALID", 3), ("NEED_REVIEW", 5)], "cluster_status string, jumlah_gambar int")
    assert {tuple(r) for r in serving.cluster_counts(found).collect()} == {("VALID", 2, 5), ("NEED_REVIEW", 1, 5)}


def test_iso_seconds(spark):
    assert spark.sql("SELECT timestamp '2024-05-06 07:08:09.9' AS t").select(scalars.iso_seconds(F.col("t"))).first()[0] == "2024-05-06T07:08:09"


def test_set_pairs_equal_all_pairs(spark):
    rng = random.Random(8)
    word = lambda: rng.choice("a b c d e f g h é  x".split(" "))
    texts = ["", " ", "a b", "a b c", "A b c", "a  b c", " a b c ", "a\nb c d"] + [" ".join(word() for _ in range(rng.randint(3, 60))) for _ in range(60)]
    for base in texts[20:30]:
        texts += [base + " " + word() + " y" * i for i in range(4)] + [base, base.upper()]
    texts = list(dict.fromkeys(texts))
    copies = [(i, t, t) for i, t in enumerate(texts)] + [(1000 + i, t, t) for i, t in enumerate(texts[:30])] + [(2000, "null", None)]
    df = spark.createDataFrame(copies, "name long, own string, text string").select(F.xxhash64("own").alias("node"), "name", F.lower("text").alias("text")).repartition(3)
    sets = []
    for t in texts:
        w = t.lower().split(" ")
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)})
    for least in (0.5, 0.8):
        expected = {}
        for i, j in itertools.combinations(range(len(texts)), 2):
            c = len(sets[i] & sets[j])
            if c and c * c >= least * least * len(sets[i]) * len(sets[j]):
                expected[i, j] = c
        got = overlap.set_pairs(df, least).collect()
        assert len(got) == len(expected) > 50
        assert {tuple(sorted((r["name_a"], r["name_b"]))): r["shared"] for r in got} == expected
    assert overlap.set_pairs(df.limit(0), 0.5).count() == 0


def test_pairs_keep_less_on_disk_than_the_texts(spark):
    small = "/root/testdata/sf0.001"
    graph.cut_lineage(spark.range(1))
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    held = lambda: {p: os.path.getsize(p) for d, _, names in os.walk(folder) for x in names for p in [os.path.join(d, x)]}
    before = held()
    fixtures.pairs(spark, small).count()
    texts = spark.read.parquet(f"{small}/documents.parquet").agg(F.sum(F.octet_length("text"))).first()[0]
    assert sum(size for p, size in held().items() if p not in before) < texts


def test_grams_are_dealt_in_rounds(spark, monkeypatch):
    """Many rounds find the pairs of one round, and what is dealt at a time is a share of all grams."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text IS NOT NULL")
    texts = docs.select(F.xxhash64("text").alias("node"), F.col("doc_id").alias("name"), F.lower("text").alias("text"))
    found = lambda: sorted(tuple(sorted((r["name_a"], r["name_b"]))) + (r["shared"], r["n_a"] + r["n_b"]) for r in overlap.set_pairs(texts, 0.5).collect())
    monkeypatch.setattr(overlap, "ROUNDS", 1)
    once = found()
    dealt = lambda rounds, turn: texts.select("node", "text").mapInArrow(overlap._dealt(3, 40, rounds, turn), overlap._BLOCKS).select("part", F.size("low").alias("n"), "sizes").collect()
    whole = dealt(1, 0)
    monkeypatch.setattr(overlap, "ROUNDS", 3)
    monkeypatch.setattr(overlap, "PART_CHARS", 1 << 12)
    monkeypatch.setattr(overlap, "BLOCK_GRAMS", 1 << 8)
    assert once and found() == once
    turns = [dealt(3, turn) for turn in range(3)]
    assert sum(r["n"] for t in turns for r in t) == sum(r["n"] for r in whole)
    assert max(sum(r["n"] for r in t) for t in turns) < 0.5 * sum(r["n"] for r in whole)
    assert all(r["part"] % 3 == turn for turn, t in enumerate(turns) for r in t)
