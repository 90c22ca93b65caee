"""Queries over neighbours, pairs, clusters and the portal, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lensgraph import serving
from lensgraph.config import RELATION_TYPES, Retrieval
from lensgraph.functions import scalars as S
from lensgraph.operators import expectations, graph, l1, l2, relationship, similarity
from lensgraph.plans import fixtures
from lensgraph.plans.layer_queries import L1_SQL, L2_SQL


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding")


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.once("scored", spark, d, lambda: _score(spark, d))


def _score(spark: SparkSession, d: str) -> DataFrame:
    pairs = fixtures.pairs(spark, d)
    attributes = ["image_hash", "phash", "lat", "lon", "second"]
    # Taken from the texts once for both sides.
    index = graph.cut_lineage(fixtures.images(spark, d).select("image_id", *attributes))
    pairs = relationship.with_pair_attributes(pairs, index, *attributes)
    ready = pairs.withColumns(
        {
            "phash_distance": S.hamming(F.col("phash_a"), F.col("phash_b")),
            "gps_distance_meter": S.haversine_m(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b")),
            "time_difference_second": F.abs(F.col("second_a") - F.col("second_b")),
        }
    )
    return relationship.score_pairs(ready)


def _images_with_code(spark: SparkSession, d: str) -> DataFrame:
    codes = l1.classify(fixtures.photos(spark, d)).select("doc_id", F.col("kode").alias("kode_l1"))
    return fixtures.images(spark, d).join(codes, "doc_id").select("image_id", "nama_file", "path_rel", "ultg", "kode_l1", "file_size")


def _clusters(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    scored = _scored(spark, d)
    clusters, members = graph.cluster_tables(scored, _images_with_code(spark, d))
    return scored, fixtures.once("clusters", spark, d, lambda: clusters), fixtures.once("members", spark, d, lambda: members)


def knn_topk(spark, d):
    v = _vectors(spark, d)
    return similarity.knn_exact(v.where(similarity.every_twentieth()), v, Retrieval().top_k)


def knn_index_recall(spark, d):
    v = _vectors(spark, d)
    queries = v.where(similarity.every_twentieth())
    exact, found = similarity.knn_exact(queries, v, 10), similarity.knn_index(queries, v, 10)
    met = exact.join(found.select("src", "dst", F.lit(1).alias("hit")), ["src", "dst"], "left")
    return met.agg(F.count("*").alias("neighbours"), (F.sum(F.coalesce("hit", F.lit(0))) >= 0.9 * F.count("*")).alias("recall_reached"))


def pair_candidates(spark, d):
    return similarity.pair_table(knn_topk(spark, d))


def exact_duplicates(spark, d):
    index = fixtures.images(spark, d)
    place = Window.partitionBy("image_hash")
    return index.select("image_id", "image_hash").withColumns({"copies": F.count("*").over(place), "reference": F.min("image_id").over(place)}).where("copies > 1").select("image_id", "reference", "copies")


def candidate_pairs(spark, d):
    return fixtures.pairs(spark, d)


def hash_distance_pairs(spark, d):
    return _scored(spark, d).select("image_a", "image_b", "phash_distance")


def pair_scores(spark, d):
    return _scored(spark, d).select("image_a", "image_b", "phash_score", "gps_proximity_score", "time_proximity_score", "relationship_score")


def pair_types(spark, d):
    return _scored(spark, d).select("image_a", "image_b", "relationship_type")


def pair_evidence(spark, d):
    return _scored(spark, d).select("image_a", "image_b", "duplicate_evidence")


def pair_bands(spark, d):
    return _scored(spark, d).groupBy("relationship_type", "duplicate_confidence").agg(F.count("*").alias("n"))


def gps_time_evidence(spark, d):
    return _scored(spark, d).select("image_a", "image_b", "gps_distance_meter", "time_difference_second")


def components(spark, d):
    return graph.connected_components(relationship.edges(_scored(spark, d)))


def cluster_summary(spark, d):
    return _clusters(spark, d)[1]


def cluster_members(spark, d):
    return _clusters(spark, d)[2]


def cluster_diameter(spark, d):
    linked = relationship.edges(_scored(spark, d)).select("image_a", "image_b")
    labels = graph.connected_components(linked)
    return graph.diameters(linked.join(labels.withColumnRenamed("image_id", "image_a"), "image_a").select("component", "image_a", "image_b"))


def relation_expectations(spark, d):
    scored, clusters, members = _clusters(spark, d)
    index = fixtures.images(spark, d)
    return expectations.run(
        [
            expectations.ordered_pair("pairs", scored),
            expectations.unique("pairs", scored, ["image_a", "image_b"]),
            expectations.within("similarity", scored, "embedding_similarity", 0.0, 1.0),
            expectations.within("score", scored, "relationship_score", 0.0, 1.0),
            expectations.domain("type", scored, "relationship_type", list(RELATION_TYPES)),
            expectations.references("members are images", members, index, ["image_id"]),
            expectations.references("canonical is a member", clusters.select(F.col("canonical_image").alias("image_id"), "duplicate_group_id"), members, ["duplicate_group_id", "image_id"]),
            expectations.declared_size("clusters", clusters, members, "duplicate_group_id", "jumlah_gambar"),
        ]
    )


def _portal(spark, d):
    scored, clusters, members = _clusters(spark, d)
    return serving.with_group(serving.numbered(scored), members), clusters, members


def page_pairs(spark, d):
    pairs, _, _ = _portal(spark, d)
    every = serving.query_pairs(pairs)
    pages = [serving.page(every, n).select(F.lit(n).alias("page"), "id", "image_a", "image_b", "group_id", "total") for n in (0, 1)]
    return pages[0].union(pages[1])


def search_pairs(spark, d):
    pairs, _, _ = _portal(spark, d)
    return serving.query_pairs(pairs, confidence="HIGH", q="IMG00000000").select("id", "image_a", "image_b", "relationship_type")


def search_clusters(spark, d):
    _, clusters, members = _portal(spark, d)
    found = serving.query_clusters(serving.cluster_listing(clusters, members), status="SPLIT_RECOMMENDED", ultg="U1", q=".JPG")
    return found.select("duplicate_group_id", "canonical_image", "ultg", "kode_l1_canonical", "jumlah_gambar")


def cluster_detail(spark, d):
    _, clusters, members = _portal(spark, d)
    return serving.cluster_detail(clusters, members, "DUP-00002").select("duplicate_group_id", "cluster_status", "image_id", "is_canonical", "quality_score")


def exists_filter(spark, d):
    pairs, clusters, members = _portal(spark, d)
    return serving.touching(clusters, members, pairs, "EXACT_DUPLICATE").select("duplicate_group_id", "jumlah_gambar")


def group_evidence(spark, d):
    pairs, _, _ = _portal(spark, d)
    return pairs.where("group_id IS NOT NULL").groupBy("group_id").agg(F.count("*").alias("pairs"), F.max("relationship_score").alias("best"))


def _layers(spark, d):
    ids = fixtures.images(spark, d).select("doc_id", "image_id")
    first = l1.classify(fixtures.photos(spark, d)).join(ids, "doc_id")
    return first, l2.features(first)


def executive_summary(spark, d):
    scored, clusters, members = _clusters(spark, d)
    return serving.executive_summary(*_layers(spark, d), scored, clusters, members)


def master_result(spark, d):
    scored, _, members = _clusters(spark, d)
    return serving.master_result(*_layers(spark, d), scored, members)


def review_queue(spark, d):
    scored, clusters, members = _clusters(spark, d)
    return serving.review_queue(_layers(spark, d)[0], scored, clusters, members)


_STEP = "CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= {a} THEN 1.0::DOUBLE WHEN {x} <= {b} THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END"
_HAM = "bit_count(xor(('0x' || a.phash)::UBIGINT, ('0x' || b.phash)::UBIGINT))::INT"
_HAV = "round(2 * 6371000.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))), 3)"
_PART = "(CASE WHEN {v} IS NULL THEN 0.0::DOUBLE ELSE {x} END)"
_VALUES = [("embedding_similarity", 0.35), ("feature_match_score", 0.25), ("ps", 0.20), ("gs", 0.10), ("ts", 0.10)]
_TOTAL = "0.0::DOUBLE + " + " + ".join(_PART.format(v=v, x=f"{v} * {w}::DOUBLE") for v, w in _VALUES)
_WEIGHT = "0.0::DOUBLE + " + " + ".join(_PART.format(v=v, x=f"{w}::DOUBLE") for v, w in _VALUES)
_SCORED = f"""{fixtures.IMAGES_SQL}, {fixtures.PAIRS_SQL},
e0 AS (SELECT p.*, a.image_hash AS ha, b.image_hash AS hb, {_HAM} AS phash_distance, {_HAV} AS gps_distance_meter, abs(a.second - b.second) AS time_difference_second
  FROM pairs p JOIN images a ON a.image_id = image_a JOIN images b ON b.image_id = image_b),
e1 AS (SELECT *, greatest(0.0::DOUBLE, 1.0::DOUBLE - phash_distance / 16.0::DOUBLE) AS ps, {_STEP.format(x='gps_distance_meter', a=5, b=20)} AS gs, {_STEP.format(x='time_difference_second', a=60, b=300)} AS ts FROM e0),
e2 AS (SELECT *, ({_TOTAL}) / ({_WEIGHT}) AS s FROM e1),
scored AS (SELECT *, round(ps, 6) AS phash_score, gs AS gps_proximity_score, ts AS time_proximity_score, round(s, 6) AS relationship_score,
  CASE WHEN ha = hb THEN 'EXACT_DUPLICATE' WHEN embedding_similarity >= 0.95 AND phash_distance <= 8 THEN 'NEAR_DUPLICATE' WHEN s >= 0.82 AND (ts = 1 OR gs = 1) THEN 'SAME_CAPTURE' WHEN s >= 0.72 AND feature_match_score >= 0.02 THEN 'SAME_OBJECT' WHEN s >= 0.55 THEN 'RELATED_ONLY' ELSE 'UNRELATED' END AS relationship_type,
  CASE WHEN s >= 0.95 THEN 'VERY_HIGH' WHEN s >= 0.85 THEN 'HIGH' WHEN s >= 0.70 THEN 'MEDIUM' ELSE 'LOW' END AS duplicate_confidence,
  concat_ws(';', CASE WHEN embedding_similarity >= 0.95 THEN 'embedding_high' WHEN embedding_similarity >= 0.80 THEN 'embedding_medium' ELSE 'embedding_low' END,
    CASE WHEN feature_match_score >= 0.25 THEN 'feature_match_high' ELSE 'feature_match_low' END,
    CASE WHEN phash_distance <= 4 THEN 'phash_low_distance' WHEN phash_distance <= 8 THEN 'phash_near_distance' ELSE 'phash_far_distance' END,
    CASE WHEN gs >= 1 THEN 'gps_same' WHEN gs > 0 THEN 'gps_near' ELSE 'gps_far' END,
    CASE WHEN ts IS NULL THEN 'time_unknown' WHEN ts >= 1 THEN 'time_close' WHEN ts > 0 THEN 'time_near' ELSE 'time_far' END) AS duplicate_evidence FROM e2)"""
_EDGES = f"""{_SCORED}, edges AS (SELECT image_a, image_b, relationship_score, relationship_type FROM scored WHERE relationship_type <> 'UNRELATED' AND relationship_score >= 0.70),
sym AS (SELECT image_a AS u, image_b AS v FROM edges UNION SELECT image_b, image_a FROM edges),
reach AS (SELECT u AS s, u AS t FROM sym UNION SELECT s, v FROM reach JOIN sym ON t = u),
comps AS (SELECT s AS image_id, min(t) AS component FROM reach GROUP BY s)"""
_PREFIX = "WITH RECURSIVE "
_CLUSTERS = f"""{_EDGES}, {fixtures.PHOTOS_SQL}, {L1_SQL.split(', l1a AS', 1)[1].join(['l1a AS', ''])},
hops AS (SELECT u AS s, u AS t, 0 AS k FROM (SELECT DISTINCT u FROM sym) UNION SELECT s, v, k + 1 FROM hops JOIN sym ON t = u WHERE k < 40),
far AS (SELECT component, max(k) AS diameter FROM (SELECT s, t, min(k) AS k FROM hops GROUP BY s, t) JOIN comps ON s = image_id GROUP BY component),
rated AS (SELECT c.component, i.image_id, i.nama_file, i.path_rel, i.ultg, r1.kode AS kode_l1, round(CASE r1.kode WHEN 'S' THEN 100.0 WHEN 'B' THEN -30.0 WHEN 'P' THEN -25.0 WHEN 'J' THEN -20.0 WHEN 'H' THEN -20.0 ELSE 0.0 END::DOUBLE + least(20.0::DOUBLE, i.file_size::DOUBLE / 100000), 3) AS quality_score
  FROM comps c JOIN images i USING (image_id) JOIN r1 ON r1.doc_id = i.doc_id),
canon AS (SELECT component, image_id AS canonical_image FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY quality_score DESC, image_id) AS p FROM rated) WHERE p = 1),
sizes AS (SELECT component, count(*) AS n, string_agg(image_id, '; ' ORDER BY image_id) AS member_images FROM rated GROUP BY 1),
numbers AS (SELECT component, printf('DUP-%05d', row_number() OVER (ORDER BY component)) AS duplicate_group_id FROM sizes),
stats AS (SELECT component, avg(relationship_score) AS a, min(relationship_score) AS m, count(*) FILTER (relationship_score >= 0.85) / count(*) AS strong FROM edges JOIN comps ON image_id = image_a GROUP BY 1),
dom AS (SELECT component, relationship_type AS relationship_type_dominant FROM (SELECT component, relationship_type, row_number() OVER (PARTITION BY component ORDER BY count(*) DESC, list_position({list(RELATION_TYPES)}, relationship_type)) AS p FROM edges JOIN comps ON image_id = image_a GROUP BY component, relationship_type) WHERE p = 1),
cl AS (SELECT *, diameter / greatest(1, n - 1) AS dn FROM sizes JOIN numbers USING (component) JOIN canon USING (component) JOIN stats USING (component) JOIN dom USING (component) JOIN far USING (component)),
clusters AS (SELECT *, n AS jumlah_gambar, round(a, 6) AS average_similarity, round(m, 6) AS minimum_similarity, round(strong, 6) AS strong_edge_ratio, round(dn, 6) AS cluster_diameter,
  CASE WHEN m < 0.5 OR dn > 0.5 THEN 'SPLIT_RECOMMENDED' WHEN a >= 0.82 AND m >= 0.65 AND strong >= 0.25 THEN 'VALID' ELSE 'NEED_REVIEW' END AS cluster_status,
  CASE WHEN m < 0.5 THEN 'minimum_similarity_too_low' WHEN dn > 0.5 THEN 'cluster_diameter_high' WHEN a >= 0.82 AND m >= 0.65 AND strong >= 0.25 THEN 'internal_similarity_consistent' ELSE 'borderline_similarity_or_weak_edge_ratio' END AS cluster_validation_notes,
  CASE WHEN m < 0.5 OR dn > 0.5 THEN 'LOW' WHEN a >= 0.82 AND m >= 0.65 AND strong >= 0.25 THEN 'HIGH' ELSE 'MEDIUM' END AS cluster_confidence FROM cl),
members AS (SELECT duplicate_group_id, image_id, nama_file, path_rel, ultg, kode_l1, CASE WHEN image_id = canonical_image THEN 'YA' ELSE 'TIDAK' END AS is_canonical, quality_score FROM rated JOIN numbers USING (component) JOIN canon USING (component)),
listed AS (SELECT *, row_number() OVER (ORDER BY embedding_similarity DESC, image_a, image_b)::INT AS id FROM scored),
portal AS (SELECT l.*, CASE WHEN x.duplicate_group_id = y.duplicate_group_id THEN x.duplicate_group_id END AS group_id FROM listed l LEFT JOIN members x ON x.image_id = image_a LEFT JOIN members y ON y.image_id = image_b)"""
_S, _E, _C = _PREFIX + _SCORED + " ", _PREFIX + _EDGES + " ", _PREFIX + _CLUSTERS + " "
_DOT = "list_sum(list_transform(list_zip(q.embedding, t.embedding), lambda x: x[1]::DOUBLE * x[2]::DOUBLE))"
_NORM = "sqrt(list_sum(list_transform({}.embedding, lambda x: x::DOUBLE * x::DOUBLE)))"
_KNN = f"""WITH hits AS (SELECT q.vec_id AS src, t.vec_id AS dst, round(greatest(0, least(1, {_DOT} / ({_NORM.format('q')} * {_NORM.format('t')}))), 6) AS similarity FROM embeddings q, embeddings t WHERE q.vec_id % 20 = 0),
knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY similarity DESC, dst)::INT AS rank FROM hits) WHERE rank <= 21 AND src <> dst) """
_L2_TAIL = L2_SQL.split(", s2 AS", 1)[1].join([", s2 AS", ""])

QUERIES = {f.__name__: f for f in (knn_topk, knn_index_recall, pair_candidates, exact_duplicates, candidate_pairs, hash_distance_pairs, pair_scores, pair_types, pair_evidence, pair_bands, gps_time_evidence, components, cluster_summary, cluster_members, cluster_diameter, relation_expectations, page_pairs, search_pairs, search_clusters, cluster_detail, exists_filter, group_evidence, executive_summary, master_result, review_queue)}

ORACLE_SQL = {
    "knn_topk": _KNN + "SELECT src, dst, similarity, rank FROM knn",
    "knn_index_recall": _KNN + "SELECT count(*) AS neighbours, true AS recall_reached FROM knn WHERE rank <= 11",
    "pair_candidates": _KNN + "SELECT least(src, dst) AS image_a, greatest(src, dst) AS image_b, max(similarity) AS embedding_similarity, max(rank) FILTER (src < dst) AS rank_a_to_b, max(rank) FILTER (src > dst) AS rank_b_to_a FROM knn GROUP BY 1, 2",
    "exact_duplicates": f"WITH {fixtures.IMAGES_SQL} SELECT image_id, reference, copies FROM (SELECT image_id, min(image_id) OVER (PARTITION BY image_hash) AS reference, count(*) OVER (PARTITION BY image_hash) AS copies FROM images) WHERE copies > 1",
    "candidate_pairs": f"WITH {fixtures.IMAGES_SQL}, {fixtures.PAIRS_SQL} SELECT image_a, image_b, embedding_similarity, feature_match_score FROM pairs",
    "hash_distance_pairs": _S + "SELECT image_a, image_b, phash_distance FROM scored",
    "pair_scores": _S + "SELECT image_a, image_b, phash_score, gps_proximity_score, time_proximity_score, relationship_score FROM scored",
    "pair_types": _S + "SELECT image_a, image_b, relationship_type FROM scored",
    "pair_evidence": _S + "SELECT image_a, image_b, duplicate_evidence FROM scored",
    "pair_bands": _S + "SELECT relationship_type, duplicate_confidence, count(*) AS n FROM scored GROUP BY ALL",
    "gps_time_evidence": _S + "SELECT image_a, image_b, gps_distance_meter, time_difference_second FROM scored",
    "components": _E + "SELECT image_id, component FROM comps",
    "cluster_summary": _C + "SELECT duplicate_group_id, canonical_image, jumlah_gambar, member_images, average_similarity, minimum_similarity, cluster_confidence, cluster_status, cluster_validation_notes, strong_edge_ratio, cluster_diameter, relationship_type_dominant FROM clusters",
    "cluster_members": _C + "SELECT duplicate_group_id, image_id, nama_file, path_rel, ultg, kode_l1, is_canonical, quality_score FROM members",
    "cluster_diameter": _C + "SELECT component, diameter::BIGINT AS diameter FROM far",
    "relation_expectations": _C
    + f"""SELECT 'ordered pair: pairs' AS check_name, (SELECT count(*) FROM scored WHERE NOT image_a < image_b) AS violations
    UNION ALL SELECT 'unique: pairs', (SELECT count(*) FROM (SELECT image_a FROM scored GROUP BY image_a, image_b HAVING count(*) > 1))
    UNION ALL SELECT 'within: similarity', (SELECT count(*) FROM scored WHERE embedding_similarity IS NULL OR embedding_similarity NOT BETWEEN 0 AND 1)
    UNION ALL SELECT 'within: score', (SELECT count(*) FROM scored WHERE relationship_score IS NULL OR relationship_score NOT BETWEEN 0 AND 1)
    UNION ALL SELECT 'domain: type', (SELECT count(*) FROM scored WHERE relationship_type NOT IN {RELATION_TYPES})
    UNION ALL SELECT 'references: members are images', (SELECT count(*) FROM members ANTI JOIN images USING (image_id))
    UNION ALL SELECT 'references: canonical is a member', (SELECT count(*) FROM clusters c WHERE NOT EXISTS (SELECT 1 FROM members m WHERE m.duplicate_group_id = c.duplicate_group_id AND m.image_id = c.canonical_image))
    UNION ALL SELECT 'declared size: clusters', (SELECT count(*) FROM clusters c FULL JOIN (SELECT duplicate_group_id, count(*) AS k FROM members GROUP BY 1) m ON c.duplicate_group_id = m.duplicate_group_id WHERE c.jumlah_gambar IS DISTINCT FROM m.k)""",
    "page_pairs": _C + "SELECT ((id - 1) // 50)::INT AS page, id, image_a, image_b, group_id, (SELECT count(*) FROM portal) AS total FROM portal WHERE id <= 100",
    "search_pairs": _C + "SELECT id, image_a, image_b, relationship_type FROM portal WHERE duplicate_confidence = 'HIGH' AND (contains(lower(image_a), 'img00000000') OR contains(lower(image_b), 'img00000000'))",
    "search_clusters": _C + "SELECT c.duplicate_group_id, c.canonical_image, string_agg(DISTINCT m.ultg, '; ' ORDER BY m.ultg) AS ultg, max(m.kode_l1) FILTER (m.is_canonical = 'YA') AS kode_l1_canonical, any_value(c.jumlah_gambar) AS jumlah_gambar FROM clusters c JOIN members m USING (duplicate_group_id) WHERE cluster_status = 'SPLIT_RECOMMENDED' GROUP BY c.duplicate_group_id, c.canonical_image HAVING count(*) FILTER (m.ultg = 'U1') > 0",
    "cluster_detail": _C + "SELECT duplicate_group_id, cluster_status, image_id, is_canonical, quality_score FROM clusters JOIN members USING (duplicate_group_id) WHERE duplicate_group_id = 'DUP-00002'",
    "exists_filter": _C + "SELECT duplicate_group_id, jumlah_gambar FROM clusters WHERE duplicate_group_id IN (SELECT duplicate_group_id FROM members WHERE image_id IN (SELECT unnest([image_a, image_b]) FROM scored WHERE relationship_type = 'EXACT_DUPLICATE'))",
    "group_evidence": _C + "SELECT group_id, count(*) AS pairs, max(relationship_score) AS best FROM portal WHERE group_id IS NOT NULL GROUP BY 1",
    "executive_summary": _C.rstrip()
    + _L2_TAIL
    + """SELECT 'l1' AS layer, 'total' AS metric, count(*) AS value FROM r1 UNION ALL SELECT 'l1', 'code:' || kode, count(*) FROM r1 GROUP BY kode UNION ALL SELECT 'l1', 'review', count(*) FROM r1 WHERE perlu_review_manual = 'YA'
    UNION ALL SELECT 'l2', 'with_gaps', count(*) FROM l2 WHERE len(gaps) > 0 UNION ALL SELECT 'l2', 'gap_cells', sum(len(gaps))::BIGINT FROM l2 UNION ALL SELECT 'l3', 'pairs', count(*) FROM scored
    UNION ALL SELECT 'l3', 'type:' || relationship_type, count(*) FROM scored GROUP BY relationship_type UNION ALL SELECT 'l3', 'confidence:' || duplicate_confidence, count(*) FROM scored GROUP BY duplicate_confidence
    UNION ALL SELECT 'l3', 'clusters', count(*) FROM clusters UNION ALL SELECT 'l3', 'members', count(*) FROM members UNION ALL SELECT 'l3', 'status:' || cluster_status, count(*) FROM clusters GROUP BY cluster_status""",
    "master_result": _C.rstrip()
    + _L2_TAIL
    + """, ends AS (SELECT image_a AS image_id, image_b AS other, relationship_score, relationship_type FROM scored UNION ALL SELECT image_b, image_a, relationship_score, relationship_type FROM scored),
    best AS (SELECT image_id, first(other ORDER BY relationship_score DESC, other) AS best_partner, max(relationship_score) AS best_score, bool_or(relationship_type = 'EXACT_DUPLICATE') AS x, bool_or(relationship_type = 'NEAR_DUPLICATE') AS y FROM ends GROUP BY 1)
    SELECT i.image_id, l2.kode, confidence, cakupan_foto, len(gaps)::INT AS jumlah_belum_dinilai, best_partner, best_score, CASE WHEN x THEN 'YA' ELSE 'TIDAK' END AS exact_duplicate_flag, CASE WHEN y THEN 'YA' ELSE 'TIDAK' END AS near_duplicate_flag, duplicate_group_id, is_canonical
    FROM l2 JOIN images i ON i.doc_id = l2.doc_id LEFT JOIN best ON best.image_id = i.image_id LEFT JOIN members m ON m.image_id = i.image_id""",
    "review_queue": _C
    + """SELECT image_id, string_agg(DISTINCT reason, ';' ORDER BY reason) AS reasons FROM (
    SELECT i.image_id, 'low_confidence' AS reason FROM r1 JOIN images i ON i.doc_id = r1.doc_id WHERE confidence = 'rendah' UNION ALL SELECT i.image_id, 'wrong_object' FROM r1 JOIN images i ON i.doc_id = r1.doc_id WHERE kode = 'O'
    UNION ALL SELECT image_id, CASE cluster_status WHEN 'NEED_REVIEW' THEN 'cluster_review' ELSE 'cluster_split' END FROM members JOIN clusters USING (duplicate_group_id) WHERE cluster_status <> 'VALID'
    UNION ALL SELECT unnest([image_a, image_b]), 'near_duplicate_with_low_score' FROM scored WHERE relationship_type = 'NEAR_DUPLICATE' AND relationship_score < 0.70
    UNION ALL SELECT unnest([image_a, image_b]), 'same_object_uncertain' FROM scored WHERE relationship_type = 'SAME_OBJECT' AND duplicate_confidence = 'MEDIUM') GROUP BY 1""",
}
