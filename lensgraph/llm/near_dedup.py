"""Near-duplicate groups by min-max hashing.

Every permutation of the shingle universe gives two signature values, its
smallest and its largest image, so 64 hash evaluations a shingle give 128
values.  Two permutations make one band of four values, 32 bands in all: two
documents of similarity s share a band with probability 1 - (1 - s^4)^32, which
at 0.75 is 1 - 5e-6.  Sets of at most ``SMALL`` shingles, whose few values
are less independent, also take each shingle as a key, which misses nothing.

1. Documents with equal shingle sets form a class; only its smallest id goes on.
2. Each document in a band bucket with others meets the one that meets most
   others in their buckets, and the link is confirmed on the full sets.  Such
   links only lead to documents that meet more, or as many and have a larger id,
   so they are a forest, whose roots are found by doubling pointers.
3. Documents of buckets that still hold several components are joined exactly,
   by prefix filtering on their full sets, pairs inside a component left out.
   So no link of a bucket that could join two components is lost, and documents
   that only share a bucket are told apart without being paired.
4. The links of step 3 join components, by alternating large and small stars.

Hot buckets: the hub side of a join has one row a key, so the long side may be
split freely (adaptive skew join); bucket aggregates combine before the shuffle.
Shingles of many documents are dealt over shares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lensgraph.llm import textnp
from lensgraph.llm.components import components, roots
from lensgraph.llm.session import cut, join_dealt, join_with_hot

SHINGLE_WORDS = 5
PERMUTATIONS = 64
BANDS = 32
SMALL = 16
#: Counters of the shingles' numbers of documents, whatever the corpus.
SKETCH = 1 << 20
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75

_rng = np.random.default_rng(404)
_A = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64)[:, None]
_BAND_SEED = textnp.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
_SIGNED = "doc_id long, n long, d1 long, d2 long, keys array<long>"


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """The band keys of a non-empty shingle set, in blocks of columns so that memory is bounded."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        image = shingles[at : at + 2048] * _A
        image ^= _B
        np.minimum(low, image.min(axis=1), out=low)
        np.maximum(high, image.max(axis=1), out=high)
    values = textnp.mix(np.stack((low, high), axis=1).reshape(BANDS, -1))
    key = _BAND_SEED.copy()
    for column in values.T:
        key = textnp.mix(key ^ column) * textnp._STEP
    if len(shingles) <= SMALL:
        key = np.concatenate((key, textnp.mix(shingles)))
    return key


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for first, last, texts in textnp.chunks(batch, "text"):
            words = textnp.Words(texts)
            hashes, bounds = words.hashes, words.bounds
            sizes, d1, d2, keys = [], [], [], []
            for i in range(last - first):
                shingles = textnp.shingle_set(hashes[bounds[i] : bounds[i + 1]], SHINGLE_WORDS)
                sizes.append(len(shingles))
                d1.append(int(np.bitwise_xor.reduce(shingles).view(np.int64)) if len(shingles) else 0)
                d2.append(int(textnp.mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(shingles) else 0)
                keys.append(band_keys(shingles).view(np.int64) if len(shingles) else np.zeros(0, np.int64))
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids[first:last], pa.array(sizes, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.ListArray.from_arrays(offsets, np.concatenate(keys))],
                names=["doc_id", "n", "d1", "d2", "keys"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, shingles) of whole texts."""
    for batch in batches:
        ids = batch.column(0)
        for first, last, texts in textnp.chunks(batch, "text"):
            words = textnp.Words(texts)
            hashes, bounds = words.hashes, words.bounds
            found = [textnp.shingle_set(hashes[bounds[i] : bounds[i + 1]], SHINGLE_WORDS).view(np.int64) for i in range(last - first)]
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids[first:last], pa.array(sizes), pa.ListArray.from_arrays(offsets, np.concatenate(found))], names=["doc_id", "n", "shingles"])


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that the full sets confirm."""
    near = pairs.join(sets.select(F.col("doc_id").alias("v"), F.col("n").alias("nv"), F.col("shingles").alias("sv")), "v").join(
        sets.select(F.col("doc_id").alias("u"), F.col("n").alias("nu"), F.col("shingles").alias("su")), "u"
    )
    near = near.where(F.lit(100) * F.least("nu", "nv") >= F.lit(PERCENT) * F.greatest("nu", "nv"))
    common = F.size(F.array_intersect("su", "sv"))
    return cut(near.where(F.lit(100) * common >= F.lit(PERCENT) * (F.col("nu") + F.col("nv") - common)).select("u", "v"))


def _with_component(members: DataFrame, comps: DataFrame) -> DataFrame:
    return members.join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def _prefixes(sketch: np.ndarray):
    """(s, doc_id, component, n, place, before): the shingles of each document that may find smaller sets, rarest first, each with the one before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            sizes = batch.column(2).to_numpy()
            sets = textnp.lists(pa.chunked_array([batch.column(3)]))
            longest = sizes - -(-sizes * PERCENT // 100) + 1
            kept = [x[np.lexsort((x, sketch[x % SKETCH]))[:k]] for x, k in zip(sets, longest, strict=True)]
            rows = np.repeat(np.arange(len(sizes)), longest)
            place = np.concatenate([np.arange(1, k + 1) for k in longest])
            before = np.concatenate([x for own, k in zip(batch.column(0).to_numpy(), kept, strict=True) for x in ([own], k[:-1])])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(kept)), *(batch.column(i).take(pa.array(rows)) for i in range(3)), pa.array(place), pa.array(before)], names=["s", "doc_id", "component", "n", "place", "before"])

    return run


def _joined(comps: DataFrame, more: DataFrame) -> DataFrame:
    """(node, component) after ``more`` links (u, v); the links are contracted to links of components first."""
    side = lambda c: comps.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))
    lifted = more.join(side("u"), "u", "left").join(side("v"), "v", "left").select("u", "v", F.coalesce("c_u", "u").alias("c_u"), F.coalesce("c_v", "v").alias("c_v"))
    least = cut(components(lifted.select(F.col("c_u").alias("u"), F.col("c_v").alias("v"))))
    nodes = comps.unionByName(lifted.select(F.col("u").alias("node"), F.col("c_u").alias("component"))).unionByName(lifted.select(F.col("v").alias("node"), F.col("c_v").alias("component"))).distinct()
    return nodes.join(least.select(F.col("node").alias("component"), F.col("component").alias("least")), "component", "left").select("node", F.coalesce("least", "component").alias("component"))


def _across_components(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) of different components that may still be linked, once each."""
    return _meetings(members, sets).distinct()


def _meetings(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) of different components that may still be linked, by prefix filtering.

    ``members``: (doc_id, component).  Shingles are put in one order for all
    documents, rarest first by a sketch of SKETCH counters.  Two sets with an
    intersection of at least a = ceil(P (n1 + n2) / (100 + P)) have a common shingle
    among the first n1 - a + 1 of the one and the first n2 - a + 1 of the other,
    whatever the order.  As a grows with the other set, a set needs
    n - ceil(P n / 100) + 1 shingles to meet smaller ones, but only
    n - ceil(2 P n / (100 + P)) + 1 to be met by ones of its size or larger.  A
    document far from its group has that many shingles of its own and meets no one.
    Documents meet at the first shingle of each run that they have in common.
    """
    own = sets.join(members, "doc_id").select("doc_id", "component", "n", "shingles")
    counters = own.select(F.explode("shingles").alias("s")).groupBy(F.pmod("s", F.lit(SKETCH)).alias("counter")).agg(F.count("*").alias("m")).toArrow()
    sketch = np.zeros(SKETCH, dtype=np.int64)
    sketch[counters["counter"].to_numpy()] = counters["m"].to_numpy()
    entries = cut(own.mapInArrow(_prefixes(sketch), "s long, doc_id long, component long, n long, place long, before long"))
    counts = entries.groupBy("s", "component").agg(F.count("*").alias("m"))
    largest = cut(counts.groupBy("s").agg(F.sum("m").alias("m"), F.max_by("component", F.struct("m", "component")).alias("largest"), F.count("*").alias("several")).where("several > 1").drop("several"))
    marked = cut(join_with_hot(entries, largest, ["s"], "m").withColumn("small", F.col("component") != F.col("largest")).drop("largest"))
    met = marked.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * (2 * PERCENT) / (100 + PERCENT)) + 1)
    met = met.select("s", *(F.col(c).alias(f"l_{c}") for c in ("doc_id", "component", "n", "place", "before", "small")))
    # Entries of a shingle's largest component do not meet each other: at least one of two is of another.
    pairs = join_dealt(marked, met.where("l_small"), ["s"], largest, "m").unionByName(join_dealt(marked.where("small"), met.where("NOT l_small"), ["s"], largest, "m"))
    # Two documents that have the same shingle before met there already, and those of one size meet from one side.
    once = (F.col("before") != F.col("l_before")) & ((F.col("n") > F.col("l_n")) | ((F.col("n") == F.col("l_n")) & (F.col("doc_id") > F.col("l_doc_id"))))
    need = F.ceil((F.col("n") + F.col("l_n")) * PERCENT / (100 + PERCENT))
    return (
        pairs.where((F.col("component") != F.col("l_component")) & once & (F.col("place") <= F.col("n") - need + 1) & (F.col("l_place") <= F.col("l_n") - need + 1))
        .select(F.least("doc_id", "l_doc_id").alias("u"), F.greatest("doc_id", "l_doc_id").alias("v"))
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    Null text and texts without a word: no shingles, a component of their own,
    kept.  Texts of any length are taken whole; memory goes with the longest one.
    Null ids: never linked, null component, kept.  Repeated rows give
    repeated rows, and rows that share an id share a node.  Ties go to the
    smallest id.  Other columns are not looked at, whatever their names.  An empty table gives none.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    signed = cut(texts.mapInArrow(_sign, _SIGNED))
    filled = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = cut(filled.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1"))
    copies = cut(join_with_hot(filled.select("doc_id", "d1", "d2", "n"), classes, ["d1", "d2", "n"], "copies").select("doc_id", "rep").distinct())
    reps = filled.join(copies.where("doc_id != rep"), "doc_id", "left_anti")

    keyed = reps.select("doc_id", F.explode("keys").alias("key")).distinct()
    shared = keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    members = cut(keyed.join(shared, "key"))
    # A document in the middle of its group shares most buckets: each bucket's hub is the member that meets most others.
    reach = members.groupBy("doc_id").agg(F.sum("m").alias("reach"))
    hubs = members.join(reach, "doc_id").groupBy("key").agg(F.max(F.struct("reach", "doc_id")).alias("hub"))
    best = members.join(hubs, "key").groupBy("doc_id").agg(F.max("hub").alias("hub")).select(F.col("hub.doc_id").alias("u"), F.col("doc_id").alias("v"))
    sets = cut(texts.join(reach.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_sets, "doc_id long, n long, shingles array<long>").dropDuplicates(["doc_id"]))
    links = _links(best.where("u != v"), sets)
    tree = cut(roots(links))
    comps = cut(tree.join(tree.groupBy("root").agg(F.min("node").alias("component")), "root").select("node", "component"))

    placed = _with_component(members.select("key", "doc_id"), comps)
    several = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("key")
    undecided = cut(placed.join(several, "key", "left_semi").select("doc_id", "component").distinct())
    if not undecided.isEmpty():
        more = _links(_across_components(undecided, sets), sets)
        if not more.isEmpty():
            comps = cut(_joined(comps, more))

    whole = copies.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("c"))
    alone = comps.join(copies.select(F.col("doc_id").alias("node")), "node", "left_anti").select(F.col("node").alias("doc_id"), F.col("component").alias("c"))
    found = whole.union(alone)
    return (
        signed.select("doc_id", F.col("n").alias("n_shingles"))
        .join(found, "doc_id", "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("c", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are.

    Nulls, texts without a word and null ids stay; a row repeated under one id
    stays repeated; an empty table gives none; names may clash with anything.
    """
    gone = near_duplicates(docs, id_column, text_column).where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_column).cast("long").alias("id"))
    return row.join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")


#: DuckDB SQL for op4: every pair of documents that share a shingle, then the transitive closure of the links.
ORACLE = rf"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {SHINGLE_WORDS - 1}), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE_WORDS - 1}, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
sym AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach AS (SELECT u AS s, u AS t FROM sym UNION SELECT s, v FROM reach JOIN sym ON t = u),
comp AS (SELECT s, min(t) AS c FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, w.doc_id) AS component_id, coalesce(c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON s = w.doc_id
"""
