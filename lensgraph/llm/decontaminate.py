"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window is ``WINDOW`` consecutive words of a benchmark item.  Of the k-grams of
a window the one with the smallest hash is its fingerprint, so a document that
holds the window holds its fingerprint at the same place inside it: every shared
span of WINDOW words is found.  An item of fewer words is one window, with the
hash of all its words as fingerprint; documents are hashed at those lengths only
if such items exist (at most WINDOW - 1 lengths).

1. A document's distinct fingerprints meet the benchmark's.  Few documents are
   left; no text leaves the scan.
2. Their windows whose fingerprint the benchmark has are extended: the words of
   both windows must be equal.
3. Hit words are the union of the windows found.

The benchmark's windows are broadcast while they have at most
``BROADCAST_BYTES``; beyond, the joins shuffle by fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lensgraph.llm.session import cut

WINDOW = 10
GRAM = 5
#: The benchmark is broadcast up to this size.
BROADCAST_BYTES = 64 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, before and after A-Z are lower-cased.
_GAPS_LOWERED = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, even where body is a loop over it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: str) -> Column:
    return F.coalesce(F.array_remove(F.split(F.translate(F.col(text), _UPPER, _LOWER), _GAPS_LOWERED), ""), F.array().cast("array<string>"))


def _positions(n: Column, length: int) -> Column:
    """1-based starts of the runs of ``length`` among n items."""
    return F.when(n >= length, F.sequence(F.lit(1), n - (length - 1))).otherwise(F.array().cast("array<int>"))


def _hashes(w: Column, length: int) -> Column:
    parts = lambda i: [F.get(w, i + (j - 1)) for j in range(length)]
    return F.transform(_positions(F.size(w), length), lambda i: F.xxhash64(F.lit(length), *parts(i)))


def _window_keys(w: Column) -> Column:
    """The fingerprint of each window, in order."""
    per_window = WINDOW - GRAM + 1
    return bind(_hashes(w, GRAM), lambda g: F.transform(_positions(F.size(g), per_window), lambda i: F.array_min(F.slice(g, i, per_window))))


def _windows(w: Column, short: list[int]) -> Column:
    """(start, length, key) of each window and of each run of a short length."""
    of = lambda keys, length: F.transform(keys, lambda k, i: F.struct((i + 1).alias("start"), F.lit(length).alias("length"), k.alias("key")))
    return F.concat(of(_window_keys(w), WINDOW), *(of(_hashes(w, n), n) for n in short))


def benchmark_windows(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, length, key, content): the windows of each item; items without words have none."""
    split = items.select(F.col(id_column).alias("item_id"), words(text_column).alias("w")).where(F.size("w") > 0)
    whole = split.where(F.size("w") >= WINDOW).select("item_id", "w", F.explode(bind(F.col("w"), lambda w: _windows(w, []))).alias("x"))
    part = split.where(F.size("w") < WINDOW)
    every = whole
    for n in range(1, WINDOW):
        key = F.get(_hashes(F.col("w"), n), F.lit(0))
        every = every.union(part.where(F.size("w") == n).select("item_id", "w", F.struct(F.lit(1).alias("start"), F.lit(n).alias("length"), key.alias("key")).alias("x")))
    return every.select("item_id", F.col("x.length").alias("length"), F.col("x.key").alias("key"), F.array_join(F.slice("w", F.col("x.start"), F.col("x.length")), " ").alias("content")).distinct()


def _hits(base: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((doc_id, th, n_hit), (doc_id, th, n_items, joined)) of the documents (doc_id, text) that hold a window."""
    bench = cut(benchmark_windows(items))
    # What is broadcast: a key of eight bytes, the words and the items of each window.
    size, *_ = bench.agg(F.sum(F.octet_length("content") + 64)).first()
    short = sorted(r[0] for r in bench.where(f"length < {WINDOW}").select("length").distinct().collect())
    small = F.broadcast if (size or 0) <= BROADCAST_BYTES else (lambda df: df)
    marked = base.withColumn("th", F.xxhash64("text"))

    keys = bind(words("text"), lambda w: F.array_distinct(F.concat(_window_keys(w), *(_hashes(w, n) for n in short))))
    met = marked.select("doc_id", "th", F.explode(keys).alias("key")).join(small(bench.select("key").distinct()), "key", "left_semi")
    candidates = cut(met.select("doc_id", "th").distinct())

    chosen = marked.alias("d").join(candidates.alias("c"), F.expr("d.doc_id <=> c.doc_id AND d.th = c.th"), "left_semi").dropDuplicates(["doc_id", "th"])
    placed = chosen.select("doc_id", "th", words("text").alias("w")).select("doc_id", "th", "w", F.explode(bind(F.col("w"), lambda w: F.transform(_windows(w, short), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"), x["key"].alias("key"), F.array_join(F.slice(w, x["start"], x["length"]), " ").alias("content"))))).alias("x"))
    windows = bench.groupBy("key", "content", "length").agg(F.collect_set("item_id").alias("items"))
    found = cut(placed.select("doc_id", "th", "x.start", "x.length", "x.key", "x.content").join(small(windows), ["key", "content", "length"]).select("doc_id", "th", "start", "length", "items"))

    spans = found.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["upto"], s["start"]))).alias("n"), F.greatest(acc["upto"], s["end"]).alias("upto")),
        lambda acc: acc["n"],
    )
    hit = spans.select("doc_id", "th", covered.cast("long").alias("n_hit"))
    named = found.select("doc_id", "th", F.explode("items").alias("item")).distinct().groupBy("doc_id", "th").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list(F.col("item").cast("string"))), ",").alias("joined"))
    return hit, named


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of ``docs``.

    Null and empty texts have no words and no hits.  Texts of any length are
    taken whole.  Repeated rows and null ids give a row each, and rows that share an
    id are judged by their own texts; there are no ties.  Null item ids count as no
    item, but their words are hit.  An empty benchmark hits nothing, and an empty
    table gives no rows.  Other columns are not looked at, whatever their names.
    """
    base = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    hit, named = _hits(base, items)
    same = lambda other: F.expr(f"d.doc_id <=> {other}.doc_id AND d.th = {other}.th")
    counted = base.select("doc_id", F.xxhash64("text").alias("th"), F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("n_words"))
    return (
        counted.alias("d")
        .join(hit.alias("h"), same("h"), "left")
        .join(named.alias("n"), same("n"), "left")
        .select(
            "d.doc_id",
            "d.n_words",
            F.coalesce("h.n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n.n_items", F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce("n.joined", F.lit("")), 256).alias("items_sha256"),
            F.coalesce(F.col("h.n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark, all columns as they are.

    A row goes by its own text, whatever other rows have its id; null texts stay.
    Null and repeated ids, ties, repeated rows, long texts, empty tables and
    clashing names are handled as by ``contamination``.
    """
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64("text").alias("th"))
    # By text alone: equal texts share the verdict, so copies are looked at once.
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    bad = _hits(texts, items)[0].select(F.col("th").alias("bad")).distinct()
    return row.join(bad, F.col("th") == F.col("bad"), "left_anti").select("row.*")


_LETTERS = f"'{_UPPER}', '{_LOWER}'"
#: DuckDB SQL for op3: every window of every item against every window of every document.
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS l, array_to_string(list_slice(w, i, i + least(len(w), {WINDOW}) - 1), ' ') AS c
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) AS i FROM b WHERE len(w) > 0)),
ls AS (SELECT DISTINCT l FROM bw),
dw AS (SELECT doc_id, i, l, array_to_string(list_slice(w, i, i + l - 1), ' ') AS c
       FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, ls WHERE len(w) >= l)),
m AS (SELECT doc_id, i, l, item_id FROM dw JOIN bw USING (l, c)),
h AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, l)) AS k FROM (SELECT DISTINCT doc_id, i, l FROM m)) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS j FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(j, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
"""
