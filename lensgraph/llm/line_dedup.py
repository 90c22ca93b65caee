"""Removal of repeated multi-line chunks, cut where the content says so, in DataFrame operations only.

1. Lines are hashed, and a rolling hash over ``ROLL`` line hashes puts a border
   after about one line in ``DIVISOR``.  Borders depend on the lines beside them
   alone, so a passage that is shifted within its document is cut as elsewhere.
2. Digests of chunks of two lines or more are counted globally, and the copies
   after the first give up their inner lines as one unit each.
3. A chunk that a passage only partly fills matches nothing.  So matches are
   extended, line by line, over chunk borders and into unmatched chunks: the
   *pairs* of neighbouring lines that no copy of step 2 covers are counted in the
   same way.  Steps 2 and 3 together find every repeated run of two or more lines.
4. Chunks and pairs with repeated digests meet their texts, and grouping by digest
   and bytes is the byte comparison.  The occurrence of smallest (document id,
   line, text hash) stays; the lines of all others go.  The first occurrence of a line
   in the corpus always stays, and a line that repeats without a neighbour is left alone.

Digests that make up more than one in ``session.HOT`` rows are dealt over shares, so no
task gets all copies of a line.  Step 4 and the rewriting need the texts by document;
they are in one plan, so that the planner shuffles the texts once and reuses that exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lensgraph.llm.decontaminate import bind
from lensgraph.llm.session import cut, join_with_hot

ROLL = 2
DIVISOR = 3


def _lines(text: str) -> Column:
    return F.coalesce(F.split(F.col(text), "\n"), F.array().cast("array<string>"))


def _chunks(lines: Column) -> Column:
    """(first, n, d1, d2, h) of each chunk: its first line from 1 on, its lines, two digests, and the hashes of its lines and of the next one."""

    def ends(h: Column) -> Column:
        every = F.when(F.size(h) > 0, F.sequence(F.lit(1), F.size(h))).otherwise(F.array().cast("array<int>"))
        rolled = lambda i: F.xxhash64(*(F.get(h, i - j) for j in range(ROLL, 0, -1)))
        return F.filter(every, lambda i: (i == F.size(h)) | ((i >= ROLL) & (F.pmod(rolled(i), F.lit(DIVISOR)) == 0)))

    def chunk(h: Column, before: Column, end: Column) -> Column:
        own = F.slice(h, before + 1, end - before)
        return F.struct((before + 1).alias("first"), (end - before).alias("n"), F.xxhash64(own).alias("d1"), F.xxhash64(F.lit(ROLL), F.reverse(own)).alias("d2"), F.slice(h, before + 1, end - before + 1).alias("h"))

    return bind(F.transform(lines, lambda x: F.xxhash64(x)), lambda h: bind(ends(h), lambda e: F.transform(e, lambda end, k: chunk(h, F.coalesce(F.get(e, k - 1), F.lit(0)), end))))


def _same(other: str) -> Column:
    return F.expr(f"d.__id <=> {other}.__id AND d.__th = {other}.__th")


def _candidates(texts: DataFrame) -> DataFrame:
    """(__id, __th, first, n, digest, shares): chunks, and pairs of lines that no later copy of a chunk covers, whose digests repeat."""
    chunks = cut(texts.select("__id", "__th", F.explode(_chunks(_lines("__text"))).alias("c")).select("__id", "__th", "c.*"))
    multi = chunks.where("n > 1").drop("h")
    rank = F.struct("__id", "first", "__th")
    repeated = cut(multi.groupBy("d1", "d2").agg(F.count("*").alias("m"), F.min(rank).alias("keep")).where("m > 1"))
    found = cut(join_with_hot(multi, repeated, ["d1", "d2"], "m", "shares").withColumn("later", ~rank.eqNullSafe(F.col("keep"))).drop("keep"))
    later = found.where("later").select(F.col("__id").alias("o_id"), F.col("__th").alias("o_th"), F.col("first").alias("o_first")).distinct()
    marked = chunks.join(later, F.expr("__id <=> o_id AND __th = o_th AND first = o_first"), "left")
    # A later copy keeps the pair that it makes up with the line after it.
    start = F.when(F.col("o_first").isNull(), F.lit(1)).otherwise(F.col("n"))
    places = F.when(F.size("h") > start, F.sequence(start, F.size("h") - 1)).otherwise(F.array().cast("array<int>"))
    pair = lambda i: F.struct((F.col("first") + i - 1).alias("first"), F.xxhash64(F.get("h", i - 1), F.get("h", i)).alias("digest"))
    pairs = cut(marked.select("__id", "__th", F.explode(F.transform(places, pair)).alias("p")).select("__id", "__th", "p.*"))
    counts = cut(pairs.groupBy("digest").agg(F.count("*").alias("m")).where("m > 1"))
    twos = join_with_hot(pairs, counts, ["digest"], "m", "shares").select("__id", "__th", "first", F.lit(2).alias("n"), "digest", "shares")
    return found.select("__id", "__th", "first", "n", F.col("d1").alias("digest"), "shares").union(twos)


def _removals(base: DataFrame) -> DataFrame:
    """(__id, __th, gone): the lines that documents lose, in order; ``base`` has __id, __th and __text."""
    texts = base.select("__id", "__th", "__text")
    wanted = _candidates(texts).groupBy("__id", "__th").agg(F.collect_set(F.struct("first", "n", "digest", "shares")).alias("wanted"))
    content = lambda x, c: F.struct(*(c[k].alias(k) for k in ("first", "n", "digest", "shares")), F.array_join(F.slice(x, c["first"], c["n"]), "\n").alias("content"))
    held = texts.alias("d").join(wanted.alias("w"), _same("w")).select("d.__id", "d.__th", F.explode(bind(_lines("d.__text"), lambda x: F.transform("w.wanted", lambda c: content(x, c)))).alias("c")).select("__id", "__th", "c.*")
    rank = F.struct("__id", "first", "__th")
    kept = held.groupBy("digest", "n", "content").agg(F.min(rank).alias("keep"), F.count("*").alias("m"), F.max("shares").alias("shares")).where("m > 1")
    # The bytes have been compared; their SHA-256 takes the verdict back to the occurrences.
    kept = kept.select("digest", "n", F.sha2("content", 256).alias("bytes"), "keep", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    dealt = held.select("__id", "__th", "first", "digest", "n", F.sha2("content", 256).alias("bytes"), F.pmod(F.xxhash64("__id", "__th", "first"), F.col("shares")).cast("int").alias("share"))
    return (
        dealt.join(kept, ["digest", "n", "bytes", "share"])
        .where(~rank.eqNullSafe(F.col("keep")))
        .groupBy("__id", "__th")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1))))).alias("gone"))
    )


def _clean_text() -> Column:
    # Set operations on positions, as they take linear time.
    rest = lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(1), F.size(x)), F.col("g.gone")), lambda i: F.get(x, i - 1)), "\n")
    return F.when(F.col("g.gone").isNull(), F.col("d.__text")).otherwise(bind(_lines("d.__text"), rest))


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_chunks_removed, n_lines_removed, clean_text) for each row of ``docs``.

    A removed chunk is a maximal run of removed lines.  Null text: no lines, null
    clean text; an empty text is one empty line.  Texts of any length are taken
    whole, in linear time.  Rows that repeat id and text are one occurrence, so all
    of them lose what one of them loses; a null id ranks first, and other ties do
    not occur.  Other columns are not looked at, whatever their names.  An empty
    table gives no rows.
    """
    base = docs.select(F.col(id_column).alias("__id"), F.xxhash64(text_column).alias("__th"), F.col(text_column).alias("__text"))
    gone = F.coalesce("g.gone", F.array().cast("array<int>"))
    return (
        base.alias("d")
        .join(_removals(base).alias("g"), _same("g"), "left")
        .select(
            F.col("d.__id").alias("doc_id"),
            F.size(_lines("d.__text")).cast("long").alias("n_lines"),
            F.size(F.array_except(gone, F.transform(gone, lambda i: i + 1))).cast("long").alias("n_chunks_removed"),
            F.size(gone).cast("long").alias("n_lines_removed"),
            _clean_text().alias("clean_text"),
        )
    )


def clean_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, n_chars and any others) without their repeated runs of lines.

    Texts and n_chars follow what is left; rows that lose lines and keep none with a
    word go.  Null and empty texts stay as they are; nulls, ties, repeated rows,
    long texts, empty tables and clashing names are handled as by ``line_dedup``.
    """
    names = docs.columns
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("__row")
    base = docs.select(row, F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__th"), F.col("text").alias("__text"))
    joined = base.alias("d").join(_removals(base).alias("g"), _same("g"), "left").select("d.__row", F.col("g.gone").isNotNull().alias("__lost"), _clean_text().alias("__clean"))
    left = joined.where(~F.col("__lost") | F.col("__clean").rlike(r"\S"))

    def column(c: str) -> Column:
        if c == "text":
            return F.col("__clean").alias(c)
        own = F.col(f"__row.`{c}`")
        return (F.when(F.col("__lost"), F.length("__clean").cast(docs.schema[c].dataType)).otherwise(own) if c == "n_chars" else own).alias(c)

    return left.select(*map(column, names))


#: DuckDB SQL for op10: a line goes if it and a neighbour are a later copy of two neighbouring lines.
ORACLE = r"""
WITH l AS (SELECT doc_id, i, x FROM (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))),
p AS (SELECT doc_id, i, x AS a, lead(x) OVER w AS b, lead(i) OVER w AS j FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT DISTINCT doc_id, unnest([i, j]) AS i FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, i) AS place FROM p WHERE j IS NOT NULL) WHERE place > 1),
n AS (SELECT doc_id, count(*) AS n_gone, count(*) FILTER (first) AS n_runs FROM (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 2) > 1 AS first FROM g) GROUP BY doc_id),
c AS (SELECT l.doc_id, string_agg(l.x, chr(10) ORDER BY l.i) AS clean FROM l ANTI JOIN g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n_runs, 0)::BIGINT AS n_chunks_removed, coalesce(n_gone, 0)::BIGINT AS n_lines_removed,
       CASE WHEN text IS NOT NULL THEN coalesce(clean, '') END AS clean_text
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""
