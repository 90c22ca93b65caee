"""Mixing sources to target weights by Sainte-Laguë apportionment.

The unit is a block of ``block`` consecutive words, the same for all sources.
Blocks are apportioned to the sources by the highest quotients weight / (2 s + 1),
then to the shelves of a source and to the shards of a shelf in the same way, so
that each shard has an integer quota.  Within a shard documents lie end to end in
seeded hash order; the quota picks every block ``quota // blocks`` times and the
remainder by seeded systematic selection.  A document takes the words of the
chosen blocks that fall on it.

Shards hold about ``SHARD_WORDS`` words or ``SHARD_ROWS`` rows whatever a source's
size, and shelves about ``SHELF_SHARDS`` shards, so a hot source is many shards in
many tasks, and a task apportions one shelf.  Rows that repeat id, source and text
are counted before they are dealt and laid one behind the other.  Totals of the
sources are all the driver gets; more than ``MAX_SOURCES`` are an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lensgraph.llm.session import SPACED_WORD, cut, release

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2
SEED = 1912
SHARD_WORDS = 500_000
SHARD_ROWS = 50_000
SHELF_SHARDS = 1000
BLOCK_WORDS = 256
#: Blocks of the smallest source at least, unless they would have fewer than LEAST_BLOCK words.
LEAST_BLOCKS = 64
LEAST_BLOCK = 16
#: A source takes the driver about 100 bytes.
MAX_SOURCES = 1_000_000
#: The table of sources, of less than 100 bytes a row, is broadcast up to this many rows.
BROADCAST_SOURCES = 50_000


def targets(sizes: np.ndarray, weights: np.ndarray, total: float) -> np.ndarray:
    """Shares of ``total`` by weight, none above MAX_REPEAT times its size; excess is reshared by weight."""
    limit = MAX_REPEAT * sizes.astype(float)
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool), float(total)
    while free.any():
        share = left * weights / weights[free].sum()
        over = free & (share > limit)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = limit[over]
        left -= limit[over].sum()
        free &= ~over
    return out


def apportion(weights: np.ndarray, seats: int, limits: np.ndarray) -> np.ndarray:
    """Sainte-Laguë seats, none above its limit; ties go to the earlier entry.

    A divisor is bisected so that nearly all seats are dealt at once; the rest
    go to the highest quotients of one ranking.
    """
    weights = np.asarray(weights, dtype=float)
    limits = np.where(weights > 0, np.asarray(limits, dtype=np.int64), 0)
    seats = int(min(seats, limits.sum()))
    if seats <= 0:
        return np.zeros(len(weights), dtype=np.int64)
    dealt = lambda d: np.minimum(np.floor(weights / d + 0.5), limits).astype(np.int64)
    low, high = weights[weights > 0].min() / (2.0 * limits.max() + 2), weights.max() * 4
    for _ in range(200):
        middle = (low * high) ** 0.5
        low, high = (middle, high) if dealt(middle).sum() > seats else (low, middle)
    out = dealt(high * (1 + 1e-12))  # a little above, so that equal quotients are left to the last step
    while (left := seats - int(out.sum())) > 0:
        # Quotients of one entry are further apart than what is left, so each gets one more at most.
        quotient = np.where(out < limits, weights / (2 * out + 1), -1.0)
        best = np.argsort(-quotient, kind="stable")[:left]
        out[best[quotient[best] > 0]] += 1
    return out


def _quotas_of_source(frame: pd.DataFrame) -> pd.DataFrame:
    """Seats of a source's shelves."""
    frame = frame.sort_values("shelf").reset_index(drop=True)
    frame["shelf_seats"] = apportion(frame["shelf_size"].to_numpy(), int(frame["seats"].iloc[0]), MAX_REPEAT * frame["shelf_blocks"].to_numpy())
    return frame[["position", "shelf", "shelf_seats"]]


def _quotas_of_shelf(frame: pd.DataFrame) -> pd.DataFrame:
    """Quotas of a shelf's shards."""
    frame = frame.sort_values("shard").reset_index(drop=True)
    frame["quota"] = apportion(frame["shard_size"].to_numpy(), int(frame["shelf_seats"].iloc[0]), MAX_REPEAT * frame["blocks"].to_numpy())
    return frame[["position", "shard", "blocks", "quota"]]


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of ``docs``.

    Sources are taken in code point order, null last as a source of its own, and
    weigh ``weights`` in turn.  Null and empty texts have size 0 and take
    nothing; texts of any length are counted whole.  Null ids are documents like
    others; repeated rows are documents of their own, laid one behind the other.
    Ties in quotients go to the earlier source, shelf or shard, ties in hash order to the
    smaller id.  Where every text is empty all targets are 0; an empty table gives no
    rows.  Other columns are not looked at, whatever their names.
    """
    return _mixed(docs, docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), F.col(text_column).alias("text")), weights, share, seed)


def add_taken(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, source and any others) with size, source_size, target and taken; odd rows as in ``mix``.

    A column of ``docs`` that has one of these names is replaced.
    """
    added = ("size", "source_size", "target", "taken")
    base = docs.drop(*added)
    key = lambda df: df.select("doc_id", "source", "text")
    found = _mixed(docs, key(base), WEIGHTS, SHARE, SEED, keep_place=True)
    # Rows that repeat id, source and text are told apart by a number, on both sides.
    same = ("id", "src", "place")
    numbered = lambda df: df.withColumn("nth", F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0))))
    left = numbered(base.select(F.struct(*(F.col(f"`{c}`") for c in base.columns)).alias("row"), F.col("doc_id").alias("id"), F.col("source").alias("src"), _place(SEED, "doc_id", "text").alias("place")))
    right = numbered(found.select(F.col("doc_id").alias("id"), F.col("source").alias("src"), "place", F.struct(*added).alias("mixed")))
    return left.alias("l").join(right.alias("r"), F.expr("l.id <=> r.id AND l.src <=> r.src AND l.place = r.place AND l.nth = r.nth")).select("l.row.*", "r.mixed.*")


def _place(seed: int, id_column: str, text_column: str):
    return F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column))


def _mixed(docs: DataFrame, picked: DataFrame, weights: tuple[int, ...], share: float, seed: int, keep_place: bool = False) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(SPACED_WORD)), F.lit(0)).cast("long")
    each = picked.select("doc_id", "source", size.alias("size"), _place(seed, "doc_id", "text").alias("place"))
    sized = cut(each.groupBy("doc_id", "source", "size", "place").agg(F.count("*").alias("copies")))
    words = F.col("size") * F.col("copies")
    sources = sized.groupBy("source").agg(F.sum(words).alias("source_size"), F.sum("copies").alias("rows")).limit(MAX_SOURCES + 1).toPandas()
    if len(sources) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    spark = docs.sparkSession
    # What follows is one plan, over which nothing else lets the driver's memory go.
    release(spark)
    order = sorted(range(len(sources)), key=lambda i: (sources["source"][i] is None, (sources["source"][i] or "").encode()))
    sizes = sources["source_size"].to_numpy(dtype=np.int64)[order] if len(sources) else np.zeros(0, np.int64)
    rows = sources["rows"].to_numpy(dtype=np.int64)[order] if len(sources) else np.zeros(0, np.int64)
    weigh = np.array([weights[i % len(weights)] for i in range(len(order))], dtype=float)
    goal = targets(sizes, weigh, share * float(sizes.sum()))
    positive = sizes[sizes > 0]
    block = int(max(LEAST_BLOCK, min(BLOCK_WORDS, positive.min() // LEAST_BLOCKS))) if len(positive) else LEAST_BLOCK
    seats = apportion(goal, round(float(goal.sum()) / block), MAX_REPEAT * -(-sizes // block))
    shards = np.maximum(1, np.maximum(-(-sizes // SHARD_WORDS), -(-rows // SHARD_ROWS)))
    known = spark.createDataFrame(
        [(sources["source"][i], n, int(sizes[n]), float(goal[n]), int(seats[n]), int(shards[n])) for n, i in enumerate(order)],
        "source string, position int, source_size long, target double, seats long, shards long",
    )
    placed = (
        sized.alias("d").join((F.broadcast(known) if len(order) <= BROADCAST_SOURCES else known).alias("s"), F.expr("d.source <=> s.source"))
        .select("doc_id", "d.source", "size", "place", "copies", "position", "source_size", "target", "seats", F.pmod(F.xxhash64(F.lit(seed + 1), "place"), F.col("shards")).alias("shard"))
    )
    whole = lambda of: F.expr(f"CAST(({of} + {block - 1}) DIV {block} AS BIGINT)")
    cells = placed.groupBy("position", "shard", "seats").agg(F.sum(words).alias("shard_size")).withColumns({"blocks": whole("shard_size"), "shelf": F.expr(f"shard DIV {SHELF_SHARDS}")})
    shelves = cells.groupBy("position", "shelf", "seats").agg(F.sum("shard_size").alias("shelf_size"), F.sum("blocks").alias("shelf_blocks")).groupBy("position").applyInPandas(_quotas_of_source, "position int, shelf long, shelf_seats long")
    quotas = cells.join(shelves, ["position", "shelf"]).groupBy("position", "shelf").applyInPandas(_quotas_of_shelf, "position int, shard long, blocks long, quota long")

    along = Window.partitionBy("position", "shard").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = placed.withColumn("upto", F.sum(words).over(along))
    joined = laid.join(quotas, ["position", "shard"]).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    joined = joined.withColumn("start", F.expr("upto - size * (copies - copy)")).withColumn("stop", F.col("start") + F.col("size"))
    # Of the first x blocks of a shard, chosen(x) take one word more than quota DIV blocks times.
    joined = joined.withColumn("extra", F.expr("quota % greatest(blocks, 1)")).withColumn("turn", F.pmod(F.xxhash64(F.lit(seed + 2), "position", "shard"), F.greatest("blocks", F.lit(1))))
    chosen = lambda x: f"(({x}) * extra + turn) DIV greatest(blocks, 1)"
    covered = lambda x: f"(({chosen(f'({x}) DIV {block}')}) * {block} + (({x}) % {block}) * (({chosen(f'({x}) DIV {block} + 1')}) - ({chosen(f'({x}) DIV {block}')})))"
    taken = F.expr(f"CAST(size * (quota DIV greatest(blocks, 1)) + {covered('stop')} - {covered('start')} AS BIGINT)").alias("taken")
    return joined.select("doc_id", *(("source", "place") if keep_place else ()), "size", "source_size", "target", taken)
