"""Nearest neighbours by cosine, exact in blocks and through an inverted-file index, and pair tables of the hits.

Vectors are packed into blocks, one row each, so that a search multiplies
matrices and the planner pairs blocks, never rows.  Only the k best of a block
leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 2048
#: Rows that the index's cells are fitted on at most, and k-means rounds.
SAMPLE = 20_000
ROUNDS = 8


def packed(vectors: DataFrame, id_column: str, vector_column: str, n_blocks: int, prefix: str, *keys: str) -> DataFrame:
    """(keys..., prefix_ids, prefix_vectors): rows of about the table's size / n_blocks vectors."""
    placed = vectors.withColumn("__block", F.pmod(F.xxhash64(id_column), F.lit(n_blocks)))
    grouped = placed.groupBy(*keys, "__block").agg(F.collect_list(F.struct(F.col(id_column).cast("long").alias("i"), F.col(vector_column).alias("v"))).alias("x"))
    return grouped.select(*keys, F.col("x.i").alias(f"{prefix}_ids"), F.flatten("x.v").alias(f"{prefix}_vectors"))


def _matrix(values: pa.Array, n: int) -> np.ndarray:
    m = values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-30)


def _best(k: int):
    """The k best of the target block for each query of the query block; ties go to the smaller id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q_ids, q_vectors, t_ids, t_vectors = (batch.column(batch.schema.get_field_index(c)) for c in ("q_ids", "q_vectors", "t_ids", "t_vectors"))
            for i in range(batch.num_rows):
                qi, ti = np.array(q_ids[i].values), np.array(t_ids[i].values)
                sims = _matrix(q_vectors[i].values, len(qi)) @ _matrix(t_vectors[i].values, len(ti)).T
                sims = np.round(np.clip(sims, 0.0, 1.0), 6)
                order = np.argsort(ti, kind="stable")
                best = np.argsort(-sims[:, order], axis=1, kind="stable")[:, :k]
                found = order[best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(qi, found.shape[1])), pa.array(ti[found].ravel()), pa.array(np.take_along_axis(sims, found, axis=1).ravel())],
                    names=["src", "dst", "similarity"],
                )

    return run


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    """Ranks count the query itself if it is among its neighbours; it is then left out."""
    order = Window.partitionBy("src").orderBy(F.desc("similarity"), "dst")
    return hits.distinct().withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= k) & (F.col("src") != F.col("dst")))


def knn_exact(queries: DataFrame, targets: DataFrame, k: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(src, dst, similarity, rank) of a stated query set against all targets, block by block."""
    n_q, n_t = queries.count(), targets.count()
    q = packed(queries, id_column, vector_column, max(1, -(-n_q // BLOCK)), "q")
    t = packed(targets, id_column, vector_column, max(1, -(-n_t // BLOCK)), "t")
    return _ranked(q.crossJoin(t).mapInArrow(_best(k + 1), "src long, dst long, similarity double"), k + 1)


def fit_cells(vectors: DataFrame, cells: int, id_column: str = "vec_id", vector_column: str = "embedding", seed: int = 5) -> np.ndarray:
    """Centres of spherical k-means on at most SAMPLE rows, drawn by hash of the id."""
    n = vectors.count()
    share = min(1.0, SAMPLE / max(1, n))
    rows = vectors.where(F.pmod(F.xxhash64(F.lit(seed), id_column), F.lit(1 << 30)) < int(share * (1 << 30))).select(vector_column).toArrow()[vector_column].combine_chunks()
    if not len(rows):
        return np.zeros((0, 0))
    x = _matrix(rows.values, len(rows))
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:cells]]
    for _ in range(ROUNDS):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        filled = np.linalg.norm(sums, axis=1) > 0
        centres[filled] = sums[filled] / np.linalg.norm(sums[filled], axis=1, keepdims=True)
    return centres


def in_cells(vectors: DataFrame, centres: np.ndarray, probes: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, vector, cell): each row in its ``probes`` nearest cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1).combine_chunks().values if hasattr(batch.column(1), "combine_chunks") else batch.column(1).values, batch.num_rows)
                near = np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, :probes]
                rows = pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(near.ravel().astype(np.int32))], names=[id_column, vector_column, "cell"])

    kind = vectors.schema[vector_column].dataType.simpleString()
    return vectors.select(F.col(id_column).cast("long").alias(id_column), vector_column).mapInArrow(run, f"{id_column} long, {vector_column} {kind}, cell int")


def knn_index(queries: DataFrame, targets: DataFrame, k: int, cells: int = 16, probes: int = 13, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Approximate neighbours: every target is in its nearest cell, each query searches ``probes`` cells exactly.

    A cell of many vectors is many blocks, so a hot cell is spread over tasks.
    """
    centres = fit_cells(targets, cells, id_column, vector_column)
    n_q, n_t = queries.count(), targets.count()
    q = packed(in_cells(queries, centres, probes, id_column, vector_column), id_column, vector_column, max(1, -(-n_q * probes // (BLOCK * cells))), "q", "cell")
    t = packed(in_cells(targets, centres, 1, id_column, vector_column), id_column, vector_column, max(1, -(-n_t // BLOCK)), "t", "cell")
    return _ranked(q.join(t, "cell").select("q_ids", "q_vectors", "t_ids", "t_vectors").mapInArrow(_best(k + 1), "src long, dst long, similarity double"), k + 1)


def pair_table(hits: DataFrame) -> DataFrame:
    """One row for each unordered pair: its highest similarity and its rank in either direction."""
    forward = F.col("src") < F.col("dst")
    return hits.groupBy(F.least("src", "dst").alias("image_a"), F.greatest("src", "dst").alias("image_b")).agg(
        F.max("similarity").alias("embedding_similarity"),
        F.max(F.when(forward, F.col("rank"))).alias("rank_a_to_b"),
        F.max(F.when(~forward, F.col("rank"))).alias("rank_b_to_a"),
    )


def every_twentieth(id_column: str = "vec_id") -> Column:
    return F.pmod(F.col(id_column), F.lit(20)) == 0
