"""Quality scores from a factorisation machine.

Features of a text are its hashed words (share of the text, square-rooted),
structure statistics and size metadata, all read from the whole text.  The model
is w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j, the pairs in linear time
by 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2).  AdaGrad steps on the
logistic loss fit it on at most ``TRAIN_ROWS`` labelled rows, drawn by hash of
the id, which bounds what is broadcast and what the driver gets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lensgraph.llm import textnp
from lensgraph.llm.session import id_remainder

WORD_BITS = 14
WORDS = 1 << WORD_BITS
FACTORS = 8
EPOCHS = 8
RATE = 0.1
DECAY = 1e-4
TRAIN_ROWS = 4000
PREDICT_AT = 0.7
SEED = 1010
STATISTICS = ("size", "word_length", "distinct", "upper", "digits", "symbols", "sentences", "exclaims", "line_words", "duplicate_lines", "repeats", "top_word")


def statistics(text: bytes, hashes: np.ndarray) -> np.ndarray:
    """Bounded structure statistics and size metadata of one text."""
    n = len(hashes)
    if not n:
        return np.zeros(len(STATISTICS))
    raw = np.frombuffer(text, dtype=np.uint8)
    counts = np.bincount(raw, minlength=256)
    bytes_in = len(raw) - counts[32] - counts[9:14].sum()
    _, each = np.unique(hashes, return_counts=True)
    pairs = np.unique(textnp.runs(hashes, 2))
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()
    symbols = bytes_in - letters - counts[48:58].sum()
    sentence = counts[[33, 46, 63]].sum()
    return np.array(
        [
            np.log1p(n) / 8,
            min(bytes_in / n / 8, 3.0),
            len(each) / n,
            counts[65:91].sum() / max(1, letters),
            counts[48:58].sum() / max(1, bytes_in),
            symbols / max(1, bytes_in),
            min(sentence / n * 4, 2.0),
            min(counts[33] / n * 2, 2.0),
            np.log1p(n / max(1, len(lines))) / 5,
            1 - len(set(lines)) / max(1, len(lines)),
            1 - len(pairs) / max(1, n - 1) if n > 1 else 0.0,
            each.max() / n if n > 3 else 0.0,
        ]
    )


def features(text: bytes | None, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) of the non-zero features; statistics come after the words."""
    index, counts = np.unique((hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), return_counts=True)
    value = np.sqrt(counts / max(1, len(hashes)))
    stats = statistics(text or b"", hashes)
    return np.concatenate((index, WORDS + np.arange(len(stats)))), np.concatenate((value, stats)).astype(np.float32)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list]]:
    for first, last, texts in textnp.chunks(batch, "text"):
        words = textnp.Words(texts)
        hashes, bounds = words.hashes, words.bounds
        yield first, last, [features(t, hashes[bounds[i] : bounds[i + 1]]) for i, t in enumerate(texts)]


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, found in _rows(batch):
            yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32()))], names=["label", "index", "value"])


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[index]
        total = value @ v
        return float(self.bias + value @ self.weights[index] + 0.5 * (total @ total - (value * value) @ (v * v).sum(axis=1)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = SEED) -> Model:
    """AdaGrad on the logistic loss of (label, index, value) rows."""
    rng = np.random.default_rng(seed)
    size = WORDS + len(STATISTICS)
    w, v = np.zeros(size, np.float32), (rng.standard_normal((size, FACTORS)) * 0.05).astype(np.float32)
    gw, gv, bias, gb = np.full(size, 1e-2, np.float32), np.full((size, FACTORS), 1e-2, np.float32), 0.0, 1e-2
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            y, index, value = rows[i]
            own = v[index]
            total = value @ own
            raw = bias + value @ w[index] + 0.5 * (total @ total - (value * value) @ (own * own).sum(axis=1))
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y
            if abs(error) < 1e-3:
                continue
            step = error * value + DECAY * w[index]
            gw[index] += step * step
            w[index] -= RATE * step / np.sqrt(gw[index])
            pair = error * (value[:, None] * total - (value * value)[:, None] * own) + DECAY * own
            gv[index] += pair * pair
            v[index] -= 0.5 * RATE * pair / np.sqrt(gv[index])
            gb += error * error
            bias -= RATE * error / np.sqrt(gb)
    return Model(float(bias), w, v)


def train(docs: DataFrame, labels: DataFrame, learnable: Column) -> Model:
    """Learns ``labels.quality`` of a bounded sample of the labelled rows with ``learnable`` (of doc_id); null labels don't count."""
    usable = labels.where(learnable & F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("label"))
    n = usable.count()
    place = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30))
    sample = usable.where(place < int(min(1.0, TRAIN_ROWS / max(1, n)) * (1 << 30)))
    # One text an id, that of the smallest hash, however often an id or a row is repeated.
    once = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    found = once.select("label", "text").mapInArrow(_collect, "label int, index array<int>, value array<float>").toArrow()
    columns = zip(found["label"].to_pylist(), textnp.lists(found["index"]), textnp.lists(found["value"]), strict=True) if found.num_rows else ()
    rows = [(int(y > 0), i, x) for y, i, x in columns]
    rows.sort(key=lambda r: (textnp.mix_int(int(r[1].sum())), float(r[2].sum()), r[0]))
    return fit(rows)


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, found in _rows(batch):
                score = 1 / (1 + np.exp(-np.clip(np.array([model.raw(*f) for f in found]), -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], batch.column(1)[first:last], pa.array(score, pa.float64()), pa.array((score >= PREDICT_AT).astype(np.int32), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    return run


def quality(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Null and empty texts are scored from their statistics, which are all zero;
    texts of any length are read whole.  A null id is not held out; repeated rows
    give repeated rows, equal texts equal scores; other columns are not looked at,
    whatever their names.  An empty table gives no rows.  Without any labelled row the
    model scores 0.5 or near it.
    """
    held = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text").mapInArrow(_scorer(model), "doc_id long, held_out boolean, score double, predicted int")
