"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are the byte n-grams of a word with its borders, hashed to ``BUCKETS``
embeddings.  A text is the mean of its embeddings, and a softmax over that mean
is trained by stochastic gradient descent in numpy, on about ``ROWS_PER_LANG``
labelled rows of each language (all of a rarer one), or fewer so that all languages
together have about ``SAMPLE_ROWS``, which bounds what the driver gets.  Every
language is learned; more than ``MAX_LANGS`` are an error.  Embedding and output layer are both linear, so predicting adds up one
precomputed row of logits for each subword of the whole text.

A fifth of those rows, never a language's first, is not trained on: it fits the softmax's temperature and
the rejection threshold, the largest one up to ``MAX_THRESHOLD`` that loses at
most ``MAX_LOSS`` of the right predictions.
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

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
GRAMS = (2, 3, 4)
DIMENSION = 16
EPOCHS = 5
#: Small samples are gone through until so many steps are made.
LEAST_STEPS = 6000
RATE = 0.5
ROWS_PER_LANG = 500
SAMPLE_ROWS = 100_000
#: A language's logits take 128 KB of the model.
MAX_LANGS = 2000
MAX_LOSS = 0.001
MAX_THRESHOLD = 0.5
SEED = 77
UNKNOWN = "und"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_ASCII_LETTER = _LETTER.copy()
_ASCII_LETTER[128:] = False
_FOLD = np.full(256, 32, dtype=np.uint32)
_FOLD[_LETTER] = np.flatnonzero(_LETTER)
_FOLD[65:91] = np.arange(97, 123)
_SCALE = {n: np.uint32(x) for n, x in zip((1, 2, 3, 4, 5), (2654435761, 2246822519, 3266489917, 668265263, 374761393), strict=True)}


def subwords(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all subwords, document of each), grouped by n-gram length and then document."""
    parts = [t or b"" for t in texts]
    raw = np.frombuffer(b" " + b" ".join(parts) + b" ", dtype=np.uint8)
    starts = np.cumsum([1, *(len(p) + 1 for p in parts)])
    folded = _FOLD[raw]
    gap = folded == 32
    gaps = np.concatenate(([0], np.cumsum(gap)))
    found, owners = [], []
    for n in GRAMS:
        m = len(folded) - n + 1
        if m <= 0:
            continue
        code = folded[:m].copy()
        for j in range(1, n):
            code = (code << np.uint32(8)) | folded[j : j + m]
        # No gap inside, and not a lone border: a gap may be the first or the last byte only.
        inside = gaps[n - 1 : n - 1 + m] - gaps[1 : 1 + m] if n > 2 else 0
        use = np.flatnonzero((inside == 0) & ~(gap[:m] & gap[n - 1 : n - 1 + m]))
        hashed = code[use] * _SCALE[n]
        hashed ^= hashed >> np.uint32(15)
        found.append((hashed * _SCALE[5]) >> np.uint32(32 - BUCKET_BITS))
        owners.append(np.searchsorted(starts, use + 1, side="right") - 1)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found).astype(np.int64), np.minimum(np.concatenate(owners), len(parts) - 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse subword counts of each training row."""
    for batch in batches:
        lang = batch.column(0)
        for first, last, texts in textnp.chunks(batch, "text"):
            buckets, owners = subwords(texts)
            pairs, counts = np.unique(owners * BUCKETS + buckets, return_counts=True)
            bounds = np.searchsorted(pairs, np.arange(len(texts) + 1) * BUCKETS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [lang[first:last], pa.ListArray.from_arrays(bounds, (pairs % BUCKETS).astype(np.int32)), pa.ListArray.from_arrays(bounds, counts.astype(np.int32))],
                names=["lang", "buckets", "counts"],
            )


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = SEED) -> Model | None:
    """A model of (lang, buckets, counts) rows; None without any row that has subwords."""
    rows = [r for r in rows if len(r[1])]
    langs = tuple(sorted({r[0] for r in rows}))
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    label = {name: i for i, name in enumerate(langs)}
    data = [(label[name], idx, (c / c.sum()).astype(np.float32)) for name, idx, c in rows]
    first = {y: i for i, (y, _, _) in reversed(list(enumerate(data)))}
    held = [d for i, d in enumerate(data) if i % 5 == 4 and first[d[0]] != i]
    train = [d for i, d in enumerate(data) if i % 5 != 4 or first[d[0]] == i]
    embed = rng.uniform(-1, 1, (BUCKETS, DIMENSION)).astype(np.float32) / DIMENSION
    out = np.zeros((DIMENSION, len(langs)), dtype=np.float32)
    bias = np.zeros(len(langs), dtype=np.float32)
    # Short pieces of the training rows keep the model honest on short texts.
    epochs = max(EPOCHS, -(-LEAST_STEPS // len(train)))
    steps, total = 0, epochs * len(train)
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            y, idx, share = train[i]
            if steps % 3 == 2 and len(idx) > 24:
                pick = rng.choice(len(idx), 16, replace=False)
                idx, share = idx[pick], share[pick] / share[pick].sum()
            rate = RATE * (1 - steps / total)
            steps += 1
            mean = share @ embed[idx]
            error = _softmax(mean @ out + bias)
            error[y] -= 1
            back = out @ error
            out -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            embed[idx] -= (rate * share[:, None]) * back * min(len(idx), 64)
    table = embed @ out
    temperature, threshold = 1.0, 0.0
    if held:
        raw = np.array([share @ table[idx] + bias for _, idx, share in held])
        truth = np.array([y for y, _, _ in held])
        grid = np.exp(np.linspace(-3, 3, 61))
        # Even where all are right, as many as one more wrong row are allowed for.
        doubt = 1 / (len(truth) + 2)

        def loss(t: float) -> float:
            logs = np.log(np.maximum(_softmax(raw / t), 1e-12))
            return float(-((1 - doubt) * logs[np.arange(len(truth)), truth] + doubt * logs.mean(axis=1)).mean())

        losses = [loss(t) for t in grid]
        temperature = float(grid[int(np.argmin(losses))])
        probability = _softmax(raw / temperature)
        right = np.sort(probability.max(axis=1)[probability.argmax(axis=1) == truth])
        if len(right):
            threshold = float(min(MAX_THRESHOLD, right[int(MAX_LOSS * len(right))]))
    return Model(langs, np.ascontiguousarray(table), bias, temperature, threshold)


def train(docs: DataFrame, learnable: Column, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model | None:
    """Fits on a sample of the ``learnable`` rows, drawn by hash of id and text and bounded for each language; repeated rows count once."""
    known = docs.where(learnable & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    # Rows that repeat id and text have one place and are one row of the sample, however many they are.
    place = F.pmod(F.xxhash64(F.lit(SEED), F.col(id_column), F.col(text_column)), F.lit(1 << 30))
    # The least place of a row with a letter, so that each language has one row at least.
    least = F.min(F.when(F.col(text_column).rlike(r"\p{L}"), place))
    counts = known.groupBy(F.col(lang_column).alias("lang")).agg(F.approx_count_distinct(place).alias("n"), F.coalesce(least, F.lit(-1)).alias("least")).limit(MAX_LANGS + 1).collect()
    if not counts:
        return None
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages in {lang_column}, which one model cannot hold")
    each = min(ROWS_PER_LANG, SAMPLE_ROWS // len(counts))
    limits = [(r["lang"], max(int(min(1.0, each / max(1, r["n"])) * (1 << 30)), r["least"] + 1)) for r in counts]
    upto = docs.sparkSession.createDataFrame(limits, "__lang string, __upto long")
    sample = known.join(F.broadcast(upto), F.col(lang_column) == F.col("__lang")).where(place < F.col("__upto")).select(F.col("__lang").alias("lang"), place.alias("place"), F.col(text_column).alias("text"))
    sample = sample.groupBy("lang", "place").agg(F.min("text").alias("text")).select("lang", "text")
    found = sample.mapInArrow(_count, "lang string, buckets array<int>, counts array<int>").toArrow()
    if not found.num_rows:
        return None
    named = zip(found["lang"].to_pylist(), textnp.lists(found["buckets"]), textnp.lists(found["counts"]), strict=True)
    rows = sorted(named, key=lambda r: (textnp.mix_int(int(r[1].sum()) * 31 + int(r[2].sum())), r[0]))
    return fit(rows)


def _has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    raw = np.frombuffer(text, dtype=np.uint8)
    return bool(_ASCII_LETTER[raw].any()) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _predictor(model: Model | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in textnp.chunks(batch, "text"):
                names, scores, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), [True] * len(texts)
                if model is not None:
                    buckets, owners = subwords(texts)
                    sums = np.stack([np.bincount(owners, model.logits[:, i][buckets], minlength=len(texts)) for i in range(len(model.langs))], axis=1)
                    n = np.maximum(1, np.bincount(owners, minlength=len(texts)))
                    probability = _softmax((sums / n[:, None] + model.bias) / model.temperature)
                    best = probability.argmax(axis=1)
                    for i, text in enumerate(texts):
                        if _has_letter(text):
                            names[i], scores[i] = model.langs[best[i]], probability[i, best[i]]
                            rejected[i] = bool(scores[i] < model.threshold)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(j)[first:last] for j in range(batch.num_columns - 1)), pa.array(names), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                    names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"],
                )

    return predict


def identify(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for each row of ``docs``.

    Null texts and texts without a letter: ``und``, score 0, rejected.  Without a
    model all rows are so, and an empty table gives no rows.  Texts of any length are read whole.  Texts with letters always get a learned language;
    ``rejected`` says that the calibrated score is below the threshold.  Ties go
    to the first language in code point order.  A null id is not held out;
    repeated rows give repeated rows; other columns are not looked at.
    """
    held = F.coalesce(id_remainder(id_column, 4) == 2, F.lit(False))
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text_column).alias("text"))
    return picked.mapInArrow(_predictor(model), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def drop_unknown(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is told with enough confidence, all columns as they are.

    Null texts and texts without a letter go; null ids are learned from.  Ties,
    repeated rows, long texts, empty tables and clashing names as in ``identify``.
    """
    model = train(docs, F.coalesce(id_remainder("doc_id", 4) != 2, F.lit(True)))
    n = len(docs.columns)
    positional = docs.toDF(*(f"c{i}" for i in range(n)))
    kinds = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    scored = positional.withColumn("text", F.col(f"c{docs.columns.index('text')}")).mapInArrow(_predictor(model), f"{kinds}, lang_pred string, score double, rejected boolean")
    return scored.where("NOT rejected").select(*(f"c{i}" for i in range(n))).toDF(*docs.columns)
