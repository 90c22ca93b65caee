"""Word probabilities from a hierarchical Pitman-Yor process.

Two levels of restaurants over a uniform base of V + 1 outcomes, one of which is
any unknown word: the unigram restaurant, and a restaurant for each word before,
or the start of the text, that shares it as its parent.  Words before are told
apart by 16 bits of their hash, so there are ``CONTEXTS`` restaurants at most, and
words that fall together share one; sections, the (context, word) pairs that
occur, grow with the corpus.

Seating is sampled by Gibbs sweeps: each sweep seats the customers of every
section anew, one after the other, given the parent's current probability of the
word and the tables of all other sections as of the sweep before; the tables become
the parent's customers, which are seated in the same way.  Once seated customers
are many, the next eighth of their number is seated by one binomial draw.  Given the
restaurants' totals, a word's sections depend on that word alone, so the corpus
is split by word, a sweep is a map over the word partitions, and only the totals
(CONTEXTS + 2 rows) are brought together.  ``BURN_IN`` sweeps are dropped and the
predictive probabilities of the next ``SAMPLES`` are averaged.  Discounts follow the
counts of counts.

Words are 48-bit hashes.  Tokens never move: a *batch* of documents asks each
word partition for the distinct (word, context) pairs it needs, and documents are
grouped by batch once, to meet the answers.  Batches are ranges of id and text hash,
so no id is too much for one; they hold about ``BATCH_BYTES`` of text, and word
partitions about as many pairs as a batch, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lensgraph.llm import textnp
from lensgraph.llm.session import cut, id_remainder

CONTEXTS = 1 << 16
BATCH_BYTES = 12 << 20
BURN_IN, SAMPLES = 2, 3
STRENGTH_CONTEXT, STRENGTH_WORD = 1.0, 10.0
SEED = 1987
_U = np.uint64
_LOW = _U(CONTEXTS - 1)
_END = _U(0x5EED5EED5EED0000)


def token_keys(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, bounds): a key holds a token's word (upper 48 bits) and its context (lower 16); the end counts as a token."""
    words = textnp.Words(texts)
    n, hashes = len(texts), words.hashes
    after = textnp.mix(hashes) % _U(CONTEXTS - 1) + _U(1)
    sizes = np.diff(words.bounds)
    bounds = words.bounds + np.arange(n + 1)
    place = np.arange(len(words.starts)) + np.repeat(np.arange(n), sizes)
    keys = np.full(len(words.starts) + n, _END, dtype=np.uint64)
    keys[place] = hashes & ~_LOW
    context = np.zeros(len(keys), dtype=np.uint64)
    context[place + 1] = after
    return keys | context, bounds


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys with their counts, as compressed byte planes of the differences."""
    steps = np.diff(keys, prepend=_U(0))
    planes = np.concatenate((steps.view(np.uint8).reshape(-1, 8).T.ravel(), counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.ravel()))
    return np.int64(len(keys)).tobytes() + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(payload[:8], np.int64)[0])
    planes = np.frombuffer(pa.decompress(payload[8:], decompressed_size=12 * n, codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    steps = np.ascontiguousarray(planes[: 8 * n].reshape(8, n).T).view(np.uint64).ravel()
    counts = np.ascontiguousarray(planes[8 * n :].reshape(4, n).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def merge(blocks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate([b[i] for b in blocks]) for i in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _counter(parts: int, edges: np.ndarray):
    """(part, batch, payload) blocks of the pairs that a batch needs, with their training counts."""

    def emit(batch_id: int, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, bytes]]:
        keys, counts = merge(held)
        part = ((keys >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
        cutpoints = np.searchsorted(part, np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(cutpoints)):
            a, b = cutpoints[p], cutpoints[p + 1]
            yield int(p), batch_id, pack(keys[a:b], counts[a:b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        sizes: dict[int, int] = {}

        def out(which: list[int]) -> Iterator[pa.RecordBatch]:
            for b in which:
                rows = list(emit(b, kept.pop(b)))
                sizes.pop(b)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["part", "batch", "payload"])

        for batch in batches:
            of = np.searchsorted(edges, batch.column(0).to_numpy(), side="right")
            trained = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, last, texts in textnp.chunks(batch, "text"):
                keys, bounds = token_keys(texts)
                for b in np.unique(of[first:last]):
                    mine = np.repeat(of[first:last] == b, np.diff(bounds))
                    learn = np.repeat(trained[first:last], np.diff(bounds))
                    seen, counts = np.unique(keys[mine & learn], return_counts=True)
                    asked = np.unique(keys[mine & ~learn])
                    kept.setdefault(int(b), []).append(merge([(seen, counts), (asked, np.zeros(len(asked), np.int64))]))
                    sizes[int(b)] = sizes.get(int(b), 0) + len(seen) + len(asked)
                    if len(kept[int(b)]) >= 8:
                        kept[int(b)] = [merge(kept[int(b)])]
                        sizes[int(b)] = len(kept[int(b)][0][0])
            if sum(sizes.values()) > 2_000_000:
                yield from out([b for b in kept])
        yield from out([b for b in kept])

    return run


def _merge_part(table: pa.Table) -> pa.Table:
    """A word partition's training counts (batch -1), and after them the pairs that each batch asks for."""
    asked: dict[int, list[np.ndarray]] = {}
    blocks = []
    for batch, payload in zip(table["batch"].to_pylist(), table["payload"], strict=True):
        keys, counts = unpack(payload.as_py())
        asked.setdefault(batch, []).append(keys)
        blocks.append((keys[counts > 0], counts[counts > 0]))
    rows = [(-1, pack(*merge(blocks)))]
    for batch in sorted(asked):
        keys = np.unique(np.concatenate(asked.pop(batch)))
        rows.append((batch, pack(keys, np.zeros(len(keys), np.int64))))
    batches, payloads = zip(*rows, strict=True)
    return pa.table({"part": pa.array([table["part"][0].as_py()] * len(rows), pa.int32()), "batch": pa.array(batches, pa.int32()), "payload": pa.array(payloads, pa.binary())})


@dataclass(frozen=True)
class Totals:
    """Totals over the corpus: tokens, words, discounts, and after each sweep the tables of every restaurant."""

    tokens: int
    words: int
    discount_context: float
    discount_word: float
    customers: np.ndarray
    sweeps: tuple[tuple[np.ndarray, float, float], ...] = field(default_factory=tuple)

    @property
    def base(self) -> float:
        return 1.0 / (self.words + 1)

    def fallback(self, sweep: int) -> tuple[np.ndarray, float]:
        """What contexts, and the unigram restaurant, leave to their parents after a sweep."""
        tables, customers_word, tables_word = self.sweeps[sweep]
        return (STRENGTH_CONTEXT + self.discount_context * tables) / (STRENGTH_CONTEXT + self.customers), (STRENGTH_WORD + self.discount_word * tables_word) / (STRENGTH_WORD + customers_word)


def seat(rng: np.random.Generator, customers: np.ndarray, pull: np.ndarray, discount: float) -> np.ndarray:
    """Tables after seating the customers of independent sections; ``pull``: the weight of a new table."""
    tables = np.minimum(customers, 1)
    active = np.flatnonzero(customers > 1)
    seated = np.ones(len(active), dtype=np.int64)
    own = tables[active].copy()
    while len(active):
        step = np.minimum(customers[active] - seated, np.maximum(1, seated // 8))
        k = pull[active]
        own += rng.binomial(step, k / (k + seated - discount * own))
        seated += step
        done = seated >= customers[active]
        tables[active[done]] = own[done]
        active, seated, own = active[~done], seated[~done], own[~done]
    return tables


class Sections:
    """The sections of one word partition, and their chain of seatings up to any sweep."""

    def __init__(self, part: int, payload: bytes):
        self.part = part
        self.keys, self.counts = unpack(payload)
        self.context = (self.keys & _LOW).astype(np.int64)
        named = self.keys & ~_LOW
        first = np.concatenate(([True], named[1:] != named[:-1])) if len(named) else np.zeros(0, bool)
        self.words, self.word = named[first], np.cumsum(first) - 1
        self.word_counts = np.bincount(self.word, self.counts, minlength=len(self.words)).astype(np.int64)

    def chain(self, totals: Totals, sweeps: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(tables, customers and tables in the unigram restaurant, its probabilities) after the start and each sweep."""
        tables, n = np.minimum(self.counts, 1), len(self.words)
        guests = np.bincount(self.word, tables, minlength=n).astype(np.int64)
        upper = np.minimum(guests, 1)
        for s in range(sweeps + 1):
            if s:
                rng = np.random.default_rng([SEED, self.part, s])
                before, _, upper_before = totals.sweeps[s - 1]
                pull = (STRENGTH_CONTEXT + totals.discount_context * before)[self.context] * parent[self.word]
                tables = seat(rng, self.counts, pull, totals.discount_context)
                guests = np.bincount(self.word, tables, minlength=n).astype(np.int64)
                weight = np.full(n, (STRENGTH_WORD + totals.discount_word * upper_before) * totals.base)
                upper = seat(rng, guests, weight, totals.discount_word)
            if s < len(totals.sweeps):
                _, customers_word, _ = totals.sweeps[s]
                parent = (guests - totals.discount_word * upper) / (STRENGTH_WORD + customers_word) + totals.fallback(s)[1] * totals.base
            else:
                parent = np.zeros(n)
            yield tables, guests, upper, parent


def _sweeper(totals: Totals, sweep: int):
    """(restaurant, customers, tables, ones, twos) of a partition after a sweep; the unigram restaurant is number -1, and words count as number -2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Sections(part, payload)
                *_, (tables, guests, upper, _) = own.chain(totals, sweep)
                by = lambda x: np.bincount(own.context, x, minlength=CONTEXTS).astype(np.int64)
                words = own.word_counts
                met = np.unique(own.context)
                columns = [
                    [met, [-1, -2]],
                    [by(own.counts)[met], [guests.sum(), words.sum()]],
                    [by(tables)[met], [upper.sum(), len(words)]],
                    [by(own.counts == 1)[met], [(guests == 1).sum(), (words == 1).sum()]],
                    [by(own.counts == 2)[met], [(guests == 2).sum(), (words == 2).sum()]],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in columns], names=["restaurant", "customers", "tables", "ones", "twos"])

    return run


def sample(merged: DataFrame) -> Totals:
    """Runs the sweeps; the driver sees CONTEXTS + 2 rows after each."""
    totals = Totals(0, 0, 0.5, 0.5, np.zeros(CONTEXTS))
    for s in range(BURN_IN + SAMPLES + 1):
        found = merged.mapInArrow(_sweeper(totals, s), "restaurant long, customers long, tables long, ones long, twos long").groupBy("restaurant").agg(*(F.sum(c).alias(c) for c in ("customers", "tables", "ones", "twos"))).toArrow()
        at = found["restaurant"].to_numpy()
        columns = {c: found[c].to_numpy() for c in ("customers", "tables", "ones", "twos")}

        def of_contexts(c: str) -> np.ndarray:
            out = np.zeros(CONTEXTS)
            out[at[at >= 0]] = columns[c][at >= 0]  # noqa: B023
            return out

        one = lambda restaurant, c: float(columns[c][at == restaurant].sum())  # noqa: E731,B023
        if not s:
            discount = lambda a, b: float(min(0.95, max(0.05, a / (a + 2 * b)))) if a else 0.5
            totals = Totals(int(one(-2, "customers")), int(one(-2, "tables")), discount(of_contexts("ones").sum(), of_contexts("twos").sum()), discount(one(-1, "ones"), one(-1, "twos")), of_contexts("customers"))
        state = (of_contexts("tables"), one(-1, "customers"), one(-1, "tables"))
        totals = Totals(totals.tokens, totals.words, totals.discount_context, totals.discount_word, totals.customers, (*totals.sweeps, state))
    return totals


class Predictive:
    """Averaged predictive probabilities of a word partition."""

    def __init__(self, own: Sections, totals: Totals):
        self.own = own
        self.direct = np.zeros(len(own.keys))
        self.weights = np.zeros((SAMPLES, CONTEXTS))
        self.parents = np.zeros((SAMPLES, len(own.words) + 1))
        for s, (tables, _, _, parent) in enumerate(own.chain(totals, BURN_IN + SAMPLES)):
            if s > BURN_IN:
                k = s - BURN_IN - 1
                left, left_word = totals.fallback(s)
                self.direct += (own.counts - totals.discount_context * tables) / (STRENGTH_CONTEXT + totals.customers)[own.context] / SAMPLES
                self.weights[k], self.parents[k, :-1], self.parents[k, -1] = left / SAMPLES, parent, left_word * totals.base

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability, training count of the word) of each key."""
        own = self.own
        cell = np.searchsorted(own.keys, keys)
        hit = cell < len(own.keys)
        hit[hit] = own.keys[cell[hit]] == keys[hit]
        named = keys & ~_LOW
        word = np.searchsorted(own.words, named)
        known = word < len(own.words)
        known[known] = own.words[word[known]] == named[known]
        word = np.where(known, word, len(own.words))
        counts = np.where(known, np.append(own.word_counts, 0)[word], 0)
        probability = (self.weights[:, (keys & _LOW).astype(np.int64)] * self.parents[:, word]).sum(axis=0)
        probability[hit] += self.direct[cell[hit]]
        return probability, counts


def _answerer(totals: Totals):
    """(batch, part, payload): the answers to a batch's pairs in the order of the pairs; a partition's counts come before its batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = None
        for rows in batches:
            for part, batch, payload in zip(*(rows.column(i) for i in range(3)), strict=True):
                part, batch, payload = part.as_py(), batch.as_py(), payload.as_py()
                if batch < 0:
                    predict = Predictive(Sections(part, payload), totals)
                    continue
                probability, counts = predict(unpack(payload)[0])
                raw = np.log10(probability).astype(np.float32).tobytes() + counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
                packed = np.int64(len(counts)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int32()), pa.array([part], pa.int32()), pa.array([packed], pa.binary())], names=["batch", "part", "payload"])

    return run


def _scorer(totals: Totals):
    denominator = float(totals.tokens + totals.words + 1)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        logs, counts = [], []
        for _, payload in sorted(zip(answers["part"].to_pylist(), answers["payload"].to_pylist(), strict=True)):
            n = int(np.frombuffer(payload[:8], np.int64)[0])
            raw = np.frombuffer(pa.decompress(payload[8:], decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
            logs.append(raw[: 4 * n].view(np.float32).astype(np.float64))
            counts.append(np.ascontiguousarray(raw[4 * n :].reshape(4, n).T).view(np.uint32).ravel())
        log, count = np.concatenate(logs), np.concatenate(counts).astype(np.int64)
        base = np.log10((count + 1) / denominator)
        known = (count > 0).astype(np.int64)
        pieces = [piece for batch in docs.to_batches() for piece in textnp.chunks(batch, "text")]
        keyed = [token_keys(texts) for _, _, texts in pieces]
        order = np.unique(np.concatenate([np.unique(k) for k, _ in keyed]))
        columns = [[], [], [], []]
        for keys, bounds in keyed:
            at = np.searchsorted(order, keys)
            columns[0].append(np.diff(bounds))
            for column, values in zip(columns[1:], (known, base, log), strict=True):
                column.append(np.add.reduceat(values[at], bounds[:-1]))
        sizes, n_known, base_score, score = (np.concatenate(c) for c in columns)
        return pa.table([docs["doc_id"], docs["held_out"], sizes, n_known, np.full(len(sizes), totals.tokens), base_score, score], schema=schema)

    return run


def score(docs: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Learns from the rows where ``learn`` (of the id column) holds; the others are
    held out.  Null text is empty and scores its end alone; texts of any length
    are scored whole.  A null id is learned from.  Repeated rows count as often as
    they occur and give repeated rows; there are no ties.  Other columns are not
    looked at, whatever their names; an empty table gives no rows.
    """
    # Batches are ranges of the id, and within one id of the text's hash; null ids come first.
    place = F.coalesce(F.col(id_column).cast("double"), F.lit(-9.3e18)) + F.pmod(F.xxhash64(text_column), F.lit(1 << 20)) / float(1 << 20)
    place = F.when(F.col(id_column).isNull(), -9.3e18 * (1 + F.pmod(F.xxhash64(text_column), F.lit(1 << 20)) / float(1 << 20))).otherwise(place)
    picked = docs.select(place.alias("place"), F.coalesce(learn, F.lit(True)).alias("learn"), F.col(text_column).alias("text"), F.col(id_column).cast("long").alias("doc_id"))
    total = picked.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n_batches = max(1, round(((total[0] or 0) + (total[1] or 0)) / BATCH_BYTES))
    edges = np.zeros(0)
    if n_batches > 1:
        found = picked.agg(F.percentile_approx("place", [i / n_batches for i in range(1, n_batches)], max(10_000, 10 * n_batches))).first()[0]
        edges = np.unique(np.array(found, dtype=np.float64))

    @F.pandas_udf("int")
    def batch_of(places: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, places.to_numpy(dtype=np.float64), side="right").astype(np.int32))

    blocks = picked.select("place", "learn", "text").mapInArrow(_counter(n_batches, edges), "part int, batch int, payload binary")
    # Written by word partition, each one's rows in order, so that neither sweeps nor answers shuffle them again.
    stored = cut(blocks.groupBy("part").applyInArrow(_merge_part, "part int, batch int, payload binary"))
    totals = sample(stored.where("batch < 0").select("part", "payload"))
    answers = stored.mapInArrow(_answerer(totals), "batch int, part int, payload binary")
    sent = picked.select(batch_of("place").alias("batch"), "doc_id", (~F.col("learn")).alias("held_out"), "text")
    return sent.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_scorer(totals), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def learnable(id_column: str = "doc_id") -> Column:
    """The rows that op7 learns from."""
    return id_remainder(id_column, 7) != 2
