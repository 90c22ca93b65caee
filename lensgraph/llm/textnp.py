"""Vectorised text kernels: word hashes and shingles of many documents at once.

A chunk is a list of UTF-8 byte strings, joined by a line feed so that no word
crosses a document.  Words are hashed by a prefix-sum polynomial over uint64,
without a Python loop over words.  64-bit hashes stand for words and shingles;
the chance of any collision between the sets of two documents is below 1e-12.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_STEP = _U(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, CHUNK_BYTES * 2), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps)
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def mix_int(x: int) -> int:
    with np.errstate(over="ignore"):
        return int(mix(np.array([x & (1 << 64) - 1], dtype=np.uint64))[0])


class Words:
    """Words of a chunk: ``hashes``, byte ``starts``/``ends`` in ``joined``, and ``bounds``:
    the words of document i are bounds[i]:bounds[i + 1]."""

    def __init__(self, texts: list[bytes | None], lower: bool = True, table: np.ndarray = _SPACE):
        parts = [t or b"" for t in texts]
        joined = b"\n".join(parts)
        self.joined = joined.lower() if lower else joined
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.doc_starts = np.concatenate(([0], np.cumsum(sizes + 1)))
        raw = np.frombuffer(self.joined, dtype=np.uint8)
        self.raw = raw
        inside = np.empty(len(raw) + 2, dtype=np.int8)
        inside[0] = inside[-1] = 0
        inside[1:-1] = ~table[raw]
        edge = np.diff(inside)
        self.starts = np.flatnonzero(edge == 1)
        self.ends = np.flatnonzero(edge == -1)
        self.bounds = np.searchsorted(self.starts, self.doc_starts)
        self.bounds[-1] = len(self.starts)
        self._sums: np.ndarray | None = None

    def _running(self, raw: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[raw] * _power_table(_BASE, len(raw))[: len(raw)], out=sums[1:])
        return sums

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
        """A hash of each byte span, the same wherever the span lies; ``fold`` maps the bytes first."""
        if not len(starts):
            return np.zeros(0, dtype=np.uint64)
        if fold is not None:
            sums = self._running(fold[self.raw])
        elif self._sums is None:
            sums = self._sums = self._running(self.raw)
        else:
            sums = self._sums
        inverse = _power_table(_BASE_INV, int(starts[-1]) + 1)
        return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))

    @property
    def hashes(self) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (len - k + 1 of them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = hashes[:n].copy()
    for j in range(1, k):
        acc *= _STEP
        acc += hashes[j : j + n]
    return mix(acc)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; of fewer words, the whole sequence as one."""
    if not len(hashes):
        return hashes
    if len(hashes) < k:
        return mix(runs(hashes, len(hashes)) + _U(len(hashes)))
    return np.unique(runs(hashes, k))


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """(first row, last row + 1, texts) of runs of rows of about ``limit`` bytes; a longer text stands alone."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
    at, held = 0, 0
    for i, size in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
        if i > at and held + size > limit:
            yield at, i, column.slice(at, i - at).to_pylist()
            at, held = i, 0
        held += size
    if at < len(column):
        yield at, len(column), column.slice(at).to_pylist()


def lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as views of one array, without a Python object for each value."""
    whole = column.combine_chunks()
    whole = pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole
    offsets, values = whole.offsets.to_numpy(), whole.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
