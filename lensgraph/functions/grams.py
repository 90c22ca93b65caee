"""Hashes of the word n-grams of many texts at once.

Words are what single spaces separate, empty ones included, so an n-gram is a
span of bytes: it is hashed by a prefix-sum polynomial over uint64, without a
Python loop over words.  64-bit hashes stand for n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(20240301).integers(1, 1 << 63, 256, dtype=np.uint64)
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
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The distinct k-word grams of each text, sorted; none where there are fewer words."""
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * _power_table(_BASE, len(raw))[: len(raw)], out=sums[1:])
    ends = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], ends[:-1] + 1))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.concatenate(([0], np.searchsorted(ends, np.cumsum(sizes + 1) - 1, side="right")))
    first, last = starts[: max(0, len(ends) - k + 1)], ends[k - 1 :]
    grams = mix((sums[last] - sums[first]) * _power_table(pow(_BASE, -1, 1 << 64), len(raw))[first] + (last - first).astype(np.uint64))
    return [np.unique(grams[a : max(a, b - k + 1)]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def chunks(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, last row + 1, texts) of runs of rows of about CHUNK_BYTES; a longer text stands alone, null is empty."""
    column = pc.fill_null(column.cast(pa.binary()), b"")
    at, held = 0, 0
    for i, size in enumerate(pc.binary_length(column).to_pylist()):
        if i > at and held + size > CHUNK_BYTES:
            yield at, i, column.slice(at, i - at).to_pylist()
            at, held = i, 0
        held += size
    if at < len(column):
        yield at, len(column), column.slice(at).to_pylist()
