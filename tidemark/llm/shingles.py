"""Hashed word shingles of whole batches of texts, with array arithmetic only.

Words are what stands between the six ASCII white-space characters, with A-Z as a-z. A shingle is the
run of ``k`` words; a text with fewer words is one shingle; one without words has none. Shingles are
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A number for each byte, so that sums over bytes tell words apart.
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Tables of powers up to this many bits of length are kept by a worker.
_KEPT_BITS = 21


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse modulo 2^64, from 0 to ``n``."""
    if n.bit_length() > _KEPT_BITS:
        return _power_table(n)
    up, down = _kept_powers(max(16, n.bit_length()))
    return up[: n + 1], down[: n + 1]


@cache
def _kept_powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    return _power_table(1 << bits)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _FACTOR)]))
    down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]))
    return up, down


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts that begin at ``starts`` in ``data``, and the text of each word."""
    space = _SPACES[data]
    first = ~space
    first[1:] &= space[:-1]
    last = ~space
    last[:-1] &= space[1:]
    inner = starts[(starts > 0) & (starts < len(data))]  # texts stand side by side
    first[inner] = ~space[inner]
    last[inner - 1] = ~space[inner - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(len(data))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[_LOWER[data]] * up[:-1])])
    hashes = mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    return hashes, np.searchsorted(starts, begin, side="right") - 1


def text_shingles(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    if not texts:
        return []
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(length) - length
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if not len(data):
        return [np.zeros(0, np.uint64) for _ in texts]
    words, owner = word_hashes(data, starts[length > 0])
    real = np.flatnonzero(length > 0)
    bounds = np.zeros(len(texts) + 1, np.int64)
    bounds[real + 1] = np.bincount(owner, minlength=len(real))
    bounds = np.cumsum(bounds)
    rolled = np.zeros(len(words), np.uint64)
    for j in range(k):
        rolled[: len(words) - j] += mixed(words[j:] + np.uint64(j + 1)) if j < len(words) else 0
    rolled = mixed(rolled)
    sets = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= k:
            sets.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            short = sum((mixed(words[a + j : a + j + 1] + np.uint64(j + 1)) for j in range(b - a)), np.zeros(1, np.uint64))
            sets.append(mixed(short + np.array([b - a], np.uint64) * _FACTOR))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def text_batches(batches: Iterator[pa.RecordBatch], most: int = 250_000) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Ids and texts in bytes (null: empty) of columns ``id`` and ``text``, in portions of bounded size."""
    for batch in batches:
        ids, column = batch.column("id"), batch.column("text").cast(pa.binary())
        held, size, start = [], 0, 0
        for i, text in enumerate(column):
            held.append(text.as_py() or b"")
            size += len(held[-1])
            if size > most:
                yield ids.slice(start, len(held)), held
                held, size, start = [], 0, i + 1
        if held:
            yield ids.slice(start, len(held)), held
