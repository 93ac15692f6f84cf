"""Two-stage suffix sorting of a buffer of texts, and the strings that stand in it twice."""

from __future__ import annotations

import numpy as np

#: Stands after every text of a buffer; no UTF-8 text holds it, and no compared string reaches it.
SEPARATOR = b"\xff"


def suffix_array(data: bytes, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Positions of ``data``, ordered by their suffixes at least as far as ``depth`` bytes: all, or those ``wanted``
    and the few behind them from which their places follow.

    Only suffixes smaller than their successors are compared. A suffix greater than its successor
    follows from where that stands: bucket by bucket (one for each first byte), it comes before the
    compared ones, in the order of the successors.
    """
    x = np.frombuffer(data, np.uint8)
    n = len(x)
    follower = np.concatenate([x[1:].astype(np.int16), [-1]])
    change = np.flatnonzero(follower != x)
    smaller = np.repeat((follower > x)[change], np.diff(change, prepend=-1))
    needed = np.ones(n, bool) if wanted is None else _with_successors(wanted, smaller)
    at = np.flatnonzero(needed)
    direct = sorted(np.flatnonzero(smaller & needed).tolist(), key=lambda p: data[p : p + depth])
    direct = np.array(direct, np.int64)
    direct_bounds = np.searchsorted(x[direct], np.arange(257))
    by_byte = at[np.argsort(x[at], kind="stable")]
    bounds = np.searchsorted(x[by_byte], np.arange(257))
    rank = np.full(n + 1, -1, np.int64)
    order = np.empty(len(at), np.int64)
    for byte in np.unique(x[at]).tolist():
        bucket = by_byte[bounds[byte] : bounds[byte + 1]]
        at = int(bounds[byte])
        wave = bucket[~smaller[bucket] & (follower[bucket] != byte)]
        wave = wave[np.argsort(rank[wave + 1], kind="stable")]
        while len(wave):  # then those with one more of the same byte before them
            order[at : at + len(wave)] = wave
            rank[wave] = np.arange(at, at + len(wave))
            at += len(wave)
            wave = wave[wave > 0] - 1
            wave = wave[(x[wave] == byte) & needed[wave]]
        own = direct[direct_bounds[byte] : direct_bounds[byte + 1]]
        order[at : at + len(own)] = own
        rank[own] = np.arange(at, at + len(own))
    return order


def _with_successors(wanted: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """``wanted``, and behind each stretch of it what stands up to the next compared suffix."""
    ends = np.flatnonzero(wanted & ~np.append(wanted[1:], False))
    compared = np.append(np.flatnonzero(smaller), len(wanted) - 1)
    stops = compared[np.minimum(np.searchsorted(compared, ends), len(compared) - 1)]
    steps = np.zeros(len(wanted) + 1, np.int64)
    np.add.at(steps, ends, 1)
    np.add.at(steps, stops + 1, -1)
    return wanted | (np.cumsum(steps[:-1]) > 0)


def common_prefix_reaches(data: bytes, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Whether the strings at positions ``a`` and ``b`` agree on ``depth`` bytes, eight bytes a step."""
    padded = np.frombuffer(data + bytes(16), np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    alive = np.arange(len(a))
    for step in [*range(0, depth - 7, 8), depth - 8]:
        one, two = (np.ascontiguousarray(words[p[alive] + step]).view(np.uint64)[:, 0] for p in (a, b))
        alive = alive[one == two]
    reached = np.zeros(len(a), bool)
    reached[alive] = True
    return reached


def repeated_starts(texts: list[bytes], depth: int, twins: list[bool]) -> list[np.ndarray]:
    """For each text the starts of its strings of ``depth`` bytes that stand in the texts a second time.

    A text with a twin stands for two equal ones: their suffixes would be neighbours all the way.
    """
    data = SEPARATOR.join(texts) + SEPARATOR
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(length + 1) - length - 1
    whole = np.zeros(len(data), bool)
    for a, n in zip(begin.tolist(), length.tolist()):
        whole[a : a + max(0, n - depth + 1)] = True
    order = suffix_array(data, depth, whole)
    order = order[whole[order]]
    same = common_prefix_reaches(data, order[:-1], order[1:], depth)
    found = np.zeros(len(data), bool)
    found[order[:-1][same]] = True
    found[order[1:][same]] = True
    for a, n, twin in zip(begin.tolist(), length.tolist(), twins):
        if twin:
            found[a : a + n] = whole[a : a + n]
    return [np.flatnonzero(found[a : a + n]) for a, n in zip(begin.tolist(), length.tolist())]
