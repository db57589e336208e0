"""Content-defined anchors: one in every window of a text, at the same place in equal windows."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

from loomframe.llm.shingles import mix

#: Bytes of a repeated string, and of the string whose hash makes an anchor.
WINDOW, SEED = 200, 64
_LOW = np.uint64((1 << 21) - 1)
#: Windows that are looked at together.
STEP = 1 << 20
_BASE = 0x369DEA0F31A53F85
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Prefix:
    """Hashes of the substrings of SEED bytes of data, from sums over its prefixes. They choose anchors and bring equal seeds together; what they
    hold for equal is compared by bytes or by cryptographic digests."""

    up = down = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Prefix.up) <= n:
            size = max(n + 1, 1 << 21)
            Prefix.up, Prefix.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * Prefix.up[:n], out=total[1:])
        starts = max(0, n - SEED + 1)
        self.seeds = mix((total[SEED:] - total[:starts]) * Prefix.down[:starts]) if starts else np.empty(0, np.uint64)


def _owners(seeds: np.ndarray, k: int) -> np.ndarray:
    """The anchor of each of the first k windows (leftmost smallest seed), by minima over blocks as wide as a window's seeds."""
    w = WINDOW - SEED + 1
    key = (seeds[: k + w - 1] & ~_LOW) | np.arange(k + w - 1).astype(np.uint64)
    rows = -(-len(key) // w)
    padded = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(key)] = key
    blocks = padded.reshape(rows, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:k], ahead[w - 1 : w - 1 + k]) & _LOW).astype(np.int64)


def anchors(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, last start, seed): every window of WINDOW bytes inside a text has one anchor, the leftmost
    smallest seed hash in it; the windows of an anchor have consecutive starts. Positions count from the start of data.

    STEP windows are looked at together, whatever the length of data; an anchor whose windows two steps share becomes one row.
    """
    n = len(data)
    found: list[list[np.ndarray]] = []
    for begin in range(0, max(0, n - WINDOW + 1), STEP):
        k = min(STEP, n - WINDOW + 1 - begin)
        seeds = Prefix(data[begin : begin + k + WINDOW - 1]).seeds
        owner = _owners(seeds, k)
        s = np.arange(begin, begin + k)
        text = np.searchsorted(edges, s, "right") - 1
        inside = np.flatnonzero(s + WINDOW <= np.append(edges[1:], n)[text])
        if not len(inside):
            continue
        s, owner = s[inside], owner[inside]
        new = np.flatnonzero((np.diff(owner) != 0) | (np.diff(s) != 1)) + 1
        first, last = np.append(0, new), np.append(new, len(s)) - 1
        part = [begin + owner[first], s[first], s[last], seeds[owner[first]]]
        if found and found[-1][0][-1] == part[0][0] and found[-1][2][-1] + 1 == part[1][0]:
            found[-1][2][-1] = part[2][0]
            part = [x[1:] for x in part]
        if len(part[0]):
            found.append(part)
    if not found:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    """128 cryptographic bits of each data[start:end]."""
    raw = data.tobytes()
    return [blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist())]
