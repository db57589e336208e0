"""Word shingles of many texts at once, kept as the words' own bytes."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loomframe.llm.bpe import utf8_buffers

WIDTH = 5
#: Bytes of text that are cut into words at once.
SLICE_BYTES = 1 << 20
#: Bytes of a word's key: words under KEY bytes stand in it with their length, longer ones as a digest of KEY - 1 bytes.
KEY = 16
#: Shingles of one text that are looked at together; a text with more is taken in classes of their hashes.
TOGETHER = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers without visible structure (two multiply-xorshift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _keys(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, key) of the words of data."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty((0, KEY), np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    blank = _blank(data)
    begin, stop = ~blank, ~blank
    begin[1:] &= blank[:-1]
    stop[:-1] &= blank[1:]
    inner = edges[(edges > 0) & (edges < n)]
    begin[inner] |= ~blank[inner]
    stop[inner - 1] |= ~blank[inner - 1]
    s, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    size = e - s
    key = np.zeros((len(s), KEY), np.uint8)
    padded = np.concatenate([data, np.zeros(KEY, np.uint8)])
    words = np.ndarray((n, KEY), np.uint8, padded, strides=(1, 1))[s]
    key[:, : KEY - 1] = np.where(np.arange(KEY - 1) < size[:, None], words[:, : KEY - 1], 0)
    key[:, KEY - 1] = np.minimum(size, KEY)
    for i in np.flatnonzero(size >= KEY).tolist():
        key[i, : KEY - 1] = np.frombuffer(blake2b(data[s[i] : e[i]].tobytes(), digest_size=KEY - 1).digest(), np.uint8)
    return np.searchsorted(edges, s, "right") - 1, key


def word_keys(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, key) of every word of the texts that edges cut data into: A-Z in lower case, split at ASCII white space.

    Different words have different keys: the bytes and the length of a word under KEY bytes, a 120-bit cryptographic digest of a longer one.
    A long text is cut into words a piece at a time, at white space.
    """
    if len(data) <= 2 * SLICE_BYTES or len(edges) > 2:
        return _keys(data, edges)
    texts, keys, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + SLICE_BYTES)
        while end < len(data):
            gap = np.flatnonzero(_blank(data[end : end + SLICE_BYTES]))
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(data), end + SLICE_BYTES)
        text, key = _keys(data[at:end], np.array([0, end - at]))
        texts.append(text)
        keys.append(key)
        at = end
    return np.concatenate(texts), np.concatenate(keys)


def _hashes(keys: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    two = np.ascontiguousarray(keys).view(np.uint64).reshape(-1, 2)
    return mix(mix(two[:, 0] + np.uint64(0x632BE59BD9B4E019)) ^ (two[:, 1] * np.uint64(0x9E3779B97F4A7C15)))


def _chained(h: np.ndarray) -> np.ndarray:
    """A hash of each run of WIDTH words."""
    rows = max(0, len(h) - WIDTH + 1)
    out = h[:rows].copy()
    for k in range(1, WIDTH):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : rows + k])
    return out


class Shingles:
    """The distinct shingles of one text: runs of WIDTH words, or all words of a text with fewer.

    They are looked at in ``pieces`` (classes of their hashes, one for most texts), without a shingle in two of them. Equal hashes are only a guess:
    wherever shingles are held for equal, their words' keys are compared, and if two of one hash differ, all are told apart by their keys.
    """

    def __init__(self, keys: np.ndarray, hashes: np.ndarray | None = None):
        if 0 < len(keys) < WIDTH:
            keys, hashes = np.concatenate([keys, np.zeros((WIDTH - len(keys), KEY), np.uint8)]), None
        self.keys = keys
        self.hashes = _chained(_hashes(keys)) if hashes is None else hashes

    def pieces(self) -> int:
        return max(1, -(-len(self.hashes) // TOGETHER))

    def rows(self, at: np.ndarray) -> np.ndarray:
        """The keys of the shingles at these places."""
        flat = np.ascontiguousarray(self.keys).reshape(-1)
        return np.ndarray((len(self.hashes), WIDTH * KEY), np.uint8, flat, strides=(KEY, 1))[at] if len(at) else np.empty((0, WIDTH * KEY), np.uint8)

    def part(self, p: int, pieces: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """(hashes, places, certain) of piece p, by rising hash: one place for each hash, and whether equal hashes were equal shingles."""
        h, at = self.hashes, None
        if pieces > 1:
            at = np.flatnonzero(h % np.uint64(pieces) == p)
            h = h[at]
        order = np.argsort(h)
        h = h[order]
        at = order if at is None else at[order]
        same = np.flatnonzero(h[1:] == h[:-1]) if len(h) > 1 else np.empty(0, np.int64)
        certain = not len(same) or bool((self.rows(at[same]) == self.rows(at[same + 1])).all())
        if len(same):
            stays = np.ones(len(h), bool)
            stays[same + 1] = False
            h, at = h[stays], at[stays]
        return h, at, certain

    def by_keys(self, p: int, pieces: int) -> tuple[pa.Array, np.ndarray]:
        """(fixed-size binary array of the keys, hashes) of the distinct shingles of piece p, told apart by their keys."""
        wide = WIDTH * KEY
        at = np.flatnonzero(self.hashes % np.uint64(pieces) == p)
        encoded = pa.Array.from_buffers(pa.binary(wide), len(at), [None, pa.py_buffer(np.ascontiguousarray(self.rows(at)))]).dictionary_encode()
        hashes = np.empty(len(encoded.dictionary), np.uint64)
        hashes[encoded.indices.to_numpy()] = self.hashes[at]
        return encoded.dictionary, hashes

    def distinct(self) -> Iterator[tuple[int, np.ndarray]]:
        """(number of shingles, their hashes) of each piece."""
        pieces = self.pieces()
        for p in range(pieces):
            h, _, certain = self.part(p, pieces)
            if not certain:
                h = self.by_keys(p, pieces)[1]
            yield len(h), h


def common(a: Shingles, b: Shingles) -> tuple[int, int, int]:
    """(size of a, size of b, size of the intersection), compared by the words' keys."""
    sizes = [0, 0, 0]
    pieces = max(a.pieces(), b.pieces())
    for p in range(pieces):
        (x, i, sure), (y, j, safe) = a.part(p, pieces), b.part(p, pieces)
        if sure and safe:
            both, m, n = np.intersect1d(x, y, assume_unique=True, return_indices=True)
            if not len(both) or (a.rows(i[m]) == b.rows(j[n])).all():
                for k, v in enumerate((len(x), len(y), len(both))):
                    sizes[k] += v
                continue
        u, v = a.by_keys(p, pieces)[0], b.by_keys(p, pieces)[0]
        sizes[0] += len(u)
        sizes[1] += len(v)
        sizes[2] += (pc.sum(pc.is_in(v, value_set=u)).as_py() or 0) if len(u) and len(v) else 0
    return sizes[0], sizes[1], sizes[2]


def shingled(texts: pa.Array) -> Iterator[tuple[int, list[Shingles], list[np.ndarray]]]:
    """(first row, shingles of each text, keys of each text's words) of runs of whole texts of about SLICE_BYTES."""
    for first, data, edges in slices(texts):
        text, keys = word_keys(data, edges)
        chained = _chained(_hashes(keys)) if len(keys) else np.empty(0, np.uint64)
        at = np.searchsorted(text, np.arange(len(edges))).tolist()
        spans = list(zip(at[:-1], at[1:]))
        yield first, [Shingles(keys[a:b], chained[a : max(a, b - WIDTH + 1)]) for a, b in spans], [keys[a:b] for a, b in spans]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, edges) of runs of whole texts of about SLICE_BYTES."""
    data, offsets = utf8_buffers(texts)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1))
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j
