"""Vectorised byte-level tokenising and hashing, shared by the text operators.

A word is a maximal run of ASCII letters and digits and of bytes of 0x80 and above (so every accented or non-Latin
letter counts as part of a word); letters A-Z are folded to lower case.  Everything works on the value buffer of an
Arrow string column, in pieces of bounded size, and never makes a Python object for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: bytes of text that are tokenised at once; bounds the memory of a Python worker
PIECE = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, elementwise on uint64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < n:
        n = max(n, PIECE + 65536)
        one = np.ones(1, np.uint64)
        with np.errstate(over="ignore"):
            _powers["p"] = np.concatenate([one, np.cumprod(np.full(n - 1, _P))])
            _powers["i"] = np.concatenate([one, np.cumprod(np.full(n - 1, _INV))])
    return _powers["p"], _powers["i"]


def buffer_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty string."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if col.type not in (pa.large_string(), pa.large_binary()):
        col = col.cast(pa.large_binary() if pa.types.is_binary(col.type) else pa.large_string())
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(data: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of data[lo:hi]: starts and ends (positions in data) and 64-bit hashes."""
    starts, ends, hashes = [], [], []
    while lo < hi:
        cut = min(hi, lo + PIECE)
        if cut < hi:  # a piece ends after a byte that is no word's
            back = np.flatnonzero(~_WORD[data[lo:cut]])
            while not len(back) and cut < hi:
                cut = min(hi, cut + PIECE)
                back = np.flatnonzero(~_WORD[data[lo:cut]])
            if cut < hi:
                cut = lo + int(back[-1]) + 1
        x = data[lo:cut]
        inside = _WORD[x]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        a, b = edge[::2], edge[1::2]
        power, inverse = _power(len(x) + 1)
        with np.errstate(over="ignore"):
            s = np.zeros(len(x) + 1, np.uint64)
            np.cumsum((_FOLD[x].astype(np.uint64) + np.uint64(1)) * power[: len(x)], out=s[1:])
            h = mix((s[b] - s[a]) * inverse[a] + np.uint64(0x5851F42D4C957F2D) * (b - a).astype(np.uint64))
        starts.append(a + lo)
        ends.append(b + lo)
        hashes.append(h)
        lo = cut
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


class Words:
    """Words of documents first..last-1 of a batch. doc: each word's document (batch index); bounds: len+1 word offsets."""

    __slots__ = ("first", "last", "start", "end", "hash", "bounds", "data", "offsets")

    def __init__(self, data, offsets, first, last):
        self.first, self.last, self.data, self.offsets = first, last, data, offsets
        # a document's last word must not run into the next document's first one
        lo, hi = int(offsets[first]), int(offsets[last])
        seg = data[lo:hi]
        gap = np.empty(hi - lo + (last - first), np.uint8)
        n = offsets[first : last + 1] - lo
        where = np.arange(hi - lo) + np.repeat(np.arange(last - first), np.diff(n))
        gap.fill(32)
        gap[where] = seg
        start, end, self.hash = words_of(gap, 0, len(gap))
        at = n[1:] + np.arange(last - first)  # the place of each document's gap
        doc = np.searchsorted(at, start)
        self.start, self.end = start - doc + lo, end - doc + lo
        self.bounds = np.searchsorted(doc, np.arange(last - first + 1))

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.first, self.last), np.diff(self.bounds))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all n-word windows inside documents, index of each one's first word)."""
        return grams(self.hash, self.bounds, n)


def prefix_hashes(w: Words, sizes: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each size (the longer words of a piece, hashes of their first `size` bytes); letters A-Z are folded."""
    lo, hi = int(w.offsets[w.first]), int(w.offsets[w.last])
    power, inverse = _power(hi - lo + 1)
    out = []
    with np.errstate(over="ignore"):
        s = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((_FOLD[w.data[lo:hi]].astype(np.uint64) + np.uint64(1)) * power[: hi - lo], out=s[1:])
        for size in sizes:
            longer = np.flatnonzero(w.end - w.start > size)
            at = w.start[longer] - lo
            out.append((longer, mix((s[at + size] - s[at]) * inverse[at] + np.uint64(7919 * size))))
    return out


def grams(h: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(h) - n + 1
    with np.errstate(over="ignore"):
        g = np.zeros(m, np.uint64)
        for k in range(n):
            g *= np.uint64(0xD1342543DE82EF95)
            g += h[k : k + m]
        g = mix(g)
    size = np.diff(bounds)
    left = np.repeat(bounds[1:], size)[:m] - np.arange(m)  # words from here to the document's end
    at = np.flatnonzero(left >= n)
    return g[at], at


def pieces(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about `most` bytes; a longer document is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def char_positions(data: np.ndarray, lo: int, hi: int, at: np.ndarray) -> np.ndarray:
    """Byte positions `at` (absolute, within lo..hi) as character offsets from lo."""
    lead = np.concatenate([[0], np.cumsum((data[lo:hi] & 0xC0) != 0x80)])
    return lead[at - lo]
