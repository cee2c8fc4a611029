"""Words and word shingles of whole texts as 64-bit hashes, in numpy.

The functions work on an Arrow column of texts and read its bytes in place.
They take a table that says which bytes belong to words; bytes of non-ASCII
characters are word bytes in all tables used here. Word hashes are polynomials
over the bytes, so a batch is hashed with a few vector operations; long batches
go in windows that end between words. Equal words have equal hashes; different
ones collide with a chance of about 2^-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

WORDS = 5
WINDOW = 1 << 20

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_ODD = np.random.default_rng(20).integers(1, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = np.random.default_rng(21).integers(1, 1 << 63, 256, np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bytes(separators: bytes) -> np.ndarray:
    """Which bytes belong to words, given those that separate them."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: White space ends words.
SPACED = word_bytes(b"\x20\x09\x0a\x0b\x0c\x0d")
#: All ASCII but letters and digits ends words.
ALNUM = word_bytes(bytes(i for i in range(128) if not chr(i).isalnum()))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    up = np.full(n + 1, _BASE, np.uint64)
    down = np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column, and where each text begins (one more at the end)."""
    column = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def slices(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """A column in parts of up to `most` bytes, or of one longer text."""
    _, ends = text_bytes(texts)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(ends, ends[begin] + most, "right")) - 1
        end = min(max(end, begin + 1), len(texts))
        yield texts.slice(begin, end - begin)
        begin = end


def word_hashes(data: np.ndarray, ends: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, lower-cased, and the word at which each text begins."""
    hashes: list[np.ndarray] = []
    places: list[np.ndarray] = []
    begin, n = 0, len(data)
    first = np.zeros(n + 1, bool)
    first[ends] = True
    while begin < n:
        end = _cut(data, first, begin, min(n, begin + WINDOW), table)
        part = data[begin:end]
        inside = table[part]
        edge = first[begin:end]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | edge[1:]
        at = np.flatnonzero(starts)
        if len(at):
            stops = inside.copy()
            stops[:-1] &= ~inside[1:] | edge[1:]
            to = np.flatnonzero(stops) + 1
            up, down = _powers(max(2 * WINDOW, len(part)) if len(part) > 2 * WINDOW else 2 * WINDOW)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[LOWER[part]] * up[: len(part)], out=sums[1:])
            hashes.append(mixed((sums[to] - sums[at]) * down[at] + (to - at).astype(np.uint64)))
            places.append(at + begin)
        begin = end
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), ends)


def _cut(data: np.ndarray, first: np.ndarray, begin: int, end: int, table: np.ndarray) -> int:
    """The last place up to `end` between two words; further on if there is none."""
    if end == len(data):
        return end
    gaps = np.flatnonzero(~table[data[begin + 1 : end]] | first[begin + 1 : end])
    if len(gaps):
        return begin + 1 + int(gaps[-1])
    while end < len(data):
        gaps = np.flatnonzero(~table[data[end : end + WINDOW]] | first[end : end + len(data[end : end + WINDOW])])
        if len(gaps):
            return end + int(gaps[0])
        end += WINDOW
    return len(data)


def shingle_hashes(words: np.ndarray, ends: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of k words, in order, and where each text begins.

    A text of fewer words, but not none, has its whole word sequence as its only
    shingle.
    """
    counts = np.diff(ends)
    size = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begins = np.concatenate([[0], np.cumsum(size)])
    total = int(begins[-1])
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    out = np.empty(total, np.uint64)
    for low in range(0, total, WINDOW):
        i = np.arange(low, min(total, low + WINDOW))
        text = np.searchsorted(begins, i, "right") - 1
        # The word at which each shingle begins, and its number of words.
        at = i + (ends[:-1] - begins[:-1])[text]
        length = np.minimum(counts, k)[text]
        summed = length.astype(np.uint64)
        for j in range(k):
            summed += np.where(length > j, padded[at + j] * _ODD[j], np.uint64(0))
        out[low : low + WINDOW] = mixed(summed)
    return out, begins


def text_shingles(texts: pa.Array, table: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of a column of texts, in order, and where each text begins."""
    words, ends = word_hashes(*text_bytes(texts), table)
    return shingle_hashes(words, ends, k)
