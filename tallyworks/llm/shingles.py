"""Word shingles and MinHash over Arrow text columns, in numpy.

Words are runs between ASCII white space with A-Z lower-cased; a shingle is five words in a row, or all
words of a text that has fewer. A text without words has no shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
#: Bytes of texts whose arrays are held at once; a longer text is a block of its own.
BLOCK = 1 << 19

_random = np.random.Generator(np.random.PCG64(20240917))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = _random.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _powers_upto(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((_BASE, _BACK)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and, for each text (ends in ``data``), how many it has."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    black = ~_WHITE[data]
    border = np.zeros(len(data) + 1, bool)
    border[ends] = True
    border[0] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, black[:-1]
    starts = np.flatnonzero(black & (~before | border[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, black[1:]
    stops = np.flatnonzero(black & (~after | border[1:])) + 1
    powers, back = _powers_upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[:len(data)], out=sums[1:])
    hashes = mixed((sums[stops] - sums[starts]) * back[starts])
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def text_blocks(texts: pa.StringArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, each text's end among them), block by block in the order of the texts."""
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, int(offsets[at]) + BLOCK, "right")) - 1)
        yield data[offsets[at]:offsets[to]], (offsets[at + 1:to + 1] - offsets[at]).astype(np.int64)
        at = to


def blocks(texts: pa.StringArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(shingles, number of each text's shingles), block by block in the order of the texts."""
    for data, ends in text_blocks(texts):
        yield _shingles(data, ends)


def _shingles(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, counts = word_hashes(data, ends)
    padded_counts = counts + WORDS - 1
    starts = np.cumsum(padded_counts) - padded_counts
    padded = np.zeros(int(padded_counts.sum()) + WORDS, np.uint64)
    text_of = np.repeat(np.arange(len(counts)), counts)
    padded[np.arange(len(words)) + text_of * (WORDS - 1)] = words
    total = len(padded) - WORDS + 1
    hashed = np.zeros(total, np.uint64)
    for k in range(WORDS):
        hashed += padded[k:total + k] * _PLACE[k]
    number = np.where(counts > 0, np.maximum(counts - WORDS + 1, 1), 0)
    first = np.cumsum(number) - number
    at = np.arange(int(number.sum())) - np.repeat(first, number) + np.repeat(starts, number)
    return mixed(hashed[at]), number


class Permutations:
    """Universal hash functions ``a * x + b`` modulo 2**64."""

    def __init__(self, size: int, seed: int):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.a = draw.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 2**63, size, dtype=np.uint64)

    def minima(self, shingles: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The least value of each function over each text's shingles, its upper 32 bits; all ones without any."""
        out = np.full((len(number), len(self.a)), 2**32 - 1, np.uint32)
        full = np.flatnonzero(number)
        if len(full):
            starts = (np.cumsum(number) - number)[full]
            for k, (a, b) in enumerate(zip(self.a, self.b, strict=True)):
                out[full, k] = np.minimum.reduceat(shingles * a + b, starts) >> np.uint64(32)
        return out
