"""Words of many UTF-8 texts at once, with numpy.

A batch of texts is one byte buffer with offsets. Splitting at ASCII bytes can be done on
bytes, since all bytes of other characters are 0x80 or above. Work goes in slices of whole
texts of about ``SLICE_BYTES``, so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Bytes that split words: blank and 0x09 to 0x0D.
BLANK = np.ones(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = False

# Words of digits, letters and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    step = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 20)
    return mix(step * np.uint64(0x9E3779B97F4A7C15))


_BYTE_VALUES = seeds(256, salt=1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def slices(column, size: int = SLICE_BYTES) -> iter:
    """``(first row, bytes, offsets)`` of slices of whole texts of about ``size`` bytes; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def lower(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def split(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Starts and ends of all words, and the number of each text's first word."""
    inside = table[data]
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[offsets > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes."""
    size = max(SLICE_BYTES, 1 << max(len(data) - 1, 1).bit_length())
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _powers(_BASE, size)[: len(data)], out=total[1:])
    sums = (total[ends] - total[starts]) * _powers(_BASE_INVERSE, size)[starts]
    return mix(sums + (ends - starts).astype(np.uint64))


def shingles(hashes: np.ndarray, first: np.ndarray, width: int):
    """Hash and text number of each run of ``width`` words inside one text.

    A text with fewer words, but at least one, gives its whole sequence once.
    """
    n_words = np.diff(first)
    count = np.where(n_words >= width, n_words - width + 1, 0)
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    factors = seeds(width, salt=2) | np.uint64(1)
    n = max(len(hashes) - width + 1, 0)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        rolled += hashes[k : k + n] * factors[k]
    rolled = mix(rolled)
    texts = np.repeat(np.arange(len(n_words)), count)
    where = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[:-1], count)
    values = rolled[where]
    if len(short):
        whole = np.array(
            [mix((hashes[first[i] : first[i + 1]] * factors[: n_words[i]]).sum(keepdims=True) + factors[:1] * np.uint64(n_words[i]))[0] for i in short],
            dtype=np.uint64,
        )
        texts, values = np.concatenate([texts, short]), np.concatenate([values, whole])
    return texts, values


def distinct_sets(texts: np.ndarray, values: np.ndarray, n_texts: int):
    """Each text's distinct values in ascending order, with offsets."""
    order = np.lexsort((values, texts))
    texts, values = texts[order], values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    texts, values = texts[new], values[new]
    return values, np.searchsorted(texts, np.arange(n_texts + 1))
