"""Word n-gram hashes of whole texts, vectorised over Arrow batches (numpy, inside tasks).

A word is a maximal run of bytes other than the six ASCII blanks, which in UTF-8 is the same as
a run of characters other than those. Hashes are 64-bit and depend on the words' bytes only.
"""

from __future__ import annotations

import numpy as np

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x2545F4914F6CDD1D)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the public-domain splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_power = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _power
    if len(_power) < n:
        _power = np.cumprod(np.full(2 * n, _STEP, np.uint64)) | np.uint64(1)
    return _power[:n]


def words(column, lower: bool = False, breaks: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each row and the total) of an Arrow string column; a word
    is a maximal run of bytes that ``breaks`` does not mark."""
    import pyarrow as pa
    import pyarrow.compute as pc
    col = pc.fill_null(column.cast(pa.large_binary()), b"")
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    if lower:
        data = LOWER[data]
    inside = ~breaks[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < len(data)]
    start[heads] = inside[heads]
    where = np.flatnonzero(start)
    first = np.concatenate([np.searchsorted(where, at[:-1]), [len(where)]]).astype(np.int64)
    if not len(where):
        return np.zeros(0, np.uint64), first
    letters = data[inside]
    begin = np.flatnonzero(start[inside])
    size = np.diff(np.append(begin, len(letters)))
    narrow = np.int32 if len(letters) < 1 << 31 else np.int64      # eight bytes a letter are held at a time, not forty
    place = np.arange(len(letters), dtype=narrow)
    place -= np.repeat(begin.astype(narrow), size)
    weight = powers(int(size.max()))[place]
    del place
    weight *= _BYTE[letters]
    h = np.add.reduceat(weight, begin)
    return mixed(h + size.astype(np.uint64) * _GOLDEN), first


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (positions too near the end: absent)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = np.full(n, np.uint64(k), np.uint64) * _GOLDEN
    for i in range(k):
        g = (g ^ h[i:i + n]) * _STEP
        g ^= g >> np.uint64(32)
    return mixed(g)
