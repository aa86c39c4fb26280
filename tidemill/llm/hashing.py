"""Word and shingle hashes of whole texts in numpy, for the operators that run Arrow batches.

Words are the runs of bytes outside ASCII white space after lower-casing A-Z, which is what
``bytes.lower().split()`` gives.  A word hash is a polynomial over a table of random 64-bit
byte codes, mixed once; nothing depends on Python's salted ``hash``.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SEGMENT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer."""
    x = np.atleast_1d(np.asarray(x, np.uint64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _segment_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and hashes of the words in a byte array that begins and ends between words."""
    gap = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, np.empty(0, np.uint64)
    inside = ~gap
    code = _BYTE[buf[inside]]
    size = end - start
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(len(code)) - np.repeat(first, size)
    power = np.cumprod(np.full(int(size.max()) + 1, _BASE, np.uint64))
    return start, mix(np.add.reduceat(code * power[place], first) + size.astype(np.uint64))


def text_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts one after another, and the offsets of each text in them."""
    raw = [(t or "").encode("utf-8").lower() for t in texts]
    at = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    starts, hashes, low = [], [], 0
    while low < len(buf):
        high = min(low + _SEGMENT, len(buf))
        while high < len(buf) and not _SPACE[buf[high - 1]]:  # end between words
            rest = np.flatnonzero(_SPACE[buf[high:high + 65536]])
            high = high + int(rest[0]) + 1 if len(rest) else min(high + 65536, len(buf))
        s, h = _segment_words(buf[low:high])
        starts.append(s + low)
        hashes.append(h)
        low = high
    start, hashed = np.concatenate(starts), np.concatenate(hashes)
    return hashed, np.searchsorted(start, at)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n``-word shingles of one text; the whole sequence where it is shorter."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * _BASE + words[k:len(words) - n + 1 + k]
    return mix(out + np.uint64(n))


def ranges(sizes: np.ndarray, most: int = 1 << 20):
    """(first, last) row ranges that hold at most ``most`` of ``sizes``, or one row."""
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size + 1 > most:
            yield first, i
            first, held = i, 0
        held += size + 1
    if first < len(sizes):
        yield first, len(sizes)


def text_ranges(column, most: int = 1 << 20):
    """(first, last, texts) of an Arrow text column, a bounded number of bytes at a time."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for first, last in ranges(sizes, most):
        yield first, last, column.slice(first, last - first).to_pylist()
