"""Word and shingle hashes of many texts at a time, and sorted hash lists packed for a shuffle (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import zstandard

U = np.uint64
BLOCK_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BYTE = mix(np.arange(1, 257, dtype=U))
BYTE_LOWER = BYTE.copy()
BYTE_LOWER[65:91] = BYTE[97:123]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, (n + 1).bit_length())
    if size not in _TABLES:
        _TABLES[size] = (powers(BASE, size), powers(INVERSE, size))
    return _TABLES[size]


def _words_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    b = np.frombuffer(data, dtype=np.uint8)
    space = np.ones(len(b) + 2, dtype=bool)
    space[1:-1] = SPACE[b]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _tables(len(b))
    sums = np.zeros(len(b) + 1, dtype=U)
    np.cumsum(BYTE_LOWER[b] * up[: len(b)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z in lower case), and where the words of each text begin (one entry more than texts)."""
    hashes, counts, block, size = [], [], [], 0

    def flush() -> None:
        starts, found = _words_of(b" ".join(block))
        begins = np.cumsum([0, *(len(t) + 1 for t in block)])
        counts.append(np.diff(np.searchsorted(starts, begins)))
        hashes.append(found)

    for text in texts:
        data = (text or "").encode()
        block.append(data)
        size += len(data)
        if size >= BLOCK_BYTES:
            flush()
            block, size = [], 0
    if block:
        flush()
    counts = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes) if hashes else np.zeros(0, dtype=U), np.concatenate([[0], np.cumsum(counts)])


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct shingles of one text's words; fewer than ``n`` words are one shingle."""
    if not len(words):
        return words
    k = min(n, len(words))
    total = np.full(len(words) - k + 1, k, dtype=U)
    for j in range(k):
        total = total * U(BASE) + words[j : len(words) - k + 1 + j]
    return np.unique(mix(total))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct keys, where each comes first, and the place of each key among them (faster than ``np.unique``)."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    found = ordered[starts]
    del ordered
    number = np.cumsum(new)
    number -= 1
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = number
    return found, np.minimum.reduceat(order, starts) if len(keys) else starts, place


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(keys)
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    return ordered[starts], np.diff(starts, append=len(keys))


def counted(keys: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct keys, and how many times each occurs at a marked place; sorts keys only, not their places."""
    found, counts = _runs(keys)
    others, more = _runs(keys[~marked])
    counts[np.searchsorted(found, others)] -= more
    return found, counts


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane."""
    steps = np.diff(keys, prepend=U(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U).reshape(-1), dtype=U)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts byte plane by byte plane, in four planes or, from 2**32 on, in eight."""
    counts = counts.astype(np.int64)
    kind = np.int64 if len(counts) and counts.max() >= 2**32 else np.uint32
    width = np.dtype(kind).itemsize
    planes = np.ascontiguousarray(counts.astype(kind).view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + zstandard.compress(planes.tobytes(), 1)


def unpack_counts(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.decompress(data[1:]), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(np.int64 if width == 8 else np.uint32).reshape(-1)
