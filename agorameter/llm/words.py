"""Words of a text as 64-bit hashes, and hashes of runs of words, in arrays.

A word is a run of bytes without ASCII white space. Its hash depends on its bytes alone, so
equal runs of words have equal hashes in every document and every task.
"""

from __future__ import annotations

import hashlib

import numpy as np

#: The white space of ASCII to spaces; the second table also lower-cases A-Z.
SPACES = bytes(32 if b in b"\t\n\v\f\r" else b for b in range(256))
LOWER = SPACES.lower()
#: Bytes that are hashed at once; a longer word is hashed by itself.
STRETCH = 1 << 17
#: Odd multipliers and a seed, of no meaning.
BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
SEED = 20240901
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, at least ``size`` of them."""
    if base not in _TABLES or len(_TABLES[base][0]) < size:
        size = 1 << max(10, (size - 1).bit_length())
        found = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            found.append(np.multiply.accumulate(steps))
        _TABLES[base] = tuple(found)
    return _TABLES[base]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


_BYTES = mix(np.arange(256, dtype=np.uint64) + np.uint64(SEED))


def word_hashes(data: bytes, table: bytes = SPACES) -> np.ndarray:
    """The hash of each word of a text, in order."""
    data = data.translate(table)
    if len(data) <= STRETCH:
        return _stretch(data)
    parts, start = [], 0
    while start < len(data):
        end = start + STRETCH
        if end < len(data):
            cut = data.rfind(b" ", start, end)
            if cut < start:
                cut = data.find(b" ", end)
                cut = len(data) if cut < 0 else cut
                word = data[start:cut]
                digest = hashlib.blake2b(word, digest_size=8).digest()
                parts.append(np.frombuffer(digest, dtype=np.uint64))
                start = cut + 1
                continue
            end = cut
        parts.append(_stretch(data[start:end]))
        start = end + 1
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def _stretch(data: bytes) -> np.ndarray:
    codes = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(codes) + 2, dtype=bool)
    np.not_equal(codes, 32, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    powers, inverse = _powers(BASE, len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[codes] * powers[: len(codes)], out=sums[1:])
    long = ends - starts
    hashed = (sums[ends] - sums[starts]) * inverse[starts]
    hashed = mix(hashed ^ (long.astype(np.uint64) << np.uint64(48)))
    if long.max() >= STRETCH:
        for i in np.flatnonzero(long >= STRETCH):
            digest = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest()
            hashed[i] = np.frombuffer(digest, dtype=np.uint64)[0]
    return hashed


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words, in order of its start."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    if size <= 4:
        hashed = np.zeros(n, dtype=np.uint64)
        for i in range(size):
            hashed = (hashed + words[i : i + n]) * np.uint64(WORD_BASE)
        return mix(hashed)
    powers, inverse = _powers(WORD_BASE, len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers[: len(words)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * inverse[:n])
