"""Words of whole texts as 64-bit hashes, computed over many documents at once in numpy.

A word is a longest run of bytes other than those of `between`, by default space and tab to carriage return; A-Z count as a-z. Its hash is a polynomial
over its bytes modulo 2^64, taken from prefix sums, and mixed; equal words have equal hashes on every machine. Words of more than
`LONG_WORD` bytes, where such polynomials can be made to agree, are hashed by BLAKE2.
"""

from __future__ import annotations

import hashlib

import numpy as np

_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NO_LETTER = np.arange(256) < 128  # ASCII other than letters and digits
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    NO_LETTER[_a:_b] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LONG_WORD = 256
BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_FOLDED = _VALUES[_LOWER]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i <= n."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(1 << 18, 1 << int(n).bit_length())
        _POWERS[:] = [np.concatenate([[_U(1)], np.full(size, _U(b))]).cumprod(dtype=np.uint64) for b in (BASE, pow(BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def prefix_sums(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[:len(data)], out=sums[1:])
    return sums


def bounds(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of each word, the byte after its last, and the words' offsets by document."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~between[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:] & (cut | ~inside[:-1]) & np.append(inside[1:-1], False))
    ends = np.flatnonzero(inside[:-1] & (cut | ~inside[1:]))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the words' offsets by document."""
    starts, ends, by_doc = bounds(data, offsets, between)
    sums = prefix_sums(data, _FOLDED)
    _, down = powers(len(data))
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[i] = int.from_bytes(hashlib.blake2b(_LOWER[data[starts[i]:ends[i]]].tobytes(), digest_size=8).digest(), "little")
    return hashes, by_doc


def shingle_hashes(words: np.ndarray, by_doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `size` words, repeats included, and their offsets by document.

    A document with fewer words has one shingle, its whole sequence; one without words has none.
    """
    counts = np.diff(by_doc)
    out = np.zeros(len(words), np.uint64)
    if len(words) >= size:
        rolled = words[:len(words) - size + 1].copy()
        for k in range(1, size):
            rolled = mix(rolled * _U(0xD6E8FEB86659FD93) + words[k:len(words) - size + 1 + k])
        out[:len(rolled)] = rolled
    keep = np.ones(len(words), bool)
    tail = np.arange(len(words)) - np.repeat(by_doc[:-1], counts) > np.repeat(counts - size, counts)
    keep[tail] = False
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        h = words[by_doc[d]:by_doc[d] + 1].copy()
        for k in range(1, counts[d]):
            h = mix(h * _U(0xD6E8FEB86659FD93) + words[by_doc[d] + k])
        out[by_doc[d]] = mix(h + _U(int(counts[d])))[0]
        keep[by_doc[d]] = True
    sizes = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    return out[keep], np.concatenate([[0], np.cumsum(sizes)])


def distinct_by_doc(values: np.ndarray, by_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each document, and their offsets."""
    parts = [np.unique(values[a:b]) for a, b in zip(by_doc[:-1], by_doc[1:])]
    return (np.concatenate(parts) if parts else values[:0]), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
