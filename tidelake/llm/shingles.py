"""Hashes of word shingles, computed over the bytes of a whole text at once."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words per shingle.
WORDS = 5

# A-Z become a-z; the six blanks of the word rule become spaces
_FOLD = bytes(
    32 if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACES = np.array([0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)

#: Powers that a worker keeps from text to text.
KEPT_POWERS = 1 << 21
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of them; a few are kept."""
    if len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    size = max(n, min(2 * n, KEPT_POWERS))
    found = []
    for base in (_BASE, _INVERSE):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        found.append(np.cumprod(steps, dtype=np.uint64))
    if size <= KEPT_POWERS:
        _powers[:] = found
    return found[0], found[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each span of bytes, the same wherever the bytes stand."""
    power, inverse = _tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash per word, A-Z in lower case, words cut at the six ASCII blanks."""
    raw = np.frombuffer(text.translate(_FOLD), np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([True], raw == 32, [True]))))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    return hashed_spans(raw, starts, ends)


def shingle_set(text: bytes) -> np.ndarray:
    """The distinct shingles, sorted; a text of fewer words is one shingle, one without words none."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < WORDS:
        counted = np.append(words * _PLACES[: len(words)], np.array([len(words)], np.uint64) * _BASE)
        return mixed(counted.sum(keepdims=True, dtype=np.uint64))
    total = words[: len(words) - WORDS + 1] * _PLACES[0]
    for i in range(1, WORDS):
        total = total + words[i : len(words) - WORDS + 1 + i] * _PLACES[i]
    return np.unique(mixed(total))


def set_hash(shingles: np.ndarray) -> int:
    """Identity of a set as a signed 64-bit number."""
    h = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return h - (1 << 64) if h >> 63 else h
