"""A minimal perfect hash: n keys, n slots, one probe."""

from __future__ import annotations

import numpy as np
import xxhash

KEYS_PER_BUCKET = 3
_MASK = (1 << 32) - 1
_SPREAD = 0x9E3779B1


def _parts(key: bytes) -> tuple[int, int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    return h & _MASK, (h >> 32) & _MASK, (h >> 64) & _MASK | 1


class PerfectHash:
    """Maps each of the given distinct keys to its value, and every other key to -1.

    Keys fall into small buckets; each bucket stores the displacement that sends its keys to slots of
    their own, the largest bucket first. A bucket of one key stores a free slot itself, as a negative
    number. The key in the slot is compared, so that a foreign key is never taken for a stored one.
    """

    def __init__(self, values: dict[bytes, int]):
        n = len(values)
        self.size, self.buckets = max(n, 1), max(1, n // KEYS_PER_BUCKET)
        groups: dict[int, list[tuple[bytes, int, int]]] = {}
        for key in values:
            bucket, first, step = _parts(key)
            groups.setdefault(bucket % self.buckets, []).append((key, first, step))
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.size
        self.values = [-1] * self.size
        free = np.ones(self.size, bool)
        singles = []
        for bucket, members in sorted(groups.items(), key=lambda g: (-len(g[1]), g[0])):
            if len(members) == 1:
                singles.append((bucket, members[0][0]))
                continue
            shift = 0
            while True:
                slots = [self._slot(first, step, shift) for _, first, step in members]
                if len(set(slots)) == len(slots) and all(free[s] for s in slots):
                    break
                shift += 1
                if shift > 1 << 22:
                    raise ValueError("keys of one bucket can't be told apart")
            self.shift[bucket] = shift
            for (key, _, _), slot in zip(members, slots):
                free[slot] = False
                self.keys[slot], self.values[slot] = key, values[key]
        for (bucket, key), slot in zip(singles, np.flatnonzero(free).tolist()):
            self.shift[bucket] = -slot - 1
            self.keys[slot], self.values[slot] = key, values[key]

    def _slot(self, first: int, step: int, shift: int) -> int:
        return ((first + shift * _SPREAD) * step >> 16) % self.size

    def get(self, key: bytes) -> int:
        bucket, first, step = _parts(key)
        shift = self.shift[bucket % self.buckets]
        slot = -shift - 1 if shift < 0 else self._slot(first, step, shift)
        return self.values[slot] if self.keys[slot] == key else -1
