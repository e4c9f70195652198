"""Range asymmetric numeral system over blocks of interleaved lanes, in numpy.

All blocks of a call are coded side by side. Each block is independent of the others: it has its own
lane states and words, so a reader can start at any block.
"""

from __future__ import annotations

import numpy as np

#: Frequencies of a table add up to two to the power of this.
TABLE_BITS = 20
LANES = 32
#: Symbols per block.
BLOCK = 16_384

_LOW = np.uint64(1 << 31)
_TOTAL = 1 << TABLE_BITS  # symbols are small numbers: ids of a vocabulary
_WORD = np.uint64(32)


def table(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct symbols, frequencies), scaled to the total with none below one."""
    counts = np.bincount(symbols)
    found = np.flatnonzero(counts)
    counts = counts[found]
    if not len(found):
        return found, counts
    if len(found) > _TOTAL:
        raise ValueError("more distinct symbols than the table has places")
    scaled = np.maximum(1, counts * _TOTAL // counts.sum())
    order = np.argsort(-scaled, kind="stable")
    excess, at = int(scaled.sum()) - _TOTAL, 0
    while excess > 0:  # take what the rare symbols were rounded up by from the frequent ones
        take = min(excess, int(scaled[order[at]]) - 1)
        scaled[order[at]] -= take
        excess, at = excess - take, at + 1
    scaled[order[0]] -= min(excess, 0)
    return found, scaled


def encode(symbols: np.ndarray, found: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(states per block and lane, words of each block) for symbols that are all in ``found``."""
    n = len(symbols)
    blocks, steps = -(-n // BLOCK), BLOCK // LANES
    index = np.zeros(blocks * BLOCK, np.int32)
    if n:
        place = np.zeros(int(found[-1]) + 1, np.int32)
        place[found] = np.arange(len(found))
        index[:n] = place[symbols]
    valid = (np.arange(blocks * BLOCK) < n).reshape(blocks, steps, LANES)
    index = index.reshape(blocks, steps, LANES)
    freq = freq.astype(np.uint64)
    start = (np.cumsum(freq) - freq).astype(np.uint64)
    state = np.full((blocks, LANES), _LOW, np.uint64)
    words = np.zeros((blocks, steps, LANES), np.uint32)
    sent = np.zeros((blocks, steps, LANES), bool)
    top = np.uint64(31 - TABLE_BITS + 32)
    for t in range(steps - 1, -1, -1):
        at, use = index[:, t], valid[:, t]
        f = freq[at]
        full = (state >= f << top) & use
        words[:, t][full] = (state[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        sent[:, t] = full
        state = np.where(full, state >> _WORD, state)
        whole = state // f
        state = np.where(use, (whole << np.uint64(TABLE_BITS)) + (state - whole * f) + start[at], state)
    flat = words[sent].astype("<u4")
    cuts = np.cumsum(sent.sum(axis=(1, 2)))
    return state, [flat[a:b].tobytes() for a, b in zip(np.append(0, cuts[:-1]), cuts)]


def decode(sizes: np.ndarray, states: np.ndarray, words: list[bytes], found: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """The symbols of the given blocks, one after another; any choice of blocks will do."""
    blocks, steps = len(sizes), BLOCK // LANES
    if not blocks:
        return found[:0]
    slots = np.repeat(np.arange(len(found), dtype=np.int32), freq)
    freq = freq.astype(np.uint64)
    start = (np.cumsum(freq) - freq).astype(np.uint64)
    stream = np.concatenate([np.frombuffer(w, "<u4") for w in words] + [np.zeros(LANES, np.uint32)])
    at = np.cumsum([0] + [len(w) // 4 for w in words[:-1]])
    state = states.astype(np.uint64).reshape(blocks, LANES)
    out = np.empty((blocks, steps, LANES), np.int32)
    lane = np.arange(LANES)
    mask = np.uint64(_TOTAL - 1)
    for t in range(steps):
        use = t * LANES + lane[None, :] < sizes[:, None]
        low = state & mask
        index = slots[low]
        out[:, t] = index
        moved = freq[index] * (state >> np.uint64(TABLE_BITS)) + low - start[index]
        state = np.where(use, moved, state)
        empty = (state < _LOW) & use
        place = at[:, None] + np.cumsum(empty, axis=1) - 1
        refill = stream[np.where(empty, place, 0)].astype(np.uint64)
        state = np.where(empty, (state << _WORD) | refill, state)
        at = at + empty.sum(axis=1)
    keep = np.arange(BLOCK)[None, :] < np.asarray(sizes)[:, None]
    return found[out.reshape(blocks, BLOCK)[keep]]
