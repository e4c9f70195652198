"""Byte-level BPE: encoding and decoding with the ranks of a public vocabulary.

A pre-token that is itself in the vocabulary is resolved by one probe of a minimal perfect hash. Any
other is merged: its bytes form a linked list, and a heap gives the pair of lowest rank, leftmost
first, until no neighbouring pair is in the vocabulary. Workers remember what pre-tokens became.
"""

from __future__ import annotations

import base64
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tidelake.llm.common import give_back, schema_with, small_batches, texts_of, with_columns, worker_cache
from tidelake.llm.mph import PerfectHash
from tidelake.llm.pretokens import Memo, Pieces

#: Parts of pre-tokens whose rank a worker remembers.
PART_ENTRIES = 100_000
#: Words that a worker remembers in each generation.
WORD_ENTRIES = 250_000
#: Bytes of text that a worker encodes at a time, and ids whose bytes it looks up at a time.
TEXT_BYTES = 2 << 20
DECODED_IDS = 1 << 15


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class Vocabulary:
    """What a worker needs to encode: the perfect hash, tables of the shortest tokens, its memory."""

    def __init__(self, hashed: PerfectHash):
        self.hash = hashed
        self.singles, self.pairs = [-1] * 256, array("i", [-1]) * 65536
        for token, rank in zip(hashed.keys, hashed.values):
            if token is not None and len(token) == 1:
                self.singles[token[0]] = rank
            elif token is not None and len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = rank
        if min(self.singles) < 0:
            raise ValueError("the vocabulary lacks a byte")
        self.parts = Memo({}, hashed.get, PART_ENTRIES)
        self.ids = Pieces(lambda token: self.encode(token.encode()).tobytes(), b"".join, words=WORD_ENTRIES)

    def encode(self, piece: bytes) -> array:
        """Ids of one pre-token."""
        whole = self.hash.get(piece)
        return array("i", [whole]) if whole >= 0 else self.merge(piece)

    def merge(self, piece: bytes) -> array:
        n, get, pairs, singles = len(piece), self.parts.__getitem__, self.pairs, self.singles
        # the part that starts at i ends at stop[i]; the part before it starts at before[i]
        stop, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of = [singles[byte] for byte in piece]
        # an entry holds rank, start and end in one number
        bits = n.bit_length()
        mask = (1 << bits) - 1
        heap = []
        for i in range(n - 1):
            rank = pairs[piece[i] << 8 | piece[i + 1]]
            if rank >= 0:
                heap.append((rank << bits | i) << bits | i + 2)
        heapify(heap)
        while heap:
            entry = heappop(heap)
            end, i = entry & mask, entry >> bits & mask
            middle = stop[i]
            if rank_of[i] < 0 or middle >= n or rank_of[middle] < 0 or stop[middle] != end:
                continue  # one of the two parts has changed since
            stop[i], rank_of[i], rank_of[middle] = end, entry >> 2 * bits, -1
            if end < n:
                before[end] = i
                after = stop[end]
                joined = get(piece[i:after])
                if joined >= 0:
                    heappush(heap, (joined << bits | i) << bits | after)
            left = before[i]
            if left >= 0:
                joined = get(piece[left:end])
                if joined >= 0:
                    heappush(heap, (joined << bits | left) << bits | end)
        return array("i", [rank for rank in rank_of if rank >= 0])


def vocabulary(path: str, shared: Broadcast) -> Vocabulary:
    """One per worker and file; the hash is built once, on the driver."""
    known = worker_cache("bpe")
    if ("encode", path) not in known:
        known["encode", path] = Vocabulary(shared.value)
    return known["encode", path]


class Decoder:
    """Bytes of all ids in one row, with their places."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.sizes = np.full(max(ranks.values(), default=-1) + 1, -1, np.int64)
        self.starts, at = np.zeros(len(self.sizes), np.int64), 0
        for token, rank in ranks.items():
            self.sizes[rank], self.starts[rank] = len(token), at
            at += len(token)
        self.row = np.frombuffer(b"".join(ranks), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids, and how many each has."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes) or self.sizes[ids].min() < 0):
            raise KeyError("an id that the vocabulary lacks")
        sizes = self.sizes[ids]
        # a place takes eight times the memory of its byte, so only a slice has its places at a time
        slices = (slice(at, at + DECODED_IDS) for at in range(0, len(ids), DECODED_IDS))
        return b"".join(self._bytes(ids[some], sizes[some]) for some in slices), sizes

    def _bytes(self, ids: np.ndarray, sizes: np.ndarray) -> bytes:
        ends = np.cumsum(sizes)
        first = self.starts[ids] - (ends - sizes)
        return self.row[np.repeat(first, sizes) + np.arange(ends[-1])].tobytes()


def decoder(path: str) -> Decoder:
    """One per worker and file."""
    known = worker_cache("bpe")
    if ("decode", path) not in known:
        known["decode", path] = Decoder(path)
    return known["decode", path]


def _encoded(ids_of, texts: list[str]) -> pa.ListArray:
    found = [ids_of(t) for t in texts]
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(ids) // 4 for ids in found], out=offsets[1:])
    ids = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(found))])
    return pa.ListArray.from_arrays(pa.array(offsets), ids)


def _decoded(found: Decoder, column: pa.ListArray) -> pa.Array:
    raw, sizes = found.decode(column.flatten().to_numpy(zero_copy_only=False))
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    upto = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
    texts = pa.Array.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(upto.astype(np.int64).tobytes()), pa.py_buffer(raw)]
    )
    return texts.cast(pa.binary())


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` without its text, with the ids of every whole text as ``out array<int>``.

    No special tokens; a null or empty text has no ids. Rows are kept, repeated ones too; a column
    that bears the new name is replaced; an empty table gives none.
    """
    schema = schema_with(df.drop(text), **{out: "array<int>"})

    shared = df.sparkSession.sparkContext.broadcast(PerfectHash(read_ranks(path)))

    def run(batches):
        ids_of = vocabulary(path, shared).ids.of
        for batch in small_batches(batches, text, TEXT_BYTES):
            yield with_columns(batch, {out: _encoded(ids_of, texts_of(batch, text))}).select(schema.names)

    return df.mapInArrow(run, schema)


def encode_and_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` in one pass: the ids go to the decoder before they leave the task."""
    schema = schema_with(df.drop(text), **{ids: "array<int>", out: "binary"})
    shared = df.sparkSession.sparkContext.broadcast(PerfectHash(read_ranks(path)))

    def run(batches):
        ids_of, found = vocabulary(path, shared).ids.of, decoder(path)
        for batch in small_batches(batches, text, TEXT_BYTES):
            coded = _encoded(ids_of, texts_of(batch, text))
            yield with_columns(batch, {ids: coded, out: _decoded(found, coded)}).select(schema.names)
        give_back()

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of the ids as ``out binary``.

    Null or no ids give no bytes; a null or unknown id raises ``KeyError``, as nothing stands for it.
    """
    schema = schema_with(df, **{out: "binary"})

    def run(batches):
        found = decoder(path)
        for batch in small_batches(batches, ids):
            yield with_columns(batch, {out: _decoded(found, batch.column(ids))}).select(schema.names)

    return df.mapInArrow(run, schema)
