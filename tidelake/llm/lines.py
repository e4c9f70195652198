"""Line dedup: a sharded minimal perfect hash over line hashes, with compact arrays, probed by documents.

Two steps, neither of which moves a line. First every batch of texts sends the distinct hashes of its
lines to the shards that own them, each with the number of its documents and the largest id; a shard
builds a minimal perfect hash over its distinct hashes, and arrays of fingerprints, counts and largest
ids in the order of its slots. This index is stored. Then documents probe: each batch sends packed
hashes to the shard's arrays, and only the line numbers to drop come back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.common import kept, small_batches, with_columns
from tidelake.llm.shingles import mixed

#: Code points of the shortest line that counts, and documents that make it a repeat.
LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
#: Bytes of text whose lines one shard of the index owns, about.
SHARD_BYTES = 256 << 20
LEAST_SHARDS = 64

_BLANKS = b" \t\n\x0b\x0c\r"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Stands for a null id: below all others.
_NO_ID = -(1 << 63)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_COUNT_MOST = 255


class PerfectHash:
    """Sends n distinct 128-bit keys to the slots 0 to n - 1.

    Keys are thrown into a bit array of twice their number; those that hit a bit alone stay, the others
    go on to the next, smaller array. A key's slot is the number of set bits before its own.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.words = sizes, bits.view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)))

    @classmethod
    def over(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        sizes, arrays = [], []
        while len(high):
            if len(sizes) == 200:
                raise ValueError("the keys are not distinct")
            size = -(-2 * len(high) // 64) * 64
            place = cls._place(high, low, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            arrays.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            rest = ~alone[place]
            high, low = high[rest], low[rest]
        return cls(np.array(sizes, np.int64), np.concatenate([*arrays, np.empty(0, np.uint8)]))

    @staticmethod
    def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        turn = mixed(np.array([level + 1], np.uint64) * _ODD) | np.uint64(1)
        return (mixed(high * turn + mixed(low ^ turn)) % np.uint64(size)).astype(np.int64)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each key; for a key that isn't stored, some slot or -1."""
        found = np.full(len(high), -1, np.int64)
        left, base = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            place = self._place(high[left], low[left], level, size) + base
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            found[left[hit]] = (self.before[place >> 6] + below)[hit]
            left, base = left[~hit], base + size
        return found


def _keys(text: bytes | None) -> list[tuple[int, bytes]]:
    """(line number, key) of the lines that are long enough."""
    found = []
    for i, line in enumerate((text or b"").translate(_LOWER).split(b"\n")):
        key = line.strip(_BLANKS)
        if len(key) >= LEAST_CHARS and (key.isascii() or len(key.decode("utf-8", "replace")) >= LEAST_CHARS):
            found.append((i, key))
    return found


def _hashed(batch: pa.RecordBatch, shards: int) -> dict[str, np.ndarray]:
    """One entry per long line of the batch: its hash, shard, row and line number."""
    digests, rows, numbers = [], [], []
    for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
        for number, key in _keys(text):
            digests.append(xxhash.xxh3_128_digest(key))
            rows.append(row)
            numbers.append(number)
    halves = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return {
        "high": halves[:, 0],
        "low": halves[:, 1],
        "shard": (mixed(halves[:, 0]) % np.uint64(shards)).astype(np.int64),
        "row": np.array(rows, np.int64),
        "number": np.array(numbers, np.int64),
    }


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("id").cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _per_shard(shard: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Packed rows, one for each run of equal shards."""
    at = _starts(shard)
    ends = np.append(at[1:], len(shard))
    packed = {
        name: pa.array([values[a:b].tobytes() for a, b in zip(at, ends)], pa.binary())
        for name, values in columns.items()
    }
    return pa.RecordBatch.from_pydict({"shard": pa.array(shard[at], pa.int32())} | packed)


def _tell(shards: int):
    """What a batch knows about its distinct lines."""

    def run(batches):
        for batch in small_batches(batches, "text"):
            lines, ids = _hashed(batch, shards), _ids(batch)
            order = np.lexsort((lines["row"], lines["low"], lines["high"], lines["shard"]))
            shard, high, low, row = (lines[c][order] for c in ("shard", "high", "low", "row"))
            own = _starts(high, low, row)  # a line that a document repeats counts once
            shard, high, low, row = shard[own], high[own], low[own], row[own]
            at = _starts(high, low)
            count = np.diff(np.append(at, len(row)))
            last = np.maximum.reduceat(ids[row], at) if len(at) else np.empty(0, np.int64)
            yield _per_shard(
                shard[at],
                {"high": high[at], "low": low[at], "count": count.astype("<i8"), "last": last.astype("<i8")},
            )

    return run


def _joined(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


_INDEX = "shard int, sizes binary, bits binary, fingerprints binary, counts binary, slots binary, lasts binary"
_INDEX_TYPES = pa.schema([("shard", pa.int32())] + [(n, pa.binary()) for n in ("sizes", "bits", "fingerprints", "counts", "slots", "lasts")])


def _indexed(least_documents: int):
    def run(table: pa.Table) -> pa.Table:
        high, low = _joined(table, "high", "<u8"), _joined(table, "low", "<u8")
        count, last = _joined(table, "count", "<i8"), _joined(table, "last", "<i8")
        order = np.lexsort((low, high))
        high, low, count, last = high[order], low[order], count[order], last[order]
        at = _starts(high, low)
        count = np.add.reduceat(count, at) if len(at) else count
        last = np.maximum.reduceat(last, at) if len(at) else last
        high, low = high[at], low[at]
        hashed = PerfectHash.over(high, low)
        by_slot = np.empty(len(high), np.int64)
        by_slot[hashed.slots(high, low)] = np.arange(len(high))
        # the largest id matters only where the line repeats often enough
        often = np.flatnonzero(count[by_slot] >= least_documents)
        return pa.table(
            {
                "shard": [table.column("shard")[0].as_py()],
                "sizes": [hashed.sizes.astype("<i8").tobytes()],
                "bits": [hashed.words.tobytes()],
                "fingerprints": [(low[by_slot] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()],
                "counts": [np.minimum(count[by_slot], _COUNT_MOST).astype(np.uint8).tobytes()],
                "slots": [often.astype("<i8").tobytes()],
                "lasts": [last[by_slot][often].astype("<i8").tobytes()],
            },
            schema=_INDEX_TYPES,
        )

    return run


def _prepared(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))


def shards_for(df: DataFrame, text: str = "text") -> int:
    """Shards of an index over ``df``, in proportion to its bytes."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return max(LEAST_SHARDS, -(-size // SHARD_BYTES))


def line_index(
    df: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """One row per shard: the perfect hash of its lines, and its arrays. At most 255 ``least_documents``."""
    if not 0 < least_documents <= _COUNT_MOST:
        raise ValueError(f"least_documents must be between 1 and {_COUNT_MOST}")
    told = _prepared(df, doc_id, text).mapInArrow(_tell(shards), "shard int, high binary, low binary, count binary, last binary")
    return kept(told.groupBy("shard").applyInArrow(_indexed(least_documents), _INDEX))


def _ask(shards: int):
    """The lines of a batch as packed probes."""

    def run(batches):
        for batch in small_batches(batches, "text"):
            lines = _hashed(batch, shards)
            ids, hashes = _ids(batch), batch.column("hash").to_numpy(zero_copy_only=False)
            order = np.argsort(lines["shard"], kind="stable")
            row = lines["row"][order]
            yield _per_shard(
                lines["shard"][order],
                {
                    "high": lines["high"][order],
                    "low": lines["low"][order],
                    "id": ids[row].astype("<i8"),
                    "hash": hashes[row].astype("<i8"),
                    "number": lines["number"][order].astype("<i4"),
                },
            )

    return run


def _probed(least_documents: int):
    schema = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("number", pa.int32())])

    def run(asked: pa.Table, index: pa.Table) -> pa.Table:
        if not asked.num_rows or not index.num_rows:
            return schema.empty_table()
        array = {n: np.frombuffer(index.column(n)[0].as_py(), kind) for n, kind in
                 (("sizes", "<i8"), ("bits", np.uint8), ("fingerprints", "<u4"), ("counts", np.uint8), ("slots", "<i8"), ("lasts", "<i8"))}
        hashed = PerfectHash(array["sizes"], array["bits"])
        high, low = _joined(asked, "high", "<u8"), _joined(asked, "low", "<u8")
        slot = hashed.slots(high, low)
        known = slot >= 0
        known[known] = array["fingerprints"][slot[known]] == (low[known] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        known[known] = array["counts"][slot[known]] >= least_documents
        ids = _joined(asked, "id", "<i8")
        hit = np.flatnonzero(known)
        hit = hit[array["lasts"][np.searchsorted(array["slots"], slot[hit])] != ids[hit]]
        columns = (ids[hit], _joined(asked, "hash", "<i8")[hit], _joined(asked, "number", "<i4")[hit])
        return pa.table([pa.array(c) for c in columns], schema=schema)

    return run


def _without_lines(batches):
    """Texts without the lines that ``_dropped`` numbers."""
    for batch in small_batches(batches, "text"):
        texts, lines, dropped = [], [], []
        for text, numbers in zip(batch.column("text").to_pylist(), batch.column("_dropped").to_pylist()):
            own = (text or "").split("\n")
            gone = set(numbers or ())
            texts.append("\n".join(x for i, x in enumerate(own) if i not in gone) if gone else text)
            lines.append(len(own))
            dropped.append(len(gone))
        yield with_columns(
            batch.drop_columns(["_dropped"]),
            {"text": pa.array(texts, pa.string()), "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())},
        )


def dedup_lines(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """(``doc_id``, ``text``, n_lines, n_dropped): every text without the lines that many documents hold.

    A line's key is the line without ASCII blanks at both ends, A-Z in lower case. Lines whose key has 40
    code points or more and is in ``least_documents`` rows or more stay only in the largest id that holds
    them. Ids are integers. Each row is a document, repeated rows too; rows that share the largest id all
    keep the line, and a null id ranks below all others. A null or empty text is one empty line and stays
    null or empty; a text all of whose lines go becomes empty. Other columns are not read.
    """
    shards = shards_for(df, text)
    index = line_index(df, shards, doc_id, text, least_documents)
    rows = _prepared(df, doc_id, text).withColumn("hash", F.xxhash64("text"))
    asked = rows.mapInArrow(_ask(shards), "shard int, high binary, low binary, id binary, hash binary, number binary")
    hits = asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(
        _probed(least_documents), "id long, hash long, number int"
    )
    dropped = hits.groupBy(F.col("id").alias("_id"), F.col("hash").alias("_hash")).agg(F.collect_set("number").alias("_dropped"))
    same = (F.coalesce(rows["id"], F.lit(_NO_ID)) == F.col("_id")) & (rows["hash"] == F.col("_hash"))
    marked = rows.join(dropped, same, "left").select("id", "text", "_dropped")
    done = marked.mapInArrow(_without_lines, "id long, text string, n_lines long, n_dropped long")
    return done.select(F.col("id").alias(doc_id), F.col("text").alias(text), "n_lines", "n_dropped")
