"""Token ids in compressed binary files, and back.

A file holds whole documents in order: a frequency table that all its blocks share, the documents'
ids and lengths, a checkpoint for every block (first token, place, lane states, checksum), and the
words of the blocks. A block can be decoded without any other. Files travel as rows of a Parquet
dataset, so that any store Spark writes to will do and a lost task is written anew.
"""

from __future__ import annotations

import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidelake.llm import rans
from tidelake.llm.common import small_batches, texts_of
from tidelake.llm.pretokens import Pieces, library

#: A file is closed after the document that brings it to so many tokens.
FILE_TOKENS = 2_000_000
#: Words that a worker remembers in each generation.
WORD_ENTRIES = 600_000

_MAGIC = b"TLRANS1\0"
_HEAD = struct.Struct("<8sQQII")
_BLOCK = np.dtype([("first", "<u8"), ("size", "<u4"), ("crc", "<u4"), ("place", "<u8"), ("words", "<u4"), ("states", "<u8", (rans.LANES,))])


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One file: header, table, documents, checkpoints, words, and a checksum of all before the words."""
    found, freq = rans.table(ids)
    states, words = rans.encode(ids, found, freq)
    index = np.zeros(len(words), _BLOCK)
    index["first"] = np.arange(len(words)) * rans.BLOCK
    index["size"] = np.minimum(rans.BLOCK, len(ids) - index["first"].astype(np.int64))
    index["crc"] = [_crc(ids[a : a + rans.BLOCK]) for a in range(0, len(ids), rans.BLOCK)]
    index["words"] = [len(w) for w in words]
    index["place"] = np.cumsum(index["words"], dtype=np.uint64) - index["words"]
    index["states"] = states
    front = b"".join(
        (
            _HEAD.pack(_MAGIC, len(doc_ids), len(ids), len(found), len(words)),
            found.astype("<u4").tobytes(),
            freq.astype("<u4").tobytes(),
            np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes(),
            bytes(i is not None for i in doc_ids),
            np.array(lengths, "<u8").tobytes(),
            index.tobytes(),
        )
    )
    return b"".join((front, struct.pack("<I", zlib.crc32(front)), *words))


class File:
    """The front of a file; tokens are decoded on demand."""

    def __init__(self, content: bytes):
        magic, docs, self.tokens, symbols, blocks = _HEAD.unpack_from(content)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        self._content, self._at = content, _HEAD.size

        def take(kind, count):
            found = np.frombuffer(content, kind, count, self._at)
            self._at += found.nbytes
            return found

        self.found, self.freq = take("<u4", symbols), take("<u4", symbols)
        keys, valid = take("<i8", docs), take("u1", docs)
        self.doc_ids = [k if v else None for k, v in zip(keys.tolist(), valid.tolist())]
        self.lengths, self.index = take("<u8", docs).astype(np.int64), take(_BLOCK, blocks)
        if struct.unpack_from("<I", content, self._at)[0] != zlib.crc32(content[: self._at]):
            raise ValueError("the front of a token file is damaged")
        self._at += 4

    def blocks(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Tokens of blocks ``first`` to ``last`` (not included), each held against its checksum."""
        index = self.index[first:last]
        words = [
            self._content[self._at + int(b["place"]) : self._at + int(b["place"]) + int(b["words"])] for b in index
        ]
        ids = rans.decode(index["size"].astype(np.int64), index["states"], words, self.found, self.freq)
        ends = np.cumsum(index["size"], dtype=np.int64)
        for block, a, b in zip(index, np.append(0, ends[:-1]), ends):
            if _crc(ids[a:b]) != block["crc"]:
                raise ValueError(f"the block at token {block['first']} is damaged")
        return ids


_encoders: dict[str, Pieces] = {}


def _encoder(path: str) -> Pieces:
    if path not in _encoders:
        lib = library(path)
        token = lib.token
        _encoders[path] = Pieces(lambda t: array("I", token(t)).tobytes(), b"".join, words=WORD_ENTRIES, many=lib.words)
    return _encoders[path]


def write(df: DataFrame, out: str, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write files in ascending order of ``doc_id``.

    ``doc_id`` must be an integer. Null ids come first; rows with equal ids follow a hash of their text,
    so that one id on very many rows is still spread. A null or empty text is the end id alone. An
    empty table writes no file.
    """

    def run(batches):
        lib, pieces = library(path), _encoder(path)
        ending, part, count = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), 0
        keys, lengths, ids = [], [], []

        def close():
            nonlocal keys, lengths, ids, count
            flat = np.frombuffer(b"".join(ids), "<u4")
            row = {
                "file": pa.array([part << 32 | count], pa.int64()),
                "n_tokens": pa.array([len(flat)], pa.int64()),
                "content": pa.array([pack(keys, lengths, flat)], pa.binary()),
            }
            keys, lengths, ids, count = [], [], [], count + 1
            return pa.RecordBatch.from_pydict(row)

        held = 0
        for batch in small_batches(batches, "t"):
            texts = texts_of(batch, "t")
            apart = [lib.splits(t) for t in texts]
            coded = iter(pieces.all([t for t, yes in zip(texts, apart) if yes]))
            for key, t, yes in zip(batch.column("k").to_pylist(), texts, apart):
                found = next(coded) if yes else np.array(lib.whole(t), "<u4").tobytes()
                keys.append(key)
                lengths.append(len(found) // 4 + 1)
                ids += (found, ending)
                held += lengths[-1]
                if held >= FILE_TOKENS:
                    yield close()
                    held = 0
        if keys:
            yield close()

    rows = df.select(F.col(doc_id).cast("long").alias("k"), F.col(text).alias("t")).withColumn("h", F.xxhash64("t"))
    ordered = rows.repartitionByRange("k", "h").sortWithinPartitions("k", "h").select("k", "t")
    ordered.mapInArrow(run, "file long, n_tokens long, content binary").write.parquet(out)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, file, first, n_tokens, ids) per document; ids as little-endian unsigned 32-bit integers.

    ``first`` counts the ids before the document in its file. A damaged file raises.
    """

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                file = File(content.as_py())
                raw = file.blocks().astype("<u4").tobytes()
                ends = np.cumsum(file.lengths)
                firsts = ends - file.lengths
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(file.doc_ids, pa.int64()),
                        "file": pa.array([name] * len(ends), pa.int64()),
                        "first": pa.array(firsts, pa.int64()),
                        "n_tokens": pa.array(file.lengths, pa.int64()),
                        "ids": pa.array([raw[4 * a : 4 * b] for a, b in zip(firsts.tolist(), ends.tolist())], pa.binary()),
                    }
                )

    files = spark.read.schema("file long, n_tokens long, content binary").parquet(path).select("file", "content")
    return files.mapInArrow(run, "doc_id long, file long, first long, n_tokens long, ids binary")


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """(file, file_start): ids of all files before, from one small row per file."""
    files = spark.read.schema("file long, n_tokens long, content binary").parquet(path).select("file", "n_tokens")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("file_start"))
