"""Token counts by a map-side lookup in two tiers.

The frequent pre-tokens of the corpus and their lengths are one broadcast table of bounded size;
whatever it lacks is encoded by the library once per worker and kept in the worker's cache. No
pre-token is shuffled: the table comes from a bounded summary that every task makes of its words.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.common import schema_with, small_batches, texts_of, with_columns
from tidelake.llm.pretokens import Pieces, library, split

#: Entries of the broadcast table, and characters of its longest key: 2 MB at most.
FREQUENT = 32_768
LONGEST_KEY = 32
#: Words that a task keeps while it counts, and those that it hands on.
SUMMARY_ENTRIES = 200_000
SUMMARY_SENT = 8_192


def _summaries(column: str):
    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in texts_of(batch, column):
                counts.update(text.split(" "))
                if len(counts) > SUMMARY_ENTRIES:
                    counts = Counter(dict(counts.most_common(SUMMARY_ENTRIES // 4)))
        top = [(w, n) for w, n in counts.most_common(SUMMARY_SENT) if 0 < len(w) < LONGEST_KEY]
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array([w for w, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())}
        )

    return run


def frequent_lengths(df: DataFrame, path: str, text: str = "text", size: int = FREQUENT) -> dict[str, int]:
    """Lengths of at most ``size`` frequent pre-tokens, from summaries over every text of ``df``.

    Which pre-tokens it holds decides the speed only; a length is always the library's.
    """
    words = (
        df.select(text)
        .mapInArrow(_summaries(text), "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(size)
        .collect()
    )
    seen: Counter = Counter()
    for row in words:
        for token in split(" " + row["word"]):
            seen[token] += row["n"]
    encode = library(path).whole
    return {token: len(encode(token)) for token, _ in seen.most_common(size)}


_caches: dict[tuple, Pieces] = {}


def _lengths(path: str, table: Broadcast, name: str) -> Pieces:
    key = (path, name)
    if key not in _caches:
        _caches.clear()
        encode = library(path).token
        _caches[key] = Pieces(lambda token: len(encode(token)), sum, table.value)
    return _caches[key]


def token_counts(
    df: DataFrame, path: str, limit: int, text: str = "text", table: dict[str, int] | None = None
) -> DataFrame:
    """``df`` without its text, with ``n_tokens long`` and ``over_limit boolean`` (more than ``limit``).

    Exactly the library's count without added special tokens; a special string inside a text is one
    token, as the library has it. A null or empty text has 0 tokens. Rows are kept as they are,
    repeated ones too; columns that bear one of the new names are replaced. An empty table gives none.
    """
    if table is None:
        table = frequent_lengths(df, path, text)
    shared = df.sparkSession.sparkContext.broadcast(table)
    schema, name = schema_with(df.drop(text), n_tokens="long"), uuid.uuid4().hex

    def run(batches):
        lengths, lib = _lengths(path, shared, name), library(path)
        for batch in small_batches(batches, text):
            counts = [
                lengths.of(t) if lib.splits(t) else len(lib.whole(t))
                for t in texts_of(batch, text)
            ]
            yield with_columns(batch, {"n_tokens": pa.array(counts, pa.int64())}).select(schema.names)

    counted = df.mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
