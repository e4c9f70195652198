"""Ranked search for words by pipelined term partitioning.

The items of a stated query set are dealt into bundles. A scan of the documents writes, for each
segment of them, the postings of the items' terms. The terms are dealt to owners, the rarest first,
each with an equal share of all postings. A bundle visits a segment's owners one after another: each
stage cogroups the bundle's sparse accumulators with the owner's postings and adds whole-number
contributions. Behind the last owner each segment offers its best documents, and the best of all
segments are selected.

An accumulator leaves a bundle, or is not opened, only if the terms of the owners that are still to
come can't lift it to what ten documents of its segment have already: the result is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.common import kept, small_batches
from tidelake.operators.skew import top_per_group

#: Bytes of item texts whose terms are broadcast at a time; a larger query set takes several scans.
BLOCK_BYTES = 16 << 20
#: Items of a bundle and documents of a segment: a bundle has at most their product of accumulators.
BUNDLE_ITEMS = 512
SEGMENT_DOCUMENTS = 4096
#: Owners of terms, and so stages.
OWNERS = 4
#: No contribution divided by the term's weight reaches this.
_MOST = 1_000_000

_FOLD = bytes(
    b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def terms(text: str | bytes | None) -> list[bytes]:
    """Runs of letters, digits and whatever is not ASCII; A-Z in lower case."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(_FOLD).split()


class Block:
    """Items whose terms fit a broadcast."""

    def __init__(self, texts: list[str | None]):
        counted = [Counter(terms(t)) for t in texts]
        self.words = {t: i for i, t in enumerate(sorted({t for c in counted for t in c}))}
        self.items = [sorted((self.words[t], n) for t, n in c.items()) for c in counted]
        self.bundles = max(1, -(-len(self.items) // BUNDLE_ITEMS))

    def bundle(self, b: int) -> list[list[tuple[int, int]]]:
        return self.items[b * BUNDLE_ITEMS : (b + 1) * BUNDLE_ITEMS]


def _postings(words):
    """For each segment: ids and lengths of its documents, and (term, document, occurrences) sorted by term."""

    def run(batches):
        known = words.value
        number = 0
        for big in small_batches(batches, "text"):
            for start in range(0, big.num_rows, SEGMENT_DOCUMENTS):
                batch = big.slice(start, SEGMENT_DOCUMENTS)
                lengths = np.zeros(batch.num_rows, np.int64)
                found = []
                for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                    own = terms(text)
                    lengths[row] = len(own)
                    ids = np.fromiter(map(known.get, own, repeat(-1)), np.int64, len(own))
                    found.append((ids[ids >= 0] << 32) | row)
                pair, count = np.unique(np.concatenate([*found, np.empty(0, np.int64)]), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": pa.array([TaskContext.get().partitionId() << 32 | number], pa.int64()),
                        "ids": pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("id")),
                        "lengths": pa.array([lengths.astype("<i8").tobytes()], pa.binary()),
                        "term": pa.array([(pair >> 32).astype("<i4").tobytes()], pa.binary()),
                        "doc": pa.array([(pair & 0xFFFFFFFF).astype("<i4").tobytes()], pa.binary()),
                        "tf": pa.array([count.astype("<i8").tobytes()], pa.binary()),
                    }
                )
                number += 1

    return run


def _document_counts(size: int):
    """How many documents of the task's segments hold each term."""

    def run(batches):
        held = np.zeros(size, np.int64)
        for batch in batches:
            for term in batch.column("term").to_pylist():
                held += np.bincount(np.frombuffer(term, "<i4"), minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"term": pa.array(some, pa.int64()), "df": pa.array(held[some], pa.int64())})

    return run


def _lengths(batches):
    """Documents with a term, and all their terms, for each segment."""
    for batch in batches:
        own = [np.frombuffer(x, "<i8") for x in batch.column("lengths").to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {
                "n": pa.array([int((x > 0).sum()) for x in own], pa.int64()),
                "l": pa.array([int(x.sum()) for x in own], pa.int64()),
            }
        )


def _owners(df: np.ndarray, owners: int) -> np.ndarray:
    """The owner of each term: rare terms first, equal shares of the postings."""
    order = np.argsort(df, kind="stable")
    upto = np.cumsum(df[order])
    owner = np.empty(len(df), np.int64)
    owner[order] = np.minimum((upto - df[order]) * owners // max(1, upto[-1] if len(upto) else 1), owners - 1)
    return owner


class Plan:
    """What every stage knows: weights, owners and, per stage and item, what later owners can add."""

    def __init__(self, block: Block, df: np.ndarray, documents: int, length: int, owners: int, k: int):
        self.documents, self.length, self.k = documents, length, k
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        self.owner = _owners(df, owners)
        self.bundles = [block.bundle(b) for b in range(block.bundles)]
        self.owners = owners

    def needed(self, bundle: int, owner: int) -> list[list[tuple[int, int]]]:
        """(term, weight times repeats) of each item of a bundle that the owner holds."""
        return [[(t, int(self.weight[t]) * n) for t, n in item if self.owner[t] == owner] for item in self.bundles[bundle]]

    def rest(self, bundle: int, owner: int) -> list[int]:
        """The most that this owner and later ones can add to each item's scores."""
        return [sum(int(self.weight[t]) * n * _MOST for t, n in item if self.owner[t] >= owner) for item in self.bundles[bundle]]


def _opened(bundles: int):
    """Each bundle without accumulators, for each segment."""

    def run(batches):
        for batch in batches:
            for b in range(bundles):
                rows = batch.num_rows
                empty = pa.array([b""] * rows, pa.binary())
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": batch.column("segment"),
                        "bundle": pa.array([b] * rows, pa.int32()),
                        "ids": batch.column("ids"),
                        "item": empty,
                        "doc": empty,
                        "score": empty,
                        "least": empty,
                    }
                )

    return run


def _owned(plan, owner: int):
    """An owner's postings for each bundle, with the contribution of an occurrence count at weight 1."""

    def run(batches):
        own = plan.value
        wanted = []
        for bundle in own.bundles:
            mask = np.zeros(len(own.owner), bool)
            mask[[t for item in bundle for t, _ in item if own.owner[t] == owner]] = True
            wanted.append(mask)
        for batch in batches:
            for i in range(batch.num_rows):
                term, doc, tf, lengths = (
                    np.frombuffer(batch.column(c)[i].as_py(), kind).astype(np.int64)
                    for c, kind in (("term", "<i4"), ("doc", "<i4"), ("tf", "<i8"), ("lengths", "<i8"))
                )
                m = 100 - 75 + (75 * lengths[doc] * own.documents) // max(1, own.length)
                part = (1_000_000_000 * tf) // (1000 * tf + 8 * m)
                masks = [mask[term] for mask in wanted]
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": pa.array([batch.column("segment")[i].as_py()] * len(masks), pa.int64()),
                        "bundle": pa.array(range(len(masks)), pa.int32()),
                        "term": pa.array([term[x].astype("<i4").tobytes() for x in masks], pa.binary()),
                        "doc": pa.array([doc[x].astype("<i4").tobytes() for x in masks], pa.binary()),
                        "part": pa.array([part[x].astype("<i8").tobytes() for x in masks], pa.binary()),
                    }
                )

    return run


def _visit(plan, owner: int, kind: pa.DataType):
    """One stage: a bundle's accumulators meet an owner's postings."""
    schema = pa.schema(
        [("segment", pa.int64()), ("bundle", pa.int32()), ("ids", pa.list_(kind)), ("item", pa.binary()), ("doc", pa.binary()), ("score", pa.binary()), ("least", pa.binary())]
    )

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        own = plan.value
        number = bundles.column("bundle")[0].as_py()
        documents = len(bundles.column("ids")[0])
        item, doc, score, least = (
            np.frombuffer(bundles.column(c)[0].as_py(), "<i4" if c in ("item", "doc") else "<i8")
            for c in ("item", "doc", "score", "least")
        )
        term, at, part = (
            np.frombuffer(b"".join(postings.column(c).to_pylist()), "<i8" if c == "part" else "<i4")
            for c in ("term", "doc", "part")
        )
        term = term.astype(np.int64)
        now, later = own.rest(number, owner), own.rest(number, owner + 1)
        ends = np.cumsum(np.bincount(item, minlength=len(now))) if len(now) else []
        new, lows = [], np.zeros(len(now), np.int64)
        lows[: len(least)] = least
        for i, wanted in enumerate(own.needed(number, owner)):
            a, b = (ends[i - 1] if i else 0), ends[i]
            dense = np.zeros(documents, np.int64)
            dense[doc[a:b]] = score[a:b]
            seen = None
            if lows[i] > now[i]:  # a document without an accumulator can't rise among the best any more
                seen = np.zeros(documents, bool)
                seen[doc[a:b]] = True
            asked = np.array([t for t, _ in wanted], np.int64)
            los, his = np.searchsorted(term, asked).tolist(), np.searchsorted(term, asked, side="right").tolist()
            for (_, weight), lo, hi in zip(wanted, los, his):
                dense[at[lo:hi]] += weight * part[lo:hi]  # a document is there once for a term
            if seen is not None:
                dense[~seen] = 0
            open_ = np.flatnonzero(dense)
            if len(open_) >= own.k:
                lows[i] = max(lows[i], np.partition(dense[open_], -own.k)[-own.k])
            open_ = open_[dense[open_] + later[i] >= lows[i]]
            new.append((np.full(len(open_), i, np.int32), open_.astype(np.int32), dense[open_]))
        item, doc, score = (np.concatenate([x[c] for x in new] + [np.empty(0, np.int64)]) for c in range(3))
        return pa.table(
            {
                "segment": bundles.column("segment"),
                "bundle": bundles.column("bundle"),
                "ids": bundles.column("ids"),
                "item": [item.astype("<i4").tobytes()],
                "doc": [doc.astype("<i4").tobytes()],
                "score": [score.astype("<i8").tobytes()],
                "least": [lows.astype("<i8").tobytes()],
            },
            schema=schema,
        )

    return run


def _offered(kind: pa.DataType, k: int):
    """The best documents of each segment for each item; more than ``k`` where scores are equal."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                item, doc, score = (
                    np.frombuffer(batch.column(c)[i].as_py(), "<i8" if c == "score" else "<i4") for c in ("item", "doc", "score")
                )
                order = np.lexsort((-score, item))
                item, doc, score = item[order], doc[order], score[order]
                first = np.searchsorted(item, item)
                place = np.arange(len(item)) - first
                last = np.minimum(first + k - 1, np.searchsorted(item, item, side="right") - 1)
                best = (place < k) | (score == score[last])
                ids = batch.column("ids")[i].values
                yield pa.RecordBatch.from_pydict(
                    {
                        "item": pa.array(item[best].astype(np.int64) + batch.column("bundle")[i].as_py() * BUNDLE_ITEMS, pa.int64()),
                        "id": ids.take(pa.array(doc[best].astype(np.int64))).cast(kind),
                        "score": pa.array(score[best].astype(np.int64), pa.int64()),
                    }
                )

    return run


def _search_block(docs: DataFrame, items: list, item_field, owners: int, k: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    spark, context = docs.sparkSession, docs.sparkSession.sparkContext
    kind, arrow = docs.schema["id"].dataType.simpleString(), to_arrow_type(docs.schema["id"].dataType)
    block = Block([r["text"] for r in items])
    stored = kept(
        docs.mapInArrow(
            _postings(context.broadcast(block.words)),
            f"segment long, ids array<{kind}>, lengths binary, term binary, doc binary, tf binary",
        )
    )
    documents, length = stored.select("lengths").mapInArrow(_lengths, "n long, l long").agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("l"), F.lit(0))
    ).first()
    held = np.zeros(len(block.words), np.int64)
    counted = stored.select("term").mapInArrow(_document_counts(len(held)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in counted.collect():  # at most the terms of the block
        held[row["term"]] = row["df"]
    plan = context.broadcast(Plan(block, held, documents, length, owners, k))
    columns = f"segment long, bundle int, ids array<{kind}>, item binary, doc binary, score binary, least binary"
    bundles = stored.select("segment", "ids").mapInArrow(_opened(block.bundles), columns)
    for owner in range(owners):
        postings = stored.select("segment", "lengths", "term", "doc", "tf").mapInArrow(
            _owned(plan, owner), "segment long, bundle int, term binary, doc binary, part binary"
        )
        bundles = bundles.groupBy("segment", "bundle").cogroup(postings.groupBy("segment", "bundle")).applyInArrow(
            _visit(plan, owner, arrow), columns
        )
    offers = bundles.select("bundle", "ids", "item", "doc", "score").mapInArrow(_offered(arrow, k), f"item long, id {kind}, score long")
    best = top_per_group(
        offers.withColumns({"down": -F.col("score"), "none": F.col("id").isNull()}), ["item"], ["down", "none", "id"], k
    )
    from pyspark.sql.types import LongType, StructField, StructType

    names = spark.createDataFrame(
        [(i, r["item_id"]) for i, r in enumerate(items)], StructType([StructField("item", LongType()), StructField("item_id", item_field)])
    )
    return best.join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, owners: int = OWNERS,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents that score highest for each item, above 0.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), N the documents with a term; a document of
    n terms gets, for an item's term that it holds tf times, the weight times
    10^9 tf div (1000 tf + 8 m), m = 25 + 75 n N div (all terms), repeats in the item counted. Equal
    scores go by ascending id, null ids last. Every row of ``docs`` is a document, repeated rows and
    shared ids too. A null or empty text has no terms; such documents are not counted in N, such items
    have no rows. Rows of ``items`` that agree in id and text are one item; if texts differ, each is
    ranked by itself under the shared id. Empty tables give no rows. Other columns are not read.
    """
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = None
    for block in range(blocks):
        own = dealt.filter(F.col("block") == block).select("item_id", "text").collect()  # BLOCK_BYTES, about
        part = _search_block(rows, own, asked.schema["item_id"].dataType, owners, k)
        found = part if found is None else found.unionByName(part)
    return found
