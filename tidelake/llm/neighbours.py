"""Approximate nearest neighbours: one small-world graph per shard, and the shards' results merged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.llm import hnsw
from tidelake.session import stored

#: Distinct vectors per graph, about, and queries that walk a graph in one go.
SHARD_ROWS = 4096
#: Distinct vectors per graph where the data is larger than the cores can share at that size.
LARGEST_SHARD = 1_000_000
QUERY_ROWS = 1024


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part: all components finite, not all zero."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(finite & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component near 1.

    That is exact and leaves cosines alone, but squares neither overflow nor vanish.
    """
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1, keepdims=True))[1])


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def _build(table: pa.Table) -> pa.Table:
    """The index of one shard as one row."""
    ids = table.column("ids").to_pylist()
    vectors = _matrix(table.column("v"))
    order = np.argsort([i[0] for i in ids], kind="stable")
    vectors = np.ascontiguousarray(vectors[order])
    graph = hnsw.build(_unit(vectors))
    ids = [ids[i] for i in order]
    return pa.table(
        {
            "dim": table.column("dim")[:1],
            "shard": table.column("shard")[:1],
            "ids": pa.array([[x for own in ids for x in own]], pa.list_(pa.int64())),
            "copies": pa.array([[len(own) for own in ids]], pa.list_(pa.int32())),
            "vectors": pa.array([vectors.astype("<f8").tobytes()], pa.binary()),
            "layers": pa.array([[g.astype("<i4").tobytes() for g in graph.layers]], pa.list_(pa.binary())),
            "entry": pa.array([graph.entry], pa.int32()),
        }
    )


def build_index(df: DataFrame, key: str, vector: str, copies: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: ids, vectors and the flat neighbour arrays of its graph; stored.

    Every usable row is indexed. Equal vectors are one node with its ``copies`` smallest ids; further
    copies can't be among that many nearest. Vectors of different length are in different shards.
    """
    rows = _usable(df, key, vector)
    # Spark drops the ranks beyond the limit before the shuffle, so a vector on very many rows is cheap
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    nodes = stored(
        rows.distinct().withColumn("rank", rank).filter(F.col("rank") <= copies)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    size = nodes.count()
    # shards grow with the data, so that their number stays near that of the cores
    cores = 2 * df.sparkSession.sparkContext.defaultParallelism
    shards = max(1, min(-(-size // shard_rows), max(cores, -(-size // LARGEST_SHARD))))
    return stored(
        nodes.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), "ids", "v")
        .groupBy("dim", "shard")
        .applyInArrow(
            _build,
            "dim int, shard int, ids array<long>, copies array<int>, vectors binary, layers array<binary>, entry int",
        )
    )


def _search(k: int, ef: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                vectors = _scaled(np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dim"]))
                degree = [hnsw.DEGREE * (2 if i == 0 else 1) for i in range(len(row["layers"]))]
                layers = [np.frombuffer(g, "<i4").reshape(-1, d) for g, d in zip(row["layers"], degree)]
                queries = _scaled(np.array(row["queries"], float).reshape(-1, row["dim"]))
                found, _ = hnsw.Graph(layers, row["entry"]).search(_unit(vectors), _unit(queries), ef)
                norms, own = np.sqrt((vectors * vectors).sum(1)), np.sqrt((queries * queries).sum(1))
                ends = np.cumsum(row["copies"])
                firsts = ends - row["copies"]
                ids = np.array(row["ids"])
                out = []
                for q, query, size, nodes in zip(row["query_ids"], queries, own, found):
                    nodes = nodes[nodes >= 0]
                    scores = (vectors[nodes] * query).sum(1) / (norms[nodes] * size)
                    best = np.lexsort((ids[firsts[nodes]], -scores))[: k + 1]
                    hits = [(-float(scores[b]), int(i)) for b in best for i in ids[firsts[nodes[b]] : ends[nodes[b]]] if i != q]
                    out += [(q, i, -s) for s, i in sorted(hits)[:k]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array([o[0] for o in out], pa.int64()),
                        "vec_id": pa.array([o[1] for o in out], pa.int64()),
                        "score": pa.array([o[2] for o in out], pa.float64()),
                    }
                )

    return run


def nearest(
    df: DataFrame,
    queries: Column,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    ef: int = hnsw.EF_SEARCH,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row that ``queries`` selects.

    Nearness is the cosine of the original vectors in double precision; ties go to the smaller id,
    and a query is not its own candidate. Rows whose id or vector is null, or whose vector is empty,
    zero, or has a null or non-finite component, take no part; vectors meet only vectors of their
    length. Rows that repeat an id and a vector count once. With fewer candidates all are given; an
    empty table gives no rows. Other columns are not read.
    """
    index = build_index(df, key, vector, k + 1, shard_rows)
    asked = _usable(df.filter(queries), key, vector).distinct()
    chunks = max(1, -(-asked.count() // QUERY_ROWS))
    packed = (
        asked.groupBy(F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(chunks)).alias("chunk"))
        .agg(F.collect_list(F.struct("id", "v")).alias("q"))
        .select("dim", F.col("q.id").alias("query_ids"), F.flatten("q.v").alias("queries"))
    )
    # every block of queries visits every shard
    sent = packed.join(index.select("dim", "shard"), "dim")
    found = sent.join(index, ["dim", "shard"]).mapInArrow(_search(k, ef), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
