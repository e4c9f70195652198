"""Which contents are known: a ledger of digests laid out by prefix, with a Bloom filter per prefix.

New digests meet the filters first. Only those that a filter may hold are looked up, and only in the
folders of their prefixes; there the few digests that are looked for are broadcast, so that the ledger
itself is never shuffled, however long it has grown.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.session import stored
from tidelake.sinks.tables import replace_by_source

#: Leading characters of a digest that name its folder: 16 folders a batch, or 256 with two. A ledger keeps
#: the number that it began with.
PREFIX = 1
#: Bits and probes per digest in a filter: about one foreign digest in a hundred passes.
FILTER_BITS = 10
PROBES = 5
#: Digests that are looked up at a time; each costs some 100 bytes in a broadcast.
LOOKED_UP = 500_000

_DIGESTS = "prefix string, batch_id string, digest string"
_FILTERS = "prefix string, batch_id string, bits binary"


def _places(digests: list[str], size: int) -> np.ndarray:
    """Bits of each digest, from 64 of its own bits by double hashing."""
    numbers = np.array([int(d[-16:], 16) for d in digests], np.uint64)
    step = (numbers >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((numbers + turns * step) % np.uint64(size)).astype(np.int64)


def _filter(table: pa.Table) -> pa.Table:
    digests = table.column("digest").to_pylist()
    size = max(64, -(-FILTER_BITS * len(digests) // 64) * 64)
    bits = np.zeros(size, bool)
    bits[_places(digests, size)] = True
    return pa.table(
        {
            "prefix": table.column("prefix")[:1],
            "batch_id": table.column("batch_id")[:1],
            "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
        }
    )


def _probed(new: pa.Table, filters: pa.Table) -> pa.Table:
    digests = new.column("digest").to_pylist()
    passed = np.zeros(len(digests), bool)
    for bits in filters.column("bits").to_pylist() if digests else ():
        held = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        passed |= held[_places(digests, len(held))].all(axis=0)
    return new.append_column("maybe", pa.array(passed))


def _read(spark: SparkSession, path: str, columns: str) -> DataFrame:
    try:
        return spark.read.schema(columns).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], columns)


def remember(digests: DataFrame, path: str, batch: str, digest: str = "content_hash", prefix: int = PREFIX) -> None:
    """Add a batch of hex digests; the same batch written again replaces itself. Nulls are left out.

    Filters are written after the digests they stand for, so whoever reads between the two may take a
    known content for a new one, but never the other way round.
    """
    spark = digests.sparkSession
    rows = stored(
        digests.select(
            F.substring(digest, 1, prefix).alias("prefix"), F.lit(batch).alias("batch_id"), F.col(digest).alias("digest")
        ).filter("digest is not null").distinct()
    )
    replace_by_source(rows.repartition("prefix"), f"{path}/digests", ["prefix", "batch_id"])
    filters = rows.groupBy("prefix", "batch_id").applyInArrow(_filter, _FILTERS)
    replace_by_source(filters, f"{path}/filters", ["prefix", "batch_id"])


def unseen(df: DataFrame, path: str, digest: str = "content_hash", prefix: int = PREFIX) -> DataFrame:
    """Rows of ``df`` whose digest the ledger doesn't hold; a row without a digest is never held.

    Exact: what passes a filter is looked up. Repeated rows are kept.
    """
    spark = df.sparkSession
    new = df.select(F.substring(digest, 1, prefix).alias("prefix"), F.col(digest).alias("digest")).filter("digest is not null").distinct()
    filters = _read(spark, f"{path}/filters", _FILTERS).select("prefix", "bits")
    tried = stored(
        new.groupBy("prefix").cogroup(filters.groupBy("prefix")).applyInArrow(_probed, "prefix string, digest string, maybe boolean").filter("maybe")
    )
    sizes = tried.groupBy("prefix").count().orderBy("prefix").collect()  # at most as many as there are prefixes
    known = None
    ledger = _read(spark, f"{path}/digests", _DIGESTS)
    for group in _groups([(r["prefix"], r["count"]) for r in sizes]):
        own = F.col("prefix").isin(group)
        asked = F.broadcast(tried.filter(own).select(F.col("digest").alias("asked")))
        found = ledger.filter(own).join(asked, F.col("digest") == F.col("asked"), "left_semi").select("digest")
        known = found if known is None else known.unionByName(found)
    if known is None:
        return df
    return df.join(stored(known.distinct()).withColumnRenamed("digest", "_known"), F.col(digest) == F.col("_known"), "left_anti")


def _groups(sizes: list[tuple[str, int]]) -> list[list[str]]:
    """Prefixes whose digests are looked up together."""
    groups, room = [], 0
    for prefix, size in sizes:
        if size > room or not groups:
            groups.append([])
            room = LOOKED_UP
        groups[-1].append(prefix)
        room -= size
    return groups
