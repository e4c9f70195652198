"""Helpers that several text operators share."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidelake.session import scratch

#: Bytes of text that one step of a Python task holds at a time.
SLICE_BYTES = 8 << 20


#: Bytes of one Arrow batch between Spark and a Python worker; Spark counts rows by default.
BATCH_BYTES = 8 << 20
_BATCH_OPTION = "spark.sql.execution.arrow.maxBytesPerBatch"


_caches: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What a Python worker remembers for ``owner`` from task to task.

    Workers are reused: when another operator's task begins, what the one before remembered goes, and
    its memory goes back to the system.
    """
    if any([_caches.pop(name) for name in list(_caches) if name != owner]):
        give_back()
    return _caches.setdefault(owner, {})


def give_back() -> None:
    """Return the memory that a worker has freed to the system, at the end of a task's work."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def bound_batches(spark: SparkSession) -> None:
    """Let no Arrow batch of the session exceed ``BATCH_BYTES``, unless one row does."""
    number, unit = re.match(r"(\d+)\s*([kmg]?)", spark.conf.get(_BATCH_OPTION).lower()).groups()
    if int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] > BATCH_BYTES:
        spark.conf.set(_BATCH_OPTION, BATCH_BYTES)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """The strings of a column; a null text counts as empty."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], name: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, or one row if that is larger."""
    for batch in batches:
        count = max(1, batch.num_rows)
        rows = max(1, size // max(1, batch.column(name).nbytes // count))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` with columns added, or replaced where the name is taken."""
    kept = {n: batch.column(n) for n in batch.schema.names if n not in new}
    return pa.RecordBatch.from_pydict(kept | new)


def schema_with(df: DataFrame, **new: str) -> StructType:
    """The schema that ``with_columns`` gives."""
    added = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in new.items()))
    return StructType([f for f in df.schema.fields if f.name not in new] + added.fields)


def utf8_bytes(text: str | Column) -> Column:
    """UTF-8 length; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read from there, without compression.

    For steps that are many and small: a codec takes buffers outside the heap for every file and
    column, and these pile up in an executor until its next full collection.
    """
    path = scratch(df.sparkSession, "step")
    df.write.option("compression", "none").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
