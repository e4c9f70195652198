"""Table sinks: append, replace by partition, ledgers, streaming append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidelake.schema import misfits


def append(df: DataFrame, path: str, files: int | None = None) -> None:
    """Append as Parquet; ``files`` bounds the number of files for a small ledger."""
    (df if files is None else df.coalesce(files)).write.mode("append").parquet(path)


def append_checked(df: DataFrame, path: str, expected: StructType) -> None:
    """Append to a table with a declared schema; whatever would be lost or break it is an error.

    Narrower numbers are widened, and optional columns that the rows lack are null.
    """
    found = misfits(expected, df.schema)
    if found:
        raise ValueError(f"rows do not fit the table: {found}")
    fitted = [
        F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in expected
    ]
    append(df.select(*fitted), path)


def replace_by_source(
    df: DataFrame, path: str, key: str | list[str], compression: str = "snappy"
) -> None:
    """Write the partitions that ``df`` has and leave the others alone.

    Writing a batch again replaces it, so a replayed batch leaves no copies.
    """
    keys = [key] if isinstance(key, str) else key
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*keys)
        .parquet(path)
    )


def record_files(
    counts: DataFrame, batch: Column, as_of: Column, ledger: str, files: int | None = None
) -> None:
    """Write a batch's rows of the file ledger; the batch is a partition, so a replay replaces it.

    ``files=1`` suits the few rows of one micro-batch.
    """
    rows = counts.select(
        F.col("source_file").alias("file_path"),
        as_of.alias("processed_at"),
        F.col("n").alias("records_processed"),
        batch.alias("batch_id"),
    )
    replace_by_source(rows if files is None else rows.coalesce(files), ledger, "batch_id")


def record_exports(written: DataFrame, batch: Column, as_of: Column, ledger: str) -> None:
    """Write a batch's rows of the export ledger. ``batch`` must name one run only."""
    rows = written.select(
        F.col("content_hash").alias("file_hash"),
        "local_path",
        "source_file",
        as_of.alias("downloaded_at"),
        "image_size",
        batch.alias("batch_id"),
    )
    replace_by_source(rows, ledger, "batch_id")


def persist_raw(
    df: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    trigger: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append a stream to a table; ``available_now`` takes what is there and ends.

    ``fmt="avro"`` needs Spark's Avro package on the class path.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
