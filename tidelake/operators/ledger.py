"""Incremental reading: what is new, what is a copy, what has been exported already."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.functions.content import export_name
from tidelake.operators.skew import ROWS_PER_TASK, SMALL_ROWS, join_counted, numbered, sized
from tidelake.session import stored


def unprocessed(files: DataFrame, ledger: DataFrame, key: str = "file_path") -> DataFrame:
    """Distinct files the ledger does not know."""
    return files.select(key).distinct().join(ledger.select(key), key, "left_anti")


def first_occurrence(
    df: DataFrame, digest: str, order_by: list[str], carry: list[str] | None = None
) -> DataFrame:
    """One row per content: its first place in ``order_by``, its number of copies, and the first
    row's ``carry`` columns (small ones; pixels are fetched by place afterwards).

    A minimum is combined inside each task before the shuffle, so a content that fills a third of
    the table costs one row per task. A single numeric ordering column keeps the hash aggregation.
    """
    carry = carry or []
    # a null digest counts no copies; testing that after the grouping hashes each row only once
    copies = F.count(digest).alias("copies")
    if len(order_by) == 1:
        first = [F.min_by(c, order_by[0]).alias(c) for c in carry]
        found = df.groupBy(digest).agg(F.min(order_by[0]).alias(order_by[0]), *first, copies)
        return found.filter("copies > 0")
    place = F.min(F.struct(*order_by, *carry)).alias("_first")
    found = df.groupBy(digest).agg(place, copies).filter("copies > 0")
    return found.select(digest, "_first.*", "copies")


def dedup_content(
    df: DataFrame, digest: str, order_by: list[str], small_rows: int = SMALL_ROWS
) -> DataFrame:
    """The first row of each content. ``order_by`` must name each row uniquely.

    Only digests and row places are grouped. The rows, with their pixels, then meet the places to
    keep, or the places to drop when only those are few enough to be broadcast: the pixels stay
    where they were read. With many of both it is a join on the unique place, which no hot content
    can skew.
    """
    first = stored(first_occurrence(df, digest, order_by))
    kept, rows = first.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    first = first.select(*order_by)
    if kept > small_rows >= rows - kept:
        known = df.filter(F.col(digest).isNotNull())
        copies = known.select(*order_by).join(first, order_by, "left_anti")
        return known.join(sized(copies), order_by, "left_anti")
    return join_counted(df, first, order_by, "left_semi", small_rows)


def keep_rows(df: DataFrame, places: DataFrame, order_by: list[str]) -> DataFrame:
    """Semi-join on row places. While their counted list is small it is broadcast, and the pixels
    stay where they were read."""
    return join_counted(df, places, order_by, "left_semi")


def new_content(df: DataFrame, ledger: DataFrame, digest: str, known: str | None = None) -> DataFrame:
    """Rows whose content the ledger does not hold. Deduplicate first: then each key is unique."""
    seen = ledger.select(F.col(known or digest).alias(digest))
    return df.join(seen, digest, "left_anti")


def already_done(df: DataFrame, ledger: DataFrame, digest: str, known: str | None = None) -> DataFrame:
    seen = ledger.select(F.col(known or digest).alias(digest))
    return df.join(seen, digest, "left_semi")


def not_present(df: DataFrame, inventory: DataFrame, name: str = "file_name") -> DataFrame:
    """Rows whose target file does not exist yet."""
    return df.join(inventory.select(name), name, "left_anti")


def run_report(
    df: DataFrame,
    ledger: DataFrame,
    inventory: DataFrame,
    digest: str = "content_hash",
    name: Callable[[Column], Column] = export_name,
) -> DataFrame:
    """One row that accounts for every input row.

    Rows are counted per content before anything is joined. A content whose target file exists
    counts with all its copies as skipped; of a new content one row is exported and the rest are
    duplicates.
    """
    per_content = df.groupBy(digest).agg(F.count("*").alias("n")).withColumn(
        "file_name", name(F.col(digest))
    )
    known = ledger.select(digest).distinct().withColumn("known", F.lit(True))
    there = inventory.select("file_name").distinct().withColumn("there", F.lit(True))
    joined = per_content.join(known, digest, "left").join(there, "file_name", "left")
    null = F.col(digest).isNull()
    in_ledger = ~null & F.col("known").isNotNull()
    on_target = ~null & F.col("known").isNull() & F.col("there").isNotNull()
    new = ~null & F.col("known").isNull() & F.col("there").isNull()

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"),
        rows(null).alias("nulls"),
        rows(in_ledger).alias("in_ledger"),
        rows(on_target).alias("on_target"),
        rows(in_ledger | on_target).alias("skipped"),
        F.count_if(new).alias("exported"),
        (rows(new) - F.count_if(new)).alias("duplicates"),
    )


def file_counts(files: DataFrame, rows: DataFrame, key: str = "source_file") -> DataFrame:
    """Rows per file, 0 for a file without rows."""
    counted = rows.groupBy(key).agg(F.count("*").alias("n"))
    return files.select(key).distinct().join(counted, key, "left").select(
        key, F.coalesce("n", F.lit(0)).alias("n")
    )


def batch_counts(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    return df.groupBy(batch).agg(F.count("*").alias("records"))


def image_bytes(df: DataFrame, blob: str = "image") -> DataFrame:
    return df.withColumn("image_size", F.length(F.col(blob).cast("binary")).cast("long"))


def last_batch(ledger: DataFrame) -> DataFrame:
    """The newest batch: by its time, then by the number of its part."""
    text = F.col("batch_id")
    number = F.coalesce(F.regexp_extract(text, r"_part_(\d+)$", 1).try_cast("decimal(38,0)"), F.lit(-1))
    time = F.regexp_replace(text, r"_part_\d+$", "")
    return ledger.agg(F.max_by(text, F.when(text.isNotNull(), F.struct(time, number, text))).alias("batch_id"))


def file_parts(
    files: DataFrame,
    key: str = "file_path",
    files_per_part: int = 10,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Cut the sorted list of files into parts of ``files_per_part``."""
    placed = numbered(files.select(key).distinct(), [], [key], "_at", rows_per_task)
    return placed.select(key, F.floor((F.col("_at") - 1) / files_per_part).alias("part"))


def pair_masks(images: DataFrame, masks: DataFrame) -> DataFrame:
    """Images and masks stored apart, paired by where they came from."""
    return images.join(masks, ["source_file", "row_index"])
