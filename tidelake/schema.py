"""Schemas of the lake's tables, and the rules for changing a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BinaryType,
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# decoded picture, the layout of Spark's own image source (BGR bytes, row by row)
IMAGE = StructType(
    [
        StructField("origin", StringType()),
        StructField("height", IntegerType()),
        StructField("width", IntegerType()),
        StructField("nChannels", IntegerType()),
        StructField("mode", IntegerType()),
        StructField("data", BinaryType()),
    ]
)

RAW = StructType([StructField("image", BinaryType())])

LANDING = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
        StructField("content", BinaryType()),
    ]
)

# fixed values: names and types of the two ledgers' columns
FILE_LEDGER = StructType(
    [
        StructField("file_path", StringType(), False),
        StructField("processed_at", TimestampType(), False),
        StructField("batch_id", StringType()),
        StructField("records_processed", LongType()),
    ]
)

EXPORT_LEDGER = StructType(
    [
        StructField("file_hash", StringType(), False),
        StructField("local_path", StringType(), False),
        StructField("source_file", StringType()),
        StructField("downloaded_at", TimestampType(), False),
        StructField("image_size", LongType()),
        StructField("batch_id", StringType()),
    ]
)

AUTO_LABEL = StructType(
    [
        StructField("image", IMAGE),
        StructField("mask", IMAGE),
        StructField(
            "metadata",
            StructType(
                [StructField("source_file", StringType()), StructField("row_index", LongType())]
            ),
        ),
    ]
)

_WIDER = [ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType]


def _widens(old: DataType, new: DataType) -> bool:
    kinds = [type(old), type(new)]
    if any(kind not in _WIDER for kind in kinds):
        return False
    if kinds in ([LongType, FloatType], [IntegerType, FloatType], [LongType, DoubleType]):
        return False  # digits would be lost
    return _WIDER.index(kinds[0]) < _WIDER.index(kinds[1])


def compare_schemas(old: StructType, new: StructType) -> list[tuple[str, str, str]]:
    """(column, change, "compatible" | "breaking") for each difference between two schemas."""
    changes = []
    before = {f.name: f for f in old}
    after = {f.name: f for f in new}
    for name, field in after.items():
        if name not in before:
            verdict = "compatible" if field.nullable else "breaking"
            changes.append((name, "added", verdict))
            continue
        was = before[name]
        if was.dataType != field.dataType:
            if _widens(was.dataType, field.dataType):
                changes.append((name, "widened", "compatible"))
            else:
                changes.append((name, "retyped", "breaking"))
        if was.nullable and not field.nullable:
            changes.append((name, "made required", "breaking"))
        elif field.nullable and not was.nullable:
            changes.append((name, "made optional", "compatible"))
    for name, field in before.items():
        if name not in after:
            verdict = "compatible" if field.nullable else "breaking"
            changes.append((name, "removed", verdict))
    return changes


def misfits(table: StructType, rows: StructType) -> list[tuple[str, str]]:
    """(column, reason) for all that keeps ``rows`` from being written to ``table`` without loss.

    A column of the table must be at least as wide as the rows', a required one must be there and
    never null, and the rows may have no column that the table lacks.
    """
    there = {f.name: f for f in rows}
    known = {f.name for f in table}
    found = [(name, "not in the table") for name in there if name not in known]
    for field in table:
        own = there.get(field.name)
        if own is None:
            if not field.nullable:
                found.append((field.name, "required, but missing"))
        elif own.dataType != field.dataType and not _widens(own.dataType, field.dataType):
            found.append((field.name, f"{own.dataType.simpleString()} does not fit {field.dataType.simpleString()}"))
        elif own.nullable and not field.nullable:
            found.append((field.name, "required, but nullable"))
    return found


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables under one schema: missing columns are null, widened types take the wider one."""
    breaking = [c for c in compare_schemas(old.schema, new.schema) if c[1] == "retyped"]
    if breaking:
        raise ValueError(f"incompatible column types: {breaking}")
    return old.unionByName(new, allowMissingColumns=True)


def require_columns(df: DataFrame, columns: list[str]) -> bool:
    return set(columns) <= set(df.columns)


def as_image(data, height, width, channels, origin=None):
    """Struct column in the image layout from its parts."""
    return F.struct(
        (F.lit(None).cast("string") if origin is None else origin).alias("origin"),
        height.cast("int").alias("height"),
        width.cast("int").alias("width"),
        channels.cast("int").alias("nChannels"),
        F.when(channels == 1, 0).when(channels == 4, 24).otherwise(16).cast("int").alias("mode"),
        data.alias("data"),
    )
