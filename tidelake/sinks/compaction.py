"""Compaction of the small files that streams leave.

A table that is compacted is read through its manifest: the newest list of its files. New files that
no manifest names are read, too; files that a manifest replaced are not. So a reader sees the small
files or the large one, never both and never neither, wherever a compaction is interrupted.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidelake.operators.skew import running_total, sized
from tidelake.session import stored
from tidelake.sinks import folders
from tidelake.sources.files import file_inventory, source_path

TARGET_BYTES = 256 << 20
_MANIFEST = StructType([StructField("file_path", StringType()), StructField("live", StringType())])


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = folders.children(spark, f"{path}/_manifests")
    return sorted(int(n.removeprefix("v")) for n in names if n.startswith("v"))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(file_path, live): ``live`` is ``yes`` for files to read and ``no`` for replaced ones."""
    versions = _versions(spark, path)
    if version is None and not versions:
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(f"{path}/_manifests/v{versions[-1] if version is None else version}")


def live_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_size) of what makes up the table now."""
    known = manifest(spark, path)
    plain = file_inventory(spark, path, recursive=True).select("file_path", "file_size")
    plain = plain.filter(~F.contains("file_path", F.lit("/_compacted/"))).filter("file_size > 0")
    fresh = plain.join(known.select("file_path"), "file_path", "left_anti")
    try:
        large = file_inventory(spark, f"{path}/_compacted/*").select("file_path", "file_size")
    except AnalysisException:  # nothing was compacted yet
        return fresh.unionByName(plain.join(known.filter("live = 'yes'"), "file_path", "left_semi"))
    named = plain.unionByName(large).join(known.filter("live = 'yes'"), "file_path", "left_semi")
    return fresh.unionByName(named)


def read_compacted(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """Rows of the table's live files; the list of files is the driver's, as in any scan."""
    files = [r["file_path"] for r in live_files(spark, path).select("file_path").collect()]
    return spark.read.schema(columns).parquet(*files) if files else spark.createDataFrame([], columns)


def compact(spark: SparkSession, path: str, columns: StructType, target_bytes: int = TARGET_BYTES) -> int:
    """Pack live files below half of ``target_bytes`` into files of about that size; returns how many went.

    Files are packed in the order of their names: each next one joins the bin that the bytes before it
    fill. The large files are written to a folder of their own and count from the moment the new
    manifest has its name; if another compaction was faster, this one changes nothing and raises.
    Folders of the table's partitions are not kept apart: ``columns`` are those of the files.
    """
    path = path.rstrip("/")
    version = max(_versions(spark, path), default=0)
    live = stored(live_files(spark, path))
    small = live.filter(F.col("file_size") < target_bytes // 2)
    binned = running_total(small, [], ["file_path"], {"_upto": F.col("file_size")}).select(
        "file_path", F.floor((F.col("_upto") - F.col("file_size")) / target_bytes).alias("bin")
    )
    # a bin of one file is as good as it gets
    sizes = binned.groupBy("bin").agg(F.count("*").alias("n")).filter("n > 1").select("bin")
    binned = stored(binned.join(sized(sizes), "bin", "left_semi"))
    packed, bins = binned.agg(F.count("*"), F.countDistinct("bin")).first()
    if not packed:
        return 0
    paths = [r["file_path"] for r in binned.select("file_path").collect()]
    rows = spark.read.schema(columns).parquet(*paths).withColumn("_file", source_path())
    placed = rows.join(sized(binned.withColumnRenamed("file_path", "_file")), "_file").drop("_file")
    folder = f"{path}/_compacted/{uuid.uuid4().hex}"
    placed.repartitionByRange(bins, "bin").drop("bin").write.parquet(folder)
    large = file_inventory(spark, folder).select("file_path").withColumn("live", F.lit("yes"))
    others = live.select("file_path").withColumn("live", F.lit("yes")).join(binned.select("file_path"), "file_path", "left_anti")
    gone = binned.select("file_path").withColumn("live", F.lit("no"))
    # replaced files stay named until they are removed, or they would count as new
    before = manifest(spark, path).filter("live = 'no'")
    draft = f"{path}/_manifests/.{uuid.uuid4().hex}"
    large.unionByName(others).unionByName(gone).unionByName(before).write.parquet(draft)
    if not folders.move_new(spark, draft, f"{path}/_manifests/v{version + 1}"):
        folders.remove(spark, draft)
        folders.remove(spark, folder)
        raise RuntimeError("another compaction has replaced these files")
    return packed


def remove_replaced(spark: SparkSession, path: str) -> int:
    """Delete the files that the newest manifest replaced; readers of older manifests must be done."""
    gone = [r["file_path"] for r in manifest(spark, path).filter("live = 'no'").collect()]
    return sum(folders.remove(spark, f) for f in gone)
