"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # an image row is about 200 KB, so Arrow batches are sized by rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.files.maxPartitionBytes": "64m",
    # sessions of a busy key are merged in each task before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


def list_in_few_tasks(spark: SparkSession) -> None:
    """Many given files are listed by a few hundred tasks, not by one for each of up to 10,000."""
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "200")


def shared_folder(spark: SparkSession) -> str:
    """The folder every node sees, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
    folder = tempfile.mkdtemp(prefix="tidelake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to a table in the shared folder, and read from there.

    Cuts the lineage like a checkpoint and survives lost executors, but is computed only once, is
    columnar, and tells the optimizer its real size.
    """
    path = scratch(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="tidelake-zip-"), "tidelake")
    context.addPyFile(shutil.make_archive(base, "zip", root, "tidelake"))
    _shipped.add(context.applicationId)
