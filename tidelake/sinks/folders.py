"""Folders of tables in whatever store Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _place(spark, path)
    return store.exists(place)


def present(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of some folders of one store that exist."""
    if not paths:
        return []
    store, place = _place(spark, paths[0])[0], spark._jvm.org.apache.hadoop.fs.Path
    return [path for path in paths if store.exists(place(path))]


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file with all that is in it; False if there is none."""
    store, place = _place(spark, path)
    return store.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it doesn't exist."""
    store, place = _place(spark, path)
    return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []


def move_new(spark: SparkSession, old: str, new: str) -> bool:
    """Give a folder a name that is free; False, and nothing done, if the name is taken."""
    store, place = _place(spark, old)
    target = _place(spark, new)[1]
    store.mkdirs(target.getParent())
    return not store.exists(target) and store.rename(place, target)


def partition(spark: SparkSession, path: str, **keys: object) -> str:
    """Folder of one partition, its values spelled as Spark spells them."""
    spelled = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join([path.rstrip("/"), *(spelled(k, str(v)) for k, v in keys.items())])


def partitions(spark: SparkSession, path: str, key: str, values: list[str]) -> list[str]:
    """Folders of many partitions by one key."""
    spelled = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return [f"{path.rstrip('/')}/{spelled(key, value)}" for value in values]
