"""Scores, ensembles, confidence, outliers in embedding space, smoothing, hard examples."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tidelake.operators.skew import ROWS_PER_TASK, attach, neighbours, top_per_group

def centroids(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Mean vector per label, as an array."""
    rows = df.filter(F.col(vector).isNotNull())
    features = array_to_vector(F.col(vector).cast("array<double>"))
    return rows.groupBy(label).agg(vector_to_array(Summarizer.mean(features)).alias("centroid"))


def distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a.cast("array<double>"), b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def ood_scores(df: DataFrame, vector: str, label: str, sigmas: float = 3.0) -> DataFrame:
    """Distance to the label's centroid, and whether it lies ``sigmas`` deviations above the mean.

    Centroids and their statistics are aggregates; no label's rows meet in one task.
    """
    far = attach(df, centroids(df, vector, label), [label]).withColumn(
        "distance", distance(F.col(vector), F.col("centroid"))
    ).drop("centroid")
    stats = far.groupBy(label).agg(
        (F.avg("distance") + F.lit(float(sigmas)) * F.stddev_pop("distance")).alias("limit")
    )
    return attach(far, stats, [label]).withColumn("is_ood", F.col("distance") > F.col("limit"))


def class_scores(df: DataFrame, vector: str, classes: DataFrame, label: str) -> DataFrame:
    """Add ``scores``: softmax of minus the distance to each class centroid, and their ``classes``.

    The centroids are the model's weights, as many rows as every scored row gets numbers. The
    arithmetic is one vector operation per Arrow batch and class. The smallest distance of
    a row is subtracted first, so far vectors have scores, too. A vector that is null, or not of the
    centroids' length, or without classes, has null scores.
    """
    rows = classes.select(label, "centroid").orderBy(label).collect()
    names = [r[label] for r in rows]
    weights = np.array([r["centroid"] for r in rows], dtype=np.float64).reshape(len(rows), -1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(vector)
            lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
            known = (lengths == weights.shape[1]) & (len(names) > 0)
            flat = column.filter(pa.array(known)).flatten().to_numpy(zero_copy_only=False)
            points = flat.astype(np.float64).reshape(int(known.sum()), -1)
            far = np.empty((len(points), len(names)))
            for at, w in enumerate(weights):
                far[:, at] = np.sqrt(((points - w) ** 2).sum(axis=1))
            scores = np.zeros((batch.num_rows, len(names)))
            if known.any():
                parts = np.exp(far.min(axis=1, keepdims=True) - far)
                scores[known] = parts / parts.sum(axis=1, keepdims=True)
            starts = pa.array(np.arange(batch.num_rows + 1) * len(names), pa.int32())
            packed = pa.ListArray.from_arrays(starts, pa.array(scores.ravel()), mask=pa.array(~known))
            yield pa.RecordBatch.from_arrays([*batch.columns, packed], [*batch.schema.names, "scores"])

    scored = StructType([*df.schema, StructField("scores", ArrayType(DoubleType()))])
    return df.mapInArrow(work, scored).withColumn("classes", F.lit(names))


def predicted(scores: Column, classes: Column) -> Column:
    """Class with the highest score, the first on a tie."""
    return F.element_at(classes, F.array_position(scores, F.array_max(scores)).cast("int"))


def ensemble(tables: list[DataFrame], key: str, scores: str = "scores") -> DataFrame:
    """Mean score vector of several models over the same items, and the variance between them.

    The items are unique in each table. Class names are taken from the first one.
    """
    named = [t.select(key, F.col(scores).alias(f"_s{i}")) for i, t in enumerate(tables)]
    if "classes" in tables[0].columns:
        named[0] = tables[0].select(key, F.col(scores).alias("_s0"), "classes")
    joined = reduce(lambda a, b: a.join(b, key), named)
    total = reduce(
        lambda a, b: F.zip_with(a, b, lambda x, y: x + y),
        [F.col(f"_s{i}") for i in range(len(tables))],
    )
    mean = F.transform(total, lambda x: x / F.lit(float(len(tables))))
    spread = reduce(
        lambda a, b: F.zip_with(a, b, lambda x, y: x + y),
        [
            F.zip_with(F.col(f"_s{i}"), F.col("scores"), lambda x, m: (x - m) * (x - m))
            for i in range(len(tables))
        ],
    )
    mean_spread = F.aggregate(spread, F.lit(0.0), lambda s, x: s + x) / (F.size(spread) * len(tables))
    return joined.withColumn("scores", mean).withColumn("variance", mean_spread).drop(
        *[f"_s{i}" for i in range(len(tables))]
    )


def confidence(df: DataFrame, scores: str = "scores") -> DataFrame:
    """Add the highest score, its lead over the second and the entropy."""
    ordered = F.sort_array(F.col(scores), asc=False)
    entropy = F.aggregate(
        F.col(scores), F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log(p)).otherwise(F.lit(0.0))
    )
    return df.withColumns(
        {
            "confidence": F.array_max(scores),
            # with one class only, nothing comes second
            "margin": F.try_element_at(ordered, F.lit(1)) - F.coalesce(F.try_element_at(ordered, F.lit(2)), F.lit(0.0)),
            "entropy": entropy,
        }
    )


def hard_examples(df: DataFrame, by: str, margin: str, key: str, k: int) -> DataFrame:
    """The ``k`` rows with the smallest lead per class."""
    return top_per_group(df, [by], [margin, key], k)


def low_confidence(df: DataFrame, limit: float, confidence: str = "confidence") -> DataFrame:
    return df.filter(F.col(confidence) < limit)


def labelled(df: DataFrame, model: str, version: str) -> DataFrame:
    """Label, confidence and provenance of each scored item."""
    scored = confidence(df).withColumn("label", predicted(F.col("scores"), F.col("classes")))
    origin = F.struct(F.lit(model).alias("model"), F.lit(version).alias("version"))
    return scored.withColumn("provenance", origin).drop("scores", "classes")


def horizon_row(df: DataFrame, profile: str = "profile") -> DataFrame:
    """Row at which the mean grey level changes most (the first such row), and by how much."""
    rows = F.col(profile)
    steps = F.zip_with(
        F.slice(rows, F.lit(1), F.size(rows) - 1),
        F.slice(rows, F.lit(2), F.size(rows) - 1),
        lambda a, b: F.abs(b - a),
    )
    change = F.array_max(steps)
    return df.withColumns({"row": F.array_position(steps, change).cast("int"), "change": change})


def smooth(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    label: str,
    reach: int = 2,
    last: int = 5,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Centred moving mean of ``value`` and the majority of the last ``last`` labels, the smallest on a tie."""

    def mean(window):
        return F.avg(value).over(window.rowsBetween(-reach, reach))

    def labels(window):
        return F.mode(label, True).over(window.rowsBetween(-(last - 1), Window.currentRow))

    return neighbours(
        df,
        [key],
        order,
        max(reach, last - 1),
        reach,
        {"smooth_value": mean, "smooth_label": labels},
        rows_per_task,
    )
