"""Joins of two streams whose state is bounded by both watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def as_of_stream(
    labels: DataFrame,
    features: DataFrame,
    key: str,
    ts: str,
    label_id: str,
    feature_id: str,
    within: str,
    delay: str,
) -> DataFrame:
    """Each label with the last feature row of its key at or before it and no older than ``within``.

    The rows are those of ``operators.features.as_of_join``, with nulls where the feature found there
    is older, whatever the cut into micro-batches; labels without a feature are kept. Of features at one time the highest id
    counts. A label is given once, when both watermarks have passed it; rows that come more than
    ``delay`` behind their stream may be dropped, and labels without a time are. State holds the features
    of the last ``within`` and ``delay`` and the labels that wait. ``label_id`` must name one label of a key and time.
    Feature columns get the prefix ``f_``. Labels and features without a key meet nothing.
    """
    rest = [c for c in labels.columns if c not in (key, ts, label_id)]
    values = [c for c in features.columns if c != key]
    left = labels.select(key, ts, label_id, F.struct(F.lit(True).alias("_"), *rest).alias("_label")).withWatermark(ts, delay)
    right = features.select(
        F.col(key).alias("_key"),
        F.col(ts).alias("_at"),
        F.struct(F.col(ts).alias("_at"), F.col(feature_id).alias("_id")).alias("_order"),
        F.struct(*[F.col(c).alias(f"f_{c}") for c in values]).alias("_feature"),
    ).withWatermark("_at", delay)
    near = (F.col("_at") <= F.col(ts)) & (F.col("_at") >= F.col(ts) - F.expr(f"interval {within}"))
    met = left.join(right, (F.col(key) == F.col("_key")) & near, "left").drop("_key", "_at")
    # a maximum: what one task holds of a label's features is one row before the shuffle
    last = met.groupBy(key, ts, label_id).agg(
        F.first("_label").alias("_label"), F.max_by("_feature", "_order").alias("_last")
    )
    columns = [F.col(c) if c in (key, ts, label_id) else F.col(f"_label.{c}") for c in labels.columns]
    return last.select(*columns, "_last.*")
