"""Feature versions, the newest row per entity, and point-in-time joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelake.operators.skew import ROWS_PER_TASK, carried


def feature_version(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """A version per feature table that depends on its rows and not on their order.

    A row's digest is taken over its fields with their lengths, so that no two rows look alike and a
    null is no text. The digests are summed in four parts of 64 bits, so each task hands over four
    numbers per table; the version is the digest of these sums.
    """
    fields = [F.col(c).cast("string") for c in columns]
    row = F.concat(*[F.coalesce(F.concat(F.length(f), F.lit(":"), f), F.lit("-")) for f in fields])
    digest = F.sha2(row.cast("binary"), 256)
    parts = [
        F.sum(F.conv(F.substring(digest, 16 * i + 1, 16), 16, 10).cast("decimal(38,0)")).alias(f"_sum{i}")
        for i in range(4)
    ]
    sums = df.groupBy(*by).agg(F.count("*").alias("rows"), *parts)
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ("rows", *[f"_sum{i}" for i in range(4)])])
    return sums.select(*by, "rows", F.sha2(text.cast("binary"), 256).alias("version"))


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The newest row per key. A maximum, so a busy key is reduced in every task first."""
    rest = [c for c in df.columns if c not in key]
    newest = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(*key, "_row.*")


def as_of_join(
    labels: DataFrame,
    features: DataFrame,
    key: str,
    ts: str,
    label_id: str,
    feature_id: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Each label with the last feature row of its key at or before it.

    Both tables go on one time line per key; the feature is carried forward. At equal times
    features come before labels, and of several the highest id counts. Labels without an earlier
    feature are kept with nulls. Feature columns get the prefix ``f_``.
    """
    values = [c for c in features.columns if c != key]
    feature = F.struct(*[F.col(c).alias(f"f_{c}") for c in values])
    label = F.struct(*[F.col(c) for c in labels.columns if c != key])
    left = features.select(
        key,
        F.col(ts).alias("_ts"),
        F.lit(0).alias("_kind"),
        F.col(feature_id).alias("_id"),
        feature.alias("_feature"),
        F.lit(None).cast(labels.select(label).schema[0].dataType).alias("_label"),
    )
    right = labels.select(
        key,
        F.col(ts).alias("_ts"),
        F.lit(1).alias("_kind"),
        F.col(label_id).alias("_id"),
        F.lit(None).cast(features.select(feature).schema[0].dataType).alias("_feature"),
        label.alias("_label"),
    )
    line = carried(
        left.unionByName(right), [key], ["_ts", "_kind", "_id"], "_feature", "_last", rows_per_task
    )
    return line.filter("_kind = 1").select(key, "_label.*", "_last.*")
