"""Samples, column profiles, histograms and drift."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from tidelake.operators.skew import ROWS_PER_TASK, running_total
from tidelake.session import stored


def _chosen(key: Column, share: float) -> Column:
    """Stable choice of about ``share`` of the keys: 48 bits of their MD5 as a number, below the share.

    0 chooses none and 1 all. A null key is a key like others.
    """
    limit = math.ceil(float(share) * 16.0**12)
    if limit <= 0 or limit >= 16**12:
        return F.lit(limit > 0)
    text = F.coalesce(key.cast("string"), F.lit("")).cast("binary")
    # digits of equal number compare as text
    return F.substring(F.md5(text), 1, 12) < f"{limit:012x}"


def sample_by_hash(df: DataFrame, key: Column, share: float = 0.01) -> DataFrame:
    """Reproducible sample: the same rows whatever the partitioning."""
    return df.filter(_chosen(key, share))


def cohort(df: DataFrame, key: str, share: float = 0.1) -> DataFrame:
    """Mark the units of a canary group: all rows of a unit are in it or none."""
    return df.withColumn("in_cohort", _chosen(F.col(key), share))


def profile(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """One row per column: rows, nulls, distinct values, and min, max, mean, std of numbers.

    All but the distinct counts come from one pass. Exact distinct counts read one column at a time,
    so each column's values are combined in the tasks before they are shuffled and no row is
    multiplied. ``exact=False`` estimates them in the one pass instead.
    """
    columns = columns or df.columns
    types = {f.name: f.dataType for f in df.schema}
    none = F.lit(None).cast("double")
    parts: list[Column] = []
    for i, name in enumerate(columns):
        number = F.col(name).cast("double") if isinstance(types[name], NumericType) else none
        parts += [
            F.count(name).alias(f"_c{i}"),
            F.min(number).alias(f"_min{i}"),
            F.max(number).alias(f"_max{i}"),
            F.avg(number).alias(f"_avg{i}"),
            F.stddev_pop(number).alias(f"_std{i}"),
        ]
        if not exact:
            parts.append(F.approx_count_distinct(name).alias(f"_d{i}"))
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.col("_n").alias("n"),
            (F.col("_n") - F.col(f"_c{i}")).alias("nulls"),
            F.col(f"_min{i}").alias("min"),
            F.col(f"_max{i}").alias("max"),
            F.col(f"_avg{i}").alias("mean"),
            F.col(f"_std{i}").alias("std"),
            *([] if exact else [F.col(f"_d{i}").alias("distinct")]),
        )
        for i, name in enumerate(columns)
    ]
    stats = df.agg(F.count("*").alias("_n"), *parts).select(F.inline(F.array(*rows)))
    if not exact:
        return stats
    counts = [
        df.filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.lit(1).alias("_one"))
        .agg(F.lit(name).alias("column"), F.count("*").alias("distinct"))
        for name in columns
    ]
    # one row per column of the table
    return stats.join(F.broadcast(reduce(DataFrame.union, counts)), "column")


def _bounds(df: DataFrame, column: str) -> Column:
    pair = F.struct(F.min(column).alias("low"), F.max(column).alias("high"))
    return df.agg(pair.alias("bounds")).scalar()


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Fixed-width bin from 0; what lies outside goes to the nearest end bin."""
    place = F.floor((value - low) / ((high - low) / F.lit(bins)))
    place = F.when(high > low, place).otherwise(F.lit(0))
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), place)).cast("int")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    bounds = _bounds(df, column)
    low, high = bounds["low"], bounds["high"]
    width = (high - low) / F.lit(bins)
    binned = df.filter(F.col(column).isNotNull()).select(_bin(F.col(column), low, high, bins).alias("bin"))
    counted = binned.groupBy("bin").agg(F.count("*").alias("n"))
    return counted.select(
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        "n",
    )


def drift_bins(
    reference: DataFrame, current: DataFrame, column: str, bins: int, floor: float = 1e-6
) -> DataFrame:
    """Shares per bin of both tables, bins cut over the reference's range.

    An empty window has no shares: they, and what is computed from them, are null.
    """
    bounds = _bounds(reference, column)
    sides = reference.select(F.col(column).alias("v"), F.lit(1).alias("ref")).unionByName(
        current.select(F.col(column).alias("v"), F.lit(0).alias("ref"))
    )
    counts = (
        sides.filter(F.col("v").isNotNull())
        .groupBy(_bin(F.col("v"), bounds["low"], bounds["high"], bins).alias("bin"))
        .agg(F.sum("ref").alias("n_ref"), F.sum(1 - F.col("ref")).alias("n_cur"))
    )
    # at most ``bins`` rows from here on
    whole = Window.partitionBy()
    upto = Window.partitionBy().orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ref = F.try_divide("n_ref", F.sum("n_ref").over(whole))
    cur = F.try_divide("n_cur", F.sum("n_cur").over(whole))
    shares = counts.select("bin", "n_ref", "n_cur", ref.alias("p_ref"), cur.alias("p_cur"))
    p, q = (F.when(F.col(c).isNotNull(), F.greatest(c, F.lit(floor))) for c in ("p_cur", "p_ref"))
    return shares.withColumns(
        {
            "psi": (p - q) * F.log(p / q),
            "gap": F.abs(F.sum("p_cur").over(upto) - F.sum("p_ref").over(upto)),
        }
    )


def drift(reference: DataFrame, current: DataFrame, column: str, bins: int) -> DataFrame:
    """Population stability index over bins, and the exact Kolmogorov-Smirnov distance of two windows.

    The distance comes from running counts over the distinct values, split into chunks where they are
    many. An empty window makes both null.
    """
    psi = drift_bins(reference, current, column, bins).agg(F.sum("psi").alias("psi"))
    return psi.crossJoin(F.broadcast(ks_distance(reference, current, column)))  # one row each


def ks_distance(
    reference: DataFrame, current: DataFrame, column: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Largest gap between the two cumulative shares, one row."""
    sides = reference.select(F.col(column).alias("v"), F.lit(1).alias("ref")).unionByName(
        current.select(F.col(column).alias("v"), F.lit(0).alias("ref"))
    )
    counts = stored(
        sides.filter(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.sum("ref").alias("n_ref"), F.sum(1 - F.col("ref")).alias("n_cur"))
    )
    totals = {"_ref": F.col("n_ref"), "_cur": F.col("n_cur")}
    upto = running_total(counts, [], ["v"], totals, rows_per_task)
    ends = counts.agg(F.sum("n_ref").alias("_all_ref"), F.sum("n_cur").alias("_all_cur"))
    gap = F.abs(F.try_divide("_ref", "_all_ref") - F.try_divide("_cur", "_all_cur"))
    return upto.crossJoin(F.broadcast(ends)).agg(F.max(gap).alias("ks"))  # one row
