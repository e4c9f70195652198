"""Column profiles and drift from sketches that are stored for each part of a table and merged.

A part (a day, a batch) is read once: its counts, moments and two sketches per column go to a store of
one folder per part. A new part is profiled without reading the others, and any set of parts is
profiled from their sketches alone. Counts, nulls, ends, mean and deviation are exact; quantiles and
distinct values are estimates with the bounds that ``rank_error`` and ``distinct_error`` state.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, NumericType, StringType, StructField, StructType

from tidelake.sinks.folders import exists
from tidelake.sinks.tables import replace_by_source

#: Size of a quantile sketch; a few kilobytes each.
QUANTILE_K = 1024
#: Binary logarithm of the registers of a distinct sketch.
DISTINCT_LOG_K = 12
#: Quantiles that a profile gives.
QUANTILES = (0.01, 0.25, 0.5, 0.75, 0.99)
#: The part that rows without one belong to.
NO_PART = "none"

STORE = StructType(
    [StructField("column", StringType())]
    + [StructField(name, LongType()) for name in ("n", "nulls")]
    + [StructField(name, DoubleType()) for name in ("min", "max", "mean", "m2")]
    + [StructField(name, BinaryType()) for name in ("quantiles", "distinct_values")]
    + [StructField("part", StringType())]
)


def rank_error(k: int = QUANTILE_K) -> float:
    """How far an estimated rank lies from the true one, at 99 % confidence (published for KLL)."""
    return 2.296 / k**0.9723


def drift_error(steps: int = 200, k: int = QUANTILE_K) -> float:
    """How far a distance from ``steps`` quantiles of two sketches lies from the true one.

    Both shares at a place are known to a step and a rank error, and so is what lies between two places.
    Rank errors count twice, so that all of the quantiles meet the bound together.
    """
    return 3 / steps + 8 * rank_error(k)


def distinct_error(log_k: int = DISTINCT_LOG_K) -> float:
    """Relative error of a distinct count at three standard deviations."""
    return 3 * 1.04 / 2 ** (log_k / 2)


def _part(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(NO_PART))


def _hashable(df: DataFrame, name: str) -> Column:
    """The column as a distinct sketch takes it; what is neither whole number nor text goes by its text."""
    kind = df.schema[name].dataType.simpleString()
    return F.col(name) if kind in ("int", "bigint", "string", "binary") else F.col(name).cast("string")


def sketch(df: DataFrame, part: str, columns: list[str] | None = None) -> DataFrame:
    """One row of ``STORE`` per part and column, from one pass over ``df``.

    Every task hands over one sketch per part and column, whatever the number of rows. NaN counts as
    null in a column of numbers. Columns that are no numbers have counts and distinct values only. Rows without a part
    form the part ``NO_PART``. An empty table has no parts.
    """
    columns = [c for c in columns or df.columns if c != part]
    parts: list[Column] = []
    rows: list[Column] = []
    for i, name in enumerate(columns):
        numeric = isinstance(df.schema[name].dataType, NumericType)
        number = F.col(name).cast("double") if numeric else F.lit(None).cast("double")
        number = F.when(~F.isnan(number), number)
        value = F.when(number.isNotNull(), _hashable(df, name)) if numeric else _hashable(df, name)
        parts += [
            F.count(value).alias(f"_c{i}"),
            F.min(number).alias(f"_min{i}"),
            F.max(number).alias(f"_max{i}"),
            F.avg(number).alias(f"_avg{i}"),
            F.var_pop(number).alias(f"_var{i}"),
            F.hll_sketch_agg(value, DISTINCT_LOG_K).alias(f"_d{i}"),
        ]
        if numeric:
            parts.append(F.kll_sketch_agg_double(number, QUANTILE_K).alias(f"_q{i}"))
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col("_n").alias("n"),
                (F.col("_n") - F.col(f"_c{i}")).alias("nulls"),
                F.col(f"_min{i}").alias("min"),
                F.col(f"_max{i}").alias("max"),
                F.col(f"_avg{i}").alias("mean"),
                (F.col(f"_var{i}") * F.col(f"_c{i}")).alias("m2"),
                # an empty quantile sketch answers nothing
                (F.when(F.col(f"_min{i}").isNotNull(), F.col(f"_q{i}")) if numeric else F.lit(None).cast("binary")).alias("quantiles"),
                F.col(f"_d{i}").alias("distinct_values"),
            )
        )
    found = df.groupBy(_part(part).alias("part")).agg(F.count("*").alias("_n"), *parts)
    return found.select("part", F.inline(F.array(*rows))).select(*STORE.names)


def stored_sketches(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(STORE).parquet(store)


def add_parts(
    df: DataFrame, part: str, store: str, columns: list[str] | None = None, again: Iterable[str] = ()
) -> list[str]:
    """Sketch the parts of ``df`` that the store lacks, and those named in ``again``; the parts taken.

    Only their folders are read if ``df`` is a table partitioned by ``part``. A part is written as a
    whole and replaces itself, so a run that was cut off can be repeated.
    """
    spark = df.sparkSession
    known: set[str] = set()
    if exists(spark, store):
        known = {r[0] for r in stored_sketches(spark, store).select("part").distinct().toLocalIterator()}
    # one name per part, as many as the table has folders
    there = {r[0] for r in df.select(_part(part)).distinct().toLocalIterator()}
    wanted = sorted((there - known) | (there & set(again)))
    if wanted:
        replace_by_source(sketch(df.filter(_part(part).isin(wanted)), part, columns), store, "part")
    return wanted


def merged(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per column (and per value of ``by``) from the sketches of many parts.

    Deviations are summed around the common mean, so nothing cancels where the mean is large.
    """
    keys = [*(by or []), "column"]
    taken = F.col("n") - F.col("nulls")
    means = sketches.filter("mean is not null").groupBy(*keys).agg(
        (F.sum(F.col("mean") * taken) / F.sum(taken)).alias("_mean")
    )
    found = sketches.join(means.select(*[F.col(k).alias(f"_{k}") for k in keys], "_mean"),
                          [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
    return found.groupBy(*keys).agg(
        F.count("*").alias("parts"),
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.max("_mean").alias("mean"),
        F.sum(F.col("m2") + taken * F.pow(F.col("mean") - F.col("_mean"), 2)).alias("m2"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct_values").alias("distinct_values"),
    ).withColumn("quantiles", F.when(F.col("mean").isNotNull(), F.col("quantiles")))


def _quantiles(sketch_column: str, shares: Iterable[float]) -> Column:
    return F.kll_sketch_get_quantile_double(sketch_column, F.array(*[F.lit(float(s)) for s in shares]))


def profile_of(found: DataFrame, shares: Iterable[float] = QUANTILES) -> DataFrame:
    """``merged`` rows as a profile; ``quantiles`` is null for columns without numbers."""
    keep = [c for c in found.columns if c not in ("m2", "quantiles", "distinct_values")]
    return found.select(
        *keep,
        F.sqrt(F.try_divide("m2", F.col("n") - F.col("nulls"))).alias("std"),
        F.hll_sketch_estimate("distinct_values").alias("distinct"),
        F.when(F.col("quantiles").isNotNull(), _quantiles("quantiles", shares)).alias("quantiles"),
    )


def drift_of(reference: DataFrame, current: DataFrame, bins: int = 10, steps: int = 200, floor: float = 1e-6) -> DataFrame:
    """(column, ks, psi) of two ``merged`` tables, without their rows.

    The Kolmogorov-Smirnov distance is the largest gap at ``steps`` quantiles of either side; it lies within
    ``drift_error(steps)`` of the true one. The stability index runs over ``bins`` bins
    of equal reference share. A column that either side lacks numbers of has nulls.
    """
    grid = [i / steps for i in range(1, steps + 1)]
    edges = [i / bins for i in range(1, bins)]

    def side(df: DataFrame, name: str) -> DataFrame:
        some = F.col("quantiles").isNotNull()
        return df.select(
            "column",
            F.when(some, _quantiles("quantiles", grid)).alias(name),
            F.when(some, F.array_distinct(_quantiles("quantiles", edges))).alias(f"{name}_edges"),
        )

    def upto(quantiles: str, places: Column) -> Column:
        """The share of a side at or below each place."""
        return F.transform(places, lambda v: F.size(F.filter(quantiles, lambda q: q <= v)) / F.lit(steps))

    def shares(quantiles: str) -> Column:
        at = upto(quantiles, F.col("_ref_edges"))
        ends, starts = F.concat(at, F.array(F.lit(1.0))), F.concat(F.array(F.lit(0.0)), at)
        return F.zip_with(ends, starts, lambda e, s: F.greatest(e - s, F.lit(floor)))

    sides = side(reference, "_ref").join(side(current, "_cur"), "column")
    places = F.concat("_ref", "_cur")
    gap = F.array_max(F.zip_with(upto("_ref", places), upto("_cur", places), lambda a, b: F.abs(a - b)))
    terms = F.zip_with(shares("_cur"), shares("_ref"), lambda p, q: (p - q) * F.log(p / q))
    both = F.col("_ref").isNotNull() & F.col("_cur").isNotNull()
    return sides.select(
        "column",
        F.when(both, gap).alias("ks"),
        F.when(both, F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)).alias("psi"),
    )
