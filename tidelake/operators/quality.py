"""Telemetry parsing, row validation, outliers, data quality metrics and alerts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidelake.operators.skew import ROWS_PER_TASK, attach, join_counted, quantiles


def parse_telemetry(df: DataFrame, schema: StructType, column: str = "props") -> DataFrame:
    """JSON text to typed columns."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.from_json(column, schema).alias("_p")).select(*rest, "_p.*")


def with_metadata(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Add the columns of a dimension table with one row per key; works on a stream too."""
    return join_counted(df, dimension, [key], "left")


def validate_rows(
    df: DataFrame, schema: StructType, column: str = "props", required: list[str] | None = None
) -> DataFrame:
    """Add ``parsed`` and ``status``: ok, absent, unparsable, wrong type or missing field."""
    required = [f.name for f in schema] if required is None else required
    corrupt = StructType([*schema, StructField("_corrupt", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = df.withColumn("_p", F.from_json(column, corrupt, options))
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(f"_p.{name}").isNull()
    status = (
        F.when(F.col(column).isNull(), "absent")
        .when(F.try_parse_json(column).isNull(), "unparsable")
        .when(F.col("_p._corrupt").isNotNull(), "wrong type")
        .when(missing, "missing field")
        .otherwise("ok")
    )
    good = F.struct(*[F.col(f"_p.{f.name}") for f in schema])
    return parsed.withColumn("status", status).withColumn("parsed", good).drop("_p")


def quarantine(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their status)."""
    return (
        validated.filter("status = 'ok'").drop("status"),
        validated.filter("status <> 'ok'").drop("parsed"),
    )


def fences(
    df: DataFrame, value: str, by: list[str], k: float = 1.5, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Lower and upper fence per group: quartiles moved out by ``k`` interquartile ranges."""
    quarters = quantiles(df, value, by, {"q1": 0.25, "q3": 0.75}, rows_per_task)
    reach = (F.col("q3") - F.col("q1")) * F.lit(float(k))
    return quarters.select(
        *by, (F.col("q1") - reach).alias("low_fence"), (F.col("q3") + reach).alias("high_fence")
    )


def clean_outliers(
    df: DataFrame, value: str, by: list[str], k: float = 1.5, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Rows with a value inside their group's fences."""
    fenced = attach(df.filter(F.col(value).isNotNull()), fences(df, value, by, k, rows_per_task), by)
    return fenced.filter(F.col(value).between(F.col("low_fence"), F.col("high_fence")))


def dq_metrics(
    df: DataFrame,
    complete: list[str],
    unique: list[str],
    valid: dict[str, Column],
    fresh: str,
    as_of: Column,
) -> DataFrame:
    """Rows (metric, item, value): completeness, uniqueness, validity, freshness in days.

    One pass for all but uniqueness, which counts the distinct values of each column by itself, so
    that no row is copied. A share of nothing, in an empty table or a column of nulls, is null.
    """
    aggregates = {("completeness", c): F.try_divide(F.count(c), F.count("*")) for c in complete}
    aggregates |= {("validity", n): F.try_divide(F.count_if(rule), F.count("*")) for n, rule in valid.items()}
    aggregates[("freshness", fresh)] = F.date_diff(as_of, F.max(fresh)).cast("double")
    one = df.agg(*[c.alias(f"_m{i}") for i, c in enumerate(aggregates.values())])
    rows = [
        F.struct(
            F.lit(metric).alias("metric"), F.lit(item).alias("item"), F.col(f"_m{i}").alias("value")
        )
        for i, (metric, item) in enumerate(aggregates)
    ]
    found = one.select(F.inline(F.array(*rows)))
    for name in unique:
        values = df.groupBy(name).agg(F.count(name).alias("n")).filter("n > 0")
        share = F.try_divide(F.count("*"), F.sum("n")).cast("double").alias("value")
        found = found.unionByName(values.agg(F.lit("uniqueness").alias("metric"), F.lit(name).alias("item"), share))
    return found


@dataclass(frozen=True)
class Rule:
    metric: str
    breached: Callable[[Column], Column]
    severity: str


def alerts(metrics: DataFrame, rules: list[Rule]) -> DataFrame:
    """A row per metric row and rule it breaches, with the severity.

    The rules become one expression over each metric row; nothing is joined.
    """
    hits = [
        F.when(
            (F.col("metric") == rule.metric) & rule.breached(F.col("value")),
            F.struct(F.lit(at).alias("rule"), F.lit(rule.severity).alias("severity")),
        )
        for at, rule in enumerate(rules)
    ]
    columns = [c for c in metrics.columns]
    found = metrics.select(*columns, F.explode(F.array_compact(F.array(*hits))).alias("_hit"))
    return found.select(*columns, "_hit.rule", "_hit.severity")
