"""Review queues with urgency and deadlines, corrections, and the trail of changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.operators.features import latest
from tidelake.operators.skew import ROWS_PER_TASK, neighbours

# fixed values: hours until a review is due
SLA_HOURS = {"critical": 1, "high": 24, "normal": 168}


def urgency(rules: dict[str, Column], default: str = "normal") -> Column:
    """The first rule that holds names the urgency."""
    chosen = None
    for name, rule in rules.items():
        chosen = (F if chosen is None else chosen).when(rule, name)
    return F.lit(default) if chosen is None else chosen.otherwise(default)


def review_queue(
    df: DataFrame, rules: dict[str, Column], created: str, as_of: Column, sla: dict[str, int] = SLA_HOURS
) -> DataFrame:
    """Add urgency, due time and whether it has passed."""
    hours = None
    for name, limit in sla.items():
        hours = (F if hours is None else hours).when(F.col("urgency") == name, F.lit(limit))
    queued = df.withColumn("urgency", urgency(rules))
    due = F.col(created) + F.make_dt_interval(F.lit(0), hours)
    return queued.withColumn("due", due).withColumn("overdue", F.col("due") < as_of)


def queue_depth(queue: DataFrame) -> DataFrame:
    return queue.groupBy("urgency").agg(
        F.count("*").alias("depth"),
        F.count_if("overdue").alias("overdue"),
        F.min("due").alias("first_due"),
    )


def merge_feedback(
    labels: DataFrame, corrections: DataFrame, key: str, value: str, order: list[str]
) -> DataFrame:
    """The latest correction of an item wins over the model's label."""
    last = latest(corrections.select(key, F.col(value).alias("_corrected"), *order), [key], order)
    merged = labels.join(last.select(key, "_corrected"), key, "left")
    return (
        merged.withColumn("corrected", F.col("_corrected").isNotNull())
        .withColumn(value, F.coalesce("_corrected", value))
        .drop("_corrected")
    )


def audit_changes(
    df: DataFrame,
    key: str,
    order: list[str],
    columns: list[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per changed column: (key, order, column, old, new); a first row has no old value."""
    before = {
        f"_was_{c}": (lambda window, c=c: F.lag(F.struct(c)).over(window)) for c in columns
    }
    seen = neighbours(df.select(key, *order, *columns), [key], order, 1, 0, before, rows_per_task)
    changes = [
        F.when(
            F.col(f"_was_{c}").isNull() | ~F.col(f"_was_{c}.{c}").eqNullSafe(F.col(c)),
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_was_{c}.{c}").cast("string").alias("old"),
                F.col(c).cast("string").alias("new"),
            ),
        )
        for c in columns
    ]
    exploded = seen.select(key, *order, F.explode(F.array_compact(F.array(*changes))).alias("_c"))
    return exploded.select(key, *order, "_c.*")
