"""Business metrics over model results: safety, savings, downtime, return."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.operators.skew import ROWS_PER_TASK, neighbours, running_total, split_by_size


def safety_index(
    df: DataFrame, unit: str, truth: Column, alarm: Column, false_alarm: float = 1.0, miss: float = 5.0
) -> DataFrame:
    """False alarms and misses per unit; the index is 1 with neither."""
    wrong = F.count_if(alarm & ~truth).alias("false_alarms")
    missed = F.count_if(truth & ~alarm).alias("misses")
    sums = df.groupBy(unit).agg(F.count("*").alias("n"), wrong, missed)
    cost = F.col("false_alarms") * F.lit(false_alarm) + F.col("misses") * F.lit(miss)
    return sums.withColumn("safety_index", 1 - F.try_divide(cost, F.col("n") * F.lit(miss)))


def saving(df: DataFrame, unit: str, value: str, in_baseline: Column) -> DataFrame:
    """Relative fall of a mean measure from the baseline period to the rest; null from a zero baseline."""
    sums = df.groupBy(unit).agg(
        F.avg(F.when(in_baseline, F.col(value))).alias("baseline"),
        F.avg(F.when(~in_baseline, F.col(value))).alias("current"),
    )
    return sums.withColumn("saving", F.try_divide(F.col("baseline") - F.col("current"), "baseline"))


def downtime(
    df: DataFrame, key: str, ts: str, gap_seconds: int, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Sessions of error events: a pause of more than ``gap_seconds`` starts a new one.

    Events of a key that fall in one slot of the length of the gap belong together whatever lies between, so
    slots are combined in the tasks first; what is ordered afterwards grows with time, not with the
    number of events.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    slot = F.floor(micros / F.lit(gap_seconds * 1_000_000))
    slots = df.groupBy(key, slot.alias("_slot")).agg(
        F.min(micros).alias("_from"), F.max(micros).alias("_to"), F.count("*").alias("_n")
    )
    if split_by_size(slots, [key], rows_per_task)[1] is None:
        rows_per_task = None
    seen = neighbours(
        slots, [key], ["_slot"], 1, 0, {"_before": lambda w: F.lag("_to").over(w)}, rows_per_task
    )
    pause = F.col("_from") - F.col("_before") > F.lit(gap_seconds * 1_000_000)
    begins = seen.withColumn("_new", F.coalesce(pause, F.lit(True)).cast("long"))
    placed = running_total(begins, [key], ["_slot"], {"_session": F.col("_new")}, rows_per_task)
    return placed.groupBy(key, "_session").agg(
        F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.sum("_n").alias("events")
    ).select(
        key,
        F.timestamp_micros("_from").alias("session_start"),
        F.timestamp_micros("_to").alias("last_event"),
        "events",
        ((F.col("_to") - F.col("_from")) / 1e6).alias("seconds"),
    )


def roi(benefit: Column, cost: Column) -> Column:
    """(benefit - cost) / cost, null without cost."""
    return F.when(cost != 0, (benefit - cost) / cost)
