"""Profiles and drift of a growing table from the sketches of its days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidelake.operators import profiling, sketches
from tidelake.plans.catalogue import query, table
from tidelake.session import scratch

_COLUMNS = ["event_id", "user_id", "event_type", "value"]


def _days(spark, sf_dir):
    """Events as a table with one folder per day."""
    events = table(spark, sf_dir, "events").select(*_COLUMNS, F.col("ts").cast("date").alias("day"))
    path = scratch(spark, "days")
    events.repartition("day").write.partitionBy("day").parquet(path)
    return spark.read.schema(events.schema).parquet(path)


def _column_sql(name: str) -> str:
    def of(function):
        return f"cast({function}({name}) as double)" if name != "event_type" else "cast(null as double)"

    return f"""select '{name}' as "column", (select count(distinct cast(ts as date)) from events) as parts, count(*) as n,
        count(*) - count({name}) as nulls, {of('min')} as "min", {of('max')} as "max", round({of('avg')}, 4) as mean,
        round({of('stddev_pop')}, 4) as std, true as distinct_close, {'true' if name != 'event_type' else 'null'} as quantiles_close from events"""


@query(" union all ".join(map(_column_sql, _COLUMNS)))
def sketch_profile(spark, sf_dir):
    """Two runs over a growing table, the second over its new days only; estimates are held to their bounds."""
    days, store = _days(spark, sf_dir), scratch(spark, "sketches")
    sketches.add_parts(days.filter(F.col("day") < "2024-01-16"), "day", store)
    sketches.add_parts(days, "day", store)
    found = sketches.profile_of(sketches.merged(sketches.stored_sketches(spark, store)))
    exact = profiling.profile(days, _COLUMNS).select("column", F.col("distinct").alias("_exact"))
    off = F.abs(F.col("distinct") - F.col("_exact")) <= F.ceil(F.col("_exact") * sketches.distinct_error())

    def close(name: str) -> DataFrame:
        # the true ranks of the estimates, from the rows
        at = found.filter(F.col("column") == name).select("quantiles").scalar()
        error = 2 * sketches.rank_error()
        n = F.count(name)
        inside = [
            (F.count(F.when(F.col(name) < at[i], 1)) / n <= share + error) & (F.count(F.when(F.col(name) <= at[i], 1)) / n >= share - error)
            for i, share in enumerate(sketches.QUANTILES)
        ]
        return days.agg(reduce(lambda a, b: a & b, inside).alias("quantiles_close")).select(F.lit(name).alias("column"), "quantiles_close")

    checked = reduce(DataFrame.union, [close(c) for c in _COLUMNS if c != "event_type"])
    return found.join(exact, "column").join(checked, "column", "left").select(
        "column", "parts", "n", "nulls", "min", "max", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
        off.alias("distinct_close"), "quantiles_close",
    )


def _drift_sql(name: str) -> str:
    return f"""select '{name}' as "column", count({name}) filter (where ts < timestamp '2024-01-16') as n_ref,
        count({name}) filter (where ts >= timestamp '2024-01-16') as n_cur, true as ks_close from events"""


@query(" union all ".join(map(_drift_sql, ("user_id", "value"))))
def sketch_drift(spark, sf_dir):
    """Drift between two sets of days from sketches alone; the distance is held to that of the rows."""
    days, store = _days(spark, sf_dir), scratch(spark, "sketches")
    columns = ["user_id", "value"]
    sketches.add_parts(days, "day", store, columns)
    rows = sketches.stored_sketches(spark, store)
    first, second = (sketches.merged(rows.filter(c)) for c in ("part < '2024-01-16'", "part >= '2024-01-16'"))
    found = sketches.drift_of(first, second)
    early, late = (days.filter(c) for c in ("day < '2024-01-16'", "day >= '2024-01-16'"))
    exact = reduce(DataFrame.union, [profiling.ks_distance(early, late, c).select(F.lit(c).alias("column"), F.col("ks").alias("_exact")) for c in columns])
    sizes = first.select("column", (F.col("n") - F.col("nulls")).alias("n_ref")).join(
        second.select("column", (F.col("n") - F.col("nulls")).alias("n_cur")), "column"
    )
    return found.join(exact, "column").join(sizes, "column").select(
        "column", "n_ref", "n_cur", (F.abs(F.col("ks") - F.col("_exact")) <= sketches.drift_error()).alias("ks_close")
    )
