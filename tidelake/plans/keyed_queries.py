"""Streams with a state for each user, over the events in parts that overlap in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelake.plans.catalogue import query, table
from tidelake.session import scratch
from tidelake.sinks.tables import append, persist_raw
from tidelake.sources.streams import table_stream
from tidelake.streaming import keyed

_COLUMNS = ["user_id", "event_id", "ts", "event_type", "value"]


def _in_parts(spark, sf_dir, part, numbers):
    """Events as a stream that takes one part after the other, and at last a row far ahead that moves the watermark."""
    events = table(spark, sf_dir, "events").select(*_COLUMNS).withColumn("ts", F.col("ts").cast("timestamp"))
    folder = scratch(spark, "parts")
    for number in numbers:
        append(events.filter(part == number), f"{folder}/in", files=1)
    ahead = events.agg((F.max("ts") + F.expr("interval 100 days")).alias("ts")).select(
        F.lit(-1).cast("long").alias("user_id"), F.lit(-1).cast("long").alias("event_id"), "ts",
        F.lit("").alias("event_type"), F.lit(0.0).alias("value"),
    )
    append(ahead, f"{folder}/in", files=1)
    return table_stream(spark, f"{folder}/in", events.schema, files_per_batch=1), folder


def _landed(spark, stream: DataFrame, folder: str) -> DataFrame:
    persist_raw(stream, f"{folder}/out", f"{folder}/log", available_now=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out").filter("user_id <> -1")


@query(
    """with p as (select *, hour(ts) // 6 as part from events),
            n as (select * from p qualify row_number() over (partition by user_id, part order by ts desc, event_id desc) = 1),
            b as (select *, max(ts) over (partition by user_id order by part
                      rows between unbounded preceding and 1 preceding) as before from n)
       select user_id, event_id, ts, event_type, value from b where before is null or ts > before"""
)
def stream_newest(spark, sf_dir):
    """What became a user's newest event while the quarters of all days came one after the other."""
    stream, folder = _in_parts(spark, sf_dir, F.floor(F.hour("ts") / 6), range(4))
    found = _landed(spark, keyed.newest_stream(stream, "user_id", "ts", "event_id", "60 days"), folder)
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    """with e as (select *, ts - lag(ts) over w as gap, value - lag(value) over w as d1 from events
                  window w as (partition by user_id order by ts, event_id)),
            n as (select *, case when gap <= interval '18 hours' then d1 end as near from e),
            s as (select *, near - lag(near) over (partition by user_id order by ts, event_id) as d2 from n)
       select event_id, user_id, round(near, 6) as first_difference, round(d2, 6) as second_difference
       from s where abs(d2) > 200"""
)
def stream_jerks(spark, sf_dir):
    """Second differences across micro-batches; every second event of a day may come with the next ten days."""
    days = F.datediff("ts", F.lit("2024-01-01")) + F.col("event_id") % 2
    stream, folder = _in_parts(spark, sf_dir, F.floor(days / 10), range(4))
    view = keyed.jerk_stream(stream, "user_id", "ts", "event_id", "value", 200.0, "2 days", "18 hours")
    return _landed(spark, view, folder).select(
        "event_id",
        "user_id",
        F.round("first_difference", 6).alias("first_difference"),
        F.round("second_difference", 6).alias("second_difference"),
    )
