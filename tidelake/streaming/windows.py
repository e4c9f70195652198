"""Stateful stream operators; every state is bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def monitor(
    df: DataFrame,
    ts: str,
    size: str,
    metrics: dict[str, Column],
    by: list[str] | None = None,
    slide: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Metrics per tumbling or sliding window, for batches and (with ``delay``) for streams."""
    source = df.withWatermark(ts, delay) if delay else df
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = source.groupBy(window.alias("_window"), *(by or []))
    return grouped.agg(*[c.alias(n) for n, c in metrics.items()]).select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *(by or []),
        *metrics,
    )


def unique_within(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay``: for producers that send at least once."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def sessions(df: DataFrame, key: str, ts: str, gap: str, delay: str) -> DataFrame:
    """Sessions of a stream; a session ends ``gap`` after its last event."""
    grouped = df.withWatermark(ts, delay).groupBy(key, F.session_window(ts, gap).alias("_session"))
    return grouped.agg(F.count("*").alias("events")).select(
        key,
        F.col("_session.start").alias("session_start"),
        F.col("_session.end").alias("session_end"),
        "events",
    )
