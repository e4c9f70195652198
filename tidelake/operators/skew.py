"""Ordered windows that stay whole when one key holds a large share of the rows.

A plain window brings all rows of a key into one task. Here the keys that are too big for that are
found first; all others take the plain window. The rows of a big key are split by a range
partitioning on key and order, and what a window needs from other chunks (a running total, the last
value, a few neighbour rows) is handed over between chunks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidelake.session import stored

ROWS_PER_TASK = 1_000_000
SHARE_PER_TASK = 1e-5
SMALL_ROWS = 100_000
SMALL_BYTES = 64 << 20
PARTS = 64
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def sized(df: DataFrame, small_bytes: int = SMALL_BYTES) -> DataFrame:
    """``df``, marked for a broadcast if its rows, written out as text, are few enough bytes."""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    size = df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= small_bytes else df


def join_counted(
    df: DataFrame, other: DataFrame, on: list[str], how: str = "inner", small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Join a table that may be small.

    It is counted first, and only a table of at most ``small_rows`` rows and SMALL_BYTES is broadcast.
    Beyond that it is a shuffle join, where AQE splits big keys.
    """
    if other.count() <= small_rows:
        other = sized(other)
    return df.join(other, on, how)


def attach(df: DataFrame, stats: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join per-group numbers, one row per group, back to the rows; they are computed once."""
    return join_counted(df, stored(stats), on, how)


def _limit(total: int, rows_per_task: int) -> int:
    return max(rows_per_task, int(total * SHARE_PER_TASK))


def split_by_size(
    df: DataFrame, keys: list[str], rows_per_task: int | None = ROWS_PER_TASK
) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows of ordinary keys, rows of big keys or None, number of chunks for the latter).

    ``rows_per_task=None`` says that the keys have been counted and none is big.

    At most 1 / SHARE_PER_TASK keys can be big whatever the size of the data, which bounds the
    broadcast of their list.
    """
    if rows_per_task is None:
        return df, None, 1
    sizes = df.groupBy(*keys).count()
    total, largest = sizes.agg(
        F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))
    ).first()
    limit = _limit(total, rows_per_task)
    if largest <= limit:
        return df, None, 1
    if not keys:
        return df.limit(0), df, -(-total // limit)
    big = stored(sizes.filter(F.col("count") > limit))
    rows = big.agg(F.sum("count")).first()[0]
    names = F.broadcast(big.select(*[F.col(k).alias(f"_big_{k}") for k in keys]))
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_big_{k}")) for k in keys]
    )
    return (
        df.join(names, same, "left_anti"),
        df.join(names, same, "left_semi"),
        -(-rows // limit),
    )


def range_chunks(df: DataFrame, keys: list[str], order: list[str], chunks: int) -> DataFrame:
    """Add ``_chunk``: chunks follow each other in (keys, order), each about equally big.

    The rows are stored with their chunk number, so that every later use sees the same cut.
    """
    placed = df.repartitionByRange(max(chunks, 2), *keys, *order)
    return stored(placed.withColumn("_chunk", F.spark_partition_id()))


def _chunk_window(keys: list[str]) -> WindowSpec:
    # one row per key and chunk: at most the number of chunks for one key
    return Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )


def _rejoin(chunked: DataFrame, per_chunk: DataFrame, keys: list[str]) -> DataFrame:
    """Join values per (key, chunk) back; there are at most big keys + chunks such pairs."""
    right = per_chunk.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        F.col("_chunk").alias("_r_chunk"),
        *[c for c in per_chunk.columns if c not in (*keys, "_chunk")],
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys],
        F.col("_chunk") == F.col("_r_chunk"),
    )
    return chunked.join(sized(right), same).drop("_r_chunk", *[f"_r_{k}" for k in keys])


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, Column],
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Add running sums (this row included) per key in the given total order."""
    plain, big, chunks = split_by_size(df, keys, rows_per_task)

    def within(part: DataFrame, by: list[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return part.withColumns({n: F.sum(c).over(window) for n, c in totals.items()})

    result = within(plain, keys)
    if big is None:
        return result
    chunked = range_chunks(big, keys, order, chunks)
    per_chunk = chunked.groupBy(*keys, "_chunk").agg(
        *[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()]
    )
    before = per_chunk.select(
        *keys,
        "_chunk",
        *[
            F.coalesce(F.sum(f"_sum_{n}").over(_chunk_window(keys)), F.lit(0)).alias(f"_before_{n}")
            for n in totals
        ],
    )
    handed = _rejoin(within(chunked, [*keys, "_chunk"]), before, keys)
    handed = handed.withColumns({n: F.col(n) + F.col(f"_before_{n}") for n in totals})
    return result.unionByName(handed.select(*result.columns))


def numbered(
    df: DataFrame, keys: list[str], order: list[str], name: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add the position (from 1) of a row within its key, or in the whole table with no keys."""
    return running_total(df, keys, order, {name: F.lit(1).cast("long")}, rows_per_task)


def carried(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    name: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the last non-null ``value`` at or before each row."""
    plain, big, chunks = split_by_size(df, keys, rows_per_task)

    def within(part: DataFrame, by: list[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return part.withColumn(name, F.last(value, ignorenulls=True).over(window))

    result = within(plain, keys)
    if big is None:
        return result
    chunked = range_chunks(big, keys, order, chunks)
    latest = chunked.groupBy(*keys, "_chunk").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_latest")
    )
    before = latest.select(
        *keys, "_chunk", F.last("_latest", ignorenulls=True).over(_chunk_window(keys)).alias("_before")
    )
    handed = _rejoin(within(chunked, [*keys, "_chunk"]), before, keys)
    handed = handed.withColumn(name, F.coalesce(name, "_before"))
    return result.unionByName(handed.select(*result.columns))


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    before: int,
    after: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead.

    Big keys are cut into blocks by exact position; each block also gets the few rows around it, and
    those are dropped again after the window.
    """
    plain, big, chunks = split_by_size(df, keys, rows_per_task)

    def within(part: DataFrame, by: list[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return part.withColumns({n: make(window) for n, make in columns.items()})

    result = within(plain, keys)
    if big is None:
        return result
    block = max(rows_per_task, before, after, 1)
    placed = _numbered_big(big, keys, order, chunks)
    own = F.floor((F.col("_at") - 1) / block)
    inside = (F.col("_at") - 1) % block
    copies = F.array(
        own,
        F.when(inside >= block - before, own + 1),
        F.when(inside < after, own - 1),
    )
    spread = (
        placed.withColumn("_own", own)
        .withColumn("_block", F.explode(F.array_compact(copies)))
    )
    done = within(spread, [*keys, "_block"]).filter(F.col("_own") == F.col("_block"))
    return result.unionByName(done.select(*result.columns))


def _numbered_big(big: DataFrame, keys: list[str], order: list[str], chunks: int) -> DataFrame:
    chunked = range_chunks(big, keys, order, chunks)
    sizes = chunked.groupBy(*keys, "_chunk").agg(F.count("*").alias("_n"))
    before = sizes.select(
        *keys, "_chunk", F.coalesce(F.sum("_n").over(_chunk_window(keys)), F.lit(0)).alias("_skip")
    )
    window = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    counted = chunked.withColumn("_in_chunk", F.row_number().over(window))
    return _rejoin(counted, before, keys).withColumn("_at", F.col("_in_chunk") + F.col("_skip"))


def quantiles(
    df: DataFrame,
    value: str,
    by: list[str],
    probs: dict[str, float],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Exact interpolating quantiles per group, one column per name in ``probs``.

    Groups that fit a task take Spark's ``percentile``. Otherwise equal values are counted before
    anything is ordered, and the ranks come from a running total over the distinct values, so no task
    holds a whole group.
    """
    df = df.filter(F.col(value).isNotNull()).select(*by, value)
    if split_by_size(df, by, rows_per_task)[1] is None:
        found = df.groupBy(*by).agg(F.percentile(value, list(probs.values())).alias("_q"))
        return found.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)])
    counts = stored(df.groupBy(*by, value).agg(F.count("*").alias("_n")))
    ranked = running_total(counts, by, [value], {"_upto": F.col("_n")}, rows_per_task)
    sizes = counts.groupBy(*by).agg(F.sum("_n").alias("_size"))
    ranked = attach(ranked, sizes, by) if by else ranked.withColumn("_size", sizes.select("_size").scalar())

    def at(rank: Column) -> Column:
        hit = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(hit, F.col(value)))

    aggregates = []
    for name, p in probs.items():
        place = (F.col("_size") - 1) * F.lit(float(p))
        low = F.floor(place)
        aggregates += [
            at(low).alias(f"_low_{name}"),
            at(F.ceil(place)).alias(f"_high_{name}"),
            F.max(place - low).alias(f"_part_{name}"),
            F.max(F.ceil(place) - place).alias(f"_up_{name}"),
        ]
    return ranked.groupBy(*by).agg(*aggregates).select(
        *by,
        *[
            # the formula of Spark's percentile, operation for operation
            F.when(F.col(f"_low_{n}") == F.col(f"_high_{n}"), F.col(f"_low_{n}"))
            .otherwise(F.col(f"_up_{n}") * F.col(f"_low_{n}") + F.col(f"_part_{n}") * F.col(f"_high_{n}"))
            .alias(n)
            for n in probs
        ],
    )


def top_per_group(
    df: DataFrame, by: list[str], order: list[str], k: int, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """First ``k`` rows per group in ascending order, with their ``rank``.

    For a small ``k`` Spark keeps ``k`` rows per task and group before the shuffle. These meet in two
    steps, first those of a part of the tasks, so that no task gets ``k`` rows from every other. Beyond
    Spark's limit for ``k`` the rows of a big group are numbered chunk by chunk.
    """
    if k > int(df.sparkSession.conf.get(GROUP_LIMIT)):
        ranked = numbered(df, by, order, "rank", rows_per_task)
        return ranked.withColumn("rank", F.col("rank").cast("int")).filter(F.col("rank") <= k)
    part = F.pmod(F.xxhash64(*order), F.lit(PARTS)).alias("_part")
    some = Window.partitionBy(*by, "_part").orderBy(*order)
    few = df.withColumn("_part", part).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
    window = Window.partitionBy(*by).orderBy(*order)
    ranked = few.drop("_part").withColumn("rank", F.row_number().over(window))
    return ranked.filter(F.col("rank") <= k)
