"""Stream operators that keep a state of their own for each key, with timers that end it.

They need state in RocksDB, which they set for the session. Late rows, more than ``delay`` behind the
newest time of the micro-batches up to the last but one, are dropped by Spark. Rows without a time are
dropped, too; rows without a key belong to one key of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidelake.session import RECOMMENDED

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_US, _ID, _VALUE = "_us", "_id", "_value"

#: Rows, and bytes, of which a task looks for the newest before they are shuffled.
COMBINED_ROWS, COMBINED_BYTES = 200_000, 32 << 20

# states; workers build them without a session
_ORDER = StructType([StructField("us", LongType()), StructField("id", LongType())])
_WAITING = StructType([*_ORDER.fields, StructField("value", DoubleType())])
_PAST = StructType([StructField("us", LongType()), StructField("value", DoubleType())])


def _after(us: int) -> int:
    """The first millisecond that lies behind a time in microseconds."""
    return us // 1000 + 1


def _timed(df: DataFrame, ts: str, delay: str) -> DataFrame:
    df.sparkSession.conf.set(_PROVIDER, RECOMMENDED[_PROVIDER])
    return df.filter(F.col(ts).isNotNull()).withWatermark(ts, delay).withColumn(_US, F.unix_micros(ts))


def _interval_us(df: DataFrame, interval: str) -> int:
    micros = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {interval}"))
    return df.sparkSession.range(1).select(micros).first()[0]


class _Newest(StatefulProcessor):
    """State: time and id of the newest row. It goes once the watermark has passed it: what comes then is newer."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.order = handle.getValueState("order", _ORDER)

    def handleInputRows(self, key, rows, timerValues):
        known = best = self.order.get() if self.order.exists() else None
        found = None
        for row in rows:
            order = (row[_US], row[_ID])
            if best is None or order > tuple(best):
                best, found = order, row
        if found is not None:
            if known is not None:
                self.handle.deleteTimer(_after(known[0]))
            self.order.update(best)
            self.handle.registerTimer(_after(best[0]))
            yield Row(*self.columns)(*[found[c] for c in self.columns])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.order.clear()
        return iter(())

    def close(self) -> None:
        pass


def _newest_rows(rows: pa.Table, key: str) -> pa.Table:
    """Of each key the newest row, the first of equal ones."""
    codes = rows.column(key).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    ids = rows.column(_ID).fill_null(np.iinfo(np.int64).min).to_numpy()
    order = np.lexsort((-np.arange(len(codes)), ids, rows.column(_US).to_numpy(), codes))
    sorted_codes = codes[order]
    last = np.append(sorted_codes[1:] != sorted_codes[:-1], True)
    return rows.take(pa.array(np.sort(order[last])))


def _combined(key: str):
    """Newest rows of each key among those that a task holds at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if pa.types.is_nested(batch.schema.field(key).type):
                yield batch
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= COMBINED_ROWS or sum(b.nbytes for b in held) >= COMBINED_BYTES:
                yield from _newest_rows(pa.Table.from_batches(held), key).to_batches()
                held = []
        if held and any(b.num_rows for b in held):
            yield from _newest_rows(pa.Table.from_batches(held), key).to_batches()

    return work


def newest_stream(df: DataFrame, key: str, ts: str, row_id: str, delay: str) -> DataFrame:
    """The rows of a stream that became the newest of their key, at most one for a key and micro-batch.

    The last of them is what ``operators.features.latest`` gives by (``ts``, ``row_id``), whatever the
    cut into micro-batches; a repeated row changes nothing. ``row_id`` is an integer and never null.
    State is one number pair for each key seen within ``delay``. Tasks shuffle only what is the newest of
    its key among the rows they hold at a time; the newest time of a micro-batch is among them, so
    the watermark is that of all rows.
    """
    rows = df.filter(F.col(ts).isNotNull()).withColumns({_US: F.unix_micros(ts), _ID: F.col(row_id).cast("long")})
    timed = _timed(rows.mapInArrow(_combined(key), rows.schema), ts, delay)
    # the time travels as a number, which no time zone touches
    columns = [_US if c == ts else c for c in df.columns]
    schema = StructType([timed.schema[c] for c in columns])
    found = timed.groupBy(key).transformWithState(_Newest(columns), schema, "Append", "EventTime")
    return found.select(*[F.timestamp_micros(_US).alias(ts) if c == _US else c for c in columns])


class _Jerks(StatefulProcessor):
    """State: the rows that the watermark hasn't passed, and the last two that it has."""

    def __init__(self, key: str, limit: float, forget: int):
        self.key, self.limit, self.forget = key, limit, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING)
        self.past = handle.getListState("past", _PAST)

    def handleInputRows(self, key, rows, timerValues):
        new = [(r[_US], r[_ID], r[_VALUE]) for r in rows]
        if new:
            self.waiting.appendList(new)
            self.handle.registerTimer(_after(min(us for us, _, _ in new)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.waiting.get(), key=lambda r: r[:2]) if self.waiting.exists() else []
        done = [r for r in waiting if r[0] <= mark]
        left = waiting[len(done) :]
        past = [tuple(r) for r in self.past.get()] if self.past.exists() else []
        if done:
            yield from self._differences(key, past, done)
            past = [*past, *((us, value) for us, _, value in done)][-2:]
            self.past.put(past)
            if left:
                self.waiting.put(left)
            else:
                self.waiting.clear()
        if left:
            self.handle.registerTimer(_after(left[0][0]))
        elif past and past[-1][0] + self.forget <= mark:
            self.past.clear()  # whatever comes now starts anew
        elif past:
            self.handle.registerTimer(_after(past[-1][0] + self.forget))

    def _differences(self, key, past: list[tuple], done: list[tuple]) -> Iterator[Row]:
        made = Row(self.key, _US, _ID, _VALUE, "first_difference", "second_difference")
        rows = [(us, None, value) for us, value in past] + done
        before = None  # the first difference of the row before
        for i in range(1, len(rows)):
            (last, _, one), (us, row_id, value) = rows[i - 1], rows[i]
            known = us - last <= self.forget and one is not None and value is not None
            first = value - one if known else None
            second = first - before if known and before is not None else None
            if i >= len(past) and second is not None and abs(second) > self.limit:  # never true of NaN
                yield made(key[0], us, row_id, value, first, second)
            before = first

    def close(self) -> None:
        pass


def jerk_stream(
    df: DataFrame, key: str, ts: str, row_id: str, value: str, limit: float, delay: str, forget: str
) -> DataFrame:
    """Rows of a stream whose second difference exceeds ``limit``, in the order of (``ts``, ``row_id``).

    A row is given once, when the watermark has passed it. A row more than ``forget`` after the one
    before it starts anew, so what a silent key holds ends by a timer and the rows don't depend on the cut
    into micro-batches: with a long ``forget`` they are those of ``operators.evaluation.jerks``. Null and NaN
    values have no differences. ``row_id`` is an integer and never null. State holds, for each key, the
    rows of the last ``delay`` and two more.
    """
    forget_us = _interval_us(df, forget)
    timed = _timed(df, ts, delay).select(
        key, ts, _US, F.col(row_id).cast("long").alias(_ID), F.col(value).cast("double").alias(_VALUE)
    )
    schema = StructType(
        [
            timed.schema[key],
            *StructType.fromDDL(
                f"{_US} long, {_ID} long, {_VALUE} double, first_difference double, second_difference double"
            ).fields,
        ]
    )
    found = timed.groupBy(key).transformWithState(_Jerks(key, limit, forget_us), schema, "Append", "EventTime")
    return found.select(
        key,
        F.timestamp_micros(_US).alias(ts),
        F.col(_ID).cast(df.schema[row_id].dataType).alias(row_id),
        F.col(_VALUE).alias(value),
        "first_difference",
        "second_difference",
    )
