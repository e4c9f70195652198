"""Big keys: the split path must give what the plain window gives."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from tidelake.operators import business, evaluation, features, labelling, ledger, quality, review, skew
from tests.oracle import rows_of

TINY = 50


@pytest.fixture(scope="module")
def events(spark):
    """Half of all rows belong to user 1, a third of those to one instant."""
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    busy = F.when(F.col("event_id") % 2 == 0, 1).otherwise(F.col("user_id"))
    crowded = F.when(F.col("event_id") % 6 == 0, F.lit("2024-01-10").cast("timestamp_ntz"))
    return rows.withColumns({"user_id": busy, "ts": F.coalesce(crowded, "ts")}).drop("props").cache()


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    left, right = rows_of(a.columns, a.collect()), rows_of(b.columns, b.collect())
    assert len(left) == len(right)
    assert left == right


@pytest.mark.parametrize("keys", [["user_id"], []])
def test_running_total(events, keys):
    order = ["ts", "event_id"]
    split = skew.running_total(events, keys, order, {"total": F.lit(1).cast("long")}, TINY)
    window = Window.partitionBy(*keys).orderBy(*order)
    same(split, events.withColumn("total", F.row_number().over(window).cast("long")))


def test_big_keys_are_split(events):
    plain, big, chunks = skew.split_by_size(events, ["user_id"], TINY)
    assert chunks > 5
    assert big.select("user_id").distinct().count() < 10
    assert plain.groupBy("user_id").count().agg(F.max("count")).first()[0] <= TINY
    assert plain.count() + big.count() == events.count()
    assert skew.split_by_size(events, ["user_id"])[1] is None


def test_null_keys_survive(events):
    rows = events.withColumn("user_id", F.when(F.col("user_id") != 1, F.col("user_id")))
    counted = skew.numbered(rows, ["user_id"], ["ts", "event_id"], "at", TINY)
    assert counted.count() == rows.count()
    assert counted.filter("user_id is null").agg(F.max("at")).first()[0] == rows.filter(
        "user_id is null"
    ).count()


def test_carried(events):
    marked = events.withColumn("mark", F.when(F.col("event_id") % 9 == 0, F.col("event_id")))
    window = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    split = skew.carried(marked, ["user_id"], ["ts", "event_id"], "mark", "last", TINY)
    same(split, marked.withColumn("last", F.last("mark", ignorenulls=True).over(window)))


@pytest.mark.parametrize("before,after", [(1, 0), (3, 2), (0, 7), (120, 90)])
def test_neighbours(events, before, after):
    order = ["ts", "event_id"]

    def nearby(w):
        return F.sum("event_id").over(w.rowsBetween(-before, after))

    split = skew.neighbours(events, ["user_id"], order, before, after, {"s": nearby}, TINY)
    same(split, events.withColumn("s", nearby(Window.partitionBy("user_id").orderBy(*order))))


def test_quantiles(events):
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    split = skew.quantiles(events, "value", ["user_id"], probs, TINY)
    exact = events.groupBy("user_id").agg(*[F.percentile("value", p).alias(n) for n, p in probs.items()])

    same(split, exact)
    whole = skew.quantiles(events, "value", [], {"m": 0.5}, TINY).first()["m"]
    assert whole == pytest.approx(events.agg(F.percentile("value", 0.5)).first()[0])


def test_operators_agree_with_their_plain_path(events):
    def both(make):
        same(make(TINY), make(skew.ROWS_PER_TASK))

    labels = events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id", "value")
    views = events.filter("event_type = 'view'").select("user_id", "ts", "event_id", "value")
    both(lambda n: features.as_of_join(labels, views, "user_id", "ts", "event_id", "event_id", n))
    both(lambda n: evaluation.jerks(events, "user_id", ["ts", "event_id"], "value", 10.0, n))
    both(lambda n: review.audit_changes(events, "user_id", ["ts", "event_id"], ["event_type"], n))
    both(
        lambda n: labelling.smooth(
            events, "user_id", ["ts", "event_id"], "value", "event_type", 2, 5, n
        ).withColumn("smooth_value", F.round("smooth_value", 6))
    )
    both(lambda n: quality.clean_outliers(events, "value", ["event_type"], 1.5, n))
    both(lambda n: business.downtime(events, "user_id", "ts", 600, n))
    files = events.select(F.col("event_id").cast("string").alias("file_path"))
    both(lambda n: ledger.file_parts(files, "file_path", 10, n))


@pytest.mark.parametrize("rows_per_task", [1, skew.ROWS_PER_TASK])
def test_as_of_ties_and_gaps(spark, rows_per_task):
    """No earlier feature, a feature at the same instant, two features at one instant."""
    labels = spark.createDataFrame([("u", 5, 1), ("u", 10, 2), ("u", 1, 3), ("v", 9, 4)], "k string, t int, id int")
    features_at = [("u", 4, 7), ("u", 10, 8), ("u", 10, 9), ("u", 11, 10), ("v", 10, 11)]
    known = spark.createDataFrame(features_at, "k string, t int, id int")
    joined = features.as_of_join(labels, known, "k", "t", "id", "id", rows_per_task)
    assert {r["id"]: r["f_id"] for r in joined.collect()} == {1: 7, 2: 9, 3: None, 4: None}


def test_downtime_is_session_window(spark):
    """A pause of exactly the gap, just below and just above it."""
    seconds = [0, 10, 20.000001, 29.999999, 40, 50.000002, 70]
    rows = spark.createDataFrame([("u", float(s)) for s in seconds], "unit string, s double").select(
        "unit", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")).alias("ts")
    )
    mine = business.downtime(rows, "unit", "ts", 10).select("session_start", "events")
    spark_own = rows.groupBy("unit", F.session_window("ts", "10 seconds").alias("w")).agg(
        F.count("*").alias("events")
    ).select(F.col("w.start").alias("session_start"), "events")
    same(mine, spark_own)


def test_hot_content_is_counted_in_the_tasks(spark):
    rows = spark.range(0, 3000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("h")
    )
    first = ledger.first_occurrence(rows, "h", ["id"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert first.filter("h = 'hot'").first().asDict() == {"h": "hot", "id": 0, "copies": 1000}
    assert ledger.dedup_content(rows, "h", ["id"]).count() == 2001


@pytest.mark.parametrize("small_rows", [0, 150, 10_000])
def test_dedup_rows_whatever_is_broadcast(spark, small_rows):
    """Both lists long, only the copies short, both short; null contents never stay."""
    h = F.when(F.col("id") % 10 == 0, F.lit("hot")).when(F.col("id") != 7, F.col("id").cast("string"))
    rows = spark.range(0, 1000, 1, 4).select("id", h.alias("h"), F.lit("payload").alias("image"))
    kept = ledger.dedup_content(rows, "h", ["id"], small_rows)
    assert sorted(r["id"] for r in kept.collect()) == [0] + [i for i in range(1000) if i % 10 and i != 7]


def test_top_per_group_limits_before_the_shuffle(events):
    top = skew.top_per_group(events, ["event_type"], ["value", "event_id"], 3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 15
    spark = events.sparkSession
    spark.conf.set(skew.GROUP_LIMIT, 2)
    try:
        same(top, skew.top_per_group(events, ["event_type"], ["value", "event_id"], 3, TINY))
    finally:
        spark.conf.unset(skew.GROUP_LIMIT)
