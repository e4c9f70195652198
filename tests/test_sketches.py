"""Sketches of parts, merged, against the rows."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidelake.operators import profiling, sketches


@pytest.fixture
def rows(spark):
    draw = random.Random(5)
    found = [
        (f"d{i % 7}", 1e9 + draw.gauss(0, 1), draw.randrange(500), None if i % 5 else f"w{i % 90}", i % 2 == 0)
        for i in range(20_000)
    ]
    return spark.createDataFrame(found, "day string, x double, k int, w string, b boolean")


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def test_merged_equals_direct(rows):
    parts = sketches.sketch(rows, "day")
    assert parts.count() == 7 * 4
    found = by_column(sketches.profile_of(sketches.merged(parts)))
    exact = by_column(profiling.profile(rows, ["x", "k", "w", "b"]))
    for name, row in found.items():
        want = exact[name]
        assert (row.parts, row.n, row.nulls, row["min"], row["max"]) == (7, want.n, want.nulls, want["min"], want["max"])
        assert abs(row["distinct"] - want["distinct"]) <= math.ceil(want["distinct"] * sketches.distinct_error())
        if name in "xk":
            assert row["mean"] == pytest.approx(want["mean"], rel=1e-12)
            # a mean of 1e9 doesn't drown a deviation of 1
            assert row["std"] == pytest.approx(want["std"], rel=1e-6)
            values = sorted(r[0] for r in rows.select(name).collect())
            for share, at in zip(sketches.QUANTILES, row["quantiles"]):
                low = sum(v < at for v in values) / len(values)
                high = sum(v <= at for v in values) / len(values)
                assert low - 2 * sketches.rank_error() <= share <= high + 2 * sketches.rank_error()
        else:
            assert row["mean"] is None and row["std"] is None and row["quantiles"] is None


def test_only_new_parts_are_read(spark, rows, tmp_path):
    table, store = str(tmp_path / "t"), str(tmp_path / "s")
    rows.filter("day < 'd5'").write.partitionBy("day").parquet(table)

    def add(**more):
        return sketches.add_parts(spark.read.schema(rows.schema).parquet(table), "day", store, **more)

    assert add() == ["d0", "d1", "d2", "d3", "d4"]
    assert add() == []
    rows.filter("day >= 'd5'").write.mode("append").partitionBy("day").parquet(table)
    assert add() == ["d5", "d6"]
    whole = by_column(sketches.merged(sketches.sketch(rows, "day")))
    stored = by_column(sketches.merged(sketches.stored_sketches(spark, store)))
    assert {c: (r.n, r.parts, r["min"]) for c, r in whole.items()} == {c: (r.n, r.parts, r["min"]) for c, r in stored.items()}
    assert add(again=["d5", "unknown"]) == ["d5"]  # replaces itself
    assert by_column(sketches.merged(sketches.stored_sketches(spark, store)))["x"].n == 20_000


def test_only_wanted_folders_are_scanned(spark, rows, tmp_path):
    rows.write.partitionBy("day").parquet(str(tmp_path / "t"))
    table = spark.read.schema(rows.schema).parquet(str(tmp_path / "t"))
    taken = sketches.sketch(table.filter(sketches._part("day").isin(["d3"])), "day", ["x"])
    plan = taken._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*coalesce\(.*d3", plan)
    assert "ReadSchema: struct<x:double>" in plan


def test_nulls_nan_and_empty(spark):
    rows = spark.createDataFrame(
        [(None, float("nan"), None), ("a", None, None), ("a", 2.0, None), ("a", 2.0, None)], "day string, x double, k int"
    )
    found = by_column(sketches.profile_of(sketches.merged(sketches.sketch(rows, "day"))))
    assert (found["x"].n, found["x"].nulls, found["x"]["distinct"], found["x"]["mean"], found["x"]["std"]) == (4, 2, 1, 2.0, 0.0)
    assert found["x"]["quantiles"] == [2.0] * len(sketches.QUANTILES)
    assert (found["k"].nulls, found["k"]["distinct"], found["k"]["quantiles"]) == (4, 0, None)
    parts = {r.part for r in sketches.sketch(rows, "day").collect()}
    assert parts == {"a", sketches.NO_PART}
    empty = sketches.sketch(rows.limit(0), "day")
    assert empty.count() == 0 and sketches.merged(empty).count() == 0


def test_drift(spark, rows):
    def side(df):
        return sketches.merged(sketches.sketch(df, "day", ["x", "k", "w"]))

    moved = rows.withColumn("x", F.col("x") + 1)
    found = by_column(sketches.drift_of(side(rows), side(moved)))
    exact = profiling.ks_distance(rows, moved, "x").first().ks
    assert abs(found["x"].ks - exact) <= sketches.drift_error()
    assert found["x"].psi > 0.5 and found["k"].psi < 0.01 and found["k"].ks <= sketches.drift_error()
    assert found["w"].ks is None and found["w"].psi is None
