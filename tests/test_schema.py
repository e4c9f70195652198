from __future__ import annotations

import pytest
from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidelake.schema import compare_schemas, evolve


def struct(**fields):
    return StructType([StructField(n, t() if isinstance(t, type) else t[0](), isinstance(t, type)) for n, t in fields.items()])


@pytest.mark.parametrize(
    "old,new,expected",
    [
        (dict(a=IntegerType), dict(a=IntegerType), []),
        (dict(a=IntegerType), dict(a=LongType), [("a", "widened", "compatible")]),
        (dict(a=LongType), dict(a=IntegerType), [("a", "retyped", "breaking")]),
        (dict(a=LongType), dict(a=FloatType), [("a", "retyped", "breaking")]),
        (dict(a=LongType), dict(a=DoubleType), [("a", "retyped", "breaking")]),
        (dict(a=IntegerType), dict(a=DoubleType), [("a", "widened", "compatible")]),
        (dict(a=LongType), dict(a=StringType), [("a", "retyped", "breaking")]),
        (dict(), dict(a=StringType), [("a", "added", "compatible")]),
        (dict(), dict(a=(StringType,)), [("a", "added", "breaking")]),
        (dict(a=StringType), dict(), [("a", "removed", "compatible")]),
        (dict(a=(StringType,)), dict(), [("a", "removed", "breaking")]),
        (dict(a=StringType), dict(a=(StringType,)), [("a", "made required", "breaking")]),
        (dict(a=(StringType,)), dict(a=StringType), [("a", "made optional", "compatible")]),
    ],
)
def test_compare(old, new, expected):
    assert compare_schemas(struct(**old), struct(**new)) == expected


def test_evolve(spark):
    old = spark.createDataFrame([(1,)], "a int")
    new = spark.createDataFrame([(2.5, "x")], "a double, b string")
    rows = evolve(old, new).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1.0, None), (2.5, "x")]
    with pytest.raises(ValueError):
        evolve(old, spark.createDataFrame([("x",)], "a string"))
