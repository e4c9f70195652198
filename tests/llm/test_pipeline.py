"""Pipeline stages with shared and null ids, null texts and columns that bear the operators' names."""

from __future__ import annotations

import corpus_pipeline as stages
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import SCHEMA, prose

CLASHING = ["score", "cut_bytes", "cut_spans", "kept_cut_bytes", "document", "key", "set", "was_null"]


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(f"my {c}") for c in CLASHING})

    return make


def kept(result, rows=None):
    assert all(r[c] == f"my {c}" for r in result.collect() for c in CLASHING)
    return sorted(((r.doc_id, r.text) for r in result.collect()), key=repr)


def test_near_copies(spark, sf, table):
    base, other, alone = prose(1, 120), prose(9, 90), prose(77, 80)
    near = base.split(" ")
    near[60] = "changed"
    near = " ".join(near)
    rows = [(5, near), (5, other), (1, base), (None, base), (None, near), (None, alone), (7, None), (7, None), (8, "")]
    left = stages.keep_one_of_near_copies(spark, table(rows), sf)
    assert kept(left) == sorted([(1, base), (5, other), (None, alone), (7, None), (8, "")], key=repr)


def test_passages(spark, sf, table):
    passage, han = prose(500, 220), "".join(chr(0x4E00 + (i * i * 7919 + i * 31) % 5000) for i in range(600))
    rows = [(None, prose(30, 40) + " " + passage), (None, prose(31, 50) + " " + passage), (3, prose(33, 60) + " " + passage),
            (3, passage + " " + prose(34, 60)), (9, han), (10, "前置" + han + "後" * 30), (11, None), (12, " ")]
    left = kept(stages.cut_repeated_passages(spark, table(rows), sf))
    sizes = {}
    for doc, text in left:
        sizes.setdefault(doc, []).append(len(text or ""))
    whole = max(len(t) for d, t in rows if d == 3)
    assert sorted(sizes[3])[0] < 600 and max(sizes[3]) >= whole - 700  # one of them stays whole
    assert sum(n < 700 for d in (3, None) for n in sizes[d]) == 3
    assert sizes[9] == [600] and sizes[10][0] < 250
    assert (11, None) in left and (12, " ") in left


def test_leaks_and_tokens(spark, sf, table):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    rows = [(None, f"x y {item} z"), (None, "clean text"), (4, item), (4, "clean"), (5, None)]
    left = stages.drop_benchmark_leaks(spark, table(rows), sf)
    assert kept(left) == sorted([(None, "clean text"), (4, "clean"), (5, None)], key=repr)
    coded = stages.encode_tokens(spark, left, sf)
    assert kept(coded) == kept(left)
    assert all(r.n_tokens == len(r.ids) and (r.n_tokens > 0) == (r.text is not None) for r in coded.collect())


def test_quality_keeps_columns_and_empty_tables_pass(spark, sf, table):
    good = stages.keep_good(spark, table([(1, prose(1, 80)), (2, None)]), sf)
    kept(good)
    for _, stage in stages.STAGES:
        assert stage(spark, table([]), sf).count() == 0
