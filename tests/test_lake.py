"""Jobs over many batches, bad files and long ledgers; compaction, lineage and tiers."""

from __future__ import annotations

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.pictures import picture, png, unpng
from tests.test_images import rgb
from tidelake import schema
from tidelake.operators import images, known, lifecycle
from tidelake.session import ship_package
from tidelake.sinks import compaction, folders
from tidelake.sinks.tables import append, replace_by_source
from tidelake.sources.files import file_inventory
from tidelake.streaming import jobs


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def lake(tmp_path):
    return lambda name: str(tmp_path / name)


def staged_rows(spark, ids, batch=None):
    image = schema.as_image(F.unhex(F.lit("00" * 48)), F.lit(4), F.lit(4), F.lit(3)).alias("image")
    name = F.lit(batch) if batch else F.concat(F.lit("b"), F.col("id").cast("string"))
    return spark.createDataFrame([(i,) for i in ids], "id long").select(
        image, F.md5(F.col("id").cast("string")).alias("content_hash"), F.col("id").cast("string").alias("source_file"),
        F.col("id").alias("row_index"), F.lit(None).cast("string").alias("error"), name.alias("batch_id"), F.lit(True).alias("valid"),
    )


def test_export_reads_new_batches_only(spark, lake, monkeypatch):
    key = ["batch_id", "valid"]
    replace_by_source(staged_rows(spark, range(100)).coalesce(1), lake("staged"), key)
    read = []
    real = jobs._batches

    def spy(spark, path, names, columns=None):
        rows = real(spark, path, names, columns)
        read.append((sorted(names), {re.search("batch_id=([^/]+)", f)[1] for f in rows.inputFiles()}))
        return rows

    monkeypatch.setattr(jobs, "_batches", spy)

    def export(encoder=lambda p: b"x"):
        read.clear()
        jobs.export_images(spark, lake("staged"), lake("out"), lake("ledger"), encoder, batches_per_export=60)
        return spark.read.parquet(lake("ledger")).count()

    assert export() == 100 and len(read) == 2
    replace_by_source(staged_rows(spark, [500, 7], "new"), lake("staged"), key)
    assert export() == 101 and read == [(["new"], {"new"})]  # 7 was exported before
    assert export() == 101 and read == []
    # a batch with a failure is not done
    replace_by_source(staged_rows(spark, [600], "bad"), lake("staged"), key)

    def never(p):
        raise ValueError("no codec")

    assert export(never) == 101 and export() == 102 and read == [(["bad"], {"bad"})]
    log = spark.read.parquet(lake("ledger_versions"))
    assert log.filter("last_batch is null").count() == 0 and log.select("batch_id").distinct().count() == 102
    assert len(os.listdir(lake("out"))) == 102


def raw(spark, path, count):
    for i in range(count):
        append(spark.createDataFrame([(bytearray(png(picture(i))),)], schema.RAW), f"{path}/f={i:02d}", files=1)


def test_one_poisonous_file_of_fifty(spark, lake):
    raw(spark, lake("raw"), 50)
    victim = next(f"{lake('raw')}/f=23/{n}" for n in os.listdir(lake("raw") + "/f=23") if n.endswith(".parquet"))
    with open(victim, "wb") as out:
        out.write(b"no parquet at all")
    os.remove(os.path.join(os.path.dirname(victim), f".{os.path.basename(victim)}.crc"))

    def run():
        jobs.stage_files(
            spark, lake("raw") + "/*", lake("staged"), lake("ledger"), lake("attempts"),
            [images.to_rgb()], decoder=unpng, files_per_batch=25, max_attempts=2,
        )
        return (
            spark.read.schema(schema.FILE_LEDGER).parquet(lake("ledger")).count(),
            jobs.read_or_empty(spark, lake("attempts"), jobs.ATTEMPTS).count(),
            jobs.read_or_empty(spark, lake("attempts_dead"), jobs.DEAD).collect(),
        )

    assert run() == (49, 1, [])
    files, attempts, dead = run()
    assert (files, attempts) == (49, 2) and [(d.file_path.split("/")[-2], d.attempts) for d in dead] == [("f=23", 2)]
    assert run()[:2] == (49, 2)  # left alone now
    staged = spark.read.parquet(lake("staged"))
    assert staged.count() == 49 and staged.select("content_hash").distinct().count() == 49


def test_interrupted_batch_keeps_its_name(spark, lake, monkeypatch):
    raw(spark, lake("raw"), 4)
    real, calls = jobs.record_files, []

    def lost(*args, **more):
        calls.append(1)
        if len(calls) == 1:
            raise KeyboardInterrupt("the driver is gone between data and ledger")
        return real(*args, **more)

    monkeypatch.setattr(jobs, "record_files", lost)
    args = (spark, lake("raw") + "/*", lake("staged"), lake("ledger"), lake("attempts"), [images.to_rgb()], unpng)
    with pytest.raises(KeyboardInterrupt):
        jobs.stage_files(*args)
    append(spark.createDataFrame([(bytearray(png(picture(77))),)], schema.RAW), lake("raw") + "/f=00", files=1)
    jobs.stage_files(*args)
    rows = spark.read.parquet(lake("staged"))
    assert rows.count() == 5 and rows.select("content_hash").distinct().count() == 5


def test_encoded_staging_is_one_pass(spark, lake):
    raw(spark, lake("raw"), 3)
    append(spark.createDataFrame([(bytearray(b"garbage"),)], schema.RAW), lake("raw") + "/f=00", files=1)
    rows = spark.read.schema(schema.RAW).parquet(lake("raw") + "/*").withColumn("content_hash", F.md5("image"))
    done = images.standardise_images(rows, [images.to_rgb()], decoder=unpng, encoder=png)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and done.schema["image"].dataType.simpleString() == "binary"
    args = (spark, lake("raw") + "/*", lake("staged"), lake("ledger"), lake("log"), [images.to_rgb()])
    jobs.stage_raw(*args, decoder=unpng, encoder=png)
    staged = spark.read.schema(jobs.staged_schema(True)).parquet(lake("staged"))
    assert sorted(r.error or "" for r in staged.collect()) == ["", "", "", "undecodable"]
    assert {bytes(r.image) for r in staged.filter("valid").collect()} == {png(unpng(png(picture(i)))) for i in range(3)}
    jobs.export_images(spark, lake("staged"), lake("out"), lake("exports"), None)
    assert len([n for n in os.listdir(lake("out")) if n.endswith(".jpg")]) == 3

    def factory():
        return lambda batch: np.stack([1 - batch.mean(axis=1), batch.mean(axis=1)], axis=1)

    jobs.label_staged(spark, lake("staged"), lake("labels"), lake("label_log"), factory, size=8, decoder=unpng)
    assert spark.read.parquet(lake("labels")).filter("mask.height = 8").count() == 3


def test_model_failures_stay_with_their_pictures(spark):
    def as_row(i):
        p = np.full((4, 4, 3), 10 * i, np.uint8)
        return (i, p.tobytes())

    rows = spark.createDataFrame([as_row(i) for i in range(10)], "id long, data binary").coalesce(1)
    rows = rows.select("id", schema.as_image(F.col("data"), F.lit(4), F.lit(4), F.lit(3)).alias("image"))

    def factory():
        def model(batch):
            if (batch > 0.34).any():
                raise RuntimeError("too bright")
            return np.stack([batch[:, 0], batch[:, 1]], axis=1)

        return model

    found = {r.id: r for r in images.label_images(rows, factory, size=None).collect()}
    assert {i for i, r in found.items() if r.error} == {9}
    assert found[9].error == "RuntimeError: too bright" and found[9].mask is None and found[8].mask.height == 4
    odd = images.label_images(rows, lambda: lambda batch: np.zeros(3), size=None).collect()
    assert all(r.error.startswith("ValueError: the model gave scores") for r in odd)


def test_labels_that_fail_the_second_time_go(spark, lake):
    replace_by_source(staged_rows(spark, range(3), "b"), lake("staged"), ["batch_id", "valid"])

    def fails():
        def model(batch):
            raise ValueError("no")

        return model

    def works():
        return lambda batch: batch

    for factory, labels, failures in ((works, 3, 0), (fails, 0, 3), (works, 3, 0)):
        replace_by_source(staged_rows(spark, range(3), "b"), lake("staged"), ["batch_id", "valid"])
        jobs.label_staged(spark, lake("staged"), lake("labels"), lake("log"), factory, size=None)
        columns = "batch_id string, content_hash string"
        for table, count in (("labels", labels), ("labels_failed", failures)):
            there = folders.exists(spark, f"{lake(table)}/batch_id=b")
            assert (spark.read.schema(columns).parquet(lake(table)).count() if there else 0) == count


def test_ledger_by_prefix(spark, lake, monkeypatch):
    def digests(ids):
        return spark.createDataFrame([(None if i is None else i,) for i in ids], "i long").select(F.md5(F.col("i").cast("string")).alias("content_hash"), "i")

    assert known.unseen(digests([1, 2, 2, None]), lake("ledger")).count() == 4
    for batch in range(3):
        known.remember(digests([*range(1000 * batch, 1000 * batch + 900), None]), lake("ledger"), f"b{batch}")
    known.remember(digests(range(2000, 2900)), lake("ledger"), "b2")  # again: replaces itself
    monkeypatch.setattr(known, "LOOKED_UP", 300)
    asked = [*range(3100), 5, 950, None, None]
    left = known.unseen(digests(asked), lake("ledger"))
    assert sorted((r.i for r in left.collect()), key=repr) == sorted((i for i in asked if i is None or i >= 2900 or i % 1000 >= 900), key=repr)
    assert spark.read.parquet(lake("ledger") + "/digests").count() == 2700
    # looking up doesn't shuffle the ledger, and reads the folders of the prefixes that are asked for
    plans = []
    real = known.stored

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(known, "stored", seen)
    known.unseen(digests([1, 5000]), lake("ledger")).count()
    look_up = plans[-1].split("HashAggregate")[-1]  # the scan and what stands below the first aggregate
    assert "BroadcastHashJoin" in look_up and "PartitionFilters: [isnotnull(prefix" in look_up
    assert "Exchange hashpartitioning" not in look_up


def test_compaction_keeps_contents(spark, lake, monkeypatch):
    rows = spark.range(4000).select("id", F.md5(F.col("id").cast("string")).alias("h"))
    rows.repartition(30).write.parquet(lake("t"))
    rows.filter("id < 2000").withColumn("id", F.col("id") + 10_000).coalesce(1).write.mode("append").parquet(lake("t"))

    def contents():
        found = compaction.read_compacted(spark, lake("t"), rows.schema)
        return found.agg(F.count("*"), F.sum("id"), F.countDistinct("id", "h")).first()

    before = contents()
    target = 20 * file_inventory(spark, lake("t")).agg(F.min("file_size")).first()[0]

    real = folders.move_new
    monkeypatch.setattr(folders, "move_new", lambda *a: (_ for _ in ()).throw(OSError("lost before the swap")))
    with pytest.raises(OSError):
        compaction.compact(spark, lake("t"), rows.schema, target)
    assert contents() == before
    monkeypatch.setattr(folders, "move_new", real)
    assert compaction.compact(spark, lake("t"), rows.schema, target) >= 30
    assert contents() == before
    sizes = [r.file_size for r in compaction.live_files(spark, lake("t")).collect()]
    assert len(sizes) <= 5 and max(sizes) < 2.5 * target
    # a stream goes on appending, and the next compaction takes that in
    rows.withColumn("id", F.col("id") + 50_000).repartition(10).write.mode("append").parquet(lake("t"))
    grown = contents()
    assert grown[0] == before[0] + 4000
    assert compaction.compact(spark, lake("t"), rows.schema, target) >= 10
    assert contents() == grown
    assert compaction.remove_replaced(spark, lake("t")) >= 40 and contents() == grown
    assert compaction.remove_replaced(spark, lake("t")) == 0
    # two at once: the slower one changes nothing
    rows.withColumn("id", F.col("id") + 90_000).repartition(10).write.mode("append").parquet(lake("t"))
    grown = contents()
    monkeypatch.setattr(folders, "move_new", lambda *a: False)
    with pytest.raises(RuntimeError):
        compaction.compact(spark, lake("t"), rows.schema, target)
    assert contents() == grown


def brute_ancestors(edges, start):
    depth, frontier = {n: 0 for n in start}, list(start)
    while frontier:
        nearer = frontier
        frontier = []
        for node in nearer:
            for s, t in edges:
                if t == node and s not in depth:
                    depth[s] = depth[node] + 1
                    frontier.append(s)
    return {n: d for n, d in depth.items() if d > 0}


def ancestors(spark, edges, start):
    found = lifecycle.lineage(
        spark.createDataFrame(edges, "source string, target string"), spark.createDataFrame([(s,) for s in start], "node string")
    )
    return {r.node: r.depth for r in found.collect()}


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    real = lifecycle.stored
    monkeypatch.setattr(lifecycle, "stored", lambda df: rounds.append("depth" in df.columns) or real(df))
    chain = spark.range(10_000).select(F.col("id").cast("string").alias("source"), (F.col("id") + 1).cast("string").alias("target"))
    found = lifecycle.lineage(chain, spark.createDataFrame([("10000",)], "node string"))
    assert found.agg(F.count("*"), F.min("depth"), F.max("depth"), F.countDistinct("depth")).first()[:] == (10_000, 1, 10_000, 10_000)
    assert sum(rounds) - 1 <= 15


@pytest.mark.parametrize("limit", [4, 0])
def test_lineage_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(lifecycle, "POINTERS_PER_EDGE", limit)
    if not limit:
        monkeypatch.setattr(lifecycle, "SMALL_ROWS", 0)
    rng = random.Random(limit)
    edges = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(90)] + [(None, "n1"), ("n1", None), ("n2", "n2")]
    edges += edges[:5]
    start = ["n1", "n7", "n1"]
    plain = [(s, t) for s, t in edges if s and t]
    assert ancestors(spark, edges, start) == brute_ancestors(plain, set(start))
    assert ancestors(spark, [], start) == {}


def test_tiers_move_once(spark, lake):
    rows = spark.range(100).select("id", F.date_sub(F.lit("2024-06-01").cast("date"), F.col("id").cast("int")).cast("timestamp").alias("ts"))
    limits = {"hot": 10, "cold": 40, "archive": 80}

    def day(text):
        return F.lit(text).cast("date")

    lifecycle.write_tiers(rows, lake("t"), "ts", "first write", day("2024-06-01"), limits)
    lifecycle.write_tiers(rows.filter("id < 5"), lake("t"), "ts", "second", day("2024-06-01"), limits)

    def run(name, when):
        found = lifecycle.move_tiers(spark, lake("t"), lake("audit"), name, day(when), rows.schema, limits)
        return {(r.from_tier, r.tier, r.action): r.rows for r in found.collect()}

    assert run("r0", "2024-06-01") == {}
    whole = rows.unionByName(rows.filter("id < 5"))
    plan = lifecycle.retention_plan(whole, "ts", day("2024-06-01"), day("2024-06-21"), limits)
    want = {(r.from_tier, r.tier, r.action): r.rows for r in plan.filter("action <> 'keep' and from_tier <> 'expired'").collect()}
    assert run("r1", "2024-06-21") == want and len(want) >= 3
    assert run("r2", "2024-06-21") == {}
    left = spark.read.parquet(lake("t"))
    alive = left.filter("tier <> 'expired'")
    assert alive.count() == whole.filter(F.date_diff(day("2024-06-21"), F.col("ts")) <= 80).count()
    assert alive.filter(lifecycle.tier(F.col("ts"), day("2024-06-21"), limits) != F.col("tier")).count() == 0


def test_files_that_fail_cost_no_passes(spark, lake, monkeypatch):
    for i in range(12):
        append(spark.createDataFrame([(bytearray(png(picture(i))),)] * 3, schema.RAW), f"{lake('raw')}/f={i:02d}", files=1)
    grey = [int(picture(i)[0, 0, 0]) for i in range(12)]
    spoilt, marks = {2, 3, 7}, {grey[i] for i in (2, 3, 7)}

    def kernel(stack, draws):
        if any(int(p[0, 0, 0]) in marks for p in stack):
            raise ValueError("spoilt")
        return stack

    assert {i for i in range(12) if grey[i] in marks} == spoilt
    passes, real = [], jobs._standardised
    monkeypatch.setattr(jobs, "_standardised", lambda *a, **k: passes.append(1) or real(*a, **k))
    for run in (1, 2, 3):
        jobs.stage_files(
            spark, lake("raw") + "/*", lake("staged"), lake("ledger"), lake("attempts"),
            [images.Step("spoilt", kernel)], decoder=unpng, files_per_batch=2, max_attempts=3,
        )
        assert len(passes) == run
        assert spark.read.schema(schema.FILE_LEDGER).parquet(lake("ledger")).agg(F.sum("records_processed")).first()[0] == 27
        assert spark.read.parquet(lake("staged")).count() == 27
    dead = jobs.read_or_empty(spark, lake("attempts_dead"), jobs.DEAD).collect()
    assert {(int(d.file_path.split("/f=")[1][:2]), d.attempts, d.error) for d in dead} == {(i, 3, "ValueError: spoilt") for i in spoilt}


def shortened(monkeypatch):
    monkeypatch.setattr(lifecycle, "SHORT_EDGES", 20)
    used, real = [], lifecycle._along_chains
    monkeypatch.setattr(lifecycle, "_along_chains", lambda *a: used.append(real(*a)) or used[-1])
    return used


def test_chains_are_shortened_first(spark, monkeypatch):
    used, written, real = shortened(monkeypatch), [], lifecycle.stored
    monkeypatch.setattr(lifecycle, "stored", lambda df: (found := real(df), written.append(found.count()))[0])
    chain = spark.range(1000).select(F.col("id").cast("string").alias("source"), (F.col("id") + 1).cast("string").alias("target"))
    found = {r.node: r.depth for r in lifecycle.lineage(chain, spark.createDataFrame([("1000",)], "node string")).collect()}
    assert found == {str(i): 1000 - i for i in range(1000)} and used[0] is not None
    assert sum(written) < 12 * 1000  # doubling alone writes some 15,000


def test_shortened_lineage_against_brute_force(spark, monkeypatch):
    used = shortened(monkeypatch)
    rng = random.Random(5)
    # chains of several lengths between a few artefacts, a cycle, a loop, and repeated edges
    edges = []
    for chain in range(14):
        nodes = [f"h{rng.randrange(6)}", *[f"c{chain}_{i}" for i in range(rng.randrange(1, 9))], f"h{rng.randrange(6)}"]
        edges += list(zip(nodes, nodes[1:]))
    edges += [("z0", "z1"), ("z1", "z2"), ("z2", "z0"), ("c1_0", "c1_0"), ("h2", "h2")] + edges[:4]
    for start in (["h0"], ["h3", "c2_0", "z1"], ["nowhere"]):
        assert ancestors(spark, edges, start) == brute_ancestors(edges, set(start))
    assert used and used[0] is not None


def test_landing_folder_is_read_in_parts(spark, sf, monkeypatch):
    from tidelake.plans import lake_queries

    real, written = lake_queries.persist_raw, []
    monkeypatch.setattr(lake_queries, "persist_raw", lambda stream, path, *a, **k: written.append(path) or real(stream, path, *a, **k))
    monkeypatch.setattr(lake_queries, "FILES_PER_STREAM", 80)
    found = lake_queries.landing_folder(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(written) == 2 * len(set(written)) == 2 * -(-docs.count() // 80) > 2
    assert all(file_inventory(spark, path).count() <= 16 for path in set(written))
    assert all((r.files, r.runs) == (1, 1) for r in found)
    assert sorted(r.content_hash for r in found) == sorted(r[0] for r in docs.select(F.md5("text")).distinct().collect())
