"""The lake's jobs end to end, run again, replayed and with bad input."""

from __future__ import annotations

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.pictures import picture, png, unpng
from tests.test_images import rgb
from tidelake import schema
from tidelake.operators import images, ledger
from tidelake.session import ship_package
from tidelake.sinks.tables import append, persist_raw, replace_by_source
from tidelake.sources.files import file_inventory, read_files, read_images, read_required, with_source
from tidelake.sources.streams import kafka_images, landing_images, landing_pixels, message_image
from tidelake.streaming import jobs


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def lake(tmp_path):
    return lambda name: str(tmp_path / name)


def raw(spark, path, blobs):
    rows = [(None if b is None else bytearray(b),) for b in blobs]
    append(spark.createDataFrame(rows, schema.RAW), path, files=1)


def stage(spark, lake, **more):
    jobs.stage_raw(
        spark, lake("raw"), lake("staged"), lake("ledger"), lake("log"),
        [images.to_rgb(), images.crop("center", 8)], decoder=unpng, **more,
    )


def staged(spark, lake):
    return spark.read.schema(jobs.STAGED).parquet(lake("staged"))


def files(spark, lake):
    return jobs.read_or_empty(spark, lake("ledger"), schema.FILE_LEDGER)


def brightest():
    return lambda batch: np.stack([1 - batch.mean(axis=1), batch.mean(axis=1)], axis=1)


def test_raw_to_exports(spark, lake):
    blobs = [png(picture(i)) for i in range(6)]
    raw(spark, lake("raw"), blobs[:3] + [b"garbage", None])
    raw(spark, lake("raw"), blobs[2:5])
    raw(spark, lake("raw"), [b"broken"])
    spark.createDataFrame([], schema.RAW).write.mode("append").parquet(lake("raw"))
    zero_row_files = file_inventory(spark, lake("raw")).count() - 3
    stage(spark, lake, files_per_batch=2)
    assert staged(spark, lake).filter("valid").count() == 6
    assert [r["error"] for r in staged(spark, lake).filter("not valid").collect()] == ["undecodable"] * 2
    counts = sorted(r["records_processed"] for r in files(spark, lake).collect())
    assert counts == sorted([3, 3, 0] + [0] * zero_row_files)

    # nothing new: nothing happens
    before = {r["file_path"] for r in files(spark, lake).collect()}
    stage(spark, lake, files_per_batch=2)
    assert staged(spark, lake).filter("valid").count() == 6
    assert {r["file_path"] for r in files(spark, lake).collect()} == before

    # one more file: exactly one ledger row
    raw(spark, lake("raw"), [blobs[5]])
    stage(spark, lake)
    assert staged(spark, lake).filter("valid").count() == 7
    assert files(spark, lake).count() == len(before) + 1

    jobs.label_staged(spark, lake("staged"), lake("labels"), lake("label_log"), brightest, size=8)
    labels = spark.read.parquet(lake("labels"))
    assert labels.count() == 7
    assert labels.filter("metadata.source_file is null or mask.height <> 8").count() == 0

    def encoder(image):
        return png(rgb(image))

    for _ in range(2):
        jobs.export_images(spark, lake("staged"), lake("out"), lake("exports"), encoder)
        jobs.export_overlays(spark, lake("labels"), lake("marked"), lake("marks"), encoder)
        names = [f for f in os.listdir(lake("out")) if f.endswith(".jpg")]
        assert len(names) == 6 and all(len(n) == len("img_.jpg") + 32 for n in names)
        assert len([f for f in os.listdir(lake("marked")) if f.startswith("marked_")]) == 6
        for ledger_path in ("exports", "marks"):
            written = spark.read.schema(schema.EXPORT_LEDGER).parquet(lake(ledger_path))
            assert written.count() == 6 and written.filter("image_size > 0").count() == 6

    # a file that exists without a ledger row is neither written nor recorded
    jobs.export_images(spark, lake("staged"), lake("out"), lake("new_ledger"), encoder)
    assert jobs.read_or_empty(spark, lake("new_ledger"), schema.EXPORT_LEDGER).count() == 0


def test_crash_between_data_and_ledger(spark, lake, monkeypatch):
    for i in range(3):
        raw(spark, lake("raw"), [png(picture(10 * i + j)) for j in range(4)])
    real = jobs.record_files
    calls = []

    def fails_once(*args, **more):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost between data and ledger")
        return real(*args, **more)

    monkeypatch.setattr(jobs, "record_files", fails_once)
    with pytest.raises(Exception):
        stage(spark, lake, files_per_batch=1)
    time.sleep(1.1)
    stage(spark, lake, files_per_batch=1)
    valid = staged(spark, lake).filter("valid")
    assert valid.count() == 12 and valid.select("content_hash").distinct().count() == 12
    assert files(spark, lake).filter("records_processed = 4").count() == 3


def test_labels_follow_a_batch_that_is_written_again(spark, lake):
    raw(spark, lake("raw"), [png(picture(i)) for i in range(3)])
    stage(spark, lake)
    jobs.label_staged(spark, lake("staged"), lake("labels"), lake("log2"), brightest, size=8)
    again = staged(spark, lake).filter("row_index > 0").cache()
    again.count()
    from tidelake.sinks.tables import replace_by_source

    replace_by_source(again, lake("staged"), ["batch_id", "valid"])
    jobs.label_staged(spark, lake("staged"), lake("labels"), lake("log2"), brightest, size=8)
    assert spark.read.parquet(lake("labels")).count() == 2


def test_landing_folder_to_raw(spark, lake):
    os.makedirs(lake("landing"))

    def land(name, data):
        with open(os.path.join(lake("landing"), name), "wb") as out:
            out.write(data)

    def run(clean="off"):
        stream = landing_images(spark, lake("landing"), clean).select(
            F.col("content").alias("image"), F.col("path").alias("source_file")
        )
        persist_raw(stream, lake("raw"), lake("raw_log"), available_now=True).awaitTermination()
        return spark.read.parquet(lake("raw"))

    land("A.PNG", png(picture(1)))
    land("b.jpeg", b"garbage")
    land("notes.txt", b"text")
    land("copy.png", png(picture(1)))
    assert run().count() == 3
    assert run().count() == 3
    land("late.jpg", png(picture(2)))
    rows = run()
    assert rows.count() == 4
    assert rows.filter("source_file like '%.txt'").count() == 0
    hashed = rows.withColumn("h", F.md5("image"))
    assert ledger.dedup_content(hashed, "h", ["source_file"]).count() == 3
    with pytest.raises(ValueError):
        landing_images(spark, lake("landing"), "burn")


def test_landing_pixels(spark, lake):
    os.makedirs(lake("landing"))
    with open(lake("landing") + "/a.png", "wb") as out:
        out.write(png(picture(3)))
    persist_raw(
        landing_pixels(spark, lake("landing")), lake("raw"), lake("log"), available_now=True
    ).awaitTermination()
    assert np.array_equal(rgb(spark.read.parquet(lake("raw")).first()["image"]), picture(3))


def test_clean_source_archives_what_was_read(spark, lake):
    os.makedirs(lake("landing"))
    for run in range(3):
        with open(f"{lake('landing')}/{run}.png", "wb") as out:
            out.write(png(picture(run)))
        stream = landing_images(spark, lake("landing"), "archive", lake("done"))
        persist_raw(
            stream.select("content"), lake("raw"), lake("log"), available_now=True
        ).awaitTermination()
    assert spark.read.parquet(lake("raw")).count() == 3
    deadline = time.time() + 20
    while len(os.listdir(lake("landing"))) > 2 and time.time() < deadline:
        time.sleep(0.5)
    assert not os.path.exists(f"{lake('landing')}/0.png")


def test_fixed_and_required_columns(spark, lake):
    raw(spark, lake("raw"), [b"x", b"", None])
    assert read_images(spark, lake("raw")).count() == 3
    listed = [r["file_path"] for r in file_inventory(spark, lake("raw")).collect()]
    assert read_files(spark, listed).count() == 3
    assert read_required(spark, lake("raw"), ["image", "mask_png"]).count() == 0
    assert read_required(spark, lake("raw"), ["image"]).count() == 3
    placed = with_source(read_images(spark, lake("raw")))
    # one spelling of a path in listings and lineage
    assert placed.select("source_file").distinct().first()[0] == listed[0]
    assert sorted(r["row_index"] for r in placed.collect()) == [0, 1, 2]


def test_messages_keep_only_the_value(spark):
    messages = spark.createDataFrame([(None, b"a"), (None, None)], "key binary, value binary")
    assert message_image(messages).columns == ["image"]
    assert message_image(messages, keep_metadata=True).columns == ["image", "key"]


def test_topic_source_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_images(spark, "localhost:1", offsets_per_batch=5)


def test_short_names_can_meet_and_full_names_cannot(spark):
    from tidelake.functions.content import export_name

    rows = spark.createDataFrame([("a" * 12 + "0" * 20,), ("a" * 12 + "1" * 20,)], "h string")
    assert rows.select(export_name(F.col("h"), digits=12)).distinct().count() == 1
    assert rows.select(export_name(F.col("h"))).distinct().count() == 2


def test_checked_append(spark, lake):
    from tidelake.sinks.tables import append_checked

    expected = schema.StructType([
        schema.StructField("a", schema.LongType()), schema.StructField("b", schema.StringType())
    ])
    append_checked(spark.createDataFrame([(1, "x")], "a long, b string"), lake("t"), expected)
    append_checked(spark.createDataFrame([(2,)], "a long"), lake("t"), expected)
    assert spark.read.parquet(lake("t")).schema == expected
    assert spark.read.parquet(lake("t")).count() == 2
    append_checked(spark.createDataFrame([(3,)], "a int"), lake("t"), expected)
    for rows, kind in (([("x",)], "a string"), ([(1, "x", 2)], "a long, b string, c int"), ([(1.5,)], "a double")):
        with pytest.raises(ValueError):
            append_checked(spark.createDataFrame(rows, kind), lake("t"), expected)
    assert spark.read.parquet(lake("t")).count() == 3
    required = schema.StructType([schema.StructField("a", schema.LongType(), False)])
    append_checked(spark.range(2).select(F.col("id").alias("a")), lake("r"), required)
    for kind in ("a long", "b long"):
        with pytest.raises(ValueError):
            append_checked(spark.createDataFrame([(1,)], kind), lake("r"), required)
    assert spark.read.parquet(lake("r")).count() == 2


def test_each_picture_is_labelled_once(spark, lake, tmp_path):
    """A staged batch of many files goes to the model once, and again only when it was written anew."""
    import numpy as np

    seen = tmp_path / "seen"
    seen.mkdir()

    def factory():
        def model(batch):
            import uuid

            (seen / f"{uuid.uuid4().hex}.{len(batch)}").touch()
            return np.zeros((len(batch), 2, 4, 4), np.float32)

        return model

    def calls():
        return sum(int(f.name.rpartition(".")[2]) for f in seen.iterdir())

    image = schema.as_image(F.unhex(F.lit("00" * 48)), F.lit(4), F.lit(4), F.lit(3)).alias("image")
    rows = spark.range(240).repartition(24, "id").select(
        image, F.md5(F.col("id").cast("string")).alias("content_hash"), F.lit("f").alias("source_file"),
        F.col("id").alias("row_index"), F.lit(None).cast("string").alias("error"), F.lit("b1").alias("batch_id"), F.lit(True).alias("valid"),
    )
    for expected in (240, 240, 480):
        if expected == 480 or not calls():
            replace_by_source(rows, lake("staged"), ["batch_id", "valid"])
        jobs.label_staged(spark, lake("staged"), lake("labelled"), lake("log"), factory, size=None, files_per_batch=5)
        assert calls() == expected
    assert spark.read.parquet(lake("labelled")).count() == 240


def test_paths_with_blanks_are_spelled_alike(spark, lake):
    """One ledger row per file, a file without rows included."""
    from tidelake.sources.files import file_inventory, with_source

    folder = lake("a b%20c+d")
    spark.range(3).write.parquet(f"{folder}/x=1 2")
    spark.range(0).coalesce(1).write.parquet(f"{folder}/x=3")
    listed = {r.file_path for r in file_inventory(spark, f"{folder}/*").collect()}
    read = {r.source_file for r in with_source(spark.read.parquet(folder)).collect()}
    assert read and read <= listed


def test_failed_exports_are_kept_with_their_reason(spark, lake, tmp_path):
    image = schema.as_image(F.unhex(F.lit("00" * 12)), F.lit(2), F.lit(2), F.lit(3)).alias("image")
    rows = spark.range(6).select(
        image, F.md5(F.col("id").cast("string")).alias("content_hash"), F.col("id").cast("string").alias("source_file"),
        F.col("id").alias("row_index"), F.lit(None).cast("string").alias("error"), F.lit("b1").alias("batch_id"), F.lit(True).alias("valid"),
    )
    replace_by_source(rows, lake("staged"), ["batch_id", "valid"])

    def never(picture):
        raise ValueError("no codec")

    jobs.export_images(spark, lake("staged"), str(tmp_path / "out"), lake("exports"), never)
    assert {r.error for r in spark.read.parquet(lake("exports_failed")).collect()} == {"ValueError: no codec"}
    jobs.export_images(spark, lake("staged"), str(tmp_path / "out"), lake("exports"), lambda p: b"x")
    jobs.export_images(spark, lake("staged"), str(tmp_path / "out"), lake("exports"), lambda p: b"x")
    assert spark.read.parquet(lake("exports")).count() == 6


def test_small_batches_share_a_pass(spark, lake, monkeypatch):
    passes, real = [], jobs._standardised
    monkeypatch.setattr(jobs, "_standardised", lambda *a, **k: passes.append(1) or real(*a, **k))
    for i in range(7):
        raw(spark, lake("raw"), [png(picture(i))])
    stage(spark, lake, files_per_batch=2)
    assert len(passes) == 1
    batches = staged(spark, lake).groupBy("batch_id").count().collect()
    assert sorted(b["count"] for b in batches) == [1, 2, 2, 2]
    assert sorted(b["count"] for b in files(spark, lake).filter("records_processed > 0").groupBy("batch_id").count().collect()) == [1, 2, 2, 2]


def test_files_of_a_content_stream_grow_with_the_text(spark, sf, monkeypatch):
    from tidelake.plans import stream_queries

    real, paths = stream_queries.table_stream, []
    monkeypatch.setattr(stream_queries, "table_stream", lambda s, path, *a, **k: paths.append(path) or real(s, path, *a, **k))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr(stream_queries, "BYTES_PER_FILE", docs.agg(F.sum(F.octet_length("text"))).first()[0] // 6)
    found = stream_queries.stream_new_content(spark, sf)
    assert file_inventory(spark, paths[0]).count() >= 6
    assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in docs.select(F.md5("text")).distinct().collect())
