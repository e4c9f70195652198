from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.pictures import picture, png, unpng
from tidelake.functions import kernels
from tidelake.functions.content import content_hash
from tidelake.operators import images
from tidelake.schema import IMAGE
from tidelake.session import ship_package
from tidelake.sources.files import file_inventory, image_pixels


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def rows_of(spark, pictures):
    """Table of RGB pictures (None for a broken one)."""
    rows = []
    for i, p in enumerate(pictures):
        if p is None:
            rows.append((i, f"h{i}", (None, -1, -1, -1, -1, bytearray())))
        else:
            bgr = p if p.shape[2] == 1 else p[..., [2, 1, 0, *range(3, p.shape[2])]]
            mode = images.MODES[p.shape[2]]
            rows.append((i, f"h{i}", (None, *p.shape, mode, bytearray(bgr.tobytes()))))
    return spark.createDataFrame(rows, f"id int, content_hash string, image {IMAGE.simpleString()}")


def rgb(image):
    pixels = np.frombuffer(bytes(image["data"]), np.uint8).reshape(
        image["height"], image["width"], image["nChannels"]
    )
    return pixels if pixels.shape[2] == 1 else pixels[..., ::-1]


def run(spark, pictures, steps, **more):
    done = images.standardise_images(rows_of(spark, pictures), steps, **more)
    return [rgb(r["image"]) for r in done.orderBy("id").collect()]


def test_image_source_decodes_and_marks_bad_files(spark, tmp_path):
    p = picture(1)
    (tmp_path / "a.png").write_bytes(png(p))
    (tmp_path / "b.jpg").write_bytes(b"garbage")
    found = image_pixels(spark, str(tmp_path))
    good, bad = images.split_invalid(found)
    assert np.array_equal(rgb(good.first()["image"]), p)
    assert [r["reason"] for r in bad.collect()] == ["undecodable"]
    assert image_pixels(spark, str(tmp_path), drop_invalid=True).count() == 1
    assert file_inventory(spark, str(tmp_path), ".png").first()["file_name"] == "a.png"


def test_decoder_keeps_the_rest_of_the_batch(spark):
    p = picture(2, 5, 7)
    rows = spark.createDataFrame(
        [(0, bytearray(png(p))), (1, bytearray(b"garbage")), (2, None)], "id int, image binary"
    )
    decoded = images.decode_images(rows, unpng).orderBy("id").collect()
    assert np.array_equal(rgb(decoded[0]["image"]), p)
    assert [r["image"]["height"] for r in decoded] == [5, -1, -1]


def test_mixed_sizes_and_bad_rows_in_one_batch(spark):
    pictures = [picture(1), None, picture(2, 9, 31), picture(3, 40, 8, 1), picture(4, 10, 10, 4)]
    done = images.standardise_images(
        rows_of(spark, pictures), [images.to_rgb(), images.crop("center", 8)]
    ).orderBy("id").collect()
    assert [r["error"] for r in done] == [None, "undecodable", None, None, None]
    assert [tuple(r["image"])[1:4] for r in done] == [(8, 8, 3), (-1, -1, -1)] + [(8, 8, 3)] * 3


def test_default_chain_does_not_depend_on_partitioning(spark):
    rows = rows_of(spark, [picture(i, 20 + i, 30) for i in range(12)])

    def digests(df):
        done = images.standardise_images(df, images.default_steps(16), seed=3)
        return {r["id"]: r["h"] for r in done.select("id", content_hash(F.col("image.data")).alias("h")).collect()}

    one, many = digests(rows.coalesce(1)), digests(rows.repartition(7))
    assert one == many and len(set(one.values())) == 12
    other = images.standardise_images(rows, images.default_steps(16), seed=4)
    assert {r["id"]: r["h"] for r in other.select("id", content_hash(F.col("image.data")).alias("h")).collect()} != one


def test_mirror_twice_is_the_picture(spark):
    p = picture(5)
    assert np.array_equal(run(spark, [p], [images.mirror(1.0), images.mirror(1.0)])[0], p)
    assert np.array_equal(run(spark, [p], [images.mirror(1.0)])[0], p[:, ::-1])
    assert np.array_equal(run(spark, [p], [images.mirror(0.0)])[0], p)


def test_rotate_by_nothing_and_brightness_by_one(spark):
    p = picture(6)
    steps = [images.rotate(0.0), images.brightness(1.0, 1.0, 1.0), images.resize(12, 16)]
    assert np.array_equal(run(spark, [p], steps)[0], p)


def test_flat_pictures_stay_as_they_are(spark):
    flat = np.full((12, 12, 3), 77, np.uint8)
    black = np.zeros((12, 12, 3), np.uint8)
    steps = [images.autocontrast(2), images.median(), images.equalize(), images.white_balance(), images.crop("center", 6)]
    assert (run(spark, [flat], steps)[0] == 77).all()
    assert (run(spark, [black], steps)[0] == 0).all()


def test_bad_parameters_fail_before_the_job():
    with pytest.raises(ValueError):
        images.crop("middle")
    with pytest.raises(ValueError):
        images.resize(4, 4, "cubic")


def test_median_against_sorting():
    p = picture(7, 9, 11)[None]
    wide = np.pad(p, ((0, 0), (1, 1), (1, 1), (0, 0)), mode="edge")
    windows = np.lib.stride_tricks.sliding_window_view(wide, (3, 3), axis=(1, 2))
    expected = np.sort(windows.reshape(*p.shape, 9), axis=-1)[..., 4]
    assert np.array_equal(kernels.median3(p), expected)


@pytest.mark.parametrize("size", [(5, 9), (12, 40), (33, 7)])
@pytest.mark.parametrize("method,radius", [("lanczos", 3), ("bilinear", 1)])
def test_resize_against_one_pixel_at_a_time(size, method, radius):
    p = picture(8, 12, 21)
    shape = kernels.FILTERS[method][0]

    def line(values, new):
        old = len(values)
        scale = old / new
        stretch = max(scale, 1)
        out = []
        for at in range(new):
            centre = (at + 0.5) * scale
            picks = range(max(int(centre - radius * stretch + 0.5), 0), min(int(centre + radius * stretch + 0.5), old))
            weights = np.array([float(shape(np.array((i + 0.5 - centre) / stretch))) for i in picks])
            total = sum(w * values[i] for w, i in zip(weights / weights.sum(), picks))
            out.append(min(max(int(np.floor(total + 0.5 + 1e-9)), 0), 255))
        return out

    height, width = size
    wide = np.array([[line(p[y, :, c], width) for c in range(3)] for y in range(12)])
    whole = np.array([[line(wide[:, c, x], height) for x in range(width)] for c in range(3)])
    assert np.array_equal(kernels.resize(p[None], height, width, method)[0], whole.transpose(2, 1, 0))
    part = kernels.resize(p[None], height, width, method, (2, 5), (1, 6))[0]
    assert np.array_equal(part, whole.transpose(2, 1, 0)[2:5, 1:6])


def test_labels_with_a_model_and_bad_rows(spark):
    def factory():
        def model(batch):
            assert batch.shape[1:] == (3, 8, 8) and len(batch) <= 2
            bright = batch.mean(axis=1)
            return np.stack([1 - bright, bright, bright], axis=1)

        return model

    pictures = [np.zeros((8, 8, 3), np.uint8), None, np.full((16, 8, 1), 255, np.uint8)]
    done = images.label_images(rows_of(spark, pictures), factory, batch=2, size=8).orderBy("id").collect()
    assert [r["error"] for r in done] == [None, "undecodable", None]
    assert done[1]["mask"] is None
    assert set(done[0]["mask"]["data"]) == {0} and set(done[2]["mask"]["data"]) == {1}
    assert (done[0]["mask"]["nChannels"], done[0]["mask"]["mode"]) == (1, 0)


def test_overlay(spark):
    p, mask = picture(9, 8, 8), picture(10, 4, 4, 1) % 11
    rows = rows_of(spark, [p, p, None]).withColumn("mask", F.col("image"))
    masks = rows_of(spark, [mask, None, mask]).select("id", F.col("image").alias("mask"))
    rows = rows.drop("mask").join(masks, "id")

    def overlay(alpha):
        return images.overlay_masks(rows, alpha).orderBy("id").collect()

    assert np.array_equal(rgb(overlay(0.0)[0]["image"]), p)
    assert [r["error"] for r in overlay(0.4)] == [None, "mask: undecodable", "undecodable"]
    # an empty mask tints with the first colour of the scale, dark blue
    empty = kernels.overlay(np.zeros((1, 4, 4, 3), np.uint8), np.zeros((1, 4, 4, 1), np.uint8), 0.4)
    assert empty[0, 0, 0].tolist() == [0, 0, 50]


def test_colour_scale_ends():
    colours = kernels.jet_colours()
    assert colours.shape == (256, 3)
    assert colours[0].tolist() == [0, 0, 127] and colours[255].tolist() == [127, 0, 0]
