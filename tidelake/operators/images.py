"""Pixel jobs: one Arrow pass over the picture column, Spark does the partitioning.

Pictures travel as the struct of Spark's image source. Other columns pass through untouched. Random
steps get their numbers from columns that depend on the content alone, computed before the pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, StringType, StructField, StructType

from tidelake.functions import kernels
from tidelake.functions.content import draw
from tidelake.schema import IMAGE

ARROW_IMAGE = to_arrow_type(IMAGE)
SLICE = 8  # pictures worked on at a time: their arrays should stay in the CPU cache
MODES = {1: 0, 3: 16, 4: 24}


@dataclass(frozen=True)
class Step:
    """A named kernel ``f(stack, draws)`` and the random numbers it needs per picture."""

    name: str
    kernel: Callable[[np.ndarray, np.ndarray], np.ndarray]
    draws: tuple[str, ...] = ()


def to_rgb() -> Step:
    return Step("to_rgb", lambda s, d: kernels.to_rgb(s))


def crop(mode: str = "random", size: int = 256) -> Step:
    if mode == "center":
        return Step("crop", lambda s, d: kernels.centre_crop(s, size))
    if mode == "random":
        return Step(
            "crop",
            lambda s, d: kernels.random_crop(s, size, d),
            ("crop.scale", "crop.left", "crop.top"),
        )
    raise ValueError("crop mode must be 'center' or 'random'")


def resize(height: int, width: int, method: str = "lanczos") -> Step:
    if method == "nearest":
        return Step("resize", lambda s, d: kernels.resize_nearest(s, height, width))
    if method not in kernels.FILTERS:
        raise ValueError("resize method must be lanczos, bilinear or nearest")
    return Step("resize", lambda s, d: kernels.resize(s, height, width, method))


def autocontrast(cutoff: int = 2) -> Step:
    return Step("autocontrast", lambda s, d: kernels.autocontrast(s, cutoff))


def median() -> Step:
    return Step("median", lambda s, d: kernels.median3(s))


def saturation(factor: float = 1.1) -> Step:
    return Step("saturation", lambda s, d: kernels.saturation(s, factor))


def equalize() -> Step:
    return Step("equalize", lambda s, d: kernels.equalize(s))


def white_balance() -> Step:
    return Step("white_balance", lambda s, d: kernels.white_balance(s))


def colour_norm(mean=kernels.IMAGENET_MEAN, std=kernels.IMAGENET_STD) -> Step:
    return Step("colour_norm", lambda s, d: kernels.colour_norm(s, mean, std))


def mirror(p: float = 0.5) -> Step:
    return Step("mirror", lambda s, d: kernels.mirror(s, d[:, 0] < p), ("mirror",))


def rotate(max_degrees: float = 10.0) -> Step:
    return Step(
        "rotate", lambda s, d: kernels.rotate(s, (2 * d[:, 0] - 1) * max_degrees), ("rotate",)
    )


def brightness(low: float = 0.8, high: float = 1.2, p: float = 0.5) -> Step:
    def kernel(stack, draws):
        factors = np.where(draws[:, 0] < p, low + (high - low) * draws[:, 1], 1.0)
        return kernels.brightness(stack, factors)

    return Step("brightness", kernel, ("brightness.p", "brightness.factor"))


def default_steps(size: int = 256) -> list[Step]:
    """The steps in use: random crop, enhancement, light augmentation."""
    return [
        to_rgb(),
        crop("random", size),
        autocontrast(2),
        median(),
        saturation(1.1),
        mirror(0.5),
        rotate(10),
        brightness(0.8, 1.2, 0.5),
    ]


def _swap(pixels: np.ndarray) -> np.ndarray:
    """Between the column's BGR(A) and the kernels' RGB(A)."""
    if pixels.shape[-1] == 1:
        return pixels
    return pixels[..., [2, 1, 0, *range(3, pixels.shape[-1])]]


def _unpack(column: pa.StructArray) -> tuple[list, list]:
    """(pictures or None, reasons or None) of a struct column."""
    pictures, reasons = [], []
    _, heights, widths, channels, _, blobs = column.flatten()
    for height, width, depth, blob in zip(
        heights.to_pylist(), widths.to_pylist(), channels.to_pylist(), blobs
    ):
        data = blob.as_buffer()
        if height is None or data is None:
            picture, reason = None, "no image"
        elif height <= 0:
            picture, reason = None, "undecodable"
        elif len(data) != height * width * depth or depth not in MODES:
            picture, reason = None, "wrong size"
        else:
            picture = _swap(np.frombuffer(data, np.uint8).reshape(height, width, depth))
            reason = None
        pictures.append(picture)
        reasons.append(reason)
    return pictures, reasons


def _pack(pictures: list, origins: pa.Array) -> pa.StructArray:
    """Struct column from pictures; a missing one gets height -1 as from the image source."""
    shapes = [(-1, -1, -1) if p is None else p.shape for p in pictures]
    fields = [
        origins,
        pa.array([s[0] for s in shapes], pa.int32()),
        pa.array([s[1] for s in shapes], pa.int32()),
        pa.array([s[2] for s in shapes], pa.int32()),
        pa.array([MODES.get(s[2], -1) for s in shapes], pa.int32()),
        pa.array([b"" if p is None else _swap(p).tobytes() for p in pictures], pa.binary()),
    ]
    return pa.StructArray.from_arrays(fields, fields=list(ARROW_IMAGE))


def _by_shape(items: dict[int, np.ndarray]) -> list[tuple[list[int], np.ndarray]]:
    shapes: dict[tuple, list[int]] = {}
    for at, picture in items.items():
        shapes.setdefault(picture.shape, []).append(at)
    return [(at, np.stack([items[i] for i in at])) for at in shapes.values()]


def _run(steps: list[Step], pictures: list, draws: np.ndarray) -> list:
    current = {i: p for i, p in enumerate(pictures) if p is not None}
    taken = 0
    for step in steps:
        numbers = draws[:, taken : taken + len(step.draws)]
        taken += len(step.draws)
        after = {}
        for at, stack in _by_shape(current):
            after.update(zip(at, step.kernel(stack, numbers[at])))
        current = after
    return [current.get(i) for i in range(len(pictures))]


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def _runs(batch: pa.RecordBatch, by: str | None) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with one value of ``by`` each."""
    start = 0
    for _, same in groupby(batch.column(by).to_pylist() if by else [None] * batch.num_rows):
        length = sum(1 for _ in same)
        yield batch.slice(start, length)
        start += length


def _with(batch: pa.RecordBatch, new: dict[str, pa.Array], drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    columns = {n: batch.column(n) for n in batch.schema.names if n not in drop}
    columns.update(new)
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _schema(df: DataFrame, **new) -> StructType:
    fields = {f.name: f for f in df.schema}
    fields.update({n: StructField(n, t) for n, t in new.items()})
    return StructType(list(fields.values()))


def split_invalid(images: DataFrame, image: str = "image") -> tuple[DataFrame, DataFrame]:
    """(usable pictures, quarantine with reason)."""
    usable = F.coalesce(F.col(f"{image}.height") > 0, F.lit(False))
    reason = F.when(F.col(image).isNull(), "no image").otherwise("undecodable")
    return images.filter(usable), images.filter(~usable).withColumn("reason", reason)


def _decode(decoder: Callable[[bytes], np.ndarray], data: bytes | None) -> np.ndarray | None:
    """A picture, or None for what the decoder can't read or no kernel takes."""
    try:
        picture = np.asarray(decoder(data), np.uint8)
    except Exception:  # whatever the caller's code raises
        return None
    return picture if picture.ndim == 3 and picture.shape[-1] in MODES and picture.size else None


def _encode(encoder: Callable[[np.ndarray], bytes], picture: np.ndarray) -> tuple[bytes | None, str | None]:
    try:
        return encoder(picture), None
    except Exception as error:  # whatever the caller's code raises is the picture's reason
        return None, f"{type(error).__name__}: {error}"


def decode_images(
    df: DataFrame, decoder: Callable[[bytes], np.ndarray], blob: str = "image"
) -> DataFrame:
    """Bytes to pictures with the caller's decoder (bytes to ``uint8[h, w, c]`` RGB).

    What cannot be decoded gets height -1; the rest of the batch goes on.
    """

    def work(batches):
        for batch in _slices(batches, SLICE):
            pictures = [_decode(decoder, data) for data in batch.column(blob).to_pylist()]
            origins = pa.nulls(batch.num_rows, pa.string())
            yield _with(batch, {blob: _pack(pictures, origins)})

    return df.mapInArrow(work, _schema(df, **{blob: IMAGE}))


def standardise_images(
    df: DataFrame,
    steps: list[Step] | None = None,
    digest: Column | str = "content_hash",
    seed: int = 0,
    image: str = "image",
    decoder: Callable[[bytes], np.ndarray] | None = None,
    encoder: Callable[[np.ndarray], bytes] | None = None,
    failure: str | None = None,
    by: str | None = None,
) -> DataFrame:
    """Run the steps over each picture in one pass. Adds ``error``, null for a usable picture.

    With a ``decoder`` the column holds bytes, with an ``encoder`` (``uint8[h, w, c]`` RGB to bytes) it
    holds bytes afterwards: decoding, steps and encoding are the same pass over slices of eight
    pictures, so decoded pixels never leave the task. What can't be encoded has no bytes and an ``error``.

    Whatever a step raises ends the job. With a column name for ``failure`` it goes there instead, for the
    pictures of the slice, which have none then; a slice has pictures of one value of ``by`` only.
    """
    steps = default_steps() if steps is None else steps
    digest = F.col(digest) if isinstance(digest, str) else digest
    names = [name for step in steps for name in step.draws]
    numbers = F.array(*[draw(digest, seed, name) for name in names]).cast("array<double>")
    source = df.withColumn("_draws", numbers)

    def worked(batch):
        column = batch.column(image)
        if decoder:
            pictures = [_decode(decoder, data) for data in column.to_pylist()]
            reasons, origins = ["undecodable" if p is None else None for p in pictures], pa.nulls(batch.num_rows, pa.string())
        else:
            (pictures, reasons), origins = _unpack(column), column.flatten()[0]
        draws = batch.column("_draws").flatten().to_numpy(zero_copy_only=False)
        done = _run(steps, pictures, draws.reshape(batch.num_rows, len(names)))
        if encoder:
            coded = [_encode(encoder, p) if r is None else (None, r) for p, r in zip(done, reasons)]
            return pa.array([c[0] for c in coded], pa.binary()), [c[1] for c in coded]
        return _pack(done, origins), reasons

    def work(batches):
        for batch in _slices(batches, SLICE):
            for part in _runs(batch, by) if failure else (batch,):
                reason = None
                try:
                    packed, reasons = worked(part)
                except Exception as error:  # whatever the caller's code raises
                    if not failure:
                        raise
                    reason = f"{type(error).__name__}: {error}"[:2000]
                    packed = pa.nulls(part.num_rows, pa.binary() if encoder else ARROW_IMAGE)
                    reasons = [reason] * part.num_rows
                new = {image: packed, "error": pa.array(reasons, pa.string())}
                if failure:
                    new[failure] = pa.array([reason] * part.num_rows, pa.string())
                yield _with(part, new, drop=("_draws",))

    kinds = {image: BinaryType() if encoder else IMAGE, "error": StringType()} | ({failure: StringType()} if failure else {})
    return source.mapInArrow(work, _schema(df, **kinds))


def image_vectors(df: DataFrame, mean=None, std=None, image: str = "image") -> DataFrame:
    """``vector``: floats 0..1, channel first, normalised when ``mean`` and ``std`` are given."""

    def work(batches):
        for batch in _slices(batches, SLICE):
            pictures, _ = _unpack(batch.column(image))
            vectors = [
                None if p is None else kernels.model_input(kernels.to_rgb(p[None]), mean, std).ravel()
                for p in pictures
            ]
            yield _with(batch, {"vector": pa.array(vectors, pa.list_(pa.float32()))}, drop=(image,))

    rest = df.drop(image)
    return df.mapInArrow(work, _schema(rest, vector=ArrayType(FloatType())))


def row_profile(df: DataFrame, image: str = "image") -> DataFrame:
    """``profile``: mean grey level of each picture row, from the top."""

    def work(batches):
        for batch in _slices(batches, SLICE):
            pictures, _ = _unpack(batch.column(image))
            profiles = [
                None if p is None else kernels.luma(kernels.to_rgb(p[None]))[0].mean(axis=1)
                for p in pictures
            ]
            yield _with(batch, {"profile": pa.array(profiles, pa.list_(pa.float64()))}, drop=(image,))

    return df.mapInArrow(work, _schema(df.drop(image), profile=ArrayType(DoubleType())))


Model = Callable[[np.ndarray], np.ndarray]


def label_images(
    df: DataFrame,
    model_factory: Callable[[], Model],
    batch: int = 8,
    size: int | None = 256,
    image: str = "image",
    decoder: Callable[[bytes], np.ndarray] | None = None,
) -> DataFrame:
    """Add ``mask``: the class with the highest score for each pixel, first class on a tie.

    ``model_factory`` is called in each task and returns ``f(float[b, 3, h, w]) -> float[b, c, h, w]``.
    Pictures are resized to ``size`` (None keeps the size; a batch must then be of one size).
    Unusable pictures are left out of the batch and get a null mask and an ``error``. Where the model
    raises, the batch is tried again picture by picture, and those that it fails on get its reason.
    With a ``decoder`` the pictures are encoded bytes, and are decoded in the same pass.
    """

    def scored(model, stack):
        scores = np.asarray(model(kernels.model_input(stack)))
        if scores.ndim != 4 or len(scores) != len(stack):
            raise ValueError(f"the model gave scores of shape {scores.shape}")
        return scores.argmax(axis=1).astype(np.uint8)

    def work(batches):
        model = model_factory()
        for part in _slices(batches, batch):
            if decoder:
                pictures = [_decode(decoder, data) for data in part.column(image).to_pylist()]
                reasons, origins = ["undecodable" if p is None else None for p in pictures], pa.nulls(part.num_rows, pa.string())
            else:
                (pictures, reasons), origins = _unpack(part.column(image)), part.column(image).flatten()[0]
            masks: list = [None] * len(pictures)
            resized = {
                i: kernels.resize(kernels.to_rgb(p[None]), size, size)[0] if size else kernels.to_rgb(p[None])[0]
                for i, p in enumerate(pictures)
                if p is not None
            }
            for at, stack in _by_shape(resized):
                try:
                    found = dict(zip(at, scored(model, stack)))
                except Exception:  # one picture may spoil the batch
                    found = {}
                    for n, i in enumerate(at):
                        try:
                            found[i] = scored(model, stack[n : n + 1])[0]
                        except Exception as error:  # whatever the model raises is the picture's reason
                            reasons[i] = f"{type(error).__name__}: {error}"
                for i, classes in found.items():
                    masks[i] = classes[..., None]
            packed = _pack(masks, origins)
            missing = pa.array([m is None for m in masks])
            packed = pa.StructArray.from_arrays(packed.flatten(), fields=list(ARROW_IMAGE), mask=missing)
            yield _with(part, {"mask": packed, "error": pa.array(reasons, pa.string())})

    return df.mapInArrow(work, _schema(df, mask=IMAGE, error=StringType()))


def overlay_masks(
    df: DataFrame, alpha: float = 0.4, image: str = "image", mask: str = "mask"
) -> DataFrame:
    """Replace ``image`` by its overlay with ``mask``. ``error`` says why a row has none."""

    def work(batches):
        for batch in _slices(batches, SLICE):
            pictures, reasons = _unpack(batch.column(image))
            masks, mask_reasons = _unpack(batch.column(mask))
            done: list = [None] * len(pictures)
            for i, (picture, classes) in enumerate(zip(pictures, masks)):
                if picture is None or classes is None:
                    reasons[i] = reasons[i] or f"mask: {mask_reasons[i]}"
                    continue
                rgb = kernels.to_rgb(picture[None])
                done[i] = kernels.overlay(rgb, classes[None, ..., :1], alpha)[0]
            yield _with(
                batch,
                {
                    image: _pack(done, batch.column(image).flatten()[0]),
                    "error": pa.array(reasons, pa.string()),
                },
            )

    return df.mapInArrow(work, _schema(df, **{image: IMAGE, "error": StringType()}))
