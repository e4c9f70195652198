"""Quality by compression: a text is judged by which of two dictionaries packs it better.

One zstandard dictionary is built from good labelled text and one from bad. The difference of the two
compressed sizes, divided by their sum, and the two sizes per byte go through a logistic calibration
fitted on labelled rows that neither dictionary has seen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.common import schema_with, small_batches, with_columns, worker_cache

#: Bounds of what is fitted on: rows of each class for its dictionary, and rows for the calibration.
DICTIONARY_ROWS = 3_000
CALIBRATION_ROWS = 12_000
#: Of a row for a dictionary, so many characters are taken, from a place that its id decides.
PIECE = 4_096
DICTIONARY_BYTES = 32_768
LEVEL = 3
#: Weight decay of the calibration.
RIDGE = 1e-4


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY_BYTES:]


class Packer:
    """Compressed sizes of texts under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        def compressor(content: bytes):
            if not content:
                return zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
            shared = zstandard.ZstdCompressionDict(content)
            shared.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=False, write_dict_id=False)

        self.good, self.bad = compressor(good), compressor(bad)

    def features(self, text: bytes) -> tuple[float, float, float, float]:
        size, good, bad = len(text), len(self.good.compress(text)), len(self.bad.compress(text))
        return (bad - good) / (bad + good), good / max(size, 1), bad / max(size, 1), float(np.log1p(size))


@dataclass
class Model:
    good: bytes = b""
    bad: bytes = b""
    constant: float | None = 0.5
    centre: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(features), self.constant)
        x = (features - np.array(self.centre)) / np.array(self.scale)
        z = self.weights[0] + x @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _calibrate(model: Model, x: np.ndarray, y: np.ndarray) -> Model:
    """Ridge logistic regression by Newton steps."""
    if not len(y) or y.min() == y.max():
        model.constant = float((y.sum() + 0.5) / (len(y) + 1))
        return model
    centre, scale = x.mean(0), x.std(0) + 1e-9
    rows = np.c_[np.ones(len(x)), (x - centre) / scale]
    weights, decay = np.zeros(rows.shape[1]), np.eye(rows.shape[1]) * RIDGE * len(y)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -40, 40)))
        slope = rows.T @ (p - y) + decay @ weights
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + decay
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    model.constant, model.centre, model.scale = None, centre.tolist(), scale.tolist()
    model.weights = weights.tolist()
    return model


def _packer(model: Model) -> Packer:
    known, key = worker_cache("quality"), model.good + model.bad
    if key not in known:
        known.clear()
        known[key] = Packer(model.good, model.bad)
    return known[key]


def _features(text: str, model):
    def run(batches):
        packer = _packer(model.value)
        for batch in batches:
            rows = [packer.features(t or b"") for t in batch.column(text).cast(pa.binary()).to_pylist()]
            yield with_columns(batch.drop_columns([text]), {"features": pa.array(rows, pa.list_(pa.float64()))})

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from the labelled rows of ``docs``; ``labels`` has an id and a 0 / 1 label.

    It is fitted on a bounded sample in the order of a hash of the id: ``DICTIONARY_ROWS`` of each
    class, and ``CALIBRATION_ROWS`` others as they come. Nulls are left out; of an id with several
    labels the lowest counts. Without a class to tell apart, the score is the share of good rows.
    """
    known = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
        .filter("id is not null and y in (0, 1)")
        .groupBy("id")
        .agg(F.min("y").alias("y"))
        .withColumn("h", F.xxhash64("id"))
    )
    own = F.pmod("h", F.lit(3)) == 0
    picks = known.filter(~own).orderBy("h", "id").limit(CALIBRATION_ROWS).withColumn("use", F.lit(2))
    for y in (0, 1):
        rows = known.filter(own & (F.col("y") == y)).orderBy("h", "id").limit(DICTIONARY_ROWS)
        picks = picks.unionByName(rows.withColumn("use", F.lit(y)))
    # at most CALIBRATION_ROWS + 2 * DICTIONARY_ROWS rows of four numbers
    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(F.broadcast(picks), "id")
    start = F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.length("t") - PIECE + 1, F.lit(1)))
    pieces = chosen.filter("use < 2").dropDuplicates(["id"]).select(
        "id", "use", F.substring("t", start + 1, F.lit(PIECE)).alias("piece")
    )
    found = sorted(pieces.collect(), key=lambda r: r["id"])
    samples = {y: [r["piece"].encode() for r in found if r["use"] == y and r["piece"]] for y in (0, 1)}
    model = Model(_dictionary(samples[1]), _dictionary(samples[0]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = (
        chosen.filter("use = 2")
        .dropDuplicates(["id"])
        .select("id", "y", "t")
        .mapInArrow(_features("t", shared), f"id {chosen.schema['id'].dataType.simpleString()}, y int, features array<double>")
        .collect()
    )
    rows.sort(key=lambda r: r["id"])
    x = np.array([r["features"] for r in rows]).reshape(-1, 4)
    return _calibrate(model, x, np.array([r["y"] for r in rows], float))


def score(df: DataFrame, model: Model, text: str = "text", keep_text: bool = False, out: str = "score") -> DataFrame:
    """``df`` with ``score double`` from 0 to 1, higher for better text, from whole texts alone.

    Inputs are the difference of the two compressed sizes over their sum, both sizes per byte, and the
    logarithm of the text's size.

    A null text counts as empty; an empty text gets the score of its features, too. Rows are kept,
    repeated ones alike; a column that bears the name ``out`` is replaced; an empty table gives none. The text
    itself is left out unless ``keep_text``.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = schema_with(df if keep_text else df.drop(text), **{out: "double"})

    def run(batches):
        packer = _packer(shared.value)
        for batch in small_batches(batches, text):
            rows = [packer.features(t or b"") for t in batch.column(text).cast(pa.binary()).to_pylist()]
            scores = shared.value.scores(np.array(rows).reshape(-1, 4))
            yield with_columns(batch, {out: pa.array(scores, pa.float64())}).select(schema.names)

    return df.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2
