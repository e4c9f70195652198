"""Column functions for content identity, file names and run ids."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

IMAGE_SUFFIX = r"\.(jpg|jpeg|png)$"


@F.pandas_udf(StringType())
def _blake2b(blobs: pd.Series) -> pd.Series:
    return blobs.map(
        lambda b: None if b is None else hashlib.blake2b(b, digest_size=32).hexdigest()
    )


def content_hash(blob: Column, algo: str = "md5") -> Column:
    """Hex digest of bytes: ``md5`` and ``sha256`` stay in the JVM, ``blake2b`` is an Arrow UDF."""
    blob = blob.cast("binary")
    if algo == "md5":
        return F.md5(blob)
    if algo == "sha256":
        return F.sha2(blob, 256)
    if algo == "blake2b":
        return _blake2b(blob)
    raise ValueError(f"unknown hash {algo!r}")


def export_name(digest: Column, prefix: str = "img", digits: int = 32, suffix: str = ".jpg") -> Column:
    """File name of an exported image.

    The whole digest by default; ``digits=12`` gives the short form, in which two contents may meet.
    """
    return F.concat(F.lit(prefix + "_"), F.substring(digest, 1, digits), F.lit(suffix))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_image(path: Column) -> Column:
    """Image by suffix, in any letter case."""
    return F.lower(path).rlike(IMAGE_SUFFIX)


def is_present(blob: Column, allow_empty: bool = True) -> Column:
    """Not null, and with ``allow_empty=False`` not empty either."""
    return blob.isNotNull() if allow_empty else F.coalesce(F.length(blob) > 0, F.lit(False))


def batch_id(as_of: Column, part: Column | None = None) -> Column:
    """``batch_20240131_235900`` with ``_part_<i>`` for a part of a run."""
    name = F.concat(F.lit("batch_"), F.date_format(as_of, "yyyyMMdd_HHmmss"))
    return name if part is None else F.concat(name, F.lit("_part_"), part.cast("string"))


def draw(digest: Column, seed: int, step: str) -> Column:
    """Uniform number in [0, 1) that depends on content, seed and step only.

    A retried task and another partitioning give the same number.
    """
    text = F.md5(F.concat_ws("|", digest, F.lit(str(seed)), F.lit(step)))
    return F.conv(F.substring(text, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
