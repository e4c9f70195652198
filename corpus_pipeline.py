"""The corpus pipeline: documents in, clean encoded documents out.

Every stage tells documents apart by id and text together: rows that share an id but not the text, and
rows without an id, are documents of their own. A null text counts as empty. Columns besides ``doc_id``
and ``text`` are carried along whatever their names; empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.llm import bpe, jaccard, quality, substrings, templates
from tidelake.llm.common import bound_batches
from tidelake.session import ship_package

#: Documents that score below this are rejected.
LEAST_QUALITY = 0.5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    bound_batches(spark)


def _own(docs: DataFrame, name: str) -> str:
    """A column name that the table doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def _identity() -> Column:
    """Orders documents by id, null ids last, then by a hash of the text."""
    return F.struct(
        F.col("doc_id").isNull().alias("nameless"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the labels' training part.

    A null or empty text is judged by the features of an empty one. Repeated rows are judged alike.
    """
    _prepare(spark)
    known = _table(spark, sf_dir, "labels").filter(~quality.held_out())
    model = quality.fit(_table(spark, sf_dir, "documents"), known)
    score = _own(docs, "score")
    scored = quality.score(docs, model, keep_text=True, out=score)
    return scored.filter(F.col(score) >= LEAST_QUALITY).select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that similarity links, the document with the smallest id; of repeated rows, one.

    Null ids come last. Texts without words link with nothing.
    """
    _prepare(spark)
    key = _own(docs, "document")
    marked = docs.withColumn(key, _identity())
    groups = jaccard.near_components(marked, doc_id=key)
    others = groups.filter(F.col(key) != F.col("component_id")).select(key).distinct()
    return marked.join(others, key, "left_anti").select(docs.columns).dropDuplicates(["doc_id", "text"])


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; a document left with nothing goes.

    Documents that lose nothing stay as they are, null and blank texts too. ``n_chars``, where there is
    one, follows the text.
    """
    _prepare(spark)
    keep = {c: _own(docs, f"kept_{c}") for c in substrings.NEW_COLUMNS if c in docs.columns}
    cut = substrings.dedup_passages(docs.withColumnsRenamed(keep))
    left = cut.filter((F.col("cut_bytes") == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("cut_bytes") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return left.drop(*substrings.NEW_COLUMNS).withColumnsRenamed({new: old for old, new in keep.items()}).select(docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item. Each row is judged by its own text, whatever its id."""
    _prepare(spark)
    key = _own(docs, "document")
    marked = docs.withColumn(key, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    found = templates.leaks(marked, _table(spark, sf_dir, "benchmark"), doc_id=key).select(key).distinct()
    return marked.join(found, key, "left_anti").select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``ids``, the ids of their texts, ``n_tokens``, and the text that the ids decode to.

    A null text has no ids and stays null. Columns that bear one of the new names are replaced.
    """
    _prepare(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    null, decoded = _own(docs, "was_null"), _own(docs, "decoded")
    coded = bpe.encode_and_decode(docs.withColumn(null, F.col("text").isNull()), path, out=decoded)
    return (
        coded.withColumn("n_tokens", F.size("ids").cast("long"))
        .withColumn("text", F.when(~F.col(null), F.col(decoded).cast("string")))
        .drop(decoded, null)
    )


STAGES = [
    ("quality", keep_good),
    ("near copies", keep_one_of_near_copies),
    ("repeated passages", cut_repeated_passages),
    ("benchmark leaks", drop_benchmark_leaks),
    ("tokens", encode_tokens),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages one after another to ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
