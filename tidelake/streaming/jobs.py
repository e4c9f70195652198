"""The lake's jobs: raw to staged, staged to labelled, and the two exports.

The jobs read what is new and end; a scheduler starts them again. Each batch writes partitions named
after the batch, so a replayed batch replaces itself. Staging runs as a stream, which stops at a
batch that fails, or by files, where a batch that fails is halved until the bad file is found.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType, TimestampType

from tidelake import schema
from tidelake.functions.content import batch_id, content_hash, export_name, is_present
from tidelake.operators import images
from tidelake.operators import known as known_contents
from tidelake.operators.ledger import (
    file_counts,
    file_parts,
    first_occurrence,
    keep_rows,
    last_batch,
    unprocessed,
)
from tidelake.operators.skew import join_counted, numbered
from tidelake.session import list_in_few_tasks, stored
from tidelake.sinks import folders
from tidelake.sinks.files import export_files, missing_files
from tidelake.sinks.tables import append, record_exports, record_files, replace_by_source
from tidelake.sources.files import file_inventory, source_path
from tidelake.sources.streams import table_stream

STAGED = StructType(
    [
        StructField("image", schema.IMAGE),
        StructField("content_hash", StringType()),
        StructField("source_file", StringType()),
        StructField("row_index", LongType()),
        StructField("error", StringType()),
        StructField("batch_id", StringType()),
        StructField("valid", BooleanType()),
    ]
)

VERSIONS = StructType([StructField("batch_id", StringType()), StructField("version", TimestampType())])

#: What an export has taken: a batch as it was at ``version``, and the ledger's newest batch after that.
EXPORTED = StructType([*VERSIONS, StructField("last_batch", StringType())])

#: Files that made a batch fail, once for each attempt, and those that are not tried any more.
ATTEMPTS = StructType(
    [
        StructField("file_path", StringType()),
        StructField("error", StringType()),
        StructField("at", TimestampType()),
        StructField("batch_id", StringType()),
    ]
)
DEAD = StructType([StructField("file_path", StringType()), StructField("attempts", LongType()), StructField("error", StringType())])

#: Files of a batch, written down before it is worked on.
PLANNED = StructType([StructField("file_path", StringType()), StructField("batch_id", StringType())])

#: Staged batches that an export reads at a time.
BATCHES_PER_EXPORT = 1000

#: Input of one micro-batch; the cluster's parallelism comes from its bytes.
BYTES_PER_BATCH = 100 << 30

#: Files of one pass over many small batches; a pass is a fixed number of Spark jobs.
FILES_PER_PASS = 10_000

#: Tasks that write the ledger rows of such a pass.
LEDGER_TASKS = 32

PLACE = ["source_file", "row_index", "batch_id"]


def read_or_empty(spark: SparkSession, path: str, columns: StructType, base: str | None = None) -> DataFrame:
    """A table that need not exist yet, or a folder of it whose table is ``base``."""
    reader = spark.read.schema(columns)
    try:
        return (reader.option("basePath", base) if base else reader).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], columns)


def incremental(
    stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Hand each new part of a stream to ``work``; its number is stable when it is replayed."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def staged_schema(encoded: bool = False) -> StructType:
    """Columns of the staged table; with an encoder its pictures are bytes."""
    return StructType([StructField("image", BinaryType()) if encoded and f.name == "image" else f for f in STAGED])


def _raw_columns(decoder: Callable | None) -> StructType:
    return schema.RAW if decoder else StructType([StructField("image", schema.IMAGE)])


def _raw_rows(spark: SparkSession, files: list[str], decoder: Callable | None) -> DataFrame:
    list_in_few_tasks(spark)
    return spark.read.schema(_raw_columns(decoder)).parquet(*files).select(
        "image", source_path().alias("source_file"), F.col("_metadata.row_index").alias("row_index")
    )


def _standardised(rows: DataFrame, batches: DataFrame, steps, decoder, encoder, seed: int, failure: str | None = None) -> DataFrame:
    """Pictures of the files in ``batches`` (source_file, batch_id), standardised in one pass."""
    rows = join_counted(rows.filter(is_present(F.col("image"))), batches, ["source_file"])
    blob = F.col("image") if decoder else F.col("image.data")
    return images.standardise_images(
        rows.withColumn("content_hash", content_hash(blob)),
        steps, seed=seed, decoder=decoder, encoder=encoder, failure=failure, by="source_file",
    )


def _write(ready: DataFrame, batches: DataFrame, names: list[str], staged: str, ledger: str, encoder) -> None:
    """Write each batch below its name, and record its files."""
    spark = ready.sparkSession
    # a first attempt may have left a side that has no rows this time
    places = folders.partitions(spark, staged, "batch_id", names)
    for folder in folders.present(spark, places):
        folders.remove(spark, folder)
    replace_by_source(ready.withColumn("valid", F.col("error").isNull()), staged, ["batch_id", "valid"])
    # only these batches' folders are listed; without a usable row one may not have been written at all
    written = folders.present(spark, places)
    columns = staged_schema(encoder is not None)
    reader = spark.read.schema(columns).option("basePath", staged)
    rows = reader.parquet(*written) if written else spark.createDataFrame([], columns)
    counts = file_counts(batches, rows.filter("valid")).join(batches, "source_file")
    if len(names) > 1:
        counts = counts.repartition(min(len(names), LEDGER_TASKS), "batch_id")
    record_files(counts, F.col("batch_id"), F.current_timestamp(), ledger, files=1 if len(names) == 1 else None)


def _names(batches: DataFrame) -> list[str]:
    return [r["batch_id"] for r in batches.select("batch_id").distinct().orderBy(F.length("batch_id"), "batch_id").collect()]


def stage_raw(
    spark: SparkSession,
    raw: str,
    staged: str,
    ledger: str,
    checkpoint: str,
    steps: list[images.Step] | None = None,
    decoder: Callable | None = None,
    files_per_batch: int | None = None,
    seed: int = 0,
    bytes_per_batch: int = BYTES_PER_BATCH,
    encoder: Callable | None = None,
) -> None:
    """Standardise new pictures of the raw table and write the file ledger.

    With a ``decoder`` the raw table holds encoded bytes, else decoded pictures; with an ``encoder`` the
    staged table holds encoded bytes. Unusable pictures go to the ``valid=false`` side of the staged
    batch with their reason. Each picture is read and worked on once, in one pass; the counts come from
    what was written.

    A staged batch has ``files_per_batch`` files. A micro-batch takes as many such batches as
    FILES_PER_PASS and ``bytes_per_batch`` (by the mean size of the files) allow, and stages them in one
    pass. Where that fails, it goes on by halves up to the batch to blame, so those before it are staged.
    """
    listed = stored(file_inventory(spark, raw).select(F.col("file_path").alias("source_file"), "file_size"))
    per_trigger = files_per_batch
    if files_per_batch:
        mean = max(1, int(listed.agg(F.avg("file_size")).first()[0] or 1))
        per_trigger *= max(1, min(FILES_PER_PASS, bytes_per_batch // mean) // files_per_batch)
    stream = table_stream(spark, raw, _raw_columns(decoder), per_trigger, bytes_per_batch=bytes_per_batch).select(
        "image",
        source_path().alias("source_file"),
        F.col("_metadata.row_index").alias("row_index"),
        F.col("_metadata.file_modification_time").alias("_modified"),
    )

    def stage(names: list[str], batches: DataFrame, rows: DataFrame) -> None:
        try:
            _write(_standardised(rows, batches, steps, decoder, encoder, seed), batches, names, staged, ledger, encoder)
        except Exception:  # whatever a file or the caller's code raises
            if len(names) == 1:
                raise
            half = len(names) // 2
            for own in (names[:half], names[half:]):
                part = stored(batches.filter(F.col("batch_id").isin(own)))
                stage(own, part, _raw_rows(spark, [r["source_file"] for r in part.select("source_file").collect()], decoder))

    def work(batch: DataFrame, number: int) -> None:
        files = stored(batch.groupBy("source_file").agg(F.max("_modified").alias("_modified")))
        part = F.floor((F.col("_at") - 1) / files_per_batch) if files_per_batch else F.lit(0)
        placed = numbered(files, [], ["_modified", "source_file"], "_at").withColumn("_part", part.cast("long"))
        # named after the newest file, not after the clock: a replay gets the same name
        newest = placed.groupBy("_part").agg(F.max("_modified").alias("_newest"))
        name = batch_id(F.col("_newest"), F.lit(number * FILES_PER_PASS) + F.col("_part"))
        batches = stored(placed.join(newest, "_part").select("source_file", name.alias("batch_id")))
        names = _names(batches)
        if names:
            stage(names, batches, batch.drop("_modified"))

    incremental(stream, work, checkpoint).awaitTermination()
    # files without rows are never seen by the stream, but this run has read all that were listed
    known = read_or_empty(spark, ledger, schema.FILE_LEDGER)
    empty = unprocessed(
        listed, known.withColumnRenamed("file_path", "source_file"), "source_file"
    ).withColumn("n", F.lit(0).cast("long"))
    record_files(stored(empty), F.lit(f"no_rows_{uuid.uuid4().hex}"), F.current_timestamp(), ledger)


def stage_files(
    spark: SparkSession,
    raw: str,
    staged: str,
    ledger: str,
    attempts: str,
    steps: list[images.Step] | None = None,
    decoder: Callable | None = None,
    files_per_batch: int = 10,
    max_attempts: int = 3,
    seed: int = 0,
    encoder: Callable | None = None,
) -> None:
    """As ``stage_raw``, batches of files that the ledger doesn't know, whatever becomes of a batch.

    Up to FILES_PER_PASS files are staged in one pass. A file whose pictures make a step fail is found in
    that pass and leaves its batch; all others are staged in this run. Where the pass itself fails, as on
    a file that can't be read, it is halved, and each half tried, down to the batch and then to the file that
    is to blame. The file gets a row in ``attempts`` and is tried again by the next run, until
    it has ``max_attempts``; then it goes to ``<attempts>_dead`` with its last error and is left alone.
    Removing it there lets it in again, with a clean slate after ``attempts`` was cleared, too.

    Which files make up a batch is written to ``<attempts>_planned`` before the work begins: a run
    that was interrupted between a batch and its ledger rows does the same batch again under the same
    name, and so replaces it.
    """
    planned, dead = (f"{attempts.rstrip('/')}_{n}" for n in ("planned", "dead"))
    run = uuid.uuid4().hex
    left = _unstaged(spark, ledger, dead)
    plan = read_or_empty(spark, planned, PLANNED)
    # a run that ended between two changes of the plan may have left a file in two batches; the last has the longest name
    latest = F.max(F.struct(F.length("batch_id").alias("length"), "batch_id"))["batch_id"]
    again = stored(left(plan.groupBy("file_path").agg(latest.alias("batch_id"))))
    # batches that were interrupted, and files that failed alone, keep their names
    listed = file_inventory(spark, raw).select("file_path")
    new = left(listed).join(again.select("file_path"), "file_path", "left_anti")
    as_of = spark.range(1).select(batch_id(F.current_timestamp())).first()[0]
    parts = file_parts(new, "file_path", files_per_batch).select(
        "file_path", F.concat(F.lit(f"{as_of}_{run[:8]}_part_"), "part").alias("batch_id")
    )
    fresh = stored(parts)
    replace_by_source(fresh, planned, "batch_id")
    batches = stored(again.unionByName(fresh))

    def given_up(failed: DataFrame) -> None:
        rows = failed.select(
            F.col("source_file").alias("file_path"), "error", F.current_timestamp().alias("at"), F.concat("batch_id", F.lit(f"_{run}")).alias("batch_id")
        )
        replace_by_source(rows.coalesce(1), attempts, "batch_id")

    def stage(group: dict[str, list[str]]) -> DataFrame:
        """Batches with their files, in one pass; files that a step failed on, with the reason."""
        files = [(f, name) for name, own in group.items() for f in own]
        batches = spark.createDataFrame(files, "source_file string, batch_id string")
        rows = _raw_rows(spark, [f for f, _ in files], decoder)
        done = stored(_standardised(rows, batches, steps, decoder, encoder, seed, failure="failure"))
        failed = stored(done.filter("failure is not null").groupBy("source_file", "batch_id").agg(F.min("failure").alias("error")))
        if not failed.isEmpty():
            batches = stored(batches.join(failed.select("source_file"), "source_file", "left_anti"))
            # those that failed leave a batch that is written, by the plan first; a batch without any other file stays as it is
            hit = batches.select("batch_id").distinct().join(failed.select("batch_id").distinct(), "batch_id")
            apart = failed.join(hit, "batch_id").select("source_file", F.concat("batch_id", F.lit(f"_{run[:8]}")).alias("batch_id"))
            plan = batches.join(hit, "batch_id").select("source_file", "batch_id").unionByName(apart)
            replace_by_source(stored(plan.withColumnRenamed("source_file", "file_path")), planned, "batch_id")
            done = join_counted(done, failed.select("source_file"), ["source_file"], "left_anti")
        names = _names(batches)
        if names:
            _write(done.drop("failure"), batches, names, staged, ledger, encoder)
        return failed

    def work(group: dict[str, list[str]]) -> None:
        """A pass; a failure is the pass's own."""
        try:
            failed = stage(group)
        except Exception as error:  # whatever a file or the caller's code raises
            for folder in folders.present(spark, folders.partitions(spark, staged, "batch_id", list(group))):
                folders.remove(spark, folder)
            names = list(group)
            if len(names) > 1:
                half = len(names) // 2
                for own in (names[:half], names[half:]):
                    work({name: group[name] for name in own})
                return
            name, files = names[0], group[names[0]]
            if len(files) > 1:
                half = len(files) // 2
                parts = {f"{name}_{side}": own for side, own in (("a", files[:half]), ("b", files[half:]))}
                # from now on the halves are the plan
                for part, own in parts.items():
                    replace_by_source(spark.createDataFrame([(f, part) for f in own], PLANNED).coalesce(1), planned, "batch_id")
                folders.remove(spark, folders.partition(spark, planned, batch_id=name))
                for part, own in parts.items():
                    work({part: own})
                return
            failed = spark.createDataFrame([(files[0], f"{type(error).__name__}: {error}"[:2000], name)], "source_file string, error string, batch_id string")
        if not failed.isEmpty():
            given_up(failed)

    names = _names(batches)
    at_a_time = max(1, FILES_PER_PASS // files_per_batch)
    for start in range(0, len(names), at_a_time):
        own = batches.filter(F.col("batch_id").isin(names[start : start + at_a_time]))
        group: dict[str, list[str]] = {}
        for r in own.orderBy("batch_id", "file_path").collect():
            group.setdefault(r["batch_id"], []).append(r["file_path"])
        work(group)
    tried = read_or_empty(spark, attempts, ATTEMPTS).groupBy("file_path").agg(
        F.count("*").alias("attempts"), F.max_by("error", "at").alias("error")
    )
    hopeless = left(tried.filter(F.col("attempts") >= max_attempts))
    append(stored(hopeless).coalesce(1), dead)


def _unstaged(spark: SparkSession, ledger: str, dead: str) -> Callable[[DataFrame], DataFrame]:
    """Rows whose file is neither in the ledger nor given up."""

    def left(files: DataFrame) -> DataFrame:
        done = read_or_empty(spark, ledger, schema.FILE_LEDGER).select("file_path")
        gone = read_or_empty(spark, dead, DEAD).select("file_path")
        return files.join(done.unionByName(gone), "file_path", "left_anti")

    return left


def label_staged(
    spark: SparkSession,
    staged: str,
    labelled: str,
    checkpoint: str,
    model_factory: Callable[[], images.Model],
    batch: int = 8,
    size: int | None = 256,
    files_per_batch: int | None = None,
    bytes_per_batch: int = BYTES_PER_BATCH,
    decoder: Callable | None = None,
) -> None:
    """Label staged batches that are new or were written again, each once per version.

    A version is the time of the batch's newest file; ``checkpoint`` keeps those that are done. Pictures
    that the model fails on are kept in ``<labelled>_failed`` with the reason. With a ``decoder`` the staged
    pictures are encoded bytes.
    """
    columns = staged_schema(decoder is not None)
    stream = table_stream(spark, staged, columns, files_per_batch, bytes_per_batch=bytes_per_batch).select("batch_id", "valid")
    log = f"{checkpoint.rstrip('/')}_versions"

    def work(part: DataFrame, _: int) -> None:
        # a staged batch is the unit of replacement, so all its files are labelled together with the
        # first of them, and a micro-batch with the others finds the version done;
        # there are at most as many names as files in the micro-batch
        names = [r["batch_id"] for r in part.filter("valid").select("batch_id").distinct().collect()]
        if not names:
            return
        whole = _batches(spark, staged, names, columns).filter("valid")
        versions = whole.groupBy("batch_id").agg(F.max("_metadata.file_modification_time").alias("version"))
        fresh = stored(versions.join(read_or_empty(spark, log, VERSIONS), ["batch_id", "version"], "left_anti"))
        names = [r["batch_id"] for r in fresh.collect()]
        if not names:
            return
        whole = whole.filter(F.col("batch_id").isin(names))
        found = images.label_images(whole.drop("valid", "error"), model_factory, batch, size, decoder=decoder)
        # the model runs once; both sides are read from what it gave
        labels = stored(found)
        failed = labels.filter(F.col("error").isNotNull()).select("content_hash", "source_file", "row_index", "error", "batch_id")
        # a batch that is labelled again may have no failures, or no labels, this time
        for name in names:
            for table in (labelled, f"{labelled.rstrip('/')}_failed"):
                folders.remove(spark, folders.partition(spark, table, batch_id=name))
        replace_by_source(failed, f"{labelled.rstrip('/')}_failed", "batch_id")
        replace_by_source(
            labels.filter(F.col("error").isNull()).select(
                "image",
                "mask",
                F.struct("source_file", "row_index").alias("metadata"),
                "content_hash",
                "batch_id",
            ),
            labelled,
            "batch_id",
        )
        fresh.coalesce(1).write.mode("append").parquet(log)

    incremental(stream, work, checkpoint).awaitTermination()


def _batches(spark: SparkSession, path: str, names: list[str], columns: StructType | None = None) -> DataFrame:
    """Rows of some batches of a table; no other folder is listed."""
    own = [folders.partition(spark, path, batch_id=name) for name in names]
    reader = spark.read.option("basePath", path)
    return (reader.schema(columns) if columns else reader).parquet(*own).withColumn("batch_id", F.col("batch_id").cast("string"))


def new_versions(spark: SparkSession, table: str, log: str) -> DataFrame:
    """(batch_id, version) of batches that ``log`` doesn't have as they are now; only names are read.

    A version is the time of the batch's newest file.
    """
    files = file_inventory(spark, table, recursive=True).filter("file_size > 0")
    name = F.url_decode(F.replace(F.regexp_extract("file_path", "/batch_id=([^/]+)/", 1), F.lit("+"), F.lit("%2B")))
    versions = files.groupBy(name.alias("batch_id")).agg(F.max("modified_at").alias("version")).filter("batch_id <> ''")
    return versions.join(read_or_empty(spark, log, EXPORTED).select("batch_id", "version"), ["batch_id", "version"], "left_anti")


def _fresh(
    rows: DataFrame, folder: str, ledger: str, prefix: str, digits: int
) -> DataFrame:
    """Places of contents that are in neither the ledger nor the folder.

    Only digests and places are read and shuffled here, never pixels, and of the ledger only what
    the digests' prefixes name.
    """
    spark = rows.sparkSession
    index = f"{ledger.rstrip('/')}_digests"
    if folders.exists(spark, ledger) and not folders.exists(spark, index):  # a ledger from before there was an index
        old = spark.read.schema(schema.EXPORT_LEDGER).parquet(ledger)
        known_contents.remember(old.withColumnRenamed("file_hash", "content_hash"), index, "before")
    first = first_occurrence(rows, "content_hash", PLACE)
    named = known_contents.unseen(first, index).withColumn(
        "file_name", export_name(F.col("content_hash"), prefix, digits)
    )
    return stored(missing_files(named.select("content_hash", *PLACE, "file_name"), folder).select("content_hash", *PLACE))


def export_images(
    spark: SparkSession,
    staged: str,
    folder: str,
    ledger: str,
    encoder: Callable | None,
    digits: int = 32,
    batches_per_export: int = BATCHES_PER_EXPORT,
) -> None:
    """Write each new staged content once as a file, and record what was written.

    Only batches that are new, or were written again since, are read; ``<ledger>_versions`` keeps
    those that are done. A batch with a failure is not done and comes again. Without an ``encoder`` the
    staged table holds encoded bytes, and they are the file.
    """
    columns = staged_schema(encoder is None)

    def rows(names: list[str]) -> DataFrame:
        return _batches(spark, staged, names, columns).filter("valid")

    _export(spark, staged, rows, folder, ledger, encoder, "img", digits, None, batches_per_export)


def export_overlays(
    spark: SparkSession,
    labelled: str,
    folder: str,
    ledger: str,
    encoder: Callable,
    alpha: float = 0.4,
    digits: int = 32,
    batches_per_export: int = BATCHES_PER_EXPORT,
) -> None:
    """Write the overlay of each new labelled content once as a file, and record it; batches as in ``export_images``."""
    if not schema.require_columns(spark.read.parquet(labelled), ["image", "mask"]):
        return

    def rows(names: list[str]) -> DataFrame:
        return _batches(spark, labelled, names).filter(
            is_present(F.col("image.data"), allow_empty=False)
            & is_present(F.col("mask.data"), allow_empty=False)
        ).select("image", "mask", "content_hash", "batch_id", "metadata.*")

    _export(spark, labelled, rows, folder, ledger, encoder, "marked", digits, alpha, batches_per_export)


def _export(spark, table, rows_of, folder, ledger, encoder, prefix, digits, overlay, at_a_time) -> None:
    log = f"{ledger.rstrip('/')}_versions"
    due = stored(new_versions(spark, table, log))
    while True:
        # the oldest first; the places of so many batches are few enough to be broadcast to their pictures
        left = due.join(read_or_empty(spark, log, EXPORTED).select("batch_id", "version"), ["batch_id", "version"], "left_anti")
        group = stored(left.orderBy("version", "batch_id").limit(at_a_time))
        names = [r["batch_id"] for r in group.collect()]
        if not names:
            return
        rows = rows_of(names)
        places = _fresh(rows, folder, ledger, prefix, digits)
        chosen = keep_rows(rows, places.drop("content_hash"), PLACE).withColumn(
            "file_name", export_name(F.col("content_hash"), prefix, digits)
        )
        if overlay is not None:
            chosen = images.overlay_masks(chosen, overlay)
        tried = stored(export_files(chosen, folder, "image", encoder=encoder))
        as_of = F.current_timestamp()
        # two runs of one second are two batches
        mark = uuid.uuid4().hex
        batch = F.concat(F.date_format(as_of, "yyyyMMdd_HHmmss"), F.lit(f"_{mark}"))
        done = tried.filter("error is null")
        record_exports(done, batch, as_of, ledger)
        known_contents.remember(done, f"{ledger.rstrip('/')}_digests", mark)
        failed = tried.filter("error is not null").select("content_hash", "source_file", "error", batch.alias("batch_id"))
        replace_by_source(failed, f"{ledger.rstrip('/')}_failed", "batch_id")
        spoilt = places.join(failed.select("content_hash"), "content_hash", "left_semi").select("batch_id").distinct()
        newest = last_batch(read_or_empty(spark, ledger, schema.EXPORT_LEDGER)).first()[0]
        finished = group.join(spoilt, "batch_id", "left_anti").withColumn("last_batch", F.lit(newest).cast("string"))
        append(finished, log, files=1)
        due = due.join(spoilt, "batch_id", "left_anti")  # they come again in the next run
