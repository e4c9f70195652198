"""Streams that run to the end of the given tables and are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake import schema
from tidelake.functions.content import content_hash, export_name
from tidelake.operators import images, ledger
from tidelake.plans.catalogue import query, table
from tidelake.plans.pixel_queries import GREY, SHOW, grey8, pixels
from tidelake.session import scratch, stored
from tidelake.sinks.files import export_files
from tidelake.sinks.tables import append, persist_raw, replace_by_source
from tidelake.sources.files import file_inventory, read_images, read_required, select_path, with_source
from tidelake.sources.streams import message_image, table_stream
from tidelake.streaming import jobs, joins, windows


def _stream(spark, sf_dir, name, **options):
    columns = table(spark, sf_dir, name).schema
    return table_stream(spark, sf_dir, columns, glob=f"{name}.parquet", **options)


def _landed(spark, stream, folder):
    """Run a stream into a Parquet table and read that."""
    persist_raw(stream, f"{folder}/out", f"{folder}/log", available_now=True).awaitTermination()
    return read_images(spark, f"{folder}/out", stream.schema)


@query("select event_id, ts, user_id, event_type, value, props from events")
def stream_raw_equals_batch(spark, sf_dir):
    return _landed(spark, _stream(spark, sf_dir, "events"), scratch(spark, "raw"))


@query(
    """select md5(props) as content_hash, cast(octet_length(encode(props)) as bigint) as size,
              count(*) as messages from events group by all"""
)
def stream_messages(spark, sf_dir):
    """Topic-like messages to the raw image table: only the value is kept."""
    messages = _stream(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").cast("binary").alias("key"), F.col("props").alias("value")
    )
    raw = _landed(spark, message_image(messages), scratch(spark, "messages"))
    sized = ledger.image_bytes(raw).withColumn("content_hash", content_hash(F.col("image")))
    return sized.groupBy("content_hash", F.col("image_size").alias("size")).agg(
        F.count("*").alias("messages")
    )


#: Text in one file of a stream, at most about so much; the task that writes a file reads all of it.
BYTES_PER_FILE = 256 << 20


@query("select distinct md5(text) as content_hash from documents")
def stream_new_content(spark, sf_dir):
    """Content ledger kept across micro-batches, one file each: every content enters it once."""
    folder = scratch(spark, "content")
    docs = table(spark, sf_dir, "documents")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    docs.repartitionByRange(max(4, -(-size // BYTES_PER_FILE)), "doc_id").write.parquet(f"{folder}/in")
    columns = schema.StructType([schema.StructField("content_hash", schema.StringType())])

    def work(batch, number):
        hashed = batch.select("doc_id", content_hash(F.col("text")).alias("content_hash"))
        first = ledger.first_occurrence(hashed, "content_hash", ["doc_id"])
        part = F.format_string("%08d", F.lit(number)).alias("batch_id")
        known = jobs.read_or_empty(spark, f"{folder}/ledger", columns)
        new = ledger.new_content(first, known, "content_hash").select("content_hash", part)
        replace_by_source(new, f"{folder}/ledger", "batch_id")

    stream = table_stream(spark, f"{folder}/in", docs.schema, files_per_batch=1)
    jobs.incremental(stream, work, f"{folder}/log").awaitTermination()
    return spark.read.parquet(f"{folder}/ledger").select("content_hash")


@query(
    """with w as (select time_bucket(interval '6 hours', ts) as window_start, event_type,
                         count(*) as events, round(sum(value), 4) as total from events group by all),
            m as (select max(ts) - interval '1 hour' as mark from events)
       select window_start, window_start + interval '6 hours' as window_end, event_type, events, total
       from w, m where window_start + interval '6 hours' <= mark"""
)
def stream_windows(spark, sf_dir):
    """Windows that the watermark has closed."""
    events = _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    metric = windows.monitor(
        events,
        "ts",
        "6 hours",
        {"events": F.count("*"), "total": F.sum("value")},
        by=["event_type"],
        delay="1 hour",
    )
    done = _landed(spark, metric, scratch(spark, "windows"))
    return done.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "event_type",
        "events",
        F.round("total", 4).alias("total"),
    )


@query(
    """with e as (select user_id, ts, ts - lag(ts) over (partition by user_id order by ts, event_id)
                         > interval '12 hours' as far from events where event_type = 'error'),
            s as (select *, sum(cast(coalesce(far, true) as integer))
                         over (partition by user_id order by ts rows unbounded preceding) as n from e),
            g as (select user_id, min(ts) as session_start, max(ts) + interval '12 hours' as session_end,
                         count(*) as events from s group by user_id, n)
       select * from g where session_end <= (select max(ts) - interval '1 hour' from events
                                             where event_type = 'error')"""
)
def stream_sessions(spark, sf_dir):
    """Error sessions that the watermark has closed."""
    errors = (
        _stream(spark, sf_dir, "events")
        .filter("event_type = 'error'")
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    found = windows.sessions(errors, "user_id", "ts", "12 hours", "1 hour")
    done = _landed(spark, found, scratch(spark, "sessions"))
    return done.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}
    )


@query("select event_id, user_id, event_type from events")
def stream_unique(spark, sf_dir):
    """A producer that sent every message twice."""
    folder = scratch(spark, "unique")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):
        append(events, f"{folder}/in", files=1)
    stream = table_stream(spark, f"{folder}/in", events.schema, files_per_batch=1)
    kept = windows.unique_within(stream, ["event_id"], "ts", "2 hours")
    return _landed(spark, kept, folder).select("event_id", "user_id", "event_type")


@query(
    """select source, count(*) as n, cast(sum(case when source in ('src3', 'src11') then 2 else 1 end)
              as bigint) as versions from documents group by source"""
)
def replace_partitions(spark, sf_dir):
    """A source written again replaces its own rows and no others."""
    folder = scratch(spark, "replace")
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.lit(1).alias("version"))
    replace_by_source(rows, folder, "source")
    again = rows.filter(F.col("source").isin("src3", "src11")).withColumn("version", F.lit(2))
    replace_by_source(again, folder, "source")
    return spark.read.parquet(folder).groupBy("source").agg(
        F.count("*").alias("n"), F.sum("version").alias("versions")
    )


@query(
    """select 'documents.parquet' as file_name, count(*) as n, max(doc_id) as last_id,
              count(*) - 1 as last_row from documents"""
)
def source_lineage(spark, sf_dir):
    """Rows with the file and position they came from."""
    docs = with_source(table(spark, sf_dir, "documents").select("doc_id", "_metadata"))
    named = docs.withColumn("file_name", F.substring_index("source_file", "/", -1))
    return named.groupBy("file_name").agg(
        F.count("*").alias("n"), F.max("doc_id").alias("last_id"), F.max("row_index").alias("last_row")
    )


@query(
    """select lang, count(*) as n, 0 as missing from documents group by lang"""
)
def path_select(spark, sf_dir):
    """SQL over a path, and a table that lacks a required column."""
    path = f"{sf_dir}/documents.parquet"
    lacking = read_required(spark, path, ["text", "mask_png"])
    rows = select_path(spark, path, "lang").groupBy("lang").agg(F.count("*").alias("n"))
    return rows.withColumn("missing", lacking.agg(F.count("*")).scalar().cast("int"))


@query("select source, lang, 1::bigint as files, true as named from documents group by source, lang")
def file_listing(spark, sf_dir):
    """Files of a partitioned table, found below its folders."""
    folder = scratch(spark, "listed")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    docs.repartition("source", "lang").write.partitionBy("source", "lang").parquet(folder)
    files = file_inventory(spark, folder, recursive=True).filter("file_size > 0")
    return files.groupBy(
        F.regexp_extract("file_path", "source=([^/]+)", 1).alias("source"), F.regexp_extract("file_path", "lang=([^/]+)", 1).alias("lang")
    ).agg(F.count("*").alias("files"), F.bool_and(F.endswith("file_path", F.concat(F.lit("/"), F.col("file_name")))).alias("named"))


@query(
    """select md5(text) as content_hash, 'doc_' || md5(text) || '.txt' as file_name, max(strlen(text)) as file_size,
              max(strlen(text)) as image_size from documents group by text"""
)
def export_round_trip(spark, sf_dir):
    """Each content as a file; names and sizes from the folder, the rest from what the export tells."""
    folder = scratch(spark, "exported").removeprefix("file://").removeprefix("file:")
    docs = table(spark, sf_dir, "documents")
    first = docs.groupBy(F.md5("text").alias("content_hash")).agg(
        F.min_by(F.col("text").cast("binary"), "doc_id").alias("image"), F.min_by("source", "doc_id").alias("source_file")
    )
    named = first.withColumn("file_name", export_name(F.col("content_hash"), "doc", suffix=".txt"))
    written = stored(export_files(named, folder)).filter("error is null")
    files = file_inventory(spark, f"file://{folder}", ".txt").select("file_name", "file_size")
    return written.withColumn("file_name", F.substring_index("local_path", "/", -1)).join(files, "file_name").select(
        "content_hash", "file_name", "file_size", "image_size"
    )


_STAGED = f"""
    {GREY}, h as (select image_id, md5(unhex(string_agg(printf('%02X', v), '' order by y, x))) as h
                  from px group by image_id),
    res as (select image_id, case when cast('0x' || substr(md5(h || '|0|mirror'), 1, 12) as bigint)
                / cast(281474976710656 as double) < 0.5 then 7 - x else x end as x, y, c, v
            from px join h using (image_id) where image_id % 10 <> 0)
"""


@query(f"with {_STAGED} select content_hash, pixels from ({SHOW}) join (select image_id, h as content_hash from h) using (image_id)")
def stage_images(spark, sf_dir):
    """Raw to staged over several files, every tenth picture broken."""
    return _staged(spark, sf_dir)[0]


@query(
    """select vec_id // 100 as raw_part, count(*) filter (where vec_id % 10 <> 0) as records
       from embeddings group by 1"""
)
def stage_file_ledger(spark, sf_dir):
    """Records per raw file in the file ledger."""
    return _staged(spark, sf_dir)[1]


def _staged(spark, sf_dir):
    folder = scratch(spark, "staged")
    broken = F.col("image_id") % 10 == 0
    image = F.col("image").withField("height", F.when(broken, -1).otherwise(F.col("image.height")))
    part = F.floor(F.col("image_id") / 100).alias("raw_part")
    raw = grey8(spark, sf_dir).select(image.alias("image"), part)
    raw.repartition("raw_part").write.partitionBy("raw_part").parquet(f"{folder}/raw")
    jobs.stage_raw(
        spark,
        f"{folder}/raw/*",
        f"{folder}/staged",
        f"{folder}/ledger",
        f"{folder}/log",
        [images.mirror(0.5)],
        files_per_batch=2,
    )
    staged = spark.read.schema(jobs.STAGED).parquet(f"{folder}/staged").filter("valid")
    shown = staged.select("content_hash", F.hex("image.data").alias("pixels"))
    counted = spark.read.schema(schema.FILE_LEDGER).parquet(f"{folder}/ledger")
    number = F.regexp_extract("file_path", r"raw_part=(\d+)", 1).cast("long")
    per_part = counted.groupBy(number.alias("raw_part")).agg(F.sum("records_processed").alias("records"))
    return shown, per_part


@query(
    """with l as (select user_id, event_id, ts, value from events where event_type = 'purchase'),
            f as (select user_id, event_id, ts, value from events where event_type = 'view'),
            j as (select l.*, f.event_id as fe, f.ts as ft, f.value as fv
                  from l asof left join f on l.user_id = f.user_id and l.ts >= f.ts)
       select user_id, event_id, ts, value, case when ft >= ts - interval '3 days' then fe end as f_event_id,
              case when ft >= ts - interval '3 days' then fv end as f_value from j"""
)
def stream_training_view(spark, sf_dir):
    """Purchases with the last view of their user in three days, both as streams of several micro-batches.

    A last file far behind all others ends every wait, so all labels are given.
    """
    folder = scratch(spark, "views")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "value", "event_type")
    events.repartitionByRange(4, "ts").write.parquet(f"{folder}/in")
    kinds = events.select(F.explode(F.array(F.lit("purchase"), F.lit("view"))).alias("event_type")).distinct()
    end = events.agg(F.max("ts").alias("ts")).crossJoin(kinds)  # two rows
    closing = end.select(
        # rows without a key are dropped before their time is seen
        F.lit(-1).alias("user_id"), F.lit(None).cast("long").alias("event_id"),
        (F.col("ts") + F.expr("interval 1000 days")).alias("ts"), F.lit(None).cast("double").alias("value"), "event_type",
    )
    append(closing.select(*[F.col(f.name).cast(f.dataType) for f in events.schema]), f"{folder}/in", files=1)

    def side(kind):
        stream = table_stream(spark, f"{folder}/in", events.schema, files_per_batch=2)
        return stream.filter(F.col("event_type") == kind).drop("event_type")

    # files come in any order, so nothing of the month counts as late
    view = joins.as_of_stream(side("purchase"), side("view"), "user_id", "ts", "event_id", "event_id", "3 days", "100 days")
    rows = _landed(spark, view.drop("f_ts"), folder).filter("event_id is not null")
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
