"""Incremental reading, content dedup and run reports over the documents table.

``text`` stands for the blob, ``source`` for the source file and ``doc_id`` for the row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.functions.content import (
    base_name,
    batch_id,
    content_hash,
    export_name,
    is_image,
    is_present,
)
from tidelake.operators import ledger
from tidelake.plans.catalogue import query, table


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        F.col("source").alias("source_file"),
        content_hash(F.col("text")).alias("content_hash"),
        F.length(F.col("text").cast("binary")).cast("long").alias("image_size"),
    )


def known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export ledger of an earlier run: the contents of every third document."""
    return content(spark, sf_dir).filter("doc_id % 3 = 0").select("content_hash")


def on_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that lie in the target folder without a ledger row."""
    return content(spark, sf_dir).filter("doc_id % 7 = 0").select(
        export_name(F.col("content_hash")).alias("file_name")
    )


@query(
    """
    with c as (select doc_id, source as source_file, md5(text) as content_hash from documents),
         r as (select *, row_number() over (partition by content_hash order by source_file, doc_id) as rn,
                      count(*) over (partition by content_hash) as copies from c)
    select content_hash, source_file, doc_id, copies from r where rn = 1
    """
)
def content_dedup(spark, sf_dir):
    return ledger.first_occurrence(content(spark, sf_dir), "content_hash", ["source_file", "doc_id"])


@query(
    """
    with c as (select doc_id, source, lang, text, md5(text) as content_hash from documents),
         r as (select *, row_number() over (partition by content_hash order by source, doc_id) as rn from c)
    select doc_id, lang, source, text from r where rn = 1
    """
)
def dedup_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("content_hash", content_hash(F.col("text")))
    kept = ledger.dedup_content(docs, "content_hash", ["source", "doc_id"])
    return kept.select("doc_id", "lang", "source", "text")


@query(
    """
    with c as (select doc_id, md5(text) as content_hash, octet_length(encode(text)) as image_size
               from documents),
         f as (select content_hash, min(doc_id) as doc_id, max(image_size) as image_size
               from c group by content_hash)
    select doc_id, content_hash, cast(image_size as bigint) as image_size from f
    where not exists (select 1 from c k where k.doc_id % 3 = 0 and k.content_hash = f.content_hash)
    """
)
def new_since_ledger(spark, sf_dir):
    rows = content(spark, sf_dir)
    first = ledger.first_occurrence(rows, "content_hash", ["doc_id"], carry=["image_size"])
    new = ledger.new_content(first, known(spark, sf_dir), "content_hash")
    return new.select("doc_id", "content_hash", "image_size")


@query(
    """
    with c as (select doc_id, md5(text) as content_hash from documents),
         f as (select content_hash, count(*) as copies from c group by content_hash)
    select content_hash, copies from f
    where exists (select 1 from c k where k.doc_id % 3 = 0 and k.content_hash = f.content_hash)
    """
)
def already_exported(spark, sf_dir):
    first = ledger.first_occurrence(content(spark, sf_dir), "content_hash", ["doc_id"])
    done = ledger.already_done(first, known(spark, sf_dir), "content_hash")
    return done.select("content_hash", "copies")


@query(
    """
    with c as (select doc_id, case when doc_id % 11 = 0 then null else md5(text) end as h from documents),
         k as (select distinct md5(text) as h from documents where doc_id % 3 = 0),
         t as (select distinct md5(text) as h from documents where doc_id % 7 = 0),
         m as (select c.h, k.h is not null as known, t.h is not null as there,
                      row_number() over (partition by c.h order by c.doc_id) as rn
               from c left join k on c.h = k.h left join t on c.h = t.h)
    select count(*) as total,
           count(*) filter (where h is null) as nulls,
           count(*) filter (where h is not null and known) as in_ledger,
           count(*) filter (where h is not null and not known and there) as on_target,
           count(*) filter (where h is not null and (known or there)) as skipped,
           count(*) filter (where h is not null and not known and not there and rn = 1) as exported,
           count(*) filter (where h is not null and not known and not there and rn > 1) as duplicates
    from m
    """
)
def run_report(spark, sf_dir):
    rows = content(spark, sf_dir).withColumn(
        "content_hash", F.when(F.col("doc_id") % 11 != 0, F.col("content_hash"))
    )
    return ledger.run_report(rows, known(spark, sf_dir), on_target(spark, sf_dir))


@query(
    """
    select distinct source as file_path from documents
    where source not in (select source from documents where lang = 'de' and doc_id % 17 = 0)
    """
)
def unprocessed_files(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(F.col("source").alias("file_path"), "lang", "doc_id")
    done = files.filter("lang = 'de' and doc_id % 17 = 0")
    return ledger.unprocessed(files, done)


@query(
    """
    with f as (select distinct source as source_file from documents),
         r as (select source, count(*) as n from documents
               where text is not null and source not in ('src1', 'src2') group by source)
    select f.source_file, coalesce(r.n, 0) as n from f left join r on f.source_file = r.source
    """
)
def file_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumnRenamed("source", "source_file")
    staged = rows.filter(is_present(F.col("text")) & ~F.col("source_file").isin("src1", "src2"))
    return ledger.file_counts(rows, staged)


@query(
    """
    with f as (select source, (dense_rank() over (order by source) - 1) // 10 as part from documents),
         a as (select strftime(max(ts), '%Y%m%d_%H%M%S') as t from events)
    select 'batch_' || t || '_part_' || part as batch_id, count(*) as records
    from f, a group by 1
    """
)
def batch_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("file_path"))
    as_of = table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    parts = ledger.file_parts(docs, files_per_part=10)
    per_file = docs.groupBy("file_path").agg(F.count("*").alias("n"))
    labelled = per_file.join(parts, "file_path").withColumn("batch_id", batch_id(as_of, F.col("part")))
    return labelled.groupBy("batch_id").agg(F.sum("n").alias("records"))


@query(
    """
    with f as (select source as file_path, count(*) as n,
                      dense_rank() over (order by source) - 1 as part from documents group by source)
    select 'batch_19980802_000000_part_' || max(part) as batch_id from f
    where file_path not in ('src8', 'src9')
    """
)
def last_batch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("file_path"))
    as_of = F.lit("1998-08-02").cast("timestamp_ntz")
    done = ledger.file_parts(docs, files_per_part=1).withColumn("batch_id", batch_id(as_of, F.col("part")))
    return ledger.last_batch(done.filter(~F.col("file_path").isin("src8", "src9")))


@query(
    """
    with c as (select md5(text) as content_hash, min(doc_id) as doc_id from documents group by 1),
         t as (select distinct 'img_' || md5(text) || '.jpg' as file_name from documents where doc_id % 7 = 0)
    select doc_id, 'img_' || content_hash || '.jpg' as file_name,
           'marked_' || substr(content_hash, 1, 12) || '.jpg' as short_name,
           'out/img_' || content_hash || '.jpg' as local_path
    from c where 'img_' || content_hash || '.jpg' not in (select file_name from t)
    """
)
def export_names(spark, sf_dir):
    first = ledger.first_occurrence(content(spark, sf_dir), "content_hash", ["doc_id"])
    named = first.withColumn("file_name", export_name(F.col("content_hash")))
    absent = ledger.not_present(named, on_target(spark, sf_dir))
    return absent.select(
        "doc_id",
        "file_name",
        export_name(F.col("content_hash"), "marked", 12).alias("short_name"),
        F.concat_ws("/", F.lit("out"), "file_name").alias("local_path"),
    )


@query(
    """
    with p as (select page_id, url, case when page_id % 4 = 0 then url || '.JPG'
                      when page_id % 4 = 1 then url || '.png' when page_id % 4 = 2 then url || '.jpg.txt'
                      else url end as path,
               case when page_id % 5 = 0 then null when page_id % 5 = 1 then '' else html end as blob
               from pages)
    select page_id, regexp_extract(path, '[^/]*$') as base_name,
           regexp_matches(lower(path), '\\.(jpg|jpeg|png)$') as is_image,
           blob is not null as not_null,
           coalesce(octet_length(encode(blob)) > 0, false) as not_empty,
           coalesce(cast(octet_length(encode(blob)) as bigint), -1) as image_size
    from p
    """
)
def image_predicates(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    kind = F.col("page_id") % 4
    path = F.concat(
        "url", F.when(kind == 0, ".JPG").when(kind == 1, ".png").when(kind == 2, ".jpg.txt").otherwise("")
    )
    blob = F.when(F.col("page_id") % 5 == 1, "").when(F.col("page_id") % 5 > 1, F.col("html"))
    rows = pages.select("page_id", path.alias("path"), blob.cast("binary").alias("image"))
    return ledger.image_bytes(rows).select(
        "page_id",
        base_name(F.col("path")).alias("base_name"),
        is_image(F.col("path")).alias("is_image"),
        is_present(F.col("image")).alias("not_null"),
        is_present(F.col("image"), allow_empty=False).alias("not_empty"),
        F.coalesce("image_size", F.lit(-1)).alias("image_size"),
    )


@query(
    """
    select doc_id, copies from (
        select min(doc_id) as doc_id, count(*) as copies from documents group by md5(text))
    """
)
def blake2b_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    hashed = docs.select("doc_id", content_hash(F.col("text"), "blake2b").alias("content_hash"))
    return ledger.first_occurrence(hashed, "content_hash", ["doc_id"]).select("doc_id", "copies")
