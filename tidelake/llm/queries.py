"""The registered queries of the operators in this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.llm import binary, bpe, chat, collocations, jaccard, lexical, lines, neighbours, quality, ring, substrings, templates, tokens
from tidelake.llm.common import bound_batches, utf8_bytes
from tidelake.session import scratch, ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query | None = None, *, sql: str | None = None):
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            bound_batches(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return run

    return register if function is None else register(function)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (utf8_bytes("text") + 16).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = ring.shard(docs, ["doc_id", "text_crc32"], shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_components(table(spark, sf_dir, "documents"))


@query
def op3_chat_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.recover_roles(table(spark, sf_dir, "conversations"), known="role")


@query
def op4_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", utf8_bytes("text").alias("n_bytes"))
    return tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query
def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = scratch(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    binary.write(docs, files, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    read = binary.read(spark, files).select(
        "doc_id", "file", "first", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
    return read.join(binary.file_starts(spark, files), "file").select(
        "doc_id", (F.col("file_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


@query
def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), quality.held_out()
    known = table(spark, sf_dir, "labels").filter(~held)
    scored = quality.score(docs.select("doc_id", "text"), quality.fit(docs, known))
    return scored.select(
        "doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


#: A-Z as a-z, and nothing else, in SQL.
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"unnest(regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"


@query(
    sql=f"""
    WITH words AS (SELECT doc_id, {_TERMS} AS term FROM documents),
    held AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
    lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
    totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM lengths),
    terms AS (
        SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals GROUP BY term, docs
    ),
    items AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, {_TERMS} AS term FROM benchmark) GROUP BY ALL),
    scored AS (
        SELECT item_id, doc_id,
            sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // l)))))::BIGINT AS score
        FROM items JOIN terms USING (term) JOIN held USING (term) JOIN lengths USING (doc_id), totals
        GROUP BY ALL
    ),
    ranked AS (
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM scored WHERE score > 0
    )
    SELECT * FROM ranked WHERE rank <= 10
    """
)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query(
    sql=f"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS number
        FROM documents
    ),
    keyed AS (
        SELECT doc_id, line, number, regexp_replace({_FOLDED.replace('text', 'line')}, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS key
        FROM lines
    ),
    often AS (
        SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
    ),
    marked AS (SELECT k.*, last IS NOT NULL AND last <> doc_id AS gone FROM keyed k LEFT JOIN often USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """
)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return found.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


_LONGER = " UNION ALL ".join(
    f"SELECT lang, {' || chr(32) || '.join(f'w{i + 1}' for i in range(start, start + short))} AS phrase, a AS longer FROM candidates WHERE k = {n}"
    for n in (3, 4) for short in range(2, n) for start in range(n - short + 1)
)
_CUTS = " UNION ALL ".join(
    f"""SELECT lang, phrase, a, {cut} AS cut, {' || chr(32) || '.join(f'w{i + 1}' for i in range(cut))} AS head,
        {' || chr(32) || '.join(f'w{i + 1}' for i in range(cut, n))} AS tail FROM candidates WHERE k = {n}"""
    for n in (2, 3, 4) for cut in range(1, n)
)


@query(
    sql=f"""
    WITH pieces AS (
        SELECT lang, doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS number FROM (
            SELECT coalesce(lang, 'und') AS lang, doc_id, string_split_regex({_FOLDED}, '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents
        )
    ),
    words AS (
        SELECT lang, doc_id, number, unnest(words) AS w1, generate_subscripts(words, 1) AS place FROM (
            SELECT lang, doc_id, number, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
        )
    ),
    grams AS (
        SELECT lang, w1, lead(w1, 1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3, lead(w1, 3) OVER piece AS w4
        FROM words WINDOW piece AS (PARTITION BY lang, doc_id, number ORDER BY place)
    ),
    counted AS (
        SELECT lang, 1 AS k, w1, NULL AS w2, NULL AS w3, NULL AS w4, count(*) AS f FROM grams GROUP BY ALL UNION ALL
        SELECT lang, 2, w1, w2, NULL, NULL, count(*) FROM grams WHERE w2 IS NOT NULL GROUP BY ALL UNION ALL
        SELECT lang, 3, w1, w2, w3, NULL, count(*) FROM grams WHERE w3 IS NOT NULL GROUP BY ALL UNION ALL
        SELECT lang, 4, w1, w2, w3, w4, count(*) FROM grams WHERE w4 IS NOT NULL GROUP BY ALL
    ),
    known AS (SELECT *, concat_ws(chr(32), w1, w2, w3, w4) AS phrase FROM counted WHERE f >= 30),
    candidates AS (SELECT *, f AS a FROM known WHERE k > 1),
    cuts AS ({_CUTS}),
    scored AS (
        SELECT c.lang, c.phrase, c.a, h.f AS l, t.f AS r, ((2000000::HUGEINT * a) // (h.f + t.f))::BIGINT AS score, cut
        FROM cuts c JOIN known h ON h.lang = c.lang AND h.phrase = head JOIN known t ON t.lang = c.lang AND t.phrase = tail
    ),
    least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    longer AS (SELECT lang, phrase, max(longer) AS longer FROM ({_LONGER}) GROUP BY ALL),
    totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
    ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank, phrase, a, l, r, n, score
        FROM least LEFT JOIN longer USING (lang, phrase) JOIN totals USING (lang)
        WHERE longer IS NULL OR 100::HUGEINT * longer < 80 * a
    )
    SELECT * FROM ranked WHERE rank <= 2000
    """
)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))
