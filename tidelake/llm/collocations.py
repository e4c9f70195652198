"""Phrase mining by dynamic itemset counting over cyclic scans of corpus shards.

The corpus is cut into shards that are scanned in turn, over and over. All words are counted from the
first scan on. A longer phrase becomes active as soon as both phrases that it consists of but for one
word have reached the threshold in what was counted so far; it is then counted for one full cycle of
scans, so exactly once over every shard, while shorter phrases are still being counted. Mining ends when
every active phrase has had its cycle.

A scan learns what has reached the threshold, and when, from a byte array of fixed size: a phrase's
bytes hold the scan after which they were first set. Phrases that share their bytes with others may
become active too early; they, too, are counted for one full cycle, so every count is exact.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.common import small_batches
from tidelake.llm.shingles import hashed_spans, mixed
from tidelake.operators.skew import running_total, top_per_group
from tidelake.session import scratch, stored

#: Words of the longest phrase, and occurrences that make a phrase frequent.
LONGEST = 4
LEAST = 30
#: A phrase inside a longer one that has this share of its occurrences, in percent, goes.
ABSORBED = 80
#: Scans of a full cycle.
SHARDS = 4
#: Bytes of the activity array, whatever the size of the data.
ACTIVITY_BYTES = 1 << 23
#: Bytes of text whose phrases a task counts together.
FLUSH_BYTES = 16 << 20
#: Bytes of text that are hashed at a time.
SLICE_BYTES = 1 << 20
_NEVER = 1 << 14

_FOLD = bytes(
    10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b in b" \t" else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_PLACES = np.array([0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


def _phrase_hash(words: list[np.ndarray]) -> np.ndarray:
    total = np.full(len(words[0]), len(words), np.uint64)
    for word, place in zip(words, _PLACES):
        total = total + word * place
    return mixed(total)


def _fragment(hashes: np.ndarray, fragments: int) -> np.ndarray:
    return (hashes % np.uint64(fragments)).astype(np.int64)


def _places(hashes: np.ndarray, fragments: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bytes of a phrase in the activity array, both in its fragment's own part."""
    part = size // fragments
    base = _fragment(hashes, fragments) * part
    return tuple(base + (mixed(hashes + np.uint64(i)) % np.uint64(part)).astype(np.int64) for i in (1, 2))


class Activity:
    """For each phrase the scan after which it had reached the threshold, or earlier; never too late."""

    def __init__(self, fragments: int, size: int = ACTIVITY_BYTES):
        self.fragments, self.size = fragments, max(size, 64 * fragments)
        self.since = np.full(self.size, 255, np.uint8)

    def reached(self, words: list[np.ndarray]) -> np.ndarray:
        a, b = _places(_phrase_hash(words), self.fragments, self.size)
        scan = np.maximum(self.since[a], self.since[b]).astype(np.int64)
        return np.where(scan == 255, _NEVER, scan)

    def add(self, places: np.ndarray, scan: int) -> None:
        new = places[self.since[places] == 255]
        self.since[new] = scan


def _words(texts: list[bytes], langs: np.ndarray, salts: np.ndarray):
    """The folded texts; hash, piece, text, start and end of every word.

    The hash depends on the language, and pieces never cross texts.
    """
    folded = b"\n".join(texts).translate(_FOLD)
    raw = np.frombuffer(folded, np.uint8)
    inside = np.concatenate(([False], (raw != 10) & (raw != 32), [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    piece = np.cumsum(raw == 10)[starts] if len(starts) else np.empty(0, np.int64)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    of = np.searchsorted(bounds, starts, side="right")
    return folded, mixed(hashed_spans(raw, starts, ends) ^ salts[langs[of]]), piece, of, starts, ends


def _counted(words: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct phrases in the order of their hashes, the place of one of each, and its count."""
    hashes = _phrase_hash(words)
    order = np.argsort(hashes)
    columns = [w[order] for w in words]
    at = _starts(*columns)
    return [c[at] for c in columns], order[at], np.diff(np.append(at, len(order)))


def _starts(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _active(words: np.ndarray, piece: np.ndarray, activity: Activity, scan: int, shards: int):
    """(length, positions) of the phrases that this scan counts."""
    reached = activity.reached([words])
    here = np.arange(len(words))
    for length in range(2, LONGEST + 1):
        # both parts of length - 1, at a position and the next one, and no end of a piece between
        if len(here) < 2:
            return
        following = here[1:] == here[:-1] + 1
        left = here[:-1][following]
        start = np.maximum(reached[:-1], reached[1:])[following] + 1
        whole = piece[left] == piece[left + length - 1]
        left, start = left[whole], start[whole]
        due = (start <= scan) & (scan < start + shards)
        if due.any():
            yield length, left[due]
        begun = start <= scan
        here = left[begun]
        if length < LONGEST and len(here):
            # shared bytes may say that a phrase reached the threshold before it was counted at all
            reached = np.maximum(activity.reached([words[here + i] for i in range(length)]), start[begun] - 1)


class _Tally:
    """What a task has counted since it last sent rows."""

    def __init__(self, fragments: int):
        self.fragments, self.bytes = fragments, 0
        self.found: dict[tuple[int, str | None], list] = {}

    def add(self, length: int, lang: str | None, words: list[np.ndarray], counts: np.ndarray, texts: np.ndarray | None) -> None:
        self.found.setdefault((length, lang), []).append((words, counts, texts))

    def rows(self):
        for (length, lang), parts in self.found.items():
            words = [np.concatenate([p[0][i] for p in parts]) for i in range(length)]
            counts = np.concatenate([p[1] for p in parts])
            texts = np.concatenate([p[2] for p in parts]) if length == 1 else None
            hashes = _phrase_hash(words)
            fragment = _fragment(hashes, self.fragments)
            order = np.lexsort((*reversed(words), fragment))
            words, counts, fragment = [w[order] for w in words], counts[order], fragment[order]
            at = _starts(*words)
            counts = np.add.reduceat(counts, at)
            words, fragment = [w[at] for w in words], fragment[at]
            texts = texts[order][at] if texts is not None else None
            cuts = _starts(fragment)
            for a, b in zip(cuts, np.append(cuts[1:], len(fragment))):
                yield {
                    "fragment": int(fragment[a]),
                    "length": length,
                    "lang": lang,
                    "words": b"".join(w[a:b].astype("<u8").tobytes() for w in words),
                    "counts": counts[a:b].astype("<i8").tobytes(),
                    "first": b"",
                    "texts": b"\n".join(texts[a:b].tolist()) if texts is not None else None,
                    "total": int(counts[a:b].sum()) if length == 1 else 0,
                    "places": None,
                }
        self.found, self.bytes = {}, 0


_ROW = pa.schema(
    [("fragment", pa.int32()), ("length", pa.int32()), ("lang", pa.string()), ("words", pa.binary()), ("counts", pa.binary()), ("first", pa.binary()), ("texts", pa.binary()), ("total", pa.int64()), ("places", pa.binary())]
)
_ROW_DDL = "fragment int, length int, lang string, words binary, counts binary, first binary, texts binary, total long, places binary"


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ROW)


def _scan(activity, scan: int, shards: int):
    """Counts of one shard: all words in the first cycle, and the phrases that are active."""

    def run(batches):
        known = activity.value
        tally = _Tally(known.fragments)
        for batch in small_batches(batches, "text", SLICE_BYTES):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            coded = batch.column("lang").dictionary_encode()
            names = coded.dictionary.to_pylist()
            langs = coded.indices.to_numpy(zero_copy_only=False)
            salts = mixed(hashed_spans(*_spelled(names))) if names else np.empty(0, np.uint64)
            folded, words, piece, of, starts, ends = _words(texts, langs, salts)
            if not len(words):
                continue
            if scan < shards:
                distinct, place, counts = _counted([words])
                lang = langs[of[place]]
                spelled = np.empty(len(place), object)
                spelled[:] = [folded[a:b] for a, b in zip(starts[place].tolist(), ends[place].tolist())]
                for code, name in enumerate(names):
                    own = lang == code
                    if own.any():
                        tally.add(1, name, [distinct[0][own]], counts[own], spelled[own])
            if scan:
                for length, at in _active(words, piece, known, scan, shards):
                    distinct, _, counts = _counted([words[at + i] for i in range(length)])
                    tally.add(length, None, distinct, counts, None)
            tally.bytes += sum(map(len, texts))
            if tally.bytes >= FLUSH_BYTES:
                yield _batch(list(tally.rows()))
        yield _batch(list(tally.rows()))

    return run


def _spelled(names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raws = [n.encode() + b"\n" for n in names]
    ends = np.cumsum([len(r) for r in raws])
    return np.frombuffer(b"".join(raws), np.uint8), ends - [len(r) for r in raws], ends


def _read(rows: list[dict], length: int, scan: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """(words, counts, first scan, whether from the state, texts) of packed rows."""
    words = [np.frombuffer(r["words"], "<u8").reshape(length, -1) for r in rows]
    counts = [np.frombuffer(r["counts"], "<i8") for r in rows]
    first = [np.frombuffer(r["first"], "<i2") if r["first"] else np.full(len(c), scan, np.int16) for r, c in zip(rows, counts)]
    old = [np.full(len(c), bool(r["first"])) for r, c in zip(rows, counts)]
    texts = None
    if length == 1:
        texts = np.empty(sum(map(len, counts)), object)
        texts[:] = [t for r, c in zip(rows, counts) if len(c) for t in r["texts"].split(b"\n")]
    return list(np.concatenate(words, axis=1)), *(np.concatenate(x) for x in (counts, first, old)), texts


def _merged(scan: int, shards: int, fragments: int, size: int, least: int):
    """A fragment's counts so far, with those of the last scan; and the bytes of what has reached the threshold."""

    def run(state: pa.Table, new: pa.Table) -> pa.Table:
        rows = state.filter(pa.compute.greater(state.column("length"), 0)).to_pylist() + new.to_pylist()
        groups: dict[tuple, list[dict]] = {}
        for row in rows:
            groups.setdefault((row["length"], row["lang"]), []).append(row)
        done, places = [], [np.empty(0, np.int64)]
        fragment = rows[0]["fragment"] if rows else None
        for (length, lang), own in groups.items():
            words, counts, first, old, texts = _read(own, length, scan)
            order = np.lexsort((*reversed(words),))
            words, counts, first, old = [w[order] for w in words], counts[order], first[order], old[order]
            at = _starts(*words)
            before = np.add.reduceat(np.where(old, counts, 0), at) if len(at) else counts
            counts = np.add.reduceat(counts, at) if len(at) else counts
            first = np.minimum.reduceat(first, at) if len(at) else first
            words = [w[at] for w in words]
            if length < LONGEST:
                risen = (counts >= least) & (before < least)
                places += _places(_phrase_hash([w[risen] for w in words]), fragments, size)
            # what has had its cycle without reaching the threshold is not needed any more
            live = (counts >= least) | (scan < first + shards - 1)
            done.append(
                {
                    "fragment": fragment,
                    "length": length,
                    "lang": lang,
                    "words": b"".join(w[live].astype("<u8").tobytes() for w in words),
                    "counts": counts[live].astype("<i8").tobytes(),
                    "first": first[live].astype("<i2").tobytes(),
                    "texts": b"\n".join(texts[order][at][live].tolist()) if texts is not None else None,
                    "total": sum(r["total"] for r in own),
                    "places": None,
                }
            )
        if fragment is not None:
            # a row of length 0 carries the bytes that are to be set, each in the fragment's own part of the array
            done.append({n: None for n in _ROW.names} | {"fragment": fragment, "length": 0, "places": np.unique(np.concatenate(places)).astype("<i4").tobytes()})
        return pa.Table.from_pylist(done, schema=_ROW)

    return run


def _unpacked(batches):
    """One row per frequent phrase, with its words' hashes and its occurrences."""
    for batch in batches:
        for row in batch.to_pylist():
            length, counts = row["length"], np.frombuffer(row["counts"], "<i8")
            words = np.frombuffer(row["words"], "<i8").reshape(length, -1)
            columns = [pa.array(words[i], pa.int64()) if i < length else pa.nulls(len(counts), pa.int64()) for i in range(LONGEST)]
            texts = [t.decode() for t in row["texts"].split(b"\n")] if length == 1 and len(counts) else [None] * len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * len(counts), pa.int32()), pa.array([row["lang"]] * len(counts), pa.string()), *columns, pa.array(counts, pa.int64()), pa.array(texts, pa.string())],
                names=["length", "lang", *_WORDS, "f", "text"],
            )


def _fragments(df: DataFrame) -> int:
    wanted = max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return 1 << (wanted - 1).bit_length()


def count_phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(frequent phrases, totals): every phrase of up to four words with ``least`` occurrences or more.

    Phrases are (length, lang, w1, w2, w3, w4, f, text) by the hashes of their words; words alone have
    ``lang`` and ``text``. Totals are (lang, n), all word occurrences.
    """
    if shards * (LONGEST + 1) > 254:
        raise ValueError("too many shards for the activity array")
    spark, fragments = df.sparkSession, _fragments(df)
    docs = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    path = scratch(spark, "shards")
    # a scan then reads its own shard only
    docs.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")).write.partitionBy("shard").parquet(path)
    cut = spark.read.schema("lang string, text string, shard int").parquet(path)
    activity = Activity(fragments)
    state = spark.createDataFrame([], _ROW_DDL)  # packed rows, one or a few for each fragment
    scan, last = 0, -1
    while scan < shards or scan <= last + shards:
        told = spark.sparkContext.broadcast(activity)
        new = cut.filter(F.col("shard") == scan % shards).select("lang", "text").mapInArrow(_scan(told, scan, shards), _ROW_DDL)
        state = stored(
            state.groupBy("fragment").cogroup(new.groupBy("fragment")).applyInArrow(
                _merged(scan, shards, fragments, activity.size, least), _ROW_DDL
            )
        )
        # at most one place for each byte of the array
        risen = [np.frombuffer(r["places"], "<i4") for r in state.filter("length = 0").select("places").collect()]
        told.unpersist()
        if any(map(len, risen)):
            activity.add(np.concatenate(risen), scan)
            last = scan
        scan += 1
    packed = state.filter("length > 0")
    columns = "length int, lang string, " + ", ".join(f"{w} long" for w in _WORDS) + ", f long, text string"
    found = packed.mapInArrow(_unpacked, columns).filter(F.col("f") >= least)
    return stored(found), packed.filter("length = 1").groupBy("lang").agg(F.sum("total").alias("n"))


def _part(start: int, length: int, of: str = "") -> list:
    """The words of a phrase from ``start`` on, as the words of a phrase of ``length``."""
    return [F.col(f"{of}{_WORDS[start + i]}") if i < length else F.lit(None).cast("long") for i in range(LONGEST)]


def _key(words: list) -> F.Column:
    return F.struct(*[F.coalesce(w, F.lit(0)).alias(n) for w, n in zip(words, _WORDS)], sum(F.when(w.isNotNull(), 1).otherwise(0) for w in words).alias("length"))


def mine(
    df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = 2000, absorbed: int = ABSORBED, shards: int = SHARDS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language that hold together best.

    A-Z count as a-z; texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces
    and tabs. A phrase of 2 to 4 words with ``least`` occurrences within pieces (a) is cut where
    2,000,000 a div (l + r) is least, the first such cut, l and r being the occurrences of its parts.
    It goes if a longer phrase that holds it has ``absorbed`` percent of its occurrences. The rest is
    ranked by score, then by a, then by the phrase's bytes. A null language is ``und``; null and empty
    texts have no words; every row counts, repeated rows too. A language without a phrase, and an empty
    table, give no rows. Other columns are not read.
    """
    found, totals = count_phrases(df, text, lang, least, shards)
    words = found.filter("length = 1").select(F.col("w1").alias("word"), "lang", "text")
    known = found.select(_key([F.col(w) for w in _WORDS]).alias("key"), F.col("f").alias("kf"))
    phrases = found.filter("length > 1").select(*_WORDS, "length", F.col("f").alias("a"))

    exact = "decimal(38,0)"
    cuts = reduce(
        DataFrame.unionByName,
        [
            phrases.filter(F.col("length") == n).select(
                *_WORDS, "a", F.lit(cut).alias("cut"), _key(_part(0, cut)).alias("head"), _key(_part(cut, n - cut)).alias("tail")
            )
            for n in range(2, LONGEST + 1)
            for cut in range(1, n)
        ],
    )
    scored = (
        cuts.join(known.select(F.col("key").alias("head"), F.col("kf").alias("l")), "head")
        .join(known.select(F.col("key").alias("tail"), F.col("kf").alias("r")), "tail")
        .withColumn("score", F.expr(f"cast((cast(a as {exact}) * 2000000) div (cast(l as {exact}) + r) as long)"))
        .groupBy(_key([F.col(w) for w in _WORDS]).alias("key"))
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"), F.first("a").alias("a"))
    )
    inside = reduce(
        DataFrame.unionByName,
        [
            phrases.filter(F.col("length") == n).select(_key(_part(start, short)).alias("key"), F.col("a").alias("longer"))
            for n in range(3, LONGEST + 1)
            for short in range(2, n)
            for start in range(n - short + 1)
        ],
    ).groupBy("key").agg(F.max("longer").alias("longer"))
    kept_phrases = scored.join(inside, "key", "left").filter(
        F.expr(f"longer is null or cast(longer as {exact}) * 100 < cast(a as {exact}) * {absorbed}")
    )
    named = stored(
        kept_phrases.join(words.select("word", "lang"), F.col("key.w1") == F.col("word")).select(
            "lang", "key", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score")
        )
    )
    # all phrases as good as the last one of the top are spelled before the bytes decide
    marks = named.groupBy("lang", "score", "a").agg(F.count("*").alias("size"))
    marks = marks.withColumns({"down": -F.col("score"), "fewer": -F.col("a")})
    ahead = running_total(marks, ["lang"], ["down", "fewer"], {"upto": F.col("size")}).filter(F.col("upto") - F.col("size") < top)
    last = ahead.groupBy("lang").agg(F.max(F.struct("down", "fewer")).alias("last"))
    place = F.struct((-F.col("score")).alias("down"), (-F.col("a")).alias("fewer"))
    near = named.join(last, "lang").filter(place <= F.col("last")).drop("last")
    for i, w in enumerate(_WORDS):
        spelled = words.select(F.col("word").alias(f"word{i}"), F.col("text").alias(f"text{i}"))
        near = near.join(spelled, F.col(f"key.{w}") == F.col(f"word{i}"), "left")
    spelled = near.withColumn("phrase", F.concat_ws(" ", *[f"text{i}" for i in range(LONGEST)])).withColumns(
        {"down": -F.col("score"), "fewer": -F.col("a")}
    )
    ranked = top_per_group(spelled, ["lang"], ["down", "fewer", "phrase"], top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
