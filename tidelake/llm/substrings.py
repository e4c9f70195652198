"""Removal of repeated passages by content-defined chunks.

A gear hash rolls over the bytes of a whole text; where its window ends at a blank and its highest bits
are zero, a chunk ends. What a chunk holds depends on the bytes around it alone, so a passage is cut
alike wherever it stands, and an insertion moves no cut behind it. Chunks are looked up by digest: the
occurrence with the smallest (document, position) stays, others are repeats. So are sequences, a chunk
with as many that follow it as have enough words together. Repeats that follow each other and have
enough words are cut out as far as sequences prove them: common phrases in a new order are known one by
one, but stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.common import give_back, schema_with, small_batches, with_columns, worker_cache
from tidelake.session import stored

#: A run of repeated chunks is cut out from so many words on. A passage of more than 50 words loses
#: about 13 words at its two ends, where chunks reach beyond it.
LEAST_WORDS = 20
#: One blank in so many ends a chunk.
WORDS_PER_CHUNK = 4
#: A chunk ends after so many bytes at the latest, at the border of a character.
LONGEST = 512
#: Bytes of text whose chunks are compared with each other before they are sent.
SLICE_BYTES = 4 << 20
#: Bytes that the rolling hash looks at.
WINDOW = 32
#: Where no blank has come for so many bytes, a chunk may end at any character, and one byte in
#: ``BYTES_PER_WORD`` counts as the beginning of a word, both as the hash decides.
UNBROKEN = 64
BYTES_PER_WORD = 16

NEW_COLUMNS = {"cut_spans": "array<struct<start: int, end: int>>", "cut_bytes": "long", "cut_words": "long"}

_GEAR = np.array([xxhash.xxh3_64_intdigest(bytes([b]), seed=7) & 0xFFFFFFFF for b in range(256)], np.uint32)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_CUT = np.uint32((1 << 32) // WORDS_PER_CHUNK)
_LAST = (1 << 63) - 1  # stands for a null id
_SEQUENCE = 1 << 31  # added to the place of a sequence


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """The gear hash at every byte: each shifts the last one left and adds its own number."""
    h = _GEAR[raw]
    width = 1
    while width < WINDOW:  # joins the hashes of two neighbouring windows of this width
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def _unbroken(raw: np.ndarray, blank: np.ndarray) -> np.ndarray | None:
    """First bytes of characters with no blank among the ``UNBROKEN`` bytes up to them; None if there are none."""
    stops = np.concatenate(([-1], np.flatnonzero(blank), [len(raw)]))
    if np.diff(stops).max() <= UNBROKEN:
        return None
    since = np.arange(len(raw)) - np.repeat(stops[:-1], np.diff(stops))[1:]
    return (since >= UNBROKEN) & (raw & 0xC0 != 0x80)


def chunk_ends(text: bytes) -> np.ndarray:
    """Ends of the chunks of a text."""
    if not text:
        return np.empty(0, np.int64)
    raw = np.frombuffer(text, np.uint8)
    blank, hashes = _BLANK[raw], gear_hashes(raw)
    found = blank & (hashes < _CUT)
    free = _unbroken(raw, blank)
    if free is not None:  # such a chunk ends before its character
        found[:-1] |= free[1:] & (hashes[:-1] < _CUT // np.uint32(BYTES_PER_WORD))
    ends = np.flatnonzero(found) + 1
    ends = ends if len(ends) and ends[-1] == len(raw) else np.append(ends, len(raw))
    gaps = np.diff(ends, prepend=0)
    if gaps.max() <= LONGEST:
        return ends
    found, before = [], 0
    for end in ends.tolist():
        while end - before > LONGEST:
            cut = before + LONGEST
            while cut > before + LONGEST - 4 and raw[cut] & 0xC0 == 0x80:
                cut -= 1
            found.append(cut)
            before = cut
        found.append(end)
        before = end
    return np.array(found)


def chunk_digests(text: bytes, ends: np.ndarray) -> np.ndarray:
    cuts = [0, *ends.tolist()]
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(text[a:b]) for a, b in zip(cuts, cuts[1:])], np.uint64)


def word_sums(text: bytes) -> np.ndarray:
    """Words that begin before each byte, and in the whole text; long stretches without blanks have several."""
    raw = np.frombuffer(text, np.uint8)
    blank = _BLANK[raw]
    begins = ~blank & np.concatenate(([True], blank[:-1]))
    free = _unbroken(raw, blank) if len(raw) else None
    if free is not None:
        begins |= free & (gear_hashes(raw) >= np.uint32((1 << 32) - (1 << 32) // BYTES_PER_WORD))
    return np.concatenate(([0], np.cumsum(begins)))


def sequence_digests(text: bytes, ends: np.ndarray, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the chunks from which on ``LEAST_WORDS`` words are left: the last one of the sequence, and its digest."""
    words = word_sums(text)
    last = np.searchsorted(words[ends], words[np.append(0, ends[:-1])] + LEAST_WORDS)
    last = last[last < len(ends)]
    raw, digest = chunks.tobytes(), xxhash.xxh3_64_intdigest
    found = [digest(raw[8 * a : 8 * b + 8], seed=1) for a, b in enumerate(last.tolist())]
    return last, np.array(found, np.uint64)


def _runs(changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs, from where a new one begins."""
    starts = np.flatnonzero(changed)
    return starts, np.diff(np.append(starts, len(changed)))


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted row differs from the one before."""
    first = np.ones(len(columns[0]), bool)
    if len(first) > 1:
        first[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return first


def _later(digest: np.ndarray, *occurrence: np.ndarray) -> np.ndarray:
    """Of rows sorted by all: which aren't the first occurrence of their digest."""
    starts, lengths = _runs(_new(digest))
    first = np.repeat(starts, lengths)
    return np.logical_or.reduce([x != x[first] for x in occurrence])


def _packed(fragment: int, doc: np.ndarray, text: np.ndarray, place: np.ndarray, digest: np.ndarray) -> tuple:
    """A row for one fragment; entries come sorted by document."""
    starts, lengths = _runs(_new(doc, text))
    return (
        fragment,
        doc[starts].astype("<i8").tobytes(),
        text[starts].astype("<i8").tobytes(),
        lengths.astype("<u4").tobytes(),
        place.astype("<u4").tobytes(),
        digest.astype("<u8").tobytes(),
    )


def _chunks(fragments: int):
    """Chunks and sequences of each batch of texts, packed by fragment of the digest.

    Of a digest that a batch has several times only the first goes to the fragment; the others are
    repeats for sure and go under a negative fragment, spread by document. So a chunk that a third of
    all documents share reaches its fragment once per batch.
    """

    def run(batches):
        worker_cache("substrings")
        for batch in small_batches(batches, "t", SLICE_BYTES):
            docs = pc.fill_null(batch.column("k"), _LAST).to_numpy(zero_copy_only=False)
            hashes = batch.column("x").to_numpy(zero_copy_only=False)
            digests, places, sizes = [], [], []
            for raw in batch.column("t").cast(pa.binary()).to_pylist():
                ends = chunk_ends(raw or b"")
                if not len(ends):
                    sizes.append(0)
                    continue
                own = chunk_digests(raw, ends)
                _, longer = sequence_digests(raw, ends, own)
                digests += own, longer
                places += np.arange(len(own)), np.arange(len(longer)) + _SEQUENCE
                sizes.append(len(own) + len(longer))
            digest = np.concatenate([*digests, np.empty(0, np.uint64)])
            doc, text = np.repeat(docs, sizes), np.repeat(hashes, sizes)
            place = np.concatenate([*places, np.empty(0, np.int64)])
            order = np.lexsort((place, text, doc, digest))
            digest, doc, text, place = digest[order], doc[order], text[order], place[order]
            later, once = _later(digest, doc, text, place), _new(digest)
            rows = []
            for known, keep in ((True, later), (False, once)):
                g, d, x, p = digest[keep], doc[keep], text[keep], place[keep]
                cut = (d ^ x) % fragments if known else (g >> np.uint64(40)).astype(np.int64) % fragments
                by = np.lexsort((p, x, d, cut))
                g, d, x, p, cut = g[by], d[by], x[by], p[by], cut[by]
                starts, lengths = _runs(_new(cut))
                for a, n in zip(starts, lengths):
                    name = -1 - int(cut[a]) if known else int(cut[a])
                    rows.append(_packed(name, d[a : a + n], x[a : a + n], p[a : a + n], g[a : a + n]))
            names = ["fragment", "docs", "texts", "counts", "places", "digests"]
            kinds = [pa.int32(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_pydict(
                {n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds))}
            )
        give_back()

    return run


def _repeats(table: pa.Table) -> pa.Table:
    """Per document, the chunks and sequences of one fragment that are repeats."""
    fragment = table.column("fragment")[0].as_py()
    docs, texts, counts, places, digests = (
        np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        for c, kind in (("docs", "<i8"), ("texts", "<i8"), ("counts", "<u4"), ("places", "<u4"), ("digests", "<u8"))
    )
    doc, text = np.repeat(docs, counts), np.repeat(texts, counts)
    if fragment >= 0:
        order = np.lexsort((places, text, doc, digests))
        digests, doc, text, places = digests[order], doc[order], text[order], places[order]
        later = _later(digests, doc, text, places)
        digests, doc, text, places = digests[later], doc[later], text[later], places[later]
    # a document's digest at a place is one, whichever of its rows told it
    order = np.lexsort((places, text, doc))
    digests, doc, text, places = digests[order], doc[order], text[order], places[order]
    fresh = _new(doc, text, places) if len(doc) else np.empty(0, bool)
    digests, doc, text, places = digests[fresh], doc[fresh], text[fresh], places[fresh]
    starts = np.flatnonzero(_new(doc, text)) if len(doc) else np.empty(0, np.int64)
    offsets = pa.array(np.append(starts, len(doc)), pa.int32())
    return pa.table(
        {
            "k": pa.array(doc[starts], pa.int64()),
            "x": pa.array(text[starts], pa.int64()),
            "places": pa.ListArray.from_arrays(offsets, pa.array(places.astype(np.int32))),
            "digests": pa.ListArray.from_arrays(offsets, pa.array(digests.view(np.int64))),
        }
    )


def repeated_spans(text: bytes, places: list[int], digests: list[int]) -> tuple[list[tuple[int, int]], int]:
    """Byte spans to cut out of a text, and their words."""
    ends = chunk_ends(text)
    if not len(ends):
        return [], 0
    known = set(zip(places, digests))
    own = chunk_digests(text, ends)
    last, longer = sequence_digests(text, ends, own)
    hit = np.array([x in known for x in enumerate(own.view(np.int64).tolist())])
    held = np.array([x in known for x in enumerate(longer.view(np.int64).tolist(), -_SEQUENCE)], bool)
    # what no repeated sequence covers
    change = np.zeros(len(ends) + 1, np.int64)
    np.add.at(change, np.flatnonzero(held), 1)
    np.add.at(change, last[held] + 1, -1)
    loose = np.cumsum(change[:-1]) == 0
    words, begins = word_sums(text), np.append(0, ends)

    def stretches(*columns):
        """First chunk, chunks, and words of each stretch that is alike."""
        starts, lengths = _runs(_new(*columns))
        return starts, lengths, words[ends[starts + lengths - 1]] - words[begins[starts]]

    for a, n, count in zip(*stretches(hit)):
        hit[a : a + n] &= count >= LEAST_WORDS
    for a, n, count in zip(*stretches(hit, loose)):
        hit[a : a + n] &= not (loose[a] and count >= LEAST_WORDS)
    spans, total = [], 0
    for a, n, count in zip(*stretches(hit)):
        if hit[a]:
            spans.append((int(begins[a]), int(ends[a + n - 1])))
            total += int(count)
    return spans, total


def dedup_passages(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with repeated passages cut out of ``text``; new columns say what was cut.

    ``cut_spans array<struct<start, end>>`` are byte ranges of the old text, ``cut_bytes`` and
    ``cut_words`` their sums. A passage stays where (id, place) is smallest. Repeats within a document
    count, too. ``doc_id`` is an integer; rows of the same id and text are one document and are cut
    alike, rows of one id with different texts are documents of their own, in the order of a hash of
    the text; null ids come last and share a rank in the same way. A null or empty text stays as it is. Columns that bear one of the new
    names are replaced, other columns and all rows are kept; an empty table gives none.
    """
    fragments = max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(F.col(doc_id).cast("long").alias("k"), F.xxhash64(text).alias("x"), F.col(text).alias("t"))
    packed = rows.mapInArrow(
        _chunks(fragments), "fragment int, docs binary, texts binary, counts binary, places binary, digests binary"
    )
    found = packed.groupBy("fragment").applyInArrow(_repeats, "k long, x long, places array<int>, digests array<long>")
    repeats = stored(
        found.groupBy(F.col("k").alias("_repeat_of"), F.col("x").alias("_repeat_text")).agg(
            F.flatten(F.collect_list("places")).alias("_places"), F.flatten(F.collect_list("digests")).alias("_digests")
        )
    )
    schema = schema_with(df, **NEW_COLUMNS)
    own = (F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)) == F.col("_repeat_of")) & (F.xxhash64(text) == F.col("_repeat_text"))
    joined = df.join(repeats, own, "left")

    def run(batches):
        worker_cache("substrings")
        for batch in small_batches(batches, text, SLICE_BYTES):
            texts, spans, words = [], [], []
            columns = (batch.column(text).cast(pa.binary()), batch.column("_places"), batch.column("_digests"))
            for t, places, digests in zip(*columns):
                t = t.as_py()
                cut, n = repeated_spans(t or b"", places.as_py(), digests.as_py()) if places.is_valid else ([], 0)
                if cut:
                    edges = [0, *(x for span in cut for x in span), len(t)]
                    t = b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2]))
                texts.append(t)
                spans.append([{"start": a, "end": b} for a, b in cut])
                words.append(n)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield with_columns(
                batch,
                {
                    text: pa.array(texts, pa.binary()).cast(pa.string()),
                    "cut_spans": pa.array(spans, kind),
                    "cut_bytes": pa.array([sum(s["end"] - s["start"] for s in x) for x in spans], pa.int64()),
                    "cut_words": pa.array(words, pa.int64()),
                },
            ).select(schema.names)
        give_back()

    return joined.mapInArrow(run, schema)
