"""Benchmark decontamination by templates.

Texts become sequences of words in which numbers, names and units are typed placeholders. Windows of
these templates are hashed and joined, documents against benchmark items. A window that matches lays
the item's slots beside the document's; one that gives the same item value two different document
values on one alignment contradicts itself, and only windows without slots count there. So a copy is
found even if its numbers and names were exchanged, as long as they were exchanged consistently.

Whether a capitalised word is a name can't be told at the head of a sentence, and what is a head in the
item can stand in mid-sentence in a document. So each window is typed in three ways (``VARIANTS``), of
which the last two look at nothing outside the window; a match in any of them counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.common import small_batches
from tidelake.llm.shingles import hashed_spans, mixed
from tidelake.session import stored

#: Words of a window, and how many of them must not be placeholders.
WINDOW = 8
LEAST_WORDS = 4
#: Windows of an item that a document must have, or all of a shorter item: 13 words in a row.
LEAST_WINDOWS = 6
#: How capitalised words are typed: as names except at the head of a sentence, as names everywhere, as plain words.
VARIANTS = 3
#: Bits of the filter of benchmark windows, 2 MB whatever the size of the benchmark.
FILTER_BITS = 1 << 24
#: Bytes of texts that are canonicalised at once.
JOINED = 1 << 18

# Words that are units where they follow a number.
UNITS = """mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t gram grams kilogram
kilograms ton tons tonne tonnes oz ounce ounces lb lbs pound pounds ml cl l liter liters litre litres gallon
gallons pint pints cup cups s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week
weeks month months year years am pm mph kmh kph hz khz mhz ghz v volt volts w kw watt watts j kj joule joules
cal kcal calorie calories n newton newtons pa kpa bar degree degrees c f k kelvin celsius fahrenheit percent
cent cents dollar dollars usd euro euros eur gbp yen peso pesos kb mb gb tb byte bytes bit bits acre acres
hectare hectares dozen""".split()

NUMBER, UNIT, NAME = (np.uint64(c) for c in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x9B05688C2B3E6C1F))
_PLACES = mixed(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)
_DIGIT = np.isin(np.arange(256), np.frombuffer(b"0123456789", np.uint8))
_UPPER = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))
_LETTER = np.array([chr(b).isascii() and chr(b).isalpha() or b >= 128 for b in range(256)])
_STOP = np.isin(np.arange(256), np.frombuffer(b".!?:;\n\r\"|", np.uint8))


class Canonical:
    """The tokens of some texts laid one behind the other, and the hashes of their windows."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(joined, np.uint8)
        # a point or comma inside a number belongs to it
        digit = _DIGIT[raw]
        inner = np.zeros(len(raw), bool)
        if len(raw) > 2:
            inner[1:-1] = ((raw[1:-1] == 46) | (raw[1:-1] == 44)) & digit[:-2] & digit[2:]
        kind = np.where(digit | inner, 1, np.where(_LETTER[raw], 2, 0)).astype(np.int8)
        # the second byte of a capital letter of Latin-1
        accent = np.zeros(len(raw), bool)
        accent[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        capital = _UPPER[raw]
        self.folded = raw + np.where(capital | accent, np.uint8(32), np.uint8(0))
        change = np.flatnonzero(np.diff(np.concatenate(([0], kind, [0]))))
        starts, ends = change[:-1], change[1:]
        solid = kind[starts] > 0 if len(starts) else np.empty(0, bool)
        self.starts, self.ends = starts[solid], ends[solid]
        count = len(self.starts)
        lengths = np.array([len(t) + 1 for t in texts])
        self.begins = np.cumsum(lengths) - lengths
        self.text = np.searchsorted(self.begins, self.starts, "right") - 1
        self.type = np.zeros(count, np.int8)
        self.windows = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        #: Bits of the variants in which a window has this hash.
        self.variants = np.empty(0, np.int8)
        if not count:
            return
        self.first = np.searchsorted(self.text, np.arange(len(texts)))
        code = hashed_spans(self.folded, self.starts, self.ends)
        number = kind[self.starts] == 1
        follows = np.zeros(count, bool)
        follows[1:] = number[:-1] & (self.text[1:] == self.text[:-1])
        unit = follows & ~number & np.isin(code, _unit_codes())
        # a capitalised word that nothing makes the first of a sentence
        stops = np.concatenate(([0], np.cumsum(_STOP[raw])))
        begun = np.ones(count, bool)
        begun[1:] = stops[self.starts[1:]] > stops[self.ends[:-1]]
        begun[1:] |= self.text[1:] != self.text[:-1]
        head = capital[self.starts] | accent[np.minimum(self.starts + 1, len(raw) - 1)]
        second = self.starts + 1 + accent[np.minimum(self.starts + 1, len(raw) - 1)]
        large = capital[np.minimum(second, len(raw) - 1)] | accent[np.minimum(second + 1, len(raw) - 1)]
        small = (second < self.ends) & ~large
        capitalised = head & small & ~number & ~unit
        self.type[number], self.type[unit], self.type[capitalised & ~begun] = 1, 2, 3
        n = count - WINDOW + 1
        if n < 1:
            return
        # what a unit or a name is without its context: a window's first word may follow a number outside of it
        alone = np.where(number, NUMBER, code)
        names = np.where(head & small & ~number, NAME, alone)
        coded = np.where(number, NUMBER, np.where(unit, UNIT, code))
        totals, enough = [], []
        inside = self.text[:n] == self.text[WINDOW - 1 :]
        for variant in range(VARIANTS):
            name = self._names(variant, capitalised)
            whole = np.where(name, NAME, coded)
            first = (whole, names, alone)[variant]
            total = first[:n] * _PLACES[0]
            for i in range(1, WINDOW):
                total += whole[i : n + i] * _PLACES[i]
            plain = ~(number | unit | name)
            sums = np.concatenate(([0], np.cumsum(plain)))
            lead = plain[:n] if variant == 0 else (first != NUMBER)[:n] & (first != NAME)[:n]
            enough.append(inside & (sums[WINDOW:] - sums[1 : n + 1] + lead >= LEAST_WORDS))
            totals.append(total)
        # a window that is the same in two variants is one entry
        bits = [e.astype(np.int8) << v for v, e in enumerate(enough)]
        for v in range(1, VARIANTS):
            for earlier in range(v):
                same = (bits[v] > 0) & (bits[earlier] > 0) & (totals[v] == totals[earlier])
                bits[earlier] = bits[earlier] | np.where(same, bits[v], 0).astype(np.int8)
                bits[v] = np.where(same, 0, bits[v]).astype(np.int8)
        kept = [np.flatnonzero(b) for b in bits]
        self.at = np.concatenate(kept)
        self.windows = mixed(np.concatenate([t[k] for t, k in zip(totals, kept)]))
        self.variants = np.concatenate([b[k] for b, k in zip(bits, kept)])
        self.capitalised = head & small & ~number

    def _names(self, variant: int, capitalised: np.ndarray) -> np.ndarray:
        return (self.type == 3, capitalised, np.zeros(len(self.type), bool))[variant]

    def counts(self) -> np.ndarray:
        """Windows of each text: places that have one, then those of each variant."""
        shown = [np.unique(self.at)] + [self.at[self.variants & 1 << v > 0] for v in range(VARIANTS)]
        return np.stack([np.bincount(self.text[at], minlength=len(self.begins)) for at in shown], 1)

    def slots(self, at: int, variant: int = 0) -> list[str]:
        """Type and value of the placeholders of the window that begins at token ``at``."""
        found = []
        for i in range(at, at + WINDOW):
            kind = int(self.type[i])
            if variant and (kind == 3 or kind == 0 or (kind == 2 and i == at)):
                kind = 3 if variant == 1 and self.capitalised[i] else 0
            if kind:
                value = self.folded[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace")
                found.append(f"{'-nua'[kind]}{i - at}:{value}")
        return found


_units: list[np.ndarray] = []


def _unit_codes() -> np.ndarray:
    if not _units:
        joined = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
        ends = np.cumsum([len(u) + 1 for u in UNITS]) - 1
        _units.append(np.sort(hashed_spans(joined, ends - [len(u) for u in UNITS], ends)))
    return _units[0]


def _windows(key: str, text: str, names: list[str], bits):
    """Rows of windows; with ``bits``, only those that the filter lets through."""

    def run(batches):
        for batch in small_batches(batches, text):
            ids, texts = batch.column(key), batch.column(text).cast(pa.binary()).to_pylist()
            rows, hashes, places, variants, counts, slots = [], [], [], [], [], []
            start = 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size < JOINED):
                    size += len(texts[end] or b"")
                    end += 1
                found = Canonical([t or b"" for t in texts[start:end]])
                hit = np.arange(len(found.at))
                if bits is not None:
                    low = found.windows & np.uint64(FILTER_BITS - 1)
                    hit = np.flatnonzero(bits.value[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8) & 1)
                at, mask = found.at[hit], found.variants[hit]
                owner = found.text[at] if len(at) else np.empty(0, np.int64)
                rows += (owner + start).tolist()
                hashes += found.windows[hit].view(np.int64).tolist()
                places += (at - found.first[owner]).tolist() if len(at) else []
                variants += mask.tolist()
                counts += found.counts()[owner].tolist() if bits is None else [None] * len(at)
                slots += [found.slots(i, (m & -m).bit_length() - 1) for i, m in zip(at.tolist(), mask.tolist())]
                start = end
            yield pa.RecordBatch.from_pydict(
                {
                    names[0]: ids.take(pa.array(rows, pa.int64())),
                    "window": pa.array(hashes, pa.int64()),
                    names[1]: pa.array(places, pa.int64()),
                    names[2]: pa.array(variants, pa.int32()),
                    names[3]: pa.array(counts, pa.list_(pa.int64())),
                    names[4]: pa.array(slots, pa.list_(pa.string())),
                }
            )

    return run


def _filter(windows: DataFrame) -> np.ndarray:
    """The bits of all benchmark windows, put together by Spark in at most 512 rows of 4 KB."""
    bit = F.col("window").bitwiseAND(FILTER_BITS - 1)
    rows = (
        windows.select(F.shiftright(bit, 15).cast("int").alias("part"), bit.bitwiseAND(32767).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows:
        bits[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bits


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    doc_text: str = "text",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and benchmark item that it contains.

    Columns: ``doc_id``, ``item_id``, ``n_windows`` (item windows found, on alignments that keep their
    slots consistent), ``item_windows``, ``n_slots``, ``n_changed`` (slots with another value than the
    item's) and ``verbatim`` (none changed). Windows count once, whatever the variants they are found in;
    the slots of an alignment are judged in each variant by themselves. An item is contained if
    ``LEAST_WINDOWS`` of its windows are found, or all that it has in one of the variants; an item of fewer than ``WINDOW`` words, or of
    placeholders mostly, has no windows and is never found, and so are null and empty texts on
    either side. Rows of documents that repeat an id count as one document. Empty tables give no
    rows. Items with the same text are all reported.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).alias("t"))
    texts = docs.select(F.col(doc_id).alias("d"), F.col(doc_text).alias("t"))
    kind = {c: s.schema[c].dataType.simpleString() for c, s in (("i", items), ("d", texts))}
    item_rows = stored(
        items.mapInArrow(
            _windows("i", "t", ["item", "item_at", "item_variants", "item_counts", "item_slots"], None),
            f"item {kind['i']}, window long, item_at long, item_variants int, item_counts array<long>, item_slots array<string>",
        )
    )
    bits = spark.sparkContext.broadcast(_filter(item_rows))
    doc_rows = texts.mapInArrow(
        _windows("d", "t", ["doc", "doc_at", "doc_variants", "doc_counts", "doc_slots"], bits),
        f"doc {kind['d']}, window long, doc_at long, doc_variants int, doc_counts array<long>, doc_slots array<string>",
    ).drop("doc_variants", "doc_counts")
    variants = range(VARIANTS)

    def held(v: int):
        return F.col("item_variants").bitwiseAND(1 << v) > 0

    matched = doc_rows.join(item_rows, "window").withColumn("shift", F.col("doc_at") - F.col("item_at"))
    matched = matched.withColumn("variant", F.explode(F.filter(F.array(*[F.when(held(v), v) for v in variants]), F.isnotnull)))
    # a window's slots side by side: type and place, item value, document value
    pair = F.zip_with("item_slots", "doc_slots", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    aligned = matched.groupBy("doc", "item", "shift", "variant").agg(
        F.max("item_counts").alias("counts"),
        F.collect_set("item_at").alias("all_at"),
        F.collect_set(F.when(F.size("item_slots") == 0, F.col("item_at"))).alias("plain_at"),
        F.flatten(F.collect_set(F.transform(pair, lambda p: F.struct(
            F.regexp_replace(p["a"], r"^(.)\d+:", "$1:").alias("a"), F.regexp_replace(p["b"], r"^(.)\d+:", "$1:").alias("b")
        )))).alias("slots"),
    )
    slots = F.array_distinct("slots")
    steady = F.size(slots) == F.size(F.array_distinct(F.transform(slots, lambda s: s["a"])))
    judged = aligned.select(
        "doc", "item", "shift", "variant", "counts",
        F.when(steady, F.col("all_at")).otherwise(F.col("plain_at")).alias("found"),
        F.when(steady, F.size(slots)).otherwise(0).alias("slots"),
        F.when(steady, F.size(F.filter(slots, lambda s: s["a"] != s["b"]))).otherwise(0).alias("changed"),
    )

    def distinct(found):
        return F.size(F.array_distinct(F.flatten(found))).cast("long")

    shifted = judged.groupBy("doc", "item", "shift").agg(
        F.max("counts").alias("counts"),
        F.flatten(F.collect_list("found")).alias("found"),
        *[F.flatten(F.collect_list(F.when(F.col("variant") == v, F.col("found")))).alias(f"found_{v}") for v in variants],
        F.max("slots").alias("slots"),
        F.max("changed").alias("changed"),
    )
    whole = shifted.groupBy("doc", "item").agg(
        F.max("counts").alias("counts"),
        distinct(F.collect_list("found")).alias("n_windows"),
        *[distinct(F.collect_list(f"found_{v}")).alias(f"n_{v}") for v in variants],
        F.sum("slots").cast("long").alias("n_slots"),
        F.sum("changed").cast("long").alias("n_changed"),
    ).withColumn("item_windows", F.col("counts")[0])
    least = F.lit(LEAST_WINDOWS)
    contained = F.col("n_windows") >= F.least(least, "item_windows")
    for v in variants:
        own = F.col("counts")[v + 1]
        contained |= (own > 0) & (F.col(f"n_{v}") >= F.least(least, own))
    return whole.filter(contained).select(
        F.col("doc").alias(doc_id),
        F.col("item").alias(item_id),
        "n_windows",
        "item_windows",
        "n_slots",
        "n_changed",
        (F.col("n_changed") == 0).alias("verbatim"),
    )
