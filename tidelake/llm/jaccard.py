"""Exact similarity join on word shingles by vertical partitioning.

The order of all shingles is cut into fragments. One shuffle brings the shingles of each fragment
together, where those that occur in one set only are dropped; the counts of the rest are summed per set,
and a set whose shared shingles can't reach the threshold leaves the join. What stays is ordered by
frequency, and sets meet on the few rarest shingles that a link can't avoid (prefix filter). This order
is cut into ranges; the overlap of a candidate pair is counted range by range and the
partial counts are summed per pair.

Pairs are not enumerated within a group. Equal sets are one class. In turns, one class of a bucket,
whose rare shingles are shared most widely, is compared with those outside its component; so the text
that copies were made from gathers them. What is left of a bucket, in different components, meets inside
the join that would pair it: there two sets become a candidate only if their sketches, the parities of
their shingles over some thousand bits, differ in no more bits than a link allows shingles to differ. That
bound is exact, so no link between components is lost, while texts that are alike but don't link, be
they thousands, give next to no candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.common import give_back, kept, small_batches, worker_cache
from tidelake.llm.components import components
from tidelake.llm.shingles import set_hash, shingle_set

#: Two sets link when DENOMINATOR * intersection >= NUMERATOR * union.
NUMERATOR, DENOMINATOR = 4, 5
#: Bits of a shingle hash that are kept within its fragment.
LOW_BITS = 48
#: One shingle in so many counts as rare in its set.
RARE = 10
#: Turns before all pairs that are left are compared; no link depends on their number.
TURNS = 2
#: The order of shingles by frequency is cut behind these: a pair's overlap is counted range by range.
BORDERS = (2, 8, 64)
#: Bits in a set's sketch: by how many of them two sets differ at least, so many shingles they don't share.
SKETCH_BITS = 4096

_LOW = np.uint64((1 << LOW_BITS) - 1)


def _needed(n: str | Column) -> Column:
    """Shared shingles that a set of ``n`` has in any link, at least."""
    n = F.col(n) if isinstance(n, str) else n
    return F.ceil(n * NUMERATOR / DENOMINATOR)


def _packed(values: np.ndarray) -> bytes:
    """Six little-endian bytes each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : LOW_BITS // 8].tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(-1, LOW_BITS // 8)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, : LOW_BITS // 8] = raw
    return wide.view("<u8").ravel()


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1]))) if len(sorted_values) else np.empty(0, np.int64)


def _cut(key: str, text: str, fragments: int, columns: list[str]):
    """Rows for the fragments, from each batch of texts.

    A shingle that several sets of the batch hold is known to be shared: these sets keep it under a
    negative fragment, spread by set, and its fragment gets it once. So a shingle that a third of all
    documents hold reaches its fragment once per batch.
    """

    def run(batches):
        worker_cache("jaccard")
        for batch in small_batches(batches, text):
            sets: dict[int, np.ndarray] = {}
            members: list[tuple[int | None, int]] = []
            for raw in batch.column(text).cast(pa.binary()).to_pylist():
                found = shingle_set(raw or b"")
                name = set_hash(found) if len(found) else None
                members.append((name, len(found)))
                if name is not None:
                    sets.setdefault(name, found)
            names = np.fromiter(sets, np.int64, len(sets))
            sizes = np.fromiter(map(len, sets.values()), np.int64, len(sets))
            shingle = np.concatenate([*sets.values(), np.empty(0, np.uint64)])
            owner = np.repeat(np.arange(len(sets)), sizes)
            fragment = ((shingle >> np.uint64(LOW_BITS)) % np.uint64(fragments)).astype(np.int64)
            token = (fragment.astype(np.uint64) << np.uint64(LOW_BITS)) | (shingle & _LOW)
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            starts = _runs(token)
            repeats = np.diff(np.append(starts, len(token)))
            several = np.repeat(repeats > 1, repeats)
            presence = token[starts][repeats > 1]
            rows = {c: [] for c in ("fragment", "owners", "counts", "tokens", "shared")}

            def put(fragment, owners, counts, tokens, shared):
                for column, value in zip(rows.values(), (fragment, owners, counts, tokens, shared)):
                    column.append(value)

            for known in (False, True):
                mine, of = token[several == known], owner[several == known]
                cut = (names[of] % fragments) if known else (mine >> np.uint64(LOW_BITS)).astype(np.int64)
                by = np.lexsort((mine, of, cut))
                mine, of, cut = mine[by], of[by], cut[by]
                at = _runs(cut)
                for a, b in zip(at, np.append(at[1:], len(cut))):
                    heads = _runs(of[a:b])
                    counts = np.diff(np.append(heads, b - a)).astype("<u4")
                    owners = names[of[a:b][heads]].astype("<i8").tobytes()
                    if known:
                        put(-1 - int(cut[a]), owners, counts.tobytes(), mine[a:b].astype("<u8").tobytes(), b"")
                    else:
                        put(int(cut[a]), owners, counts.tobytes(), _packed(mine[a:b] & _LOW), b"")
            cut = (presence >> np.uint64(LOW_BITS)).astype(np.int64)
            at = _runs(cut)
            for a, b in zip(at, np.append(at[1:], len(cut))):
                put(int(cut[a]), b"", b"", b"", _packed(presence[a:b] & _LOW))
            m, r = batch.num_rows, len(rows["fragment"])
            ids = batch.column(key)
            yield pa.RecordBatch.from_pydict(
                {
                    "fragment": pa.array([-1 - i % fragments for i in range(len(members))] + rows["fragment"], pa.int32()),
                    "key": pa.concat_arrays([ids, pa.nulls(r, ids.type)]),
                    "set": pa.array([n for n, _ in members] + [None] * r, pa.int64()),
                    "n": pa.array([n for _, n in members] + [None] * r, pa.int64()),
                    **{c: pa.array([None] * m + rows[c], pa.binary()) for c in ("owners", "counts", "tokens", "shared")},
                }
            ).select(columns)
        give_back()

    return run


def _owned(owners: list[bytes], counts: list[bytes]) -> np.ndarray:
    return np.repeat(
        np.frombuffer(b"".join(owners), "<i8"), np.frombuffer(b"".join(counts), "<u4").astype(np.int64)
    )


def _by_set(name: np.ndarray, token: np.ndarray) -> pa.Table:
    """One row per set with its tokens; rows come sorted by set."""
    at = _runs(name)
    lists = pa.ListArray.from_arrays(
        pa.array(np.append(at, len(name)), pa.int32()), pa.array(token.astype(np.int64), pa.int64())
    )
    return pa.table({"set": pa.array(name[at], pa.int64()), "tokens": lists})


def _shared_in_fragment(kind: pa.DataType):
    """Members as they are, and for each set its shingles that another set has, too."""

    def run(table: pa.Table) -> pa.Table:
        schema = pa.schema([("key", kind), ("set", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64()))])
        fragment = table.column("fragment")[0].as_py()
        owners, counts, tokens, shared = (
            [x for x in table.column(c).to_pylist() if x] for c in ("owners", "counts", "tokens", "shared")
        )
        name = _owned(owners, counts)
        if fragment < 0:
            token = np.frombuffer(b"".join(tokens), "<u8")
            order = np.lexsort((token, name))
            name, token = name[order], token[order]
            found = _by_set(name, token)
            member = table.filter(pa.compute.is_valid(table.column("n"))).select(["key", "set", "n"])
            rows = [
                member.append_column("tokens", pa.nulls(member.num_rows, pa.list_(pa.int64()))),
                pa.table({"key": pa.nulls(found.num_rows, kind), "set": found["set"], "n": pa.nulls(found.num_rows, pa.int64()), "tokens": found["tokens"]}),
            ]
            return pa.concat_tables([t.cast(schema) for t in rows])
        token = _unpacked(b"".join(tokens))
        order = np.lexsort((name, token))
        name, token = name[order], token[order]
        first = np.ones(len(token), bool)
        first[1:] = (token[1:] != token[:-1]) | (name[1:] != name[:-1])
        name, token = name[first], token[first]  # a set that several batches hold counts once
        starts = _runs(token)
        repeats = np.diff(np.append(starts, len(token)))
        several = np.repeat((repeats > 1) | np.isin(token[starts], _unpacked(b"".join(shared))), repeats)
        name, token = name[several], token[several] | np.uint64(fragment << LOW_BITS)
        order = np.argsort(name, kind="stable")
        found = _by_set(name[order], token[order])
        return pa.table(
            {"key": pa.nulls(found.num_rows, kind), "set": found["set"], "n": pa.nulls(found.num_rows, pa.int64()), "tokens": found["tokens"]}
        ).cast(schema)

    return run


def _fragments(df: DataFrame) -> int:
    """At least as many as shuffle partitions."""
    wanted = max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return min(1 << (64 - LOW_BITS - 1), 1 << (wanted - 1).bit_length())


def _overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Links among pairs (a, b): partial overlaps of each fragment, summed per pair."""
    left = parts.select(F.col("set").alias("a"), F.col("n").alias("na"), "part", F.col("tokens").alias("ta"))
    right = parts.select(F.col("set").alias("b"), F.col("n").alias("nb"), "part", F.col("tokens").alias("tb"))
    return (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, ["b", "part"])
        .select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("overlap"))
        .groupBy("a", "b", "na", "nb")
        .agg(F.sum("overlap").alias("overlap"))
        .filter(DENOMINATOR * F.col("overlap") >= NUMERATOR * (F.col("na") + F.col("nb") - F.col("overlap")))
        .select("a", "b")
    )


def _may_link(a: str, b: str) -> Column:
    """Whether two sets that meet on a shingle can reach the threshold, and may meet there.

    Their sizes and their shared shingles must suffice for the overlap that they need together. The
    smaller set needs to offer fewer of its rarest shingles than the larger one, ties broken by name.
    """

    def col(side: str, name: str) -> Column:
        return F.col(side + name)

    sizes = DENOMINATOR * F.least(col(a, "n"), col(b, "n")) >= NUMERATOR * F.greatest(col(a, "n"), col(b, "n"))
    both = NUMERATOR * (col(a, "n") + col(b, "n"))
    enough = (NUMERATOR + DENOMINATOR) * F.least(col(a, "m"), col(b, "m")) >= both
    small = F.least(*[F.struct(col(s, "n").alias("n"), col(s, "set").alias("set"), col(s, "at").alias("at")) for s in (a, b)])
    offered = small["n"] - F.ceil(small["n"] * (2 * NUMERATOR) / (NUMERATOR + DENOMINATOR)) + 1
    return sizes & enough & (small["at"] < offered)


def _sketches(sets: DataFrame) -> DataFrame:
    """(set, sketch): for each bit, whether an odd number of the set's shingles falls on it."""
    place = F.pmod(F.xxhash64("token"), F.lit(SKETCH_BITS))
    bits = (
        sets.select("set", F.explode("tokens").alias("token"))
        .groupBy("set", F.floor(place / 64).cast("int").alias("word"))
        .agg(F.bit_xor(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(token), {SKETCH_BITS}) % 64 as int))")).alias("bits"))
    )
    by_word = bits.groupBy("set").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
    words = F.sequence(F.lit(0), F.lit(SKETCH_BITS // 64 - 1))
    return by_word.select("set", F.transform(words, lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long"))).alias("sketch"))


def _can_overlap(a: str, b: str) -> Column:
    """Whether the sketches allow the overlap that a link needs.

    Shingles that only one of two sets has are at least as many as the bits that differ; sketches
    are made from shared shingles, so the others count as not shared anyway.
    """
    differ = F.aggregate(
        F.zip_with(a + "sketch", b + "sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n
    )
    most = F.col(a + "m") + F.col(b + "m") - differ  # twice the overlap
    return (NUMERATOR + DENOMINATOR) * most >= 2 * NUMERATOR * (F.col(a + "n") + F.col(b + "n"))


def _mixed_buckets(prefix: DataFrame, links: DataFrame) -> DataFrame:
    """(token, set, n, m, wide, at, component) in the buckets that hold several components."""
    named = components(links).withColumnRenamed("node", "set")
    labelled = prefix.join(named, "set", "left").select(
        "token", "set", "n", "m", "wide", "at", F.coalesce("component", "set").alias("component")
    )
    spread = labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return labelled.join(spread.filter("lo != hi").select("token"), "token")


def near_components(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``df``.

    Words are lower-cased (A-Z) and cut at ASCII blanks; a set holds the distinct shingles of five
    words, or the whole sequence of a shorter text. Two documents link when their sets' Jaccard
    similarity is at least 4 / 5, and ``component_id`` is the smallest id that links reach. A null,
    empty or blank text has no shingles, links with nothing and is its own component. Repeated rows
    are kept; a null id is never a component's smallest unless all are null. An empty table gives
    no rows. Other columns are not read.
    """
    spark, fragments = df.sparkSession, _fragments(df)
    kind = df.select(doc_id).schema[0].dataType.simpleString()
    # ids may be structs; their parts count as nullable from here on
    rows = df.select(F.col(doc_id).cast(kind).alias("key"), F.col(text).alias("text"))
    columns = ["fragment", "key", "set", "n", "owners", "counts", "tokens", "shared"]
    cut = rows.mapInArrow(
        _cut("key", "text", fragments, columns),
        f"fragment int, key {kind}, set long, n long, owners binary, counts binary, tokens binary, shared binary",
    )
    from pyspark.sql.pandas.types import to_arrow_type

    step = kept(
        cut.groupBy("fragment").applyInArrow(
            _shared_in_fragment(to_arrow_type(rows.schema["key"].dataType)),
            f"key {kind}, set long, n long, tokens array<long>",
        )
    )
    members = step.filter("n is not null").select("key", "set", "n")
    classes = members.filter("set is not null").groupBy("set").agg(F.max("n").alias("n"), F.min("key").alias("least"))
    shared = step.filter("n is null").select("set", "tokens")

    # sets that have enough shared shingles to be in any link
    reach = shared.groupBy("set").agg(F.sum(F.size("tokens")).alias("m")).join(classes.select("set", "n"), "set")
    able = reach.filter(F.col("m") >= _needed("n")).select("set", "n")
    token_rows = kept(
        shared.join(able, "set").select("set", "n", F.explode("tokens").alias("token")).distinct()
    )
    frequency = token_rows.groupBy("token").agg(F.count("*").alias("f")).filter("f > 1")
    sets = kept(
        token_rows.join(frequency, "token")
        .groupBy("set", "n")
        .agg(F.sort_array(F.collect_list(F.struct("f", "token"))).alias("t"))
        .filter(F.size("t") >= _needed("n"))
        .select(
            "set",
            "n",
            F.col("t.token").alias("tokens"),
            # where each range of the order begins among them
            F.array(F.lit(0), *[F.size(F.expr(f"filter(t, x -> x.f <= {b})")) for b in BORDERS], F.size("t")).alias("starts"),
            # how many sets share even the rare shingles of this one: many, if others were made from it
            F.coalesce(F.get("t", (F.floor(F.col("n") / RARE) - F.col("n") + F.size("t")).cast("int"))["f"], F.lit(1)).alias("wide"),
        )
    )
    # the rarest shingles, one of which every link of the set shares with it; unshared ones come first
    alone = F.col("n") - F.size("tokens")
    prefix = kept(
        sets.select(
            "set",
            "n",
            F.size("tokens").alias("m"),
            "wide",
            alone.alias("alone"),
            F.posexplode(F.slice("tokens", F.lit(1), (F.size("tokens") - _needed("n") + 1).cast("int"))).alias("i", "token"),
        ).select("set", "n", "m", "wide", "token", (F.col("alone") + F.col("i")).alias("at"))
    )
    parts = sets.select(
        "set", "n", "tokens", "starts", F.explode(F.sequence(F.lit(0), F.lit(len(BORDERS)))).alias("part")
    ).select(
        "set", "n", "part", F.expr("slice(tokens, starts[part] + 1, starts[part + 1] - starts[part])").alias("tokens")
    )
    links = compared = spark.createDataFrame([], "a long, b long")
    for turn in range(TURNS):
        mixed = _mixed_buckets(prefix, links) if turn else prefix.withColumn("component", F.col("set"))
        # in each bucket, the set that is shared most widely meets all that lies outside its component
        place = F.struct("wide", F.xxhash64("set", F.lit(turn)).alias("h"), "set", "n", "m", "at", "component")
        leaders = mixed.groupBy("token").agg(F.max(place).alias("leader"))
        pairs = (
            mixed.join(leaders, "token")
            .filter(F.col("component") != F.col("leader.component"))
            .filter(_may_link("leader.", ""))
            .select(F.least("leader.set", "set").alias("a"), F.greatest("leader.set", "set").alias("b"))
            .distinct()
        )
        pairs = kept(pairs.join(compared, ["a", "b"], "left_anti"))
        links = links.unionByName(kept(_overlaps(pairs, parts)))
        compared = compared.unionByName(pairs)
    # what is left of the buckets: all pairs of different components that haven't met
    mixed = kept(_mixed_buckets(prefix, links))
    left = kept(_sketches(sets.join(mixed.select("set").distinct(), "set", "left_semi")))
    mixed = mixed.join(left, "set")
    one, other = (mixed.select(*[F.col(c).alias(side + c) for c in mixed.columns]) for side in ("a_", "b_"))
    # where a pair first meets in the common order, no more can follow than either set has left
    left_over = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    enough = (NUMERATOR + DENOMINATOR) * left_over >= NUMERATOR * (F.col("a_n") + F.col("b_n"))
    meet = (F.col("a_token") == F.col("b_token")) & (F.col("a_component") < F.col("b_component"))
    candidates = (
        one.join(other, meet & _may_link("a_", "b_") & enough & _can_overlap("a_", "b_"))
        .select(F.least("a_set", "b_set").alias("a"), F.greatest("a_set", "b_set").alias("b"))
        .distinct()
    )
    more = kept(_overlaps(candidates.join(compared, ["a", "b"], "left_anti"), parts))
    groups = components(links.unionByName(more))

    # the smallest id of each class, then of each component
    linked = groups.join(classes, F.col("node") == F.col("set")).select("set", "component", "least")
    least = linked.groupBy("component").agg(F.min("least").alias("component_least"))
    reached = linked.join(least, "component").select("set", "component_least")
    named = classes.select("set", "least").join(reached, "set", "left").select(
        "set", F.coalesce("component_least", "least").alias("component_id")
    )
    return members.join(named, "set", "left").select(
        F.col("key").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "key").alias("component_id"),
    )
