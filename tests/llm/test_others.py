"""Ring, transcripts, neighbours, quality and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import clashing, documents, frame, prose
from tidelake.llm import chat, hnsw, neighbours, quality, ring

# ring


def brute_walk(arcs, room):
    """Key by key round the ring, twice."""
    queue, room, out = [], list(room), []
    for shard, over in arcs + [(s, 0) for s, _ in arcs]:
        queue += [None] * over
        while queue and room[shard]:
            queue.pop(0)
            room[shard] -= 1
            out.append(shard)
    assert not queue
    return out


@pytest.mark.parametrize("n,shards,slack", [(0, 3, 0), (1, 5, 0), (997, 7, 0), (1000, 40, 0), (1200, 6, 0.1)])
def test_ring(spark, n, shards, slack):
    rows = [(i if i % 97 else None, f"text {i}") for i in range(n)]
    df = clashing(frame(spark, rows), "cell", "shard", "slot")
    got = ring.shard(df, ["doc_id", "text"], shards, slack, nodes=8, cells=512)
    assert got.columns == ["doc_id", "text", "cell", "shard", "slot"]
    found = got.collect()
    assert len(found) == n == len({r.text for r in found})
    sizes = Counter(r.shard for r in found)
    if slack:
        assert max(sizes.values()) <= -(-n * (1 + slack) // shards)
    elif n:
        assert max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())

    # place every key by the rules, one by one
    layout = [tuple(r) for r in ring.ring(spark, shards, 8, 512).orderBy("turn").select("cell", "arc", "shard").collect()]
    cell = {r.text: r.c for r in df.select("text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(512)).alias("c")).collect()}
    count = Counter(cell.values())
    bound = [-(-int(n * (1 + slack) * 1000) // (1000 * shards)) if slack else n // shards + (s < n % shards) for s in range(shards)]
    room, arcs = list(bound), []
    for c, arc, s in layout:
        kept = min(room[s], count[c])
        room[s] -= kept
        arcs.append((s, count[c] - kept))
    sent = Counter(brute_walk(arcs, room))
    homes = Counter()
    for c, _, s in layout:
        homes[s] += count[c]
    assert all(sizes[s] == min(homes[s], bound[s]) + sent[s] for s in range(shards))


def test_ring_moves_few_keys(spark):
    df = frame(spark, [(i, None) for i in range(4000)])
    home = ring.ring(spark, 10).select(F.col("cell").alias("c"), F.col("shard").alias("home"))
    own = df.withColumn("c", F.pmod(F.xxhash64("doc_id"), F.lit(ring.CELLS)))
    moved = ring.shard(own, ["doc_id"], 10).join(home, "c").filter("shard != home").count()
    assert moved < 800


def test_repeated_rows_get_their_own_slots(spark):
    found = ring.shard(frame(spark, [(1, "a")] * 50 + [(None, None)] * 50), ["doc_id", "text"], 4).collect()
    assert len({(r.shard, r.slot) for r in found}) == 100 and Counter(r.shard for r in found) == {s: 25 for s in range(4)}


# transcripts


def brute_path(model, seen):
    """The best score over all paths."""
    best, paths = None, list(product(range(chat.STATES), repeat=len(seen)))
    emit = model.emissions(seen)
    for path in paths:
        score = int(model.first[path[0]] + emit[0][path[0]])
        for i in range(1, len(path)):
            score += int(model.move[path[i - 1]][path[i]] + emit[i][path[i]])
        best = score if best is None else max(best, score)
    return best


def path_score(model, seen, path):
    emit = model.emissions(seen)
    score = int(model.first[path[0]] + emit[0][path[0]])
    return score + sum(int(model.move[a][b] + emit[i + 1][b]) for i, (a, b) in enumerate(zip(path, path[1:])))


def counts(seed):
    rng = np.random.default_rng(seed)
    n = chat.STATES
    return {"first": rng.integers(0, 9, n).astype(float), "move": rng.integers(0, 50, (n, n)).astype(float), "shows": [rng.integers(0, 30, (n, s)).astype(float) for s in chat.SHAPE]}


def test_blocks_give_the_best_path():
    rng = random.Random(3)
    for seed in range(6):
        model = chat._model(counts(seed))
        seen = np.array([[rng.randrange(s) for s in chat.SHAPE] for _ in range(5)])
        whole = chat.block_matrix(model, seen, True)[0]
        end = int(whole.argmax())
        path = chat.block_path(model, seen, True, 0, end)
        assert path_score(model, seen, path) == brute_path(model, seen) == whole.max()
        for cut in range(1, 5):
            before, after = chat.block_matrix(model, seen[:cut], True)[0], chat.block_matrix(model, seen[cut:], False)
            through = before[:, None] + after
            assert (through.max(0) == whole).all()
            start = int(through[:, end].argmax())
            joined = chat.block_path(model, seen[:cut], True, 0, start) + chat.block_path(model, seen[cut:], False, start, end)
            assert path_score(model, seen, joined) == whole.max()


def talk(conv, turns):
    return [(conv, i, r, t) for i, (r, t) in enumerate(turns)]


def conversations():
    rows = []
    for c in range(60):
        rng = random.Random(c)
        turns = [("system", "You are a helpful assistant.")] if c % 3 == 0 else []
        for i in range(rng.randint(1, 4)):
            turns += [("user", prose(c * 50 + i, 8) + "?"), ("assistant", "\n".join(prose(c * 99 + i * 7 + k, 30) for k in range(3)))]
        rows += talk(c, turns)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_roles_come_back(spark):
    known = spark.createDataFrame(conversations(), SCHEMA)
    found = chat.recover_roles(clashing(known, "part", "content", "block", "pos"), known="role").collect()
    role = {(c, t): r for c, t, r, _ in conversations()}
    right = [role[r.conv_id, r.turn] == r.role for r in found if r.part == 0]
    assert len(right) == len(role) and sum(right) >= 0.95 * len(right)
    assert all(r.rendered == f"<|{r.role}|>\n{r.content}\n<|end|>" for r in found)


def test_markers_split_a_raw_transcript(spark):
    raw = "System: Be brief.\nHuman: Why is it so?\nI wonder.\nAssistant: Because.\n- one\n- two\n### User:\nThanks\nQ: a\nA: b<|im_end|>"
    rows = [(1, 0, None, raw), (2, 0, None, None), (2, 1, None, ""), (None, None, None, "USER: hi"), (None, None, None, "USER: hi")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = chat.recover_roles(df, known="role").orderBy("conv_id", "turn", "part").collect()
    turns = [(r.role, r.content) for r in found if r.conv_id == 1]
    assert turns == [("system", "Be brief."), ("user", "Why is it so?\nI wonder."), ("assistant", "Because.\n- one\n- two"), ("user", "Thanks"), ("user", "a"), ("assistant", "b")]
    assert [(r.role, r.content) for r in found if r.conv_id is None] == [("user", "hi")] * 2
    assert [r.content for r in found if r.conv_id == 2] == ["", ""]
    assert chat.recover_roles(df.limit(0), known="role").count() == 0


def test_long_conversations_are_decoded_in_blocks(spark, monkeypatch):
    known = spark.createDataFrame(conversations(), SCHEMA)
    rows = [(1, i, *("user assistant".split()[i % 2], ("User: " if i % 2 == 0 else "Bot: ") + prose(i, 5))) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = {(r.turn, r.part): r.role for r in chat.recover_roles(df.unionByName(known), known="role").filter("conv_id = 1 and content != ''").collect()}
    monkeypatch.setattr(chat, "BLOCK_ROWS", 7)
    cut = {(r.turn, r.part): r.role for r in chat.recover_roles(df.unionByName(known), known="role").filter("conv_id = 1 and content != ''").collect()}
    assert [cut[i, 0] for i in range(300)] == ["user", "assistant"] * 150
    assert sum(whole[k] != v for k, v in cut.items()) <= 2  # the model sees no moves between blocks


# neighbours


def vectors(n, seed=1, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, dim))


def brute_nearest(rows, asked, k):
    usable = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in sorted(i for i in usable if asked(i)):
        own = usable[q]
        scored = [(-(own @ v) / np.linalg.norm(own) / np.linalg.norm(v), i) for i, v in usable.items() if i != q and len(v) == len(own)]
        out[q] = sorted((round(s, 9), i) for s, i in scored)[:k]
    return out


def check_nearest(spark, rows, least, **more):
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "rank", "score", "v", "shard").repartition(3)
    found = neighbours.nearest(df, F.col("vec_id") % 50 == 0, 5, **more)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    want, got = brute_nearest(rows, lambda i: i % 50 == 0, 5), defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((round(-r.score, 9), r.vec_id))
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in want.items() if x}
    assert all(x == sorted(x) for x in got.values())
    hits = [len(set(got[q]) & set(x)) / len(x) for q, x in want.items() if x]
    assert not hits or np.mean(hits) >= least


def test_nearest_over_several_shards(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(3000))]
    check_nearest(spark, rows, 0.97, shard_rows=500)


def test_nearest_of_odd_vectors(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(120))]
    rows += [(200, None), (250, []), (300, [0.0] * 16), (350, [float("nan")] * 16), (400, [float("inf")] + [1.0] * 15), (None, [1.0] * 16), (450, [None] * 16)]
    rows += [(500, [1.0, 2.0]), (550, [2.0, 1.0]), (600, [1.0] * 3)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [rows[5], rows[5]]
    check_nearest(spark, rows, 1.0)
    check_nearest(spark, [], 1.0)
    check_nearest(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])], 1.0)


def test_graph_recall():
    own = neighbours._unit(vectors(2500, 7, 32))
    graph = hnsw.build(own)
    assert all(g.shape[0] == 2501 for g in graph.layers) and graph.layers[0].shape[1] == 2 * hnsw.DEGREE
    found, _ = graph.search(own, own[::25])
    true = np.argsort(-(own[::25] @ own.T), axis=1, kind="stable")[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found[:, :10].tolist(), true.tolist())]) > 0.97
    assert len(hnsw.build(own[:1]).search(own[:1], own[:2])[0]) == 2


# quality


def labelled(n):
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(i, 90)
        docs.append((i, "".join(f"{w}$$$ ### " for w in text.split(" ")) if bad else text))
        labels.append((i, int(not bad)))
    return docs, labels


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(600)
    df, known = frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(df, known.filter(~quality.held_out()))
    scored = quality.score(clashing(df.withColumn("held", quality.held_out()), "score", "features"), model)
    assert scored.columns == ["doc_id", "held", "features", "score"]
    rows = scored.collect()
    assert {r.doc_id for r in rows if r.held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [(r.score >= 0.7) == (r.doc_id % 4 != 0) for r in rows if r.held]
    assert np.mean(right) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_quality_of_odd_inputs(spark):
    docs, labels = labelled(60)
    df = frame(spark, docs)
    for known in ([], [(1, 1), (2, 1)], [(1, None), (None, 1)], labels[:12] + [(0, 1), (0, 0)]):
        model = quality.fit(df, spark.createDataFrame(known, "doc_id long, quality int"))
        rows = quality.score(frame(spark), model).collect()
        assert len(rows) == len(documents()) and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(frame(spark, []), model).count() == 0


def test_queries(spark, sf):
    from tidelake.llm.queries import QUERIES

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op1_hash_ring"](spark, sf).collect()
    assert {(r.doc_id, r["size"], r.text_crc32) for r in rows} == {(d, len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in docs.items()}
    assert Counter(r.shard for r in rows) == {s: len(docs) // 40 for s in range(40)} and {r.law for r in rows} == {"rows"}
    rows = QUERIES["op10_quality"](spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in rows)
    vecs = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_nearest(vecs, lambda i: i % 50 == 0, 5)
    got = defaultdict(list)
    for r in QUERIES["op9_nearest"](spark, sf).collect():
        got[r.query_id].append((round(-r.score, 9), r.vec_id))
    assert np.mean([len(set(got[q]) & set(x)) / 5 for q, x in want.items()]) >= 0.9
    talks = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    found = [r for r in QUERIES["op3_chat_roles"](spark, sf).collect() if r.part == 0]
    role = {(t.conv_id, t.turn): t.role for t in talks}
    assert len(found) == len(talks) and np.mean([role[r.conv_id, r.turn] == r.role for r in found]) > 0.8


def test_pipeline(spark, sf):
    import corpus_pipeline
    from tests.llm.test_copies import brute_components, brute_cut
    from tidelake.llm import bpe, templates
    import public_tokenizers

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = corpus_pipeline.keep_good(spark, docs, sf).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in good}
    assert np.mean([d in kept for d, q in label.items() if q == 1]) > 0.97
    assert np.mean([d in kept for d, q in label.items() if q == 0]) < 0.5
    good = [(r.doc_id, r.text) for r in good]
    one = [(d, dict(good)[d]) for d, _, c in brute_components(good) if d == c]
    left = [(d, t) for (d, old), t in zip(one, brute_cut(one)) if t == old or (t or "").strip()]
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    leaked = {r.doc_id for r in templates.leaks(frame(spark, left), items).collect()}
    want = {d: t for d, t in left if d not in leaked}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id: r.text for r in rows} == want
    known = {rank: token for token, rank in bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).items()}
    assert all(b"".join(known[i] for i in r.ids).decode() == r.text and r.n_tokens == len(r.ids) for r in rows)
