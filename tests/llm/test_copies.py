"""The join on shingles, passages and benchmark items against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.cases import WORDS, clashing, documents, frame, prose
from tidelake.llm import components, jaccard, shingles, substrings, templates

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def brute_set(text):
    words = BLANKS.findall((text or "").translate(FOLD))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(docs):
    """Rows as (id, set size, smallest id reachable)."""
    sets = [brute_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    held = defaultdict(list)
    for i, own in enumerate(sets):
        common = Counter(j for g in own for j in held[g])
        for g in own:
            held[g].append(i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        root = find(i)
        if doc is not None:
            least[root] = min(doc, least.get(root, doc))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(docs)), key=str)


def check(spark, docs, parts=3):
    df = clashing(frame(spark, docs, parts), "n_shingles", "component_id", "set", "token")
    got = jaccard.near_components(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(docs)


def test_cases(spark):
    check(spark, documents())


def test_empty_and_blank_tables(spark):
    check(spark, [])
    check(spark, [(1, None), (2, ""), (3, "  ")])
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def edited(words, share, rng):
    return [rng.choice(WORDS) if rng.random() < share else w for w in words]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_groups_at_all_similarities(spark, seed):
    rng = random.Random(seed)
    docs = []
    for g in range(25):
        base = [rng.choice(WORDS) for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, 9)):
            docs.append((len(docs), " ".join(edited(base, rng.choice([0, 0.01, 0.02, 0.03, 0.06]), rng))))
    common = prose(99, 40)
    docs += [(1000 + i, common + " " + prose(500 + i, rng.choice([3, 8, 40]))) for i in range(60)]
    rng.shuffle(docs)
    check(spark, docs, 5)


def test_exactly_at_the_threshold(spark):
    def text(n, start):
        return " ".join(f"w{start + i}" for i in range(n + 4))

    # 8 of 10 shingles in the union, 79 of 99 and 80 of 100
    docs = [(1, text(9, 0)), (2, text(9, 1)), (3, text(89, 1000)), (4, text(89, 1010)), (5, text(90, 2000)), (6, text(90, 2010))]
    check(spark, docs)
    linked = {r.doc_id: r.component_id for r in jaccard.near_components(frame(spark, docs)).collect()}
    assert linked == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5}


def test_chains_are_followed_to_their_end(spark):
    # each text shares 0.8 or more with the next only
    docs = [(100 - i, " ".join(f"w{i * 6 + k}" for k in range(64))) for i in range(20)]
    check(spark, docs)


def test_one_large_group_makes_few_comparisons(spark):
    rng = random.Random(4)
    base = [rng.choice(WORDS) for _ in range(150)]
    docs = [(i, " ".join(edited(base, 0.004, rng))) for i in range(400)]
    check(spark, docs, 6)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(500, 500), (7, 7)]
    rng.shuffle(edges)
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}


def test_hashes_don_t_depend_on_place():
    text = " one  Two\tthree\n" * 3
    first, *rest = np.split(shingles.word_hashes(text.encode()), 3)
    assert len(first) == 3 and all((first == r).all() for r in rest)
    assert len(shingles.shingle_set(b"")) == 0 and len(shingles.shingle_set("é ß".encode())) == 1
    assert (shingles.shingle_set(b"a b") != shingles.shingle_set(b"b a")).all()


# passages


def brute_gear(text):
    h, out = 0, []
    for byte in text:
        h = ((h << 1) + int(substrings._GEAR[byte])) & 0xFFFFFFFF
        out.append(h)
    return out


def brute_cut(docs):
    """Row -> text left, by a dictionary of chunks."""
    chunks = []
    for doc, text in docs:
        raw, own, start = (text or "").encode(), [], 0
        hashes = brute_gear(raw)
        ends = [i + 1 for i, b in enumerate(raw) if b in b" \t\n\v\f\r" and hashes[i] < 1 << 30]
        for end in ends + [len(raw)] * (bool(raw) and (not ends or ends[-1] != len(raw))):
            while end - start > substrings.LONGEST:
                cut = start + substrings.LONGEST
                while raw[cut] & 0xC0 == 0x80:
                    cut -= 1
                own.append(raw[start:cut])
                start = cut
            own.append(raw[start:end])
            start = end
        chunks.append(own)
    key = [1 << 63 if d is None else d for d, _ in docs]
    first = {}
    for k, own in sorted(zip(key, chunks), key=lambda x: x[0]):
        for place, chunk in enumerate(own):
            first[chunk] = min(first.get(chunk, (k, place)), (k, place))
    left = []
    for k, own, (_, text) in zip(key, chunks, docs):
        out, run = [], []
        for place, chunk in enumerate([*own, None]):
            if chunk is not None and first[chunk] != (k, place):
                run.append(chunk)
                continue
            if len(b"".join(run).split()) < substrings.LEAST_WORDS:
                out += run
            run = []
            out.append(chunk or b"")
        left.append(None if text is None else b"".join(out).decode())
    return left


def test_passages_against_brute_force(spark):
    docs = documents()
    df = clashing(frame(spark, docs), "cut_spans", "cut_bytes", "cut_words", "places", "k")
    rows = substrings.dedup_passages(df).collect()
    want = sorted((str(d), str(t)) for (d, _), t in zip(docs, brute_cut(docs)))
    assert sorted((str(r.doc_id), str(r.text)) for r in rows) == want
    assert all(r.places == "clash" for r in rows)
    assert substrings.dedup_passages(frame(spark, [])).count() == 0


def test_planted_passages_go_and_the_rest_stays(spark):
    docs, passages = [], [prose(10_000 + i, 55) for i in range(40)]
    for i in range(160):
        a, b = prose(2 * i, 70), prose(2 * i + 1, 60)
        docs.append((i, f"{a}\n{passages[i % 40]}\n{b}" if i < 120 else f"{a} {b}"))
    rows = {r.doc_id: r for r in substrings.dedup_passages(frame(spark, docs)).collect()}
    for i in range(160):
        if i < 40 or i >= 120:
            assert rows[i].cut_words == 0 and rows[i].text == docs[i][1]
        else:
            assert 25 <= rows[i].cut_words <= 60
            # a word at the border may happen to be the same in two documents
            assert rows[i].text.startswith(prose(2 * i, 70)[:-12]) and rows[i].text.endswith(prose(2 * i + 1, 60)[12:])


def test_cuts_resist_insertions():
    text = prose(77, 400).encode()
    before = {text[a:b] for a, b in zip([0, *substrings.chunk_ends(text)], substrings.chunk_ends(text))}
    moved = b"inserted words " + text
    after = {moved[a:b] for a, b in zip([0, *substrings.chunk_ends(moved)], substrings.chunk_ends(moved))}
    assert len(before - after) <= 4


def chunks_of(text):
    raw = text.encode()
    ends = substrings.chunk_ends(raw)
    return [raw[a:b].decode() for a, b in zip([0, *ends], ends)]


def test_known_phrases_in_a_new_order_stay(spark):
    docs, mixed = [(i, prose(40_000 + i, 60)) for i in range(60)], []
    for _, text in docs:
        for chunk in chunks_of(text)[:-1]:
            if len(chunk.encode()) >= 32 and len(chunk.split()) < 15 and chunks_of("".join([*mixed, chunk])) == [*mixed, chunk]:
                mixed.append(chunk)
                break
    assert len(mixed) > 5 and len("".join(mixed).split()) > 40
    source = docs[7][1]
    docs += [(100, "".join(mixed)), (101, source + "\n" + prose(41_000, 40)), (102, prose(41_001, 40) + " " + source)]
    rows = {r.doc_id: r for r in substrings.dedup_passages(frame(spark, docs)).collect()}
    assert rows[100].text == "".join(mixed) and rows[100].cut_words == 0
    assert rows[101].cut_words >= 40 and rows[102].cut_words >= 25


# benchmark items


def test_templates_type_their_slots():
    text = "Tom gave Mary 3.5 kg of apples for 1,200 dollars. Then he ate 12kg in Él"
    found = templates.Canonical([text.encode(), b"", b"x 5"])
    kinds = {1: "N", 2: "U", 3: "P", 0: ""}
    words = [(found.folded[a:b].tobytes().decode(), kinds[t]) for a, b, t in zip(found.starts, found.ends, found.type)]
    assert words[:11] == [("tom", ""), ("gave", ""), ("mary", "P"), ("3.5", "N"), ("kg", "U"), ("of", ""), ("apples", ""), ("for", ""), ("1,200", "N"), ("dollars", "U"), ("then", "")]
    assert ("12", "N") in words and ("él", "P") in words
    # the same window whatever stands before it
    again = templates.Canonical([b"before. " + text.encode()])
    assert set(found.windows) <= set(again.windows)


PLAIN = prose(321, 40).replace("ß", "s")
ITEMS = [
    (1, "If Anna buys 12 apples and gives Peter 5 of them how many apples does Anna still have at home today"),
    (2, PLAIN),
    (3, "too short to find"),
    (4, None),
    (5, ""),
    (6, "A train goes 90 km in 2 hours and then rests for 90 minutes before it goes on to the last station"),
    (7, PLAIN),
]


def test_leaks(spark):
    docs = [
        (1, prose(50, 60) + " " + ITEMS[0][1] + " " + prose(51, 60)),
        (2, ITEMS[0][1].replace("12", "31").replace("5", "7").replace("Anna", "Maria").replace("Peter", "John")),
        (3, "so " + ITEMS[5][1].replace("90 km", "70 km").replace("90 minutes", "70 minutes")),
        (4, "so " + ITEMS[5][1].replace("90 minutes", "15 minutes")),
        (5, prose(52, 300)),
        (6, (prose(53, 20) + " " + PLAIN).upper()),
        (7, None),
        (8, ""),
        (9, "too short to find"),
        (None, PLAIN),
        (10, "12 34 56 78 " * 50),
    ]
    got = templates.leaks(
        clashing(frame(spark, docs), "window", "item", "n_windows"),
        clashing(spark.createDataFrame(ITEMS, "item_id long, text string"), "window", "item_windows"),
    )
    rows = {(r.doc_id, r.item_id): r for r in got.collect()}
    assert set(rows) == {(1, 1), (2, 1), (3, 6), (6, 2), (6, 7), (None, 2), (None, 7)}
    assert rows[1, 1].verbatim and not rows[2, 1].verbatim and rows[2, 1].n_changed == 4
    # the item's 90 stands for two different numbers in document 4, so only windows without slots count
    assert rows[3, 6].n_changed >= 1
    assert rows[6, 2].n_windows >= rows[6, 2].item_windows - 2


def test_leaks_whatever_stands_before_a_name(spark):
    items = [
        (1, "Tom has 5 red apples and gives away two of them"),
        (2, "Henry walked to the old mill. Henry saw 40 ducks there. Henry fed them. Henry went home"),
        (3, "In some old towns there are 12 more bells"),
        (4, "Later on we met old Anna Berg by the sea"),
    ]
    docs = [
        (1, "they asked whether " + items[0][1] + " or not"),
        (2, "they asked whether " + items[0][1].replace("Tom", "Maria").replace("5", "8") + " or not"),
        (3, items[0][1].replace("Tom", "Maria")),
        (4, items[1][1].replace("Henry", "Maria")),
        (5, "it is on page 14 " + items[2][1]),
        (6, items[3][1].lower()),
        (7, items[1][1].replace("Henry", "Maria", 1).replace("40", "50").replace("mill", "barn").replace("ducks", "geese")),
        (8, "they asked whether Tom has 5 red pears and gives away two of them"),
    ]
    got = templates.leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    rows = {(r.doc_id, r.item_id): r for r in got}
    assert set(rows) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 3), (6, 4)}
    assert {d for (d, _), r in rows.items() if r.verbatim} == {1, 5, 6}
    assert all(0 < r.n_windows <= r.item_windows for r in got) and rows[2, 1].n_changed == 2


def test_leaks_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert templates.leaks(frame(spark, []), items).count() == 0
    assert templates.leaks(frame(spark), items.limit(0)).count() == 0


def test_queries(spark, sf):
    from tidelake.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op2_ngram_jaccard"](spark, sf).collect()), key=str) == brute_components(docs)
    left = dict(zip([d for d, _ in docs], brute_cut(docs)))
    assert {r.doc_id: r.text for r in QUERIES["op6_passage_dedup"](spark, sf).collect()} == left
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    copied = {(d, i.item_id) for i in items for d, t in docs if t and i.text in t}
    found = {(r.doc_id, r.item_id) for r in QUERIES["op4_template_leaks"](spark, sf).collect()}
    words = {d: set(templates.Canonical([(t or "").encode()]).windows.tolist()) for d, t in docs}
    for i in items:
        own = set(templates.Canonical([i.text.encode()]).windows.tolist())
        alike = {(d, i.item_id) for d in words if len(own & words[d]) >= min(templates.LEAST_WINDOWS, len(own)) > 0}
        assert {f for f in found if f[1] == i.item_id} <= alike
    assert copied <= found
