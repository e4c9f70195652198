"""Lexical search, line dedup and phrase mining against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.cases import clashing, documents, frame, prose
from tidelake.llm import collocations, lexical, lines

FOLD = {i: i + 32 for i in range(65, 91)}
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score); one entry for each distinct (id, text) of the items."""
    counts = [Counter(TERM.findall((t or "").translate(FOLD))) for _, t in docs]
    lengths = [sum(c.values()) for c in counts]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for c in counts for t in c)
    found = []
    for item, text in set(items):
        scores = []
        for (doc, _), own, length in zip(docs, counts, lengths):
            m = 25 + (75 * length * n) // total if total else 0
            score = sum(
                repeats * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * own[t]) // (1000 * own[t] + 8 * m))
                for t, repeats in Counter(TERM.findall((text or "").translate(FOLD))).items() if own[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        found += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(found, key=repr)


def many(count: int, vocabulary: int = 300) -> list[tuple[int, str]]:
    rng = random.Random(count)
    words = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 60)))) for i in range(count)]


ITEMS = [(1, prose(1, 20)), (2, "the The same TWO words words"), (3, None), (4, "..."), (5, "tab\tnaïve 日本語のテキスト"),
         (2, "same"), (1, prose(1, 20)), (None, "two words")]


def search(spark, docs, items, **options):
    df = clashing(frame(spark, docs), "score", "rank", "term")
    asked = clashing(spark.createDataFrame(items, "item_id long, text string"), "doc_id", "block")
    got = lexical.search(df, asked, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_search_cases(spark):
    assert search(spark, documents(), ITEMS) == brute_search(documents(), ITEMS)


def test_search_prunes_nothing_that_counts(spark):
    docs = many(700)
    items = [(i, t) for i, t in many(30)] + [(99, "w0 w0 w1 w299"), (98, "w0")]
    assert search(spark, docs, items) == brute_search(docs, items)


def test_search_segments_bundles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BUNDLE_ITEMS", 4)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 600)
    docs, items = many(300), many(25)
    assert search(spark, docs, items, k=3, owners=3) == brute_search(docs, items, 3)


def test_search_empty(spark):
    assert search(spark, [], ITEMS) == []
    assert search(spark, documents(), []) == []
    assert search(spark, [(1, None), (2, "")], ITEMS) == []


def test_owners_hold_equal_shares_rare_first():
    df = np.array([1, 1000, 3, 500, 2, 700])
    owner = lexical._owners(df, 2)
    assert owner.tolist() == [0, 1, 0, 0, 0, 0] and lexical._owners(np.array([], np.int64), 3).size == 0


def brute_lines(docs, least=5):
    blanks = " \t\n\x0b\x0c\r"
    keyed = [[(line, line.strip(blanks).translate(FOLD)) for line in (t or "").split("\n")] for _, t in docs]
    held = defaultdict(set)
    for row, own in enumerate(keyed):
        for _, key in own:
            if len(key) >= 40:
                held[key].add(row)
    rank = [(-(1 << 63)) if d is None else d for d, _ in docs]
    last = {k: max(rank[r] for r in rows) for k, rows in held.items() if len(rows) >= least}
    found = []
    for row, ((doc, text), own) in enumerate(zip(docs, keyed)):
        stay = [line for line, key in own if last.get(key, rank[row]) == rank[row]]
        kept = "\n".join(stay) if len(stay) < len(own) else text
        found.append((doc, kept, len(own), len(own) - len(stay)))
    return sorted(found, key=repr)


def dedup(spark, docs, parts=3, **options):
    got = lines.dedup_lines(clashing(frame(spark, docs, parts), "n_lines", "hash", "id"), **options)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    return sorted(map(tuple, got.collect()), key=repr)


LONG, OTHER = "A line of more than forty characters, é.", "Another line that has more than forty code points"


def with_lines():
    docs = documents()
    docs += [(100 + i, f"own {i}\n  {LONG.upper() if i % 2 else LONG}\t\n{OTHER}\nend\n") for i in range(6)]
    docs += [(200, LONG), (200, f"{LONG}\n{LONG}\nx"), (None, f"{LONG}\nnull"), (None, LONG[:-1])]
    docs += [(300 + i, "é" * 39 + "\n" + "é" * 40 + f"\n{OTHER[:39]}\n" + "x" * 39) for i in range(5)]
    docs += [(None, "held by documents without an id only, so they keep it")] * 5
    return docs


@pytest.mark.parametrize("parts", [1, 7])
def test_lines(spark, parts):
    docs = with_lines()
    want = brute_lines(docs)
    assert sum(r[3] for r in want) > 10
    assert dedup(spark, docs, parts) == want


def test_line_in_a_third_of_the_rows(spark):
    docs = [(i, f"{LONG}\nrow {i}" if i % 3 == 0 else prose(i, 30)) for i in range(900)]
    assert dedup(spark, docs) == brute_lines(docs)
    assert dedup(spark, docs, least_documents=255) == brute_lines(docs, 255)


def test_lines_empty(spark):
    assert dedup(spark, []) == []


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    high, low = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
    high[: n // 2] = 7  # halves may agree
    hashed = lines.PerfectHash.over(high, low)
    assert sorted(hashed.slots(high, low).tolist()) == list(range(n))
    strange = hashed.slots(high ^ np.uint64(1), low)
    assert len(strange) == n and (strange < max(n, 1)).all()


def brute_phrases(docs, least, top, absorbed=80):
    """Sorted (lang, rank, phrase, a, l, r, n, score)."""
    found = []
    for lang in {d[0] or "und" for d in docs}:
        f = Counter()
        for own, text in docs:
            if (own or "und") != lang:
                continue
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
                words = re.findall(r"[^\x20\x09]+", piece)
                f.update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            score, cut = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= absorbed * a for b in longer):
                rows.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        found += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(found, key=repr)


def mined(spark, docs, parts=3, **options):
    df = spark.createDataFrame(docs, "lang string, text string").repartition(parts)
    got = collocations.mine(clashing(df, "phrase", "shard", "f"), **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def chatter(rows: int, seed: int = 0) -> list[tuple[str | None, str | None]]:
    rng = random.Random(seed)
    words = [f"W{i}" if i % 7 else f"é{i}'s" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    fixed = ["in spite of", "New York", "as a matter of fact", "new york city council"]

    def text():
        out = []
        for _ in range(rng.randint(0, 40)):
            out += [rng.choice(fixed) if rng.random() < 0.15 else rng.choices(words, weights)[0], rng.choice([" ", " ", "\t", ", ", "\n", ". ", "  "])]
        return "".join(out)

    langs = ["en", "en", "de", None, "und"]
    return [(langs[i % 5], text()) for i in range(rows)] + [("en", None), ("fr", ""), ("es", "one two three")] + [("en", "same row again")] * 9


def test_phrases(spark):
    docs = chatter(300)
    want = brute_phrases(docs, 10, 2000)
    assert {len(r[2].split()) for r in want} == {2, 3, 4}
    assert mined(spark, docs, least=10) == want


def test_phrases_top_and_ties(spark):
    docs = chatter(120, 1)
    assert mined(spark, docs, parts=1, least=4, top=7, shards=2) == brute_phrases(docs, 4, 7)


def test_phrases_with_a_full_activity_array(spark, monkeypatch):
    """Nearly all phrases share their bytes: they become active too early, and the counts stay exact."""
    monkeypatch.setattr(collocations, "ACTIVITY_BYTES", 1)
    docs = chatter(150, 2)
    assert mined(spark, docs, least=6, shards=3) == brute_phrases(docs, 6, 2000)


def test_phrases_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [("en", None), (None, "")]) == []
