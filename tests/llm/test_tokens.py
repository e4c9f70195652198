from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.cases import clashing, documents, frame
from tidelake.llm import binary, bpe, mph, pretokens, rans, tokens
from tidelake.session import scratch

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_are_the_library_s(spark, library):
    df = clashing(frame(spark), "n_tokens", "over_limit", "lang")
    got = tokens.token_counts(df, JSON, limit=10)
    assert sorted(got.columns) == ["doc_id", "lang", "n_tokens", "over_limit"]
    want = sorted((str(d), len(ids(library, t)), len(ids(library, t)) > 10) for d, t in documents())
    assert sorted((str(r.doc_id), r.n_tokens, r.over_limit) for r in got.collect()) == want


def test_counts_of_another_kind_of_vocabulary(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    got = tokens.token_counts(frame(spark), path, limit=10, table={})
    assert sorted(r.n_tokens for r in got.collect()) == sorted(len(ids(other, t)) for _, t in documents())


def test_empty_tables(spark):
    df = frame(spark, [])
    assert tokens.token_counts(df, JSON, limit=1).count() == 0
    assert bpe.decode(bpe.encode(df, RANKS), RANKS).count() == 0
    path = scratch(spark, "none")
    binary.write(df, path, JSON, end_id=0)
    assert binary.read(spark, path).count() == 0 == binary.file_starts(spark, path).count()


def test_words_between_spaces_give_the_same_pre_tokens():
    rng = random.Random(5)
    pieces = pretokens.Pieces(lambda t: (t,), lambda parts: tuple(x for p in parts for x in p))
    for _ in range(20_000):
        text = "".join(rng.choices(["a", "b", "é", "1", "'s", "'", "!", " ", " ", "\n", "\t", " ", "x y"], k=rng.randint(0, 9)))
        assert list(pieces.of(text)) == pretokens.split(text), repr(text)


def test_small_caches_forget_but_don_t_err():
    memo = pretokens.Memo({"fixed": 0}, len, 3)
    for word in ["a", "bb", "ccc", "dddd", "a", "eeeee", "bb", "fixed"] * 3:
        assert memo[word] == (0 if word == "fixed" else len(word))
        assert len(memo) <= 5


def test_perfect_hash_finds_every_key_and_no_other():
    values = {str(i).encode(): i for i in range(5000)}
    found = mph.PerfectHash(values)
    assert sorted(k for k in found.keys) == sorted(values)
    assert all(found.get(k) == v for k, v in values.items())
    assert all(found.get(str(i).encode()) == -1 for i in range(5000, 9000))
    assert mph.PerfectHash({}).get(b"x") == -1


def test_bpe_is_the_reference_library_s(spark, reference):
    df = clashing(frame(spark), "ids", "decoded")
    rows = bpe.decode(bpe.encode(df, RANKS), RANKS).collect()
    want = sorted(((str(d), reference.encode_ordinary(t or "")) for d, t in documents()), key=repr)
    assert sorted(((str(r.doc_id), r.ids) for r in rows), key=repr) == want
    assert sorted(bytes(r.decoded) for r in rows) == sorted((t or "").encode() for _, t in documents())


def test_merges_take_the_lowest_rank_then_the_leftmost(reference):
    vocabulary = bpe.Vocabulary(mph.PerfectHash(bpe.read_ranks(RANKS)))
    rng = random.Random(11)
    for _ in range(3000):
        piece = bytes(rng.choices(b"aeinst \xc3\xa9\xff", k=rng.randint(1, 40)))
        assert list(vocabulary.encode(piece)) == reference._encode_single_piece(piece)


def test_null_ids_decode_to_nothing_and_unknown_ones_raise(spark):
    df = spark.createDataFrame([(1, [72, 73]), (2, None), (3, [])], "doc_id long, ids array<int>")
    rows = {r.doc_id: bytes(r.decoded) for r in bpe.decode(df, RANKS).collect()}
    known = {rank: token for token, rank in bpe.read_ranks(RANKS).items()}
    assert rows == {1: known[72] + known[73], 2: b"", 3: b""}
    with pytest.raises(Exception, match="KeyError"):
        bpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>"), RANKS).collect()


@pytest.mark.parametrize("n", [1, 31, 33, rans.BLOCK - 1, rans.BLOCK, rans.BLOCK + 1, 60_000])
def test_coder_round_trip(n):
    symbols = np.minimum(np.random.default_rng(n).zipf(1.3, n), 50_000)
    found, freq = rans.table(symbols)
    assert freq.sum() == 1 << rans.TABLE_BITS and freq.min() > 0
    states, words = rans.encode(symbols, found, freq)
    sizes = np.minimum(rans.BLOCK, n - np.arange(len(words)) * rans.BLOCK)
    assert (rans.decode(sizes, states, words, found, freq) == symbols).all()
    last = slice(len(words) - 1, None)  # any block by itself
    assert (rans.decode(sizes[last], states[last], words[last], found, freq) == symbols[(len(words) - 1) * rans.BLOCK :]).all()


def test_rare_symbols_keep_a_place():
    symbols = np.append(np.zeros(3_000_000, np.int64), np.arange(1, 40_000))
    found, freq = rans.table(symbols)
    states, words = rans.encode(symbols[-70_000:], found, freq)
    sizes = np.minimum(rans.BLOCK, 70_000 - np.arange(len(words)) * rans.BLOCK)
    assert (rans.decode(sizes, states, words, found, freq) == symbols[-70_000:]).all()


def test_files_read_back_in_order(spark, library, monkeypatch):
    path = scratch(spark, "files")
    binary.write(clashing(frame(spark), "file", "n_tokens", "k", "t"), path, JSON, end_id=0)
    starts = binary.file_starts(spark, path)
    rows = binary.read(spark, path).join(starts, "file").withColumn("start", F.col("file_start") + F.col("first")).orderBy("start").collect()
    want = sorted(documents(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in rows] == [d for d, _ in want]
    at = 0
    for row, (doc, text) in zip(rows, want):
        own = np.frombuffer(bytes(row.ids), "<u4").tolist()
        assert row.start == at and row.n_tokens == len(own) and own[-1] == 0
        if doc is not None:
            assert own[:-1] == ids(library, text)
        at += len(own)


def test_damage_is_found():
    content = binary.pack([5, None], [3, 40_000], np.random.default_rng(1).integers(0, 900, 40_003))
    file = binary.File(content)
    assert file.doc_ids == [5, None] and len(file.blocks()) == 40_003
    assert (file.blocks(1, 2) == file.blocks()[rans.BLOCK : 2 * rans.BLOCK]).all()
    broken = bytearray(content)
    broken[-1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        binary.File(bytes(broken)).blocks()
    broken = bytearray(content)
    broken[60] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        binary.File(bytes(broken))


def test_queries(spark, sf, library, reference):
    from tidelake.llm.queries import QUERIES

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in QUERIES["op5_token_counts"](spark, sf).collect():
        n = len(ids(library, docs[row.doc_id]))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(docs[row.doc_id].encode()), n, n > 512)
    rows = QUERIES["op7_byte_bpe"](spark, sf).collect()
    assert len(rows) == len(docs)
    for row in rows:
        found = reference.encode_ordinary(docs[row.doc_id])
        assert row.n_tokens == len(found)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, found)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()
    start = 0
    for row in sorted(QUERIES["op8_token_files"](spark, sf).collect(), key=lambda r: r.doc_id):
        found = np.array(ids(library, docs[row.doc_id]) + [0], "<u4")
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(found), zlib.crc32(found.tobytes()))
        start += len(found)


def test_decoding_holds_the_places_of_a_slice_only():
    found = bpe.Decoder(RANKS)
    ids = np.random.default_rng(3).integers(256, len(found.sizes), 400_000).astype(np.int32)
    tracemalloc.start()
    raw, sizes = found.decode(ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * len(raw) + 24 * len(ids) + (64 << 20) // 8
    known = {rank: token for token, rank in bpe.read_ranks(RANKS).items()}
    assert raw == b"".join(known[i] for i in ids.tolist()) and sizes.sum() == len(raw)
    assert found.decode(ids[:0])[0] == b""


@pytest.mark.parametrize("entries", [3, 100_000])
def test_texts_at_once_give_the_library_s_ids_with_few_calls_of_its_model(library, entries):
    rng, lib = random.Random(7), pretokens.Library(JSON)
    texts = ["".join(rng.choices("aàbéstñ", k=rng.randint(1, 9))) + rng.choice(["", ".", ",\nAb", "'s", "'", " ", "  ", "12", "\xa0a"]) for _ in range(6000)]
    texts = ["", " ", "the", *(" ".join(texts[at : at + 20]) for at in range(0, len(texts), 20))]
    calls, tokenize = [], lib._tokenize
    lib._tokenize = lambda letters: calls.append(letters) or tokenize(letters)
    pieces = pretokens.Pieces(
        lambda t: np.array(lib.token(t), "<u4").tobytes(), b"".join, words=entries, many=lib.words
    )
    assert pieces.all([]) == [] and lib.words([]) == []
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in pieces.all(texts)] == [ids(library, t) for t in texts]
    words = ["".join(rng.choices("abcdefgé", k=8)) for _ in range(2000)]
    calls.clear()
    assert [np.frombuffer(b, "<u4").tolist() for b in pieces.all([" ".join(["a", *words])])] == [ids(library, " ".join(["a", *words]))]
    if entries > len(words):
        assert len(calls) < 100


def test_words_go_to_the_model_one_by_one_if_merges_may_cross_a_space():
    letters = pretokens._byte_letters()
    vocab = {c: i for i, c in enumerate(letters)}
    assert pretokens._openers({"vocab": vocab}, letters).sum() == 1
    assert pretokens._openers({"vocab": vocab | {"aĠb": 256}}, letters) is None
    assert pretokens._openers({"vocab": vocab, "ignore_merges": True}, letters) is None
    lib = pretokens.Library(JSON)
    joined = lib.words(["then", "été", "x" * 300])
    lib._opens = None
    assert lib.words(["then", "été", "x" * 300]) == joined
