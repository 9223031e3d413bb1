"""Texts on which sums modulo 2**64 collide: words and pieces must be told apart by what they are."""

import hashlib
import tracemalloc
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import crc, docs
from tillflow.llm import bpe, lm, minhash, packing
from tillflow.llm import textnp as T

LENGTHS = (1024, 2048, 4096, 8192)


def twins(n):
    """Two different words whose polynomials modulo 2**64 agree for every base: letters by the bits of their place."""
    odd = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in odd), "".join("ba"[b] for b in odd)


@pytest.mark.parametrize("n", LENGTHS)
def test_digests_differ_where_plain_sums_do_not(n):
    one, two = twins(n)
    data = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    at = np.array([0, n + 1]), np.array([n, 2 * n + 1])
    assert len(set(T.word_hashes(data, *at).tolist())) == 1  # why the digests aren't made that way
    assert len(set(T.word_digests(data, *at).tolist())) == 2


def test_digest_is_the_polynomial_modulo_the_prime():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 30_000).astype(np.uint8)
    start = np.sort(rng.integers(0, 29_000, 200))
    end = start + rng.integers(0, 900, 200)
    for s, e, got in zip(start.tolist(), end.tolist(), T.word_digests(data, start, end).tolist(), strict=True):
        h = 0
        for i, c in enumerate(data[s:e].tolist()):
            h = (h + (c + 1) * pow(T._ROOT, i, T.PRIME)) % T.PRIME
        assert got == int(T.mix(np.array([(h + (e - s) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])


def test_long_spans_are_summed_in_parts(monkeypatch):
    rng = np.random.default_rng(2)
    data = np.tile(rng.integers(0, 256, 5_000).astype(np.uint8), 2)
    at = np.array([0, 5_000, 17]), np.array([5_000, 10_000, 9_000])
    whole = T.word_digests(data, *at)
    monkeypatch.setattr(T, "_SUM_BYTES", 700)
    assert (T.word_digests(data, *at) == whole).all() and whole[0] == whole[1] != whole[2]


def test_long_spans_leave_the_tables_of_powers_small(monkeypatch):
    monkeypatch.setattr(T, "DIGEST_BYTES", 512, raising=False)
    T._PRIME_POWERS.clear()
    data = np.random.default_rng(3).integers(0, 256, 9_000).astype(np.uint8)
    start, end = np.array([0, 3, 700, 1_500, 8_990]), np.array([9_000, 5_000, 703, 4_100, 9_000])
    got = T.word_digests(data, start, end).tolist()
    kept = sum(len(t) for pair in T._PRIME_POWERS for t in pair)
    T._PRIME_POWERS.clear()
    for s, e, digest in zip(start.tolist(), end.tolist(), got, strict=True):
        h = sum((c + 1) * pow(T._ROOT, i, T.PRIME) for i, c in enumerate(data[s:e].tolist())) % T.PRIME
        assert digest == int(T.mix(np.array([(h + (e - s) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
    assert kept == 4 * 512


def test_digests_take_little_memory():
    """What a Python worker of an executor needs beside 2 MB of text, at most and afterwards."""
    T._PRIME_POWERS.clear()
    data = np.tile(np.frombuffer(b"abcdefghi ", np.uint8), T.STEP_BYTES // 10)
    start = np.arange(0, len(data), 10)
    tracemalloc.start()
    try:
        out = T.word_digests(data, start, start + 9)
        kept, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(set(out.tolist())) == 1
    assert most < 40 << 20 and kept < 16 << 20


def test_hashes_take_little_memory_and_are_the_same_in_blocks():
    T._POWERS.clear()
    rng = np.random.default_rng(4)
    data = rng.integers(0, 256, T.STEP_BYTES).astype(np.uint8)
    start = np.append(np.sort(rng.integers(0, len(data), 5_000)), [0, len(data)])
    end = np.minimum(start + np.append(rng.integers(0, 900, 5_000), [700_000, 0]), len(data))
    whole = T.span_hash(T._BYTE[data], start, end)
    assert (T.word_hashes(data, start, end) == whole).all()
    T._POWERS.clear()
    tracemalloc.start()
    try:
        T.word_hashes(data, start[:-2], end[:-2])
        kept, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert most < 40 << 20 and kept < 16 << 20


def test_tokenizers_keep_colliding_words_apart(spark):
    texts = [t for n in LENGTHS for t in twins(n)]
    df = docs(spark, texts).coalesce(1)
    for r in bpe.digests(df, P.path("byte_bpe_multi_50k.tiktoken")).collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces = {}
    for r in packing.pack(df, P.path("byte_bpe_50k.json")).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(texts):
        ids = [*lib.encode(t, add_special_tokens=False).ids, 0]
        for r in pieces[i]:
            own = np.array(ids[r["start"]: r["start"] + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(own)


def test_unlike_texts_of_colliding_words_are_no_duplicates(spark):
    one, two = twins(2048)
    words = [twins(64)[0], twins(64)[1]]
    spelled = [" ".join(words["ab".index(c)] for c in t) for t in twins(1024)]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs(spark, [one, two, *spelled])).collect()}
    assert got[0] == 0 and got[1] == 1


def test_unseen_word_stays_unknown(spark):
    one, two = twins(1024)
    seen = next(i for i in range(100) if crc(i) % 7 != 2)
    unseen = next(i for i in range(100) if crc(i) % 7 == 2)
    df = spark.createDataFrame([(seen, one), (unseen, two)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_known"] for r in lm.score_texts(df).collect()} == {seen: 2, unseen: 1}
