"""Merge replay against tiktoken and tokenizers, and packing as an exact cover of every document."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.helpers import ODD, SCHEMA, docs
from tillflow.llm import bpe, packing

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def lib():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    letters = list("abcdest'llrevemñé中文ß😀'''—Ⅷ²  \n\n\t.,!?0123  ́\x1c\x85")
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(1500)] + [
        "it's we'll I'VE they're 'sabc ' s 'd''s", " \n x", "aaaaaaaaaaaa", "<|endoftext|> a", "x" * 3001]


def test_digests_match_tiktoken(spark, tik, texts):
    got = bpe.digests(docs(spark, texts).repartition(4), RANKS).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        ids = tik.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_encode_and_decode_round_trip(spark, lib, texts):
    df = docs(spark, texts, extra=True)
    coded = bpe.encode(df, JSON)
    back = bpe.decode(coded, JSON).collect()
    assert len(back) == len(texts)
    for r in back:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == lib.encode(text, add_special_tokens=False).ids
        assert bytes(r["bytes"]) == text.encode() and r["label"] == "own label"
    assert bpe.digests(spark.createDataFrame([], SCHEMA), RANKS).count() == 0


def test_pieces_cover_every_document_once(spark, lib, texts):
    got = packing.pack(docs(spark, texts).repartition(3), JSON).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for d, parts in by_doc.items():
        ids = [*lib.encode(texts[d] or "", add_special_tokens=False).ids, packing.END_ID]
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at: at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = total = 0
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
        total += at
    assert padding < 0.02 * total
    assert packing.pack(spark.createDataFrame([], SCHEMA), JSON).count() == 0


def test_best_cuts_are_optimal():
    """The monotone queue against the plain quadratic recursion."""
    rng = random.Random(4)
    for _ in range(30):
        size = rng.choice([8, 16, 32])
        places = [0]
        while len(places) < 60:
            places.append(places[-1] + rng.randint(1, size // 2))
        pen = [0.0] + [rng.choice([0.0, 0.5, 4.0]) for _ in places[1:]]

        def cost(cuts):
            return sum(size - (places[b] - places[a]) + pen[b] for a, b in zip(cuts, cuts[1:], strict=False))
        best = [0.0]
        for j in range(1, len(places)):
            best.append(pen[j] + min(best[i] + size - (places[j] - places[i]) for i in range(j) if places[j] - places[i] <= size))
        cuts = packing.best_cuts(np.array(places), np.array(pen), size)
        assert all(0 < places[b] - places[a] <= size for a, b in zip(cuts, cuts[1:], strict=False))
        assert abs(cost(cuts) - best[-1]) < 1e-9


@pytest.mark.parametrize("length", [1, 2, 3, 7, 700, 1019, 1021, 1023, 1024])
def test_tail_cuts_add_up(length):
    parts = packing.tail_cuts(length)
    assert sum(parts) == length
    assert sum(0 if p & (p - 1) == 0 else 1024 - p for p in parts) <= packing.INSIDE
