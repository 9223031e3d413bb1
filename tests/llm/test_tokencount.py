"""Token counts against the tokenizers library with its defaults."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import ODD, docs
from tillflow.llm import tokencount as C

JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(JSON)


def random_texts(seed, n):
    rng = random.Random(seed)
    some = ["a", "b", "the ", " The", "'s", "'ll", "'re", "é", "中文", "🙂", "\n", "\t", " ", "  ", "12", "³", "<|endoftext|>",
            "<|endoftext", "|>", "ing", "tion", "́", " ", " "]
    return ["".join(rng.choice(some) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def counted(spark, texts, **kw):
    return {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"])
            for r in C.count_tokens(docs(spark, texts).repartition(3), JSON, **kw).collect()}


def want(lib, texts, limit=512):
    out = {}
    for i, t in enumerate(texts):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        out[i] = (len((t or "").encode()), n, n > limit)
    return out


def test_counts_are_the_librarys(spark, lib):
    texts = ODD + random_texts(1, 1500) + ["<|endoftext|>", "x<|endoftext|><|endoftext|> y", "a" * 4001, "ab" * 3000, "<|endoftext|" * 9]
    assert counted(spark, texts) == want(lib, texts)


def test_limit_is_exclusive(spark, lib):
    texts = [" the" * 512, " the" * 513, "the" + " the" * 511]
    assert [v[1:] for _, v in sorted(counted(spark, texts).items())] == [(512, False), (513, True), (512, False)]
    assert counted(spark, texts, limit=3) == want(lib, texts, 3)


def test_memo_forgets_without_changing_counts(lib, monkeypatch):
    monkeypatch.setattr(C, "MEMO_PIECES", 5)
    memo = C.Memo(C.load(JSON))
    for text in random_texts(2, 300):
        assert C.count_texts(C.T.large(C.pa.array([text])), memo)[0] == len(lib.encode(text, add_special_tokens=False).ids)
    assert len(memo) <= 5


def test_pairs_of_one_rank_go_left_to_right(lib):
    v = C.load(JSON)
    rng = random.Random(3)
    for _ in range(500):
        word = "".join(rng.choice("aehtn") for _ in range(rng.randint(1, 40)))
        assert C.count_piece(v, word.encode()) == len(lib.encode(word, add_special_tokens=False).ids)


def test_keeps_named_columns_only(spark, lib):
    df = docs(spark, ["one two", None], extra=True)
    out = C.count_tokens(df, JSON, keep=("doc_id", "label", "lang"))
    assert out.columns == ["doc_id", "label", "lang", "n_bytes", "n_tokens", "over_limit"]
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(0, "own label", "en", 7, 2, False), (1, "own label", "en", 0, 0, False)]
    with pytest.raises(ValueError, match="named like results"):
        C.count_tokens(df, JSON, keep=("n_tokens",))


def test_empty_table(spark):
    out = C.count_tokens(docs(spark, ["x"]).limit(0), JSON)
    assert out.count() == 0 and out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
