"""Phrase mining against plain counting, on every edge the contract names."""

import random
import re
from collections import Counter

import pytest

from tests.llm.helpers import ODD, docs
from tillflow.llm import phrases as P
from tillflow.plans.explain import plan_text

SCHEMA = "doc_id long, text string, lang string"


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def plain(rows, longest, least, top):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything in memory."""
    f, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            total[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    inside = {}
    for (lang, w), n in f.items():
        if n >= least:
            for i in range(len(w)):
                for j in range(i + 1, len(w) + 1):
                    if j - i < len(w):
                        inside[lang, w[i:j]] = max(inside.get((lang, w[i:j]), 0), n)
    out = []
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least or inside.get((lang, w), 0) >= a:
            continue
        score, k = min((1000 * a * total[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], total[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(mine, 1)]
    return set(ranked)


def mined(spark, rows, longest=5, least=3, top=2000, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = [tuple(r) for r in P.collocations(df, longest, least, top).collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_rows(seed, n):
    rng = random.Random(seed)
    names = ["the", "The", "of", "New", "york", "é", "straße", "中文", "a", "b", "c", "x'y", "\x00", "\u0085", "　"]
    seps = [" ", "  ", "\t", " ", " ", " ", ", ", ".", "\n", "\r", "\x0b", "; ", "!?"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(names) + rng.choice(seps) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.3:
            text += " the New York of straße"
        rows.append((i, text, rng.choice(["en", "fr", None, "und", ""])))
    return rows


@pytest.mark.parametrize("seed,least,longest", [(1, 3, 5), (2, 1, 5), (3, 8, 3), (4, 2, 2)])
def test_collocations_are_the_plain_ones(spark, seed, least, longest):
    rows = random_rows(seed, 120)
    assert mined(spark, rows, longest, least) == plain(rows, longest, least, 2000)


def test_top_and_ties(spark):
    rows = [(i, "p q. r s. t u. v w. q r", "en") for i in range(5)] + random_rows(5, 40)
    for top in (1, 3, 7):
        assert mined(spark, rows, top=top) == plain(rows, 5, 3, top)


def test_odd_texts_repeats_and_languages(spark):
    rows = [(i, t, None if i % 2 else "en") for i, t in enumerate(ODD)] * 4
    assert mined(spark, rows) == plain(rows, 5, 3, 2000)


def test_counts_beyond_64_bits(spark):
    """Scores whose products pass 64 bits are exact."""
    big = 3_000_000_019
    rows = [("en", "", 10 * big + 7), ("en", "a", big), ("en", "b", big - 1), ("en", "a b", big - 2)]
    counts = spark.createDataFrame(rows, P.COUNTS)
    got = P.ranked(counts, 5, 2000).collect()
    assert [(r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got] == [
        (big - 2, big, big - 1, 10 * big + 7, 1000 * (big - 2) * (10 * big + 7) // (big * (big - 1)))]


def test_filters_lose_nothing(spark, monkeypatch):
    """Counts of all levels with filters as small as they get are those without filters."""
    monkeypatch.setattr(P, "LEAST_BITS", 1 << 16)
    rows = random_rows(7, 150)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["lang"], r["phrase"]): r["n"] for r in P.count_levels(df, 4, 5).collect() if r["phrase"]}
    f = Counter()
    for _, text, lang in rows:
        for w in pieces(text):
            f.update(("und" if lang is None else lang, " ".join(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    assert got == {key: n for key, n in f.items() if n >= 5}


def test_empty_table_and_extra_columns(spark):
    assert P.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    texts = ["in the house of the rising sun"] * 4
    got = P.collocations(docs(spark, texts, extra=True), least=3).collect()
    assert {(r["phrase"], r["a"]) for r in got} == {(r[2], r[3]) for r in plain([(i, t, "en") for i, t in enumerate(texts)], 5, 3, 2000)}


def test_streams_meet_in_a_merge_join(spark):
    counts = spark.createDataFrame([("en", "", 10), ("en", "a", 4), ("en", "b", 4), ("en", "a b", 3)], P.COUNTS)
    plan = plan_text(P.ranked(counts, 5, 10), "simple")
    assert plan.count("SortMergeJoin") == 2 and "CartesianProduct" not in plan
