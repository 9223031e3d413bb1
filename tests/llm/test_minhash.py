"""MinHash near-dedup: the sketch, the join, and whole results against all pairs."""

import random

import numpy as np
import pandas as pd
import pytest

from tests.llm.helpers import ODD, SCHEMA, classes, docs, shingles
from tillflow.llm import graph, minhash


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    pairs = [(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[:i]
             if a == b or (s and t and len(s & t) >= 0.8 * len(s | t))]
    return classes(pairs, [d for d, _ in sets])


def mutate(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_classes_match_all_pairs(spark):
    rng = random.Random(7)
    rows = list(enumerate(ODD))
    for g in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 40, 150, 400]))]
        rows += [(len(rows) + k, mutate(rng, base, rng.randrange(0, 1 + len(base) // 25))) for k in range(rng.choice([1, 2, 6, 25]))]
    rows += [(3, "a text that shares its id with another one"), (500, rows[20][1]), (501, rows[20][1]), (None, rows[20][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        assert r["class_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or r["class_id"] == r["doc_id"])


def test_one_large_group_of_near_copies(spark):
    """Copies whose similarity to each other lies around the threshold, in one bucket of hundreds."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(1000)}" for _ in range(150)]
    rows = [(i, mutate(rng, base, rng.randrange(0, 6))) for i in range(420)]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_last_wave_finds_what_single_pivots_miss(spark, monkeypatch):
    """One pivot a bucket and blocks of 16: copies far around the threshold, in a few classes of very unequal size."""
    monkeypatch.setattr(minhash, "PIVOTS", 1)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(11)
    base = [f"w{rng.randrange(1000)}" for _ in range(150)]
    rows = [(i, mutate(rng, base, rng.choice([2, 3, 4, 5, 7]))) for i in range(160)]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and 1 < len(set(got.values())) < len(rows)


def test_keep_one_keeps_columns(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = docs(spark, [text, text + " more", "other words that are not the same", None], extra=True)
    got = minhash.keep_one(df)
    assert got.columns == df.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 2, 3]
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_agreement_estimates_weighted_jaccard():
    """Coordinates agree as often as sum(min) / sum(max), for real and for unit weights."""
    rng = np.random.default_rng(1)
    k = 2000
    for weights in ("real", "unit"):
        el = np.arange(60, dtype=np.uint64) + np.uint64(1000)
        a = rng.uniform(0.2, 9, 60) if weights == "real" else np.ones(60)
        b = np.where(rng.random(60) < 0.5, a, rng.uniform(0.2, 9, 60)) if weights == "real" else (rng.random(60) < 0.7).astype(float)
        doc = np.repeat([0, 1], 60)
        use = np.concatenate([a, b]) > 0
        sig = minhash.signatures(doc[use], np.tile(el, 2)[use], np.concatenate([a, b])[use], 2, k)
        assert np.isfinite(sig).all()
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((sig[0] == sig[1]).mean() - want) < 5 * np.sqrt(want * (1 - want) / k) + 1e-3


def test_count_weights_change_the_sketch_only_for_repeats(spark):
    plain, again = "a b c d e f g h", "a b c d e a b c d e a b c d e"
    df = docs(spark, [plain, again])
    unit = [r["bands"] for r in minhash.signature_table(df).orderBy("doc_id").collect()]
    count = [r["bands"] for r in minhash.signature_table(df, "count").orderBy("doc_id").collect()]
    assert unit[0] == count[0] and unit[1] != count[1]


def test_link_blocks_returns_no_pairs_of_one_class():
    grams = np.arange(50, dtype="<u4")
    frame = pd.DataFrame({"rep": range(40), "comp": [0] * 20 + list(range(20, 40)), "pivot": True,
                          "grams": [grams.tobytes()] * 40})
    got = minhash.link_blocks(frame)
    assert len(got) <= 21 * 21  # a link per pair of classes at most, not per pair of members
    assert len(set(classes(got.to_numpy().tolist() + [(0, i) for i in range(20)], range(40)).values())) == 1


def test_components_have_no_last_round(spark, monkeypatch):
    """A chain that one round leaves split is followed to its end, whatever number of rounds was once thought enough."""
    pairs = [(i, i + 1) for i in range(120)]
    random.Random(7).shuffle(pairs)
    monkeypatch.setattr(graph, "TASK_LINKS", 4)
    monkeypatch.setattr(graph, "MAX_ROUNDS", 1, raising=False)
    got = graph.components(spark.createDataFrame(pairs, "a long, b long").repartition(8)).collect()
    assert {r["v"] for r in got} == set(range(121)) and {r["label"] for r in got} == {0}


@pytest.mark.parametrize("links", [500_000, 40])
def test_components_of_chains_stars_and_loops(spark, monkeypatch, links):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(200, 260)] + [(5, 5), (300, 301), (301, 300)]
    pairs += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(80)]
    want = classes(pairs, {x for p in pairs for x in p})
    monkeypatch.setattr(graph, "TASK_LINKS", links)
    got = {r["v"]: r["label"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {v: c for v, c in want.items() if any(a != b and v in (a, b) for a, b in pairs)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
