"""Quality ledger and line dedup against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, SCHEMA, WORD, docs
from tillflow.llm import linededup, quality
from tillflow.plans.explain import has_python_udf


def brute_quality(text):
    text = text or ""
    w = WORD.findall(text)
    seen, where = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            where |= {i + k for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(where))


def test_measures_match_brute_force(spark):
    rng = random.Random(2)
    texts = ODD + [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 80))) for _ in range(40)]
    texts += ["\n".join(rng.choice(["x y", " ", "x y ", "z"]) for _ in range(9)) for _ in range(20)]
    rows = quality.quality(docs(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_quality(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])


def test_policies_are_masks_over_one_ledger(spark):
    led = quality.ledger(docs(spark, ODD)).cache()
    table = {r["rule"]: r for r in quality.ablation(led, "v2").collect()}
    bits = [r["failed"] for r in led.collect()]
    for rule, bit in quality.BIT.items():
        assert table[rule]["n_failed"] == sum(bool(b & bit) for b in bits)
        assert table[rule]["n_only"] == sum(b == bit for b in bits)
        assert table[rule]["n_kept"] == sum(b == 0 for b in bits)
    assert set(quality.POLICIES["v1"]) <= set(quality.POLICIES["v2"])


def test_keep_good_keeps_columns_and_clean_texts(spark):
    clean = "This is a plain text of more than twenty words that says one thing after another and then it simply ends here."
    df = docs(spark, [clean, clean, None, "short"], extra=True)
    got = quality.keep_good(df)
    assert got.columns == df.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 1]
    assert quality.quality(docs(spark, [])).count() == 0
    assert not has_python_udf(got)


def test_scripts_without_blanks_are_no_long_words(spark):
    lao, han, thai = "ພາສາລາວເປັນພາສາທີ່ສວຍງາມຫຼາຍ", "这是一个没有空格的很长的句子它说的是天气很好我们出去走走", "ภาษาไทยเขียนติดกันโดยไม่มีช่องว่างระหว่างคำ"
    texts = [" ".join(f"{x}{i}" for i in range(24)) for x in (han, thai, lao, "averyveryverylongword" * 2)]
    texts.append(texts[0] + " " + "x" * 600)
    led = {r["doc_id"]: r for r in quality.ledger(docs(spark, texts)).collect()}
    assert [bool(led[i]["failed"] & quality.BIT["word_length"]) for i in range(5)] == [False, False, False, True, True]
    assert led[0]["n_unspaced"] == 24 * len(han) and led[3]["n_unspaced"] == 0
    assert all(r["word_chars"] > quality.LONG_WORD * r["n_words"] for r in led.values())


def brute_lines(rows):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20 and d is not None:
                holders.setdefault(key(line), set()).add(d)
    hot = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or hot.get(key(x), d) == d]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(3)
    pool = [f"This is the shared passage number {i} É" for i in range(12)] + ["short", "", " ", "\t"]
    pool += [p.upper().replace("É", "é") for p in pool[:4]] + ["  " + p + "\r" for p in pool[:4]]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 8)))) for i in range(60)]
    rows += [(60, None), (61, ""), (None, pool[0]), (5, rows[5][1]), (6, pool[1] + "\n" + pool[2]), (62, (pool[3] + "\n") * 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = linededup.line_dedup_digest(df)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_lines(rows), key=repr)
    assert not has_python_udf(got)


def test_line_dedup_keeps_columns(spark):
    df = docs(spark, ODD, extra=True)
    got = linededup.line_dedup(df)
    assert set(df.columns) <= set(got.columns) and got.count() == len(ODD)
    assert got.filter(F.col("key") != "own key").count() == 0
    assert linededup.line_dedup_digest(spark.createDataFrame([], SCHEMA)).count() == 0
    names = ("__id", "__row", "__drop", "__text", "__h", "__split", "__own", "__doc", "row", "h1", "n_dropped")
    for c in names:
        df = df.withColumn(c, F.lit(f"own {c}"))
    got = linededup.line_dedup(df)
    assert set(df.columns) <= set(got.columns) and got.count() == len(ODD)
    assert all(got.filter(F.col(c) != f"own {c}").count() == 0 for c in ("__id", "__split", "__own", "row"))


@pytest.mark.parametrize("policy", sorted(quality.POLICIES))
def test_rules_of_a_policy_exist(policy):
    assert quality.mask(policy) < 1 << len(quality.RULES)
