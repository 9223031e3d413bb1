"""Conversation repair against a plain version: every edit sequence by recursion over suffixes."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tillflow.llm import conversations as C
from tillflow.plans.explain import plan_text

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(kinds):
    """(cost, audit) over (initial, must be deleted, truncated) rows."""
    @lru_cache(maxsize=None)
    def best(i, state, room):
        ways = []
        if i == len(kinds) and state in "0a":
            ways.append((0, ""))
        if room:
            cost, text = best(i, "u" if state != "u" else "a", room - 1)
            ways.append((cost + 2, "I" + text))
        if i < len(kinds):
            initial, gone, cut = kinds[i]
            cost, text = best(i + 1, state, 3)
            ways.append((cost + 3, "D" + text))
            if not gone:
                cost, text = best(i + 1, "u" if state != "u" else "a", 3)
                ways.append((cost + 2 + cut, "R" + text))
                if state + initial in ("0s", "0u", "su", "au", "ua"):
                    cost, text = best(i + 1, initial, 3)
                    ways.append((cost + cut, "K" + text))
        return min(ways, default=(10**9, ""))
    return best(0, "0", 3)


def expected(rows):
    out = {}
    after = damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, kinds, faults = set(), [], []
        for _, _, role, text in mine:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not body else "duplicate" if (role, text) in seen
                     else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
            faults.append(fault)
            kinds.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        cost, audit = cheapest(tuple(kinds))
        turns = {r[1] for r in mine} - {None}
        initials = [k[0] for k in kinds]
        written, rest, state = [], iter(mine), "0"
        for edit in audit:
            if edit != "I":
                _, _, role, text = next(rest)
            if edit == "D":
                continue
            if edit == "K":
                state = role[:1]
            else:
                state = "u" if state != "u" else "a"
                role, text = {"u": "user", "a": "assistant"}[state], "" if edit == "I" else text
            written.append(f"{role}:{text}")
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in C.FAULTS[1:]),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(written).encode()).hexdigest())
    return out


def reported(spark, rows, schema=SCHEMA, **kw):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return {r[0]: tuple(r[1:9]) for r in C.report(df, C.damage(df), **kw).collect()}


def random_rows(seed, conversations):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(conversations), None]:
        roles = rng.choice((["user", "assistant"], ["system", "user", "assistant"], ["tool", "user", "assistant", None, "", "sub"]))
        for t in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([t, t, t, 2 * t, None]), rng.choice(roles),
                         rng.choice(["Hi.", "What? ", "no end", f"turn {t}.", "", " \t", None, "...", "Ja\u0085", "s" * 50])))
    return rows


def test_report_is_the_plain_version(spark):
    rows = random_rows(5, 250)
    assert reported(spark, rows) == expected(rows)


def test_spilled_conversations_and_small_batches(spark):
    """Every conversation spills, and batches end within conversations."""
    rows = [(conv, t, ["user", "assistant"][t % 2] if t % 7 else "system", f"text {t}" + "." * (t % 3))
            for conv in (1, 2) for t in range(60)] + random_rows(6, 20)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert reported(spark, rows, spill_rows=2) == expected(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_program_over_all_short_conversations():
    """Costs and least edits of every sequence of up to four kinds of rows, without Spark."""
    kinds = [(fault, letter) for fault in (0, 2, 3) for letter in range(4)]
    rng = random.Random(1)
    tried = [[k] for k in kinds] + [[a, b] for a in kinds for b in kinds]
    tried += [[rng.choice(kinds) for _ in range(rng.randint(3, 14))] for _ in range(3000)]
    program = C.Program()
    for case in tried:
        talk = C.Conversation("c", program)
        for fault, letter in case:
            talk.add(None, ["s", "u", "a", "x"][letter], "t", fault * 4 + letter)
        edits = list(talk.edits())
        want = cheapest(tuple((["s", "u", "a", "x"][x], f == 2, int(f == 3)) for f, x in case))
        assert (sum(e[8] for e in edits), "".join(e[2] for e in edits)) == want
    assert len(program.configs) < 500


def test_long_repeated_and_missing(spark):
    long = "word " * 200_000 + "end."
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 1, "assistant", long), (2, None, None, None),
            (2, None, None, None), (None, 5, "user", "Hi."), (None, 9, "assistant", "Ho.")]
    assert reported(spark, rows) == expected(rows)


def test_empty_and_extra_columns(spark):
    assert C.report(spark.createDataFrame([], SCHEMA), C.damage(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = [(*r, "x", 1, "y") for r in random_rows(8, 10)]
    extra = SCHEMA + ", kind string, step long, edit string"
    assert reported(spark, rows, extra) == expected([r[:4] for r in rows])


def test_a_conversation_that_loses_all_rows(spark):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert reported(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_one_shuffle_of_the_texts(spark):
    plan = plan_text(C.summarise(C.repair(spark.createDataFrame(random_rows(9, 5), SCHEMA))), "simple")
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_edits_rebuild_the_conversation(spark, seed):
    rows = random_rows(seed, 30)
    df = spark.createDataFrame(rows, SCHEMA)
    by_conv = {}
    for r in C.repair(df).orderBy("conv_id", "step").collect():
        by_conv.setdefault(r["conv_id"], []).append(r)
    for edits in by_conv.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r["new_role"][0] for r in edits if r["new_role"] is not None))
        assert [r["step"] for r in edits] == list(range(len(edits)))
    assert sum(r["edit"] != "I" for e in by_conv.values() for r in e) == len(rows)
