"""Language identification by cross-parsing entropy.

Per language a suffix automaton is built from labelled text: a path from its root exists
for exactly the strings that occur in that text. A document is parsed against each
automaton into the longest matches, one after the other. A phrase costs about log2 of
the learned text's length in bits, so phrases * log2(n) / length estimates the cross-entropy
of the document under the language, and the language needing fewest bits wins.

Only the automata's transitions are needed to parse. They are kept as displaced rows: the rows of
all states share one array, each shifted to a place where its moves fall into free slots, and a slot
names the state it belongs to. A transition that isn't there restarts at the root and sets a flag. The
size of a model thus follows the learned text, not states times letters, in scripts with thousands
of letters too. Thousands of text segments are parsed in step, a few gathers per symbol and language.
Segments (SEGMENT symbols) cut a phrase here and there, in every language alike.
Letters are lower-cased; everything else is a break, and runs of breaks count once.

The learned text is a bounded sample of whole labelled texts, a language at most ROWS distinct ones
(chosen by hash of the text) of at most ROW_CHARS characters each and CHARS together; a language whose labelled
texts are all longer learns from its shortest one. Rows whose label the other half of
the sample contradicts are left out, as a copy of a mislabelled text would find itself in the
wrong automaton. Every text is parsed whole.

Edge cases: a null text, or one without letters, is ``und`` with score 0; ties go to the
language with more labelled rows, then by name; letters that no sample has match nothing; rows
with a null doc_id count as training rows; no labelled rows at all: every text is ``und``; an empty
table gives an empty result; repeated rows get equal results; further columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm import textnp as T
from tillflow.llm.bpe import classes
from tillflow.llm.toxicity import in_fold

CHARS, ROWS, ROW_CHARS = 16_000, 48, 2_000
SEGMENT = 256
UNKNOWN = "und"
#: Bits of difference that count as evidence: neighbouring phrases are not independent.
TEMPER = 0.5


class Moves(NamedTuple):
    base: np.ndarray       # state -> where its row begins in the slots
    slots: np.ndarray      # base + symbol -> state it belongs to << 32 | next state * 2
    root: np.ndarray       # symbol -> the root's next state * 2 + 1, for a move that a state lacks


class Model(NamedTuple):
    langs: list            # best first among ties
    symbols: np.ndarray    # symbol of each BMP code point: 0 break, 1 other letter, 2… learned letters
    moves: list            # per language
    bits: np.ndarray       # per language, bits of a phrase


def _fold_table() -> np.ndarray:
    """Lower-case code point of every BMP letter, 0 of everything else."""
    out = np.zeros(1 << 16, np.int64)
    for c in range(1 << 16):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
    return out


def automaton(seq: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``seq``; state 0 is the root."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in seq:
        cur = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return go


def _displaced(go: list[dict[int, int]], width: int) -> Moves:
    """The moves of an automaton over symbols below ``width`` as displaced rows, fullest rows first.

    Rows of several moves search onwards from the last one's place; rows of one fill the gaps."""
    room = 2 * sum(map(len, go)) + width
    taken = bytearray(room)
    base = np.zeros(len(go), np.int32)
    at = gap = 0
    for s in sorted(range(len(go)), key=lambda s: -len(go[s])):
        row = list(go[s])
        if len(row) > 1:
            while any(taken[at + c] for c in row):
                at += 1
                if at + width > len(taken):
                    taken.extend(bytes(len(taken)))
            place = at
        elif row:
            while taken[gap] or gap < row[0]:
                gap += 1
                if gap + width > len(taken):
                    taken.extend(bytes(len(taken)))
            place = gap - row[0]
        else:
            continue
        base[s] = place
        for c in row:
            taken[place + c] = 1
    slots = np.full(int(base.max()) + width, -1 << 32, np.int64)
    root = np.ones(width, np.int64)
    for s, moves in enumerate(go):
        for c, t in moves.items():
            slots[base[s] + c] = s << 32 | t * 2
    for c, t in go[0].items():
        root[c] = t * 2 + 1
    return Moves(base, slots, root)


def _squeeze(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of breaks as one, none at a text's beginning."""
    if len(symbols) == 0:
        return symbols, at
    keep = symbols != 0
    before = np.concatenate([[False], keep[:-1]])
    first = at[:-1][np.diff(at) > 0]
    before[first] = False
    keep |= before
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])
    return symbols[keep], total[at]


def fit(rows: list[tuple[str, str]], counts: dict[str, int]) -> Model | None:
    """A model from (language, text) rows; ``counts`` orders the languages for ties."""
    fold = _fold_table()
    parts: dict[str, list[np.ndarray]] = {}
    for lang, text in rows:
        points = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
        parts.setdefault(lang, []).append(np.append(fold[np.minimum(points, 0xFFFF)] * (points <= 0xFFFF), 0))
    langs = sorted((x for x in parts if any(p.any() for p in parts[x])), key=lambda x: (-counts.get(x, 0), x))
    if not langs:
        return None
    text = {x: np.concatenate(parts[x]) for x in langs}
    letters = np.unique(np.concatenate([t[t > 0] for t in text.values()]))
    number = np.where(fold > 0, 1, 0).astype(np.int32)
    place = np.searchsorted(letters, fold)
    known = (fold > 0) & (letters[np.minimum(place, len(letters) - 1)] == fold)
    number[known] = place[known] + 2
    width = len(letters) + 2
    moves, bits = [], []
    for x in langs:
        seq = np.where(text[x] > 0, number[text[x]], 0)
        seq = _squeeze(seq, np.array([0, len(seq)]))[0]
        moves.append(_displaced(automaton(seq.tolist()), width))
        bits.append(np.log2(len(seq) + 2))
    return Model(langs, number, moves, np.array(bits))


def fit_checked(rows: list[tuple[str, str]], counts: dict[str, int]) -> Model | None:
    """``fit`` without mislabelled rows: each half of the sample is judged by the other half's
    model, and only rows whose label is confirmed are learned (all rows of a language that has none)."""
    half = [fit(rows[k::2], counts) for k in (0, 1)]
    good = []
    for k in (0, 1):
        judge = half[1 - k]
        said, _ = predict(judge, pa.array([t for _, t in rows[k::2]], pa.large_string()))
        good += [r for r, x in zip(rows[k::2], said, strict=True) if judge is None or r[0] not in judge.langs or x == r[0]]
    have = {x for x, _ in good}
    return fit(good + [r for r in rows if r[0] not in have], counts)


def phrases(model: Model, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of longest-match phrases of every text (rows) under every language (columns)."""
    n = len(at) - 1
    many = -(-np.diff(at) // SEGMENT)
    owner = np.repeat(np.arange(n), many)
    begin = at[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)) * SEGMENT
    size = np.minimum(SEGMENT, at[owner + 1] - begin)
    order = np.argsort(-size, kind="stable")  # those still running lie in front
    owner, begin, size = owner[order], begin[order], size[order]
    state = np.zeros((len(model.moves), len(owner)), np.int64)
    count = np.ones((len(model.moves), len(owner)), np.int64)
    for t in range(int(size.max(initial=0))):
        live = int(np.searchsorted(-size, -t))
        row = symbols[begin[:live] + t]
        for m, now, seen in zip(model.moves, state[:, :live], count[:, :live], strict=True):
            got = m.slots[m.base[now] + row]
            move = np.where(got >> 32 == now, got & 0xFFFFFFFF, m.root[row])
            seen += move & 1
            np.right_shift(move, 1, out=now)
    return np.stack([np.bincount(owner, c, n) for c in count], axis=1)


def predict(model: Model | None, text: pa.LargeStringArray) -> tuple[list[str], np.ndarray]:
    data, at = T.bytes_of(text)
    n = len(text)
    if model is None or len(data) == 0:
        return [UNKNOWN] * n, np.zeros(n)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    cut = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), at)
    symbols = model.symbols[np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        symbols[high] = classes(points[high]) == 1
    letter = np.concatenate([np.zeros(1, np.int64), np.cumsum(symbols > 0)])
    known = letter[cut[1:]] > letter[cut[:-1]]
    symbols, cut = _squeeze(symbols, cut)
    cost = phrases(model, symbols, cut) * model.bits
    best = cost.argmin(1)
    odds = np.exp2(-TEMPER * (cost - cost.min(1, keepdims=True)))
    score = np.where(known, 1.0 / odds.sum(1), 0.0)
    return [model.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), known.tolist(), strict=True)], score


def learn(docs: DataFrame) -> Model | None:
    """The model of the labelled rows outside the held-out quarter."""
    rows = docs.filter("lang is not null and text is not null").filter(~in_fold(2, 4))
    spot, size = F.xxhash64("text"), F.length("text")
    about = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct(F.when(size <= ROW_CHARS, spot)).alias("texts"),
                                     F.min_by("text", F.struct(size, "text")).alias("least")).collect()
    if not about:
        return None
    share = F.lit(0).cast("long")
    for r in about:
        share = F.when(F.col("lang") == r["lang"], F.lit(int(min(1.0, 1.5 * ROWS / max(r["texts"], 1)) * (1 << 40)))).otherwise(share)
    few = rows.filter((size <= ROW_CHARS) & (F.pmod(spot, F.lit(1 << 40)) < share)).select("lang", "text", spot.alias("spot")).dropDuplicates()
    some: dict[str, list] = {}
    room = {r["lang"]: CHARS for r in about}
    for r in sorted(few.collect(), key=lambda r: (r["spot"], r["text"])):
        mine = some.setdefault(r["lang"], [])
        if len(mine) < ROWS and len(r["text"]) <= room[r["lang"]]:
            mine.append(r["text"])
            room[r["lang"]] -= len(r["text"])
    for r in about:
        if not some.get(r["lang"]):
            some[r["lang"]] = [r["least"]]
    return fit_checked([(x, t) for x in sorted(some) for t in some[x]], {r["lang"]: r["n"] for r in about})


def identify(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    model = learn(docs.select("doc_id", "text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = T.large(batch.column("text"))
            for lo, hi in T.steps(text):
                lang, score = predict(shared.value, text.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(lang, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double").select(
        "doc_id", in_fold(2, 4).alias("held_out"), "lang_pred", "score")
