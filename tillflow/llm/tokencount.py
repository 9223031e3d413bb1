"""Token counts by heap-and-linked-list byte-pair merging.

A piece of text (a match of the split pattern) starts as its bytes, one symbol each, in
a doubly linked list. A heap holds every adjacent pair that the vocabulary merges, keyed
by rank and then by place; the lowest is popped again and again, its right symbol is
unlinked, and the two pairs that the merged symbol forms with its neighbours are pushed.
A popped entry whose pair has changed meanwhile is skipped. What is left counts: the
piece has as many tokens as it had symbols, less its merges. No ids are emitted.

A Python worker keeps the counts of the pieces it has met (bounded, see MEMO_PIECES; what is
forgotten is merged again), so that a common word is merged seldom. A string of the
vocabulary's added tokens inside a text is one token, and the text around it is split
on its own, as the library does by default.

Edge cases: a null or empty text has 0 bytes and 0 tokens; a very long text is a step of its
own, and a very long piece costs n log n; repeated rows and pairs of one rank (the leftmost
goes first) count alike; an empty table gives an empty result; of further columns only the
ones named in ``keep`` are carried, and one named like a result is refused.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tillflow.llm import bpe
from tillflow.llm import textnp as T

#: Pieces whose counts a worker remembers, and the bytes of the longest that is remembered.
MEMO_PIECES, MEMO_LONGEST = 1_500_000, 64
RESULTS = ("n_bytes", "n_tokens", "over_limit")


class Vocabulary(NamedTuple):
    base: list[int]         # symbol of each byte
    rank: dict[int, int]    # rank of a pair, left << 32 | right
    made: list[int]         # symbol that a rank's merge makes
    special: re.Pattern | None


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """A byte-level BPE vocabulary in the tokenizers library's JSON form."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if (model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
            or not split.get("use_regex", True) or spec.get("normalizer") or model.get("ignore_merges")):
        raise ValueError(f"{path} isn't a plain byte-level BPE vocabulary")
    added = spec.get("added_tokens") or []
    if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path} has added tokens that match more than their own string")
    vocab, rank, made = model["vocab"], {}, []
    for r, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        rank[vocab[a] << 32 | vocab[b]] = r
        made.append(vocab[a + b])
    names = sorted((t["content"] for t in added), key=len, reverse=True)
    return Vocabulary([vocab[c] for c in bpe.byte_alphabet()], rank, made,
                      re.compile("|".join(map(re.escape, names))) if names else None)


def count_piece(v: Vocabulary, piece: bytes) -> int:
    """Tokens of one piece: its symbols less its merges."""
    n = len(piece)
    if n < 2:
        return n
    get, made = v.rank.get, v.made
    sym = [v.base[b] for b in piece] + [-1]  # the place n is no symbol: no pair with it has a rank
    after, before = [*range(1, n + 1), n], [n, *range(n)]
    heap = [r << 32 | i for i in range(n - 1) if (r := get(sym[i] << 32 | sym[i + 1])) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        top = heapq.heappop(heap)
        r, i = top >> 32, top & 0xFFFFFFFF
        j = after[i]
        if get(sym[i] << 32 | sym[j]) != r:
            continue
        k, p = after[j], before[i]
        sym[i] = s = made[r]
        sym[j] = -1
        after[i], before[k] = k, i
        merges += 1
        if (q := get(s << 32 | sym[k])) is not None:
            heapq.heappush(heap, q << 32 | i)
        if (q := get(sym[p] << 32 | s)) is not None:
            heapq.heappush(heap, q << 32 | p)
    return n - merges


class Memo(dict):
    """Counts of the pieces met so far."""

    def __init__(self, v: Vocabulary) -> None:
        super().__init__()
        self.v = v

    def __missing__(self, piece: bytes) -> int:
        n = count_piece(self.v, piece)
        if len(piece) <= MEMO_LONGEST:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = n
        return n


@lru_cache(maxsize=2)
def memo_of(path: str) -> Memo:
    """The memo that the tasks of one Python worker share."""
    return Memo(load(path))


def _parts(text: pa.LargeStringArray, special: re.Pattern | None) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The texts between added tokens, and the first part of each text (and the end)."""
    if special is None or not pc.any(pc.match_substring_regex(text, special.pattern)).as_py():
        return text, np.arange(len(text) + 1)
    parts = [special.split(t) for t in text.to_pylist()]
    return (pa.array([p for own in parts for p in own], pa.large_string()),
            np.cumsum([0, *map(len, parts)]))


def count_texts(text: pa.LargeStringArray, memo: Memo) -> np.ndarray:
    """Tokens of each text."""
    parts, cut = _parts(text, memo.v.special)
    data, at = T.bytes_of(parts)
    starts, first = bpe.pieces(data, at)
    raw, place = data.tobytes(), starts.tolist()
    found = [memo[raw[a:b]] for a, b in zip(place, place[1:], strict=False)]
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.array(found, np.int64))])[first]
    return np.diff(total[cut]) + np.diff(cut) - 1


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, text: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the text's bytes, its tokens and whether they are more than ``limit``."""
    if set(keep) & set(RESULTS):
        raise ValueError(f"columns {sorted(set(keep) & set(RESULTS))} are named like results")
    own = docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = memo_of(vocabulary)
        for batch in batches:
            column = T.large(batch.column(len(keep)))
            for lo, hi in T.steps(column):
                part = column.slice(lo, hi - lo)
                n = count_texts(part, memo)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(lo, hi - lo) for i in range(len(keep))],
                     pc.binary_length(part).cast(pa.int64()), pa.array(n), pa.array(n > limit)], [*keep, *RESULTS])
    schema = own.select(*[f"`{c}`" for c in keep]).schema
    return own.mapInArrow(run, schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean"))
