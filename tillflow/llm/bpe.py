"""Byte-level BPE by corpus-level merge replay.

A task takes its texts in chunks. All pieces of a chunk's texts (matches of the split
pattern) are reduced to the distinct ones, which form one corpus of byte symbols.
An inverted index holds, for every mergeable pair, the positions where the pair
begins. A heap yields the ranks; each rank's merge is applied to all of its positions at
once, and only the pairs that touch a merged symbol are looked up again and put
into the index. A piece's own merges therefore happen in rank order, leftmost
first, just as if it were encoded alone, and any text is its pieces' ids.

The split pattern is evaluated on character classes of whole arrays: a piece begins
where the class changes, a single blank belongs to the run after it, and an
apostrophe takes the contraction letters that follow.

Edge cases: a null or empty text has no ids, and decodes to no bytes; very long texts
are chunks of their own; repeated rows and ties of rank (one token reached by
several pairs) are encoded alike; an empty table gives an empty result; further
columns are not read by ``digests`` and are kept by ``encode``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm import textnp as T

#: Bytes of text whose distinct pieces are encoded together.
CHUNK_BYTES = 24 << 20
_NONE = np.int32(2**31 - 1)

# The White_Space code points, and the contraction endings of the split pattern.
_SPACES = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_ONE = "stmd"
_TWO = ("re", "ve", "ll")


class Merges(NamedTuple):
    base: np.ndarray    # id of each byte
    keys: np.ndarray    # sorted pairs, left id << 32 | right id
    ranks: np.ndarray   # rank of each pair
    new: np.ndarray     # id that a rank's merge makes
    tokens: list        # bytes of each id
    first: np.ndarray   # rank of each pair of bytes, by left * 256 + right


def _build(base: list[int], pairs: list[tuple[int, int, int]], new: dict[int, int], tokens: dict[int, bytes]) -> Merges:
    keys = np.array([a << 32 | b for a, b, _ in pairs], np.int64)
    ranks = np.array([r for _, _, r in pairs], np.int32)
    order = np.argsort(keys, kind="stable")
    table = np.zeros(max(new, default=0) + 1, np.int32)
    for r, i in new.items():
        table[r] = i
    low = np.array(base, np.int32)
    m = Merges(low, keys[order], ranks[order], table, [tokens.get(i, b"") for i in range(max(tokens) + 1)], low)
    both = (low.astype(np.int64)[:, None] << 32 | low.astype(np.int64)[None, :]).reshape(-1)
    return m._replace(first=_lookup(m, both))


def _lookup(m: Merges, keys: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(m.keys, keys), len(m.keys) - 1)
    return np.where(m.keys[at] == keys, m.ranks[at], _NONE)


@lru_cache(maxsize=4)
def load(path: str) -> Merges:
    """Merges of a vocabulary file: ``.tiktoken`` ranks or a ``.json`` with its merge list."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_alphabet()
        vocab, back = model["vocab"], {c: b for b, c in enumerate(alphabet)}
        pairs, new = [], {}
        for r, (a, b) in enumerate(model["merges"]):
            pairs.append((vocab[a], vocab[b], r))
            new[r] = vocab[a + b]
        tokens = {i: bytes(back[c] for c in s) for s, i in vocab.items() if all(c in back for c in s)}
        return _build([vocab[c] for c in alphabet], pairs, new, tokens)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    pairs = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t))
             if t[:k] in ranks and t[k:] in ranks]
    return _build([ranks[bytes([b])] for b in range(256)], pairs, {r: r for r in ranks.values()},
                  {r: t for t, r in ranks.items()})


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the JSON vocabulary: itself where
    it is printable Latin-1, else the next free one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 space, for the Basic Multilingual Plane."""
    kind = np.array([{"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 0) for c in range(1 << 16)], np.uint8)
    kind[list(_SPACES)] = 3
    return kind


def classes(points: np.ndarray) -> np.ndarray:
    out = _classes()[np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)
    if len(high):
        some, where = np.unique(points[high], return_inverse=True)
        kind = np.array([{"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 0) for c in some], np.uint8)
        out[high] = kind[where]
    return out


def pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where the pieces of all texts begin (and the end), and the first piece of each text (and the end)."""
    if len(data) == 0:
        return np.zeros(1, np.int64), np.zeros(len(at), np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = (data & 0xC0) != 0x80
    place = np.append(np.flatnonzero(lead), len(data))
    n = len(points)
    cut = np.zeros(n + 1, bool)
    cut[np.searchsorted(place, at)] = True
    cut[n] = True
    kind = classes(points)
    turn = cut[:n].copy()
    turn[0] = True
    turn[1:] |= kind[1:] != kind[:-1]
    rs = np.flatnonzero(turn)
    re = np.append(rs[1:], n)
    space = kind[rs] == 3
    ends_text = cut[re]
    blank = points[re - 1] == 32
    mark = np.zeros(n + 1, bool)
    attach = ~space & ~cut[rs] & (points[np.maximum(rs, 1) - 1] == 32)
    mark[rs[~space] - attach[~space]] = True
    long = re - rs > 1
    mark[rs[space & (ends_text | long | ~blank)]] = True
    mark[re[space & ~ends_text & ~blank] - 1] = True
    # Contractions: a lone apostrophe, then letters of the same text.
    k = np.flatnonzero((kind[rs] == 0) & (re - rs == 1) & (points[rs] == 39) & ~attach & ~ends_text)
    k = k[(k + 1 < len(rs))]
    k = k[kind[rs[np.minimum(k + 1, len(rs) - 1)]] == 1]
    if len(k):
        begin, length = rs[k + 1], re[k + 1] - rs[k + 1]
        c1, c2 = points[begin], points[np.minimum(begin + 1, n - 1)]
        take = np.zeros(len(k), np.int64)
        take[np.isin(c1, [ord(c) for c in _ONE])] = 1
        for a, b in _TWO:
            take[(c1 == ord(a)) & (c2 == ord(b)) & (length > 1)] = 2
        hit = take > 0
        begin, length, take = begin[hit], length[hit], take[hit]
        mark[begin] = False
        mark[(begin + take)[take < length]] = True
    mark[n] = True
    starts = place[np.flatnonzero(mark)]
    return starts, np.searchsorted(starts, at)


def replay(m: Merges, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many byte strings (concatenated in ``data``) and the first id of each (and the end)."""
    n = len(data)
    sym = m.base[data]
    nxt = np.arange(1, n + 1, dtype=np.int64)
    prv = np.arange(-1, n - 1, dtype=np.int64)
    nxt[offsets[1:][np.diff(offsets) > 0] - 1] = -1
    prv[offsets[:-1][np.diff(offsets) > 0]] = -1
    rank = np.full(n, _NONE, np.int32)
    go = np.flatnonzero(nxt >= 0)
    rank[go] = m.first[data[go].astype(np.int64) * 256 + data[go + 1]]
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def add(at: np.ndarray, r: np.ndarray) -> None:
        if len(at) > 1:
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
            groups, names = np.split(at, cuts), r[np.concatenate([[0], cuts])].tolist()
        else:
            groups, names = [at], r.tolist()
        for name, group in zip(names, groups, strict=False):
            if name in index:
                index[name].append(group)
            else:
                index[name] = [group]
                heapq.heappush(heap, name)

    go = go[rank[go] != _NONE]
    if len(go):
        add(go, rank[go])
    while heap:
        r = heapq.heappop(heap)
        found = index.pop(r)
        p = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        p = p[rank[p] == r]
        if len(p) == 0:
            continue
        q = nxt[p]
        if (rank[q] == r).any():  # overlapping, as in a run of one letter: leftmost first
            keep, gone = np.ones(len(p), bool), -1
            for i, (a, b) in enumerate(zip(p.tolist(), q.tolist(), strict=True)):
                if a == gone:
                    keep[i] = False
                else:
                    gone = b
            p, q = p[keep], q[keep]
        sym[p] = m.new[r]
        sym[q] = -1
        after = nxt[q]
        nxt[p] = after
        more = after >= 0
        prv[after[more]] = p[more]
        rank[q] = _NONE
        rank[p] = _NONE
        left = prv[p]
        touched = np.concatenate([left[left >= 0], p[more]])
        if len(touched) == 0:
            continue
        touched = np.unique(touched)
        got = _lookup(m, sym[touched].astype(np.int64) << 32 | sym[nxt[touched]])
        rank[touched] = got
        ok = got != _NONE
        if ok.any():
            add(touched[ok], got[ok])
    alive = sym >= 0
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(alive)])
    return sym[alive], total[offsets]


class Pieces:
    """The distinct pieces of a chunk, numbered exactly: an Arrow dictionary for each step, unified at the end."""

    def __init__(self) -> None:
        self.steps: list[pa.DictionaryArray] = []

    def add(self, data: np.ndarray, starts: np.ndarray) -> None:
        """The pieces ``data[starts[i]:starts[i + 1]]`` of one step."""
        plain = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [
            None, pa.py_buffer(np.ascontiguousarray(starts, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        self.steps.append(plain.dictionary_encode())

    def encode(self, m: Merges) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The piece numbers of each step, the ids of the distinct pieces, and the first id of each piece (and the end)."""
        whole = pa.chunked_array(self.steps).unify_dictionaries()
        data, at = T.bytes_of(whole.chunk(0).dictionary)
        return [step.indices.to_numpy(zero_copy_only=False) for step in whole.chunks], *replay(m, data, at)


class Encoded(NamedTuple):
    rows: list          # (record batch, first row, end row) of each step
    numbers: list       # piece numbers of each step
    firsts: list        # first piece of each text of a step, and the end
    ids: np.ndarray     # ids of the distinct pieces, one after the other
    cuts: np.ndarray    # first id of each distinct piece, and the end


def chunks(batches: Iterator[pa.RecordBatch], m: Merges, column: str = "text") -> Iterator[Encoded]:
    """The texts of a task, encoded chunk by chunk."""
    book, rows, firsts, size = Pieces(), [], [], 0
    for batch in batches:
        text = T.large(batch.column(column))
        for lo, hi in T.steps(text):
            data, at = T.bytes_of(text.slice(lo, hi - lo))
            starts, first = pieces(data, at)
            rows.append((batch, lo, hi))
            book.add(data, starts)
            firsts.append(first)
            size += len(data)
            if size >= CHUNK_BYTES:
                numbers, ids, cuts = book.encode(m)
                yield Encoded(rows, numbers, firsts, ids, cuts)
                book, rows, firsts, size = Pieces(), [], [], 0
    if rows:
        numbers, ids, cuts = book.encode(m)
        yield Encoded(rows, numbers, firsts, ids, cuts)


def texts(part: Encoded) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    """For each step: its rows, all ids, and the first id of each text (and the end)."""
    length = np.diff(part.cuts)
    for (batch, lo, hi), number, first in zip(part.rows, part.numbers, part.firsts, strict=True):
        many = length[number]
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(many)])
        yield batch, lo, hi, part.ids[T.ragged(part.cuts[number], many)], total[first]


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array<int> column of the text's ids (an equally named column is replaced)."""
    docs = docs.drop(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, load(vocabulary), text):
            for batch, lo, hi, flat, cut in texts(part):
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(flat))],
                    [*own.schema.names, ids])
    return docs.mapInArrow(run, docs.select("*", F.lit(None).cast("array<int>").alias(ids)).schema)


def decode(table: DataFrame, vocabulary: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``table`` with the bytes of its ids; null ids decode to no bytes."""
    table = table.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(vocabulary).tokens
        for batch in batches:
            made = [b"".join([tokens[i] for i in row or ()]) for row in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*batch.schema.names, out])
    return table.mapInArrow(run, table.select("*", F.lit(None).cast("binary").alias(out)).schema)


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The contract's row per document: token count, and digests of the ids and of the bytes decoded from them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(vocabulary)
        for part in chunks(batches, m):
            flat, cut = part.ids.tolist(), part.cuts.tolist()
            spans = [flat[a:b] for a, b in zip(cut, cut[1:], strict=False)]
            shown = [",".join(map(str, s)) for s in spans]
            plain = [b"".join([m.tokens[i] for i in s]) for s in spans]
            length = np.diff(part.cuts)
            for (batch, lo, hi), number, first in zip(part.rows, part.numbers, part.firsts, strict=True):
                total = np.concatenate([np.zeros(1, np.int64), np.cumsum(length[number])])[first]
                used, ends = number.tolist(), first.tolist()
                ids_sha, dec_sha = [], []
                for a, b in zip(ends, ends[1:], strict=False):
                    mine = used[a:b]
                    ids_sha.append(hashlib.sha256(",".join([shown[i] for i in mine]).encode()).hexdigest())
                    dec_sha.append(hashlib.sha256(b"".join([plain[i] for i in mine])).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(total)), pa.array(ids_sha), pa.array(dec_sha)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
