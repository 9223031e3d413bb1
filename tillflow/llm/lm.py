"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

    q(token | history) = P(class | history) * P(kind | class, history) * P(token | class, kind)

A token's class is hashed from its ending, its kind within the class from its beginning. The first two factors
are softmaxes with hashed n-gram and skip features, trained by gradient steps: the class by the previous token,
the token before it, the classes of both, and the classes of the two tokens before those; the kind
by the class together with the previous token, with the token before it (a skip) and with the previous
token's class and kind. The third is the softmax whose one feature is the token itself, with weight log(c + 1), c
being the token's count in all training texts, and one share for tokens never seen.

The weight tables have a fixed size. What follows the input are the tokens' counts and, for every pair
of neighbours in the training texts, its count n over the whole corpus, with N, the previous token's
count. They are interpolated with q by the mass that absolute discounting sets free on average:

    P = (1 - d) n / N + d q, or q where N is 0

with d = D * (distinct successors per occurrence of tokens about as frequent as N), which all chunks measure
by powers of two of N, and D = (n1 + 1) / (n1 + 2 n2 + 2) from the numbers of pairs seen once and twice
in the corpus. The probabilities of all tokens sum to one.

1. Texts become chunks: per chunk the distinct tokens (64-bit digest, class and kind, count in its
   training texts) and all token places as numbers into them. They are written once to the
   shared folder, and everything later reads them instead of the texts.
2. Counts: each chunk sends its distinct tokens and its distinct pairs as sorted, packed hashes to buckets by hash,
   whose number grows with the corpus. A bucket adds them up and answers every chunk in its order with
   what the corpus has beyond the chunk's own count. A pair's bucket follows from both tokens, so
   a frequent token's pairs lie in all buckets.
3. Training: every task runs over the training texts of its chunks in minibatches (adaptive
   gradient steps) from common weights; the tasks' weights are averaged, each feature weighted
   by how often a task saw it, in a tree of sums, WIDE at a time.
4. Scoring: a chunk meets its answers and is scored in sparse numpy batches.

Two tokens with one digest would count as one: at 10 billion distinct tokens about twenty pairs. Pairs are
known by PAIR_BITS more bits than the corpus has places: about one in 16,000 shares its count with another.

Edge cases: a null or empty text is its end token alone; rows with a null doc_id count as
training rows; no training rows: all counts are 0 and the classes are equally likely; a very long text is a
chunk of its own; repeated rows count and score as often as they occur; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm import textnp as T
from tillflow.llm.toxicity import in_fold
from tillflow.session import shared_path

CHUNK_BYTES = 8 << 20
CLASSES, KINDS = 32, 16
CELLS = CLASSES * KINDS
#: Rows of the classes' weight table: previous token, the one before, their classes, the classes before those.
TOKEN1, TOKEN2 = 1 << 13, 1 << 12
PAIR = CLASSES * CLASSES
FEATURES = TOKEN1 + TOKEN2 + 2 * PAIR
#: Rows of the kinds' weight table: class with previous token, with the one before, with the previous cell.
WITHIN1, WITHIN2 = 1 << 14, 1 << 13
WITHIN = WITHIN1 + WITHIN2 + CLASSES * CELLS
BATCH, RATE, DAMP = 8192, 0.2, 4.0
#: Bound of a logit either way, within which no sum of powers leaves 32 bits.
LOGIT = 60
#: Slices of the weight table and tasks whose slices one sum takes.
SLICES, WIDE = 16, 64
#: Token places whose pairs one bucket takes, and the least number of buckets.
BUCKET, BUCKETS = 1 << 21, 64
#: Bits of a pair's hash beyond those that count the corpus's places.
PAIR_BITS = 14
#: Powers of two of a token's count by which new successors are measured.
BINS = 48

_U = np.uint64
END_HASH = T.mix(np.array([0x51ED270B], np.uint64))[0]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digest and cell (class * KINDS + kind) of every token of all texts in order, ends included, and tokens per text."""
    low = _LOWER[data]
    starts, ends, doc = T.word_spans(low, at)
    n = len(at) - 1
    count = np.bincount(doc, minlength=n)
    h = T.word_digests(low, starts, ends)
    tail = T.word_hashes(low, np.maximum(ends - 2, starts), ends)
    head = T.word_hashes(low, starts, np.minimum(starts + 2, ends))
    cell = (1 + (tail >> _U(33)) % _U(CLASSES - 1)) * _U(KINDS) + (head >> _U(35)) % _U(KINDS)
    place = np.arange(len(h)) + doc
    hashes = np.full(len(h) + n, END_HASH, np.uint64)
    cells = np.zeros(len(h) + n, np.uint16)
    hashes[place], cells[place] = h, cell.astype(np.uint16)
    return hashes, cells, count + 1


CHUNK_SCHEMA = ("chunk long, doc_ids array<long>, held array<boolean>, lengths binary, places binary, n_places long, "
                "hashes array<long>, counts array<int>, cells array<int>, slots binary")


def chunk_table(docs: DataFrame) -> DataFrame:
    """One row per chunk of texts. ``docs`` has doc_id, text and held_out."""
    def close(number: int, parts: list) -> pa.RecordBatch:
        hashes = np.concatenate([p[2] for p in parts])
        name, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        lengths = np.concatenate([p[4] for p in parts])
        held = np.concatenate([p[1] for p in parts])
        counts = np.bincount(back[~np.repeat(held, lengths)], minlength=len(name))
        cells = np.concatenate([p[3] for p in parts])[first]
        # Frequent tokens get small numbers, which pack well.
        order = np.argsort(-np.bincount(back, minlength=len(name)), kind="stable")
        rank = np.empty(len(name), np.int32)
        rank[order] = np.arange(len(name), dtype=np.int32)
        name, cells, counts = name[order], cells[order], counts[order]
        ids = [i for p in parts for i in p[0]]
        slots = (T.mix(name) & _U(0xFFFF)).astype("<u2")
        row = {"chunk": [number], "doc_ids": [ids], "held": [held.tolist()],
               "lengths": [lengths.astype("<i4").tobytes()],
               "places": [bytes(pa.compress(rank[back].astype("<i4").tobytes(), "zstd"))], "n_places": [len(back)],
               "hashes": pa.ListArray.from_arrays(pa.array([0, len(name)], pa.int32()), pa.array(name.view(np.int64))),
               "counts": pa.ListArray.from_arrays(pa.array([0, len(name)], pa.int32()), pa.array(counts.astype(np.int32))),
               "cells": pa.ListArray.from_arrays(pa.array([0, len(name)], pa.int32()), pa.array(cells.astype(np.int32))),
               "slots": [slots.tobytes()]}
        kinds = {"chunk": pa.int64(), "doc_ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()),
                 "lengths": pa.binary(), "places": pa.binary(), "n_places": pa.int64(), "slots": pa.binary()}
        return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, kinds[k]) for k, v in row.items()], list(row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            text = T.large(batch.column("text"))
            for lo, hi in T.steps(text):
                data, at = T.bytes_of(text.slice(lo, hi - lo))
                parts.append((batch.column("doc_id").slice(lo, hi - lo).to_pylist(),
                              np.array(batch.column("held_out").slice(lo, hi - lo).to_pylist(), bool), *tokens(data, at)))
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield close(number, parts)
                    number, parts, size = number + 1, [], 0
        if parts:
            yield close(number, parts)
    return docs.mapInArrow(run, CHUNK_SCHEMA)


def features(place: np.ndarray, begins: np.ndarray, slots: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(4, tokens) rows of the classes' table and (3, tokens) rows of the kinds' table that are active for each token,
    as 16-bit numbers, which sort by their digits."""
    since = np.arange(len(place)) - begins
    hash_, cell = slots[place], cells[place]

    def back(a: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        out[k:] = a[:-k] if k else a
        out[since < k] = 0
        return out
    k1, k2, k3, k4 = (back(cell // KINDS, i) for i in (1, 2, 3, 4))
    h1, h2, own = back(hash_, 1), back(hash_, 2), cell // KINDS
    mixed = [(h * CLASSES + own) * 0x9E3779B1 >> 7 for h in (h1, h2)]
    return (np.stack([h1 % TOKEN1, TOKEN1 + h2 % TOKEN2, TOKEN1 + TOKEN2 + k1 * CLASSES + k2,
                      TOKEN1 + TOKEN2 + PAIR + k3 * CLASSES + k4]).astype(np.uint16),
            np.stack([mixed[0] % WITHIN1, WITHIN1 + mixed[1] % WITHIN2, WITHIN1 + WITHIN2 + own * CELLS + back(cell, 1)]).astype(np.uint16))


def class_logs(weights: np.ndarray, f: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log P(target | history), natural, in batches."""
    out = np.empty(len(target), np.float32)
    for lo in range(0, len(target), BATCH):
        x = weights.take(f[0, lo: lo + BATCH], axis=0)
        for row in f[1:]:
            x += weights.take(row[lo: lo + BATCH], axis=0)
        np.clip(x, -LOGIT, LOGIT, out=x)
        got = x[np.arange(len(x)), target[lo: lo + BATCH]]
        out[lo: lo + BATCH] = got - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], np.float32))
    return out


def descend(weights: np.ndarray, power: np.ndarray, f: np.ndarray, target: np.ndarray) -> None:
    """One pass of adaptive gradient steps over the tokens, in place."""
    for lo in range(0, len(target), BATCH):
        rows, t = f[:, lo: lo + BATCH], target[lo: lo + BATCH]
        x = weights.take(rows[0], axis=0)
        for row in rows[1:]:
            x += weights.take(row, axis=0)
        np.clip(x, -LOGIT, LOGIT, out=x)
        np.exp(x, out=x)
        x /= (x @ np.ones(x.shape[1], np.float32))[:, None]
        x[np.arange(len(t)), t] -= 1
        for row in rows:
            order = np.argsort(row, kind="stable")
            name = row[order]
            first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
            # Two neighbouring 32-bit sums at a time, as the parts of one complex number.
            g = np.add.reduceat(x.take(order, axis=0).view(np.complex64), first, axis=0).view(np.float32)
            name = name[first]
            p = power.take(name, axis=0)
            p += g * g
            power[name] = p
            p += DAMP
            g /= np.sqrt(p, out=p)
            g *= RATE
            weights[name] = weights.take(name, axis=0) - g


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token places, first place of each token's text, text lengths, slots."""
    n = int(row["n_places"])
    place = np.frombuffer(pa.decompress(row["places"], 4 * n, "zstd"), "<i4") if n else np.zeros(0, np.int32)
    lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
    return place, np.repeat(np.cumsum(lengths) - lengths, lengths), lengths, np.frombuffer(row["slots"], "<u2")


SHAPES = ((FEATURES, CLASSES), (WITHIN, KINDS))


def train(chunks: DataFrame) -> list[np.ndarray]:
    """Weights of the classes and of the kinds (SHAPES): every task descends over its chunks, then the tasks' weights are averaged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [np.zeros(shape, np.float32) for shape in SHAPES]
        power = [np.zeros_like(w) for w in weights]
        seen = [np.zeros(rows) for rows, _ in SHAPES]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in ("places", "n_places", "lengths", "slots")}
                place, begins, lengths, slots = _unpack(row)
                cells = batch.column("cells")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                learn = np.repeat(~np.array(batch.column("held")[i].as_py(), bool), lengths)
                for lo, hi in _doc_ranges(lengths):
                    own = cells[place[lo:hi]][learn[lo:hi]]
                    for k, f in enumerate(features(place[lo:hi], begins[lo:hi] - lo, slots, cells)):
                        f = f[:, learn[lo:hi]]
                        descend(weights[k], power[k], f, own % KINDS if k else own // KINDS)
                        seen[k] += np.bincount(f.reshape(-1), minlength=len(seen[k]))
        if seen[0].any():
            flat = np.concatenate([np.concatenate([w * n[:, None], n[:, None]], axis=1).reshape(-1) for w, n in zip(weights, seen, strict=True)])
            parts = np.array_split(flat, SLICES)
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array([task] * SLICES, pa.int64()),
                 pa.array([p.astype("<f4").tobytes() for p in parts], pa.binary())], ["slice", "task", "total"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, "<f4").astype(np.float64) for b in frame["total"])
        return pd.DataFrame({"slice": [frame["slice"].iloc[0]], "task": [frame["task"].iloc[0] // WIDE],
                             "total": [total.astype("<f4").tobytes()]})
    schema = "slice int, task long, total binary"
    sums = chunks.select("places", "n_places", "lengths", "slots", "cells", "held").mapInArrow(run, schema).checkpoint()
    top = sums.agg(F.max("task")).first()[0]
    if top is None:
        return [np.zeros(shape, np.float32) for shape in SHAPES]
    while True:
        sums = sums.groupBy("slice", F.floor(F.col("task") / WIDE)).applyInPandas(add, schema)
        top //= WIDE
        if top == 0:
            break
    rows = {r["slice"]: np.frombuffer(r["total"], "<f4") for r in sums.collect()}  # SLICES rows, both tables in all
    flat, out, at = np.concatenate([rows[k] for k in range(SLICES)]), [], 0
    for n, wide in SHAPES:
        both = flat[at: at + n * (wide + 1)].reshape(n, wide + 1)
        out.append((both[:, :wide] / np.maximum(both[:, wide:], 1)).astype(np.float32))
        at += n * (wide + 1)
    return out


def _doc_ranges(lengths: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Token ranges of whole texts, about ``limit`` tokens each."""
    ends = np.cumsum(lengths)
    lo = 0
    while lo < (ends[-1] if len(ends) else 0):
        k = max(int(np.searchsorted(ends, lo + limit, "right")) - 1, int(np.searchsorted(ends, lo, "right")))
        hi = int(ends[k])
        yield lo, hi
        lo = hi


def pair_keys(place: np.ndarray, begins: np.ndarray, hashes: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` bits by which each place's (previous token, token) is known; no previous token counts as 0."""
    before = np.zeros(len(place), np.uint64)
    before[1:] = hashes[place[:-1]]
    before[np.arange(len(place)) == begins] = 0
    return T.mix(T.mix(before) * _U(0xD6E8FEB86659FD93) + hashes[place]) >> _U(64 - width)


_squash, _spread = T.squash, T.spread


def _widths(places: int) -> tuple[int, int]:
    """Bits of a bucket's number, and bits of a pair's key."""
    return (max(BUCKETS, -(-places // BUCKET)) - 1).bit_length(), min(64, max(places, 2).bit_length() + PAIR_BITS)


def _bin(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), BINS - 1)


GATHERED = "chunk long, level int, at long, c long, more binary, sums binary"
TOKENS, PAIRS, NEW = 0, 1, 2


def gather(chunks: DataFrame, places: int) -> DataFrame:
    """Answers to every chunk's tokens (level TOKENS, in order of digest) and pairs (PAIRS, in order of key), bucket by bucket:
    ``more``, what the corpus counts beyond the chunk. ``sums`` are, once a bucket, the counts and numbers of known tokens by cell (TOKENS),
    the numbers of pairs seen once and twice (PAIRS), and with level NEW, by bins of a token's count in a chunk, its occurrences and
    distinct successors."""
    bits, width = _widths(places)

    def packed(chunk: int, level: int, key: np.ndarray, own: np.ndarray, wide: int, cells: np.ndarray | None = None) -> list[tuple]:
        cut = np.searchsorted(key >> _U(wide - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        return [(chunk, level, int(b), int(cut[b + 1] - cut[b]), _squash(np.diff(key[cut[b]: cut[b + 1]], prepend=_U(0))),
                 _squash(own[cut[b]: cut[b + 1]].astype("<i4")), b"" if cells is None else _squash(cells[cut[b]: cut[b + 1]].astype("<u2")))
                for b in np.flatnonzero(np.diff(cut))]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in ("places", "n_places", "lengths", "slots")}
                place, begins, lengths, _ = _unpack(row)
                hashes, counts, cells = (batch.column(k)[i].values.to_numpy(zero_copy_only=False) for k in ("hashes", "counts", "cells"))
                hashes, chunk = hashes.view(np.uint64), batch.column("chunk")[i].as_py()
                order = np.argsort(hashes)
                out = packed(chunk, TOKENS, hashes[order], counts[order], 64, cells[order])
                learn = np.repeat(~np.array(batch.column("held")[i].as_py(), bool), lengths)
                name, first, back = np.unique(pair_keys(place, begins, hashes, width), return_index=True, return_inverse=True)
                own = np.bincount(back[learn], minlength=len(name))
                out += packed(chunk, PAIRS, name, own, width)
                left = np.where(first == begins[first], -1, place[np.maximum(first, 1) - 1])
                new = np.bincount(left[(own > 0) & (left >= 0)], minlength=len(counts))
                bins = _bin(counts)
                sums = np.stack([np.bincount(bins[counts > 0], a[counts > 0], BINS) for a in (counts, new)]).astype("<i8")
                out.append((chunk, NEW, chunk % BUCKETS, 0, b"", b"", sums.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*out, strict=True), (
                        pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                    ["chunk", "level", "at", "c", "keys", "own", "cells"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        c, level = frame["c"].to_numpy(), int(frame["level"].iloc[0])
        out = frame[["chunk", "level", "at", "c"]].copy()
        if level == NEW:
            total = sum(np.frombuffer(b, "<i8") for b in frame["cells"])
            return out.iloc[:1].assign(more=[b""], sums=[total.astype("<i8").tobytes()])
        key = np.concatenate([np.cumsum(_spread(k, m, "<u8"), dtype=np.uint64) for k, m in zip(frame["keys"], c, strict=True)])
        own = np.concatenate([_spread(k, m, "<i4") for k, m in zip(frame["own"], c, strict=True)]).astype(np.int64)
        name, first, back = np.unique(key, return_index=True, return_inverse=True)
        n = np.bincount(back, own, len(name)).astype(np.int64)
        more, ends = n[back] - own, np.cumsum(c)
        sums = [b""] * len(c)
        if level == TOKENS:
            cell = np.concatenate([_spread(k, m, "<u2") for k, m in zip(frame["cells"], c, strict=True)])[first][n > 0]
            sums[0] = np.stack([np.bincount(cell, n[n > 0], CELLS), np.bincount(cell, minlength=CELLS)]).astype("<i8").tobytes()
        else:
            sums[0] = np.array([(n == 1).sum(), (n == 2).sum()], "<i8").tobytes()
        return out.assign(more=[_squash(more[hi - m: hi].astype("<i8")) for hi, m in zip(ends, c, strict=True)], sums=sums)
    sent = chunks.select("chunk", "places", "n_places", "lengths", "slots", "hashes", "counts", "cells", "held").mapInArrow(
        send, "chunk long, level int, at long, c long, keys binary, own binary, cells binary")
    return sent.groupBy("level", "at").applyInPandas(add, GATHERED)


def add_sums(gathered: DataFrame, level: int, wide: int) -> np.ndarray:
    """The (2, wide) sums of one level over all buckets; a task sends one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * wide, np.int64)
        for batch in batches:
            for b in batch.column("sums").to_pylist():
                total += np.frombuffer(b, "<i8")
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"i": pa.array(some, pa.int64()), "n": pa.array(total[some], pa.int64())})
    rows = gathered.filter((F.col("level") == level) & (F.length("sums") > 0)).select("sums").mapInArrow(run, "i long, n long")
    out = np.zeros(2 * wide, np.int64)
    for r in rows.groupBy("i").agg(F.sum("n").alias("n")).collect():  # 2 * wide rows at most
        out[r["i"]] = r["n"]
    return out.reshape(2, wide)


def novelty(sums: np.ndarray) -> np.ndarray:
    """Distinct successors per occurrence by bins of a token's count, falling; a bin that no token is in takes that of the one before."""
    out, last = np.ones(BINS), 1.0
    for k in range(BINS):
        if sums[0, k] > 0:
            last = min(last, max(sums[1, k] / sums[0, k], 1e-9))
        out[k] = last
    return out


def interpolate(n: np.ndarray, whole: np.ndarray, free: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Probabilities from counts ``n`` out of ``whole`` and ``q``, which gets the share ``free``."""
    return np.where(whole > 0, (1 - free) * n / np.maximum(whole, 1) + free * q, q)


OUT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_texts(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    spark = docs.sparkSession
    path = shared_path(spark, "lm", "chunks")
    chunk_table(docs.select("doc_id", "text", in_fold(2, 7).alias("held_out"))).write.parquet(path)
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    places = chunks.agg(F.sum("n_places")).first()[0] or 0
    answered = shared_path(spark, "lm", "answers")
    gather(chunks, places).write.parquet(answered)
    answers = spark.read.schema(GATHERED).parquet(answered)
    cells, fresh = add_sums(answers, TOKENS, CELLS), add_sums(answers, NEW, BINS)
    total, kinds = int(cells[0].sum()), int(cells[1].sum())
    size = cells.sum(0).astype(np.float64) + 1
    once, twice = add_sums(answers, PAIRS, 1)[:, 0].tolist()
    free = novelty(fresh) * (once + 1) / (once + 2 * twice + 2)
    shared = spark.sparkContext.broadcast((train(chunks), size, free))
    width = _widths(places)[1]

    def run(known: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        (by_class, by_kind), size, free = shared.value
        found = known.sort_values("at")
        out = []
        for row in part.to_dict("records"):
            place, begins, lengths, slots = _unpack(row)
            cells, hashes = np.asarray(row["cells"]).astype(np.int64), np.asarray(row["hashes"]).view(np.uint64)
            more = [np.concatenate([np.zeros(0, np.int64), *(_spread(b, m, "<i8") for b, m in zip(mine["more"], mine["c"], strict=True))])
                    for mine in (found[found["level"] == k] for k in (TOKENS, PAIRS))]
            c = np.asarray(row["counts"]).astype(np.int64)
            c[np.argsort(hashes)] += more[0]
            doc = np.repeat(np.arange(len(lengths)), lengths)
            plain = np.bincount(doc, np.log10(c + 1.0)[place], len(lengths))
            logs = np.empty(len(place), np.float64)
            for lo, hi in _doc_ranges(lengths):
                own = cells[place[lo:hi]]
                f, g = features(place[lo:hi], begins[lo:hi] - lo, slots, cells)
                logs[lo:hi] = class_logs(by_class, f, own // KINDS) + class_logs(by_kind, g, own % KINDS)
            q = np.exp(logs) * ((c + 1) / size[cells])[place]
            back = np.unique(pair_keys(place, begins, hashes, width), return_inverse=True)[1]
            learn = np.repeat(~np.asarray(row["held"], bool), lengths)
            n = (np.bincount(back[learn], minlength=len(more[1])) + more[1])[back]
            end = np.flatnonzero(hashes == END_HASH)
            whole = np.full(len(place), c[end[0]] if len(end) else 0)   # every training text begins once and ends once
            after = np.arange(len(place)) != begins
            whole[after] = c[place[np.flatnonzero(after) - 1]]
            model = np.bincount(doc, np.log10(interpolate(n, whole, free[_bin(whole)], q)), len(lengths))
            ids = list(row["doc_ids"])
            out.append(pd.DataFrame({
                "doc_id": pd.array([None if i is None or i != i else int(i) for i in ids], "Int64"),
                "held_out": np.asarray(row["held"], bool),
                "n_tokens": lengths, "n_known": np.bincount(doc, c[place] > 0, len(lengths)).astype(np.int64),
                "train_tokens": np.int64(total),
                "base_score": plain - lengths * np.log10(total + kinds + 1), "score": model}))
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in OUT.split(", ")})

    parts = spark.read.schema(CHUNK_SCHEMA).parquet(path).select(
        "chunk", "doc_ids", "held", "lengths", "places", "n_places", "hashes", "counts", "cells", "slots")
    other = answers.filter(F.col("level") != NEW).select("chunk", "level", "at", "c", "more")
    return other.groupBy("chunk").cogroup(parts.groupBy("chunk")).applyInPandas(run, OUT)
