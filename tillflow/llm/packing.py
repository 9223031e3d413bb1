"""Packing token streams into windows by order-preserving dynamic programming.

The documents of a task form one stream, in their order. A window is a stretch of at
most ``size`` tokens between two cuts; cuts may lie at document ends (free), at
sentence ends (a small penalty) and, so that no gap without a sentence end costs
padding, at places inside long sentences (a larger penalty). The best cuts minimise
padding plus penalties:

    f(j) = pen(j) + min over cuts i with c_j - size <= c_i < c_j of f(i) + size - (c_j - c_i)

f(i) + c_i enters a monotone queue once and leaves it once, so the work grows with
the number of cuts. What remains of a task's stream at its end is shorter than a window;
sequences of a power of two need no padding, so it is cut into powers of two as
long as that costs less than padding does. The stream is handled chunk by chunk: the last
window of a chunk is carried over into the next. So a last window's room costs nothing in
the recursion, or slack that the end absorbs would be spread over windows that can't be cut.

Edge cases: a null or empty text is its closing id alone; a text longer than a window
spans several; ties between cuts go to the earlier one; repeated rows are packed like any
other; an empty table gives an empty result; a null doc_id is kept as null; further
columns are not read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tillflow.llm import bpe

SIZE = 1024
END_ID = 0
#: Penalties in tokens of padding, and the distance of cuts inside a sentence.
SENTENCE, INSIDE = 0.5, 4.0
STRIDE = 8
_STOPS = (b".", b"!", b"?", b"\n")

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


@lru_cache(maxsize=4)
def _stops(vocabulary: str) -> np.ndarray:
    """Whether an id's bytes hold the end of a sentence or line."""
    return np.array([any(s in t for s in _STOPS) for t in bpe.load(vocabulary).tokens], bool)


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, stops: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Places where the stream may be cut (its start is the first), and the penalty of each."""
    n = len(ids)
    pen = np.full(n + 1, np.inf)
    pen[np.flatnonzero(stops[ids]) + 1] = SENTENCE
    pen[doc_ends] = 0.0
    pen[[0, n]] = 0.0
    have = np.flatnonzero(pen < np.inf)
    gap = np.diff(have)
    many = (gap - 1) // stride
    base = np.repeat(have[:-1], many)
    k = np.arange(len(base)) - np.repeat(np.cumsum(many) - many, many) + 1
    pen[base + k * stride] = INSIDE
    at = np.flatnonzero(pen < np.inf)
    return at, pen[at]


def best_cuts(at: np.ndarray, pen: np.ndarray, size: int = SIZE, open_end: bool = False) -> list[int]:
    """Indices into ``at`` of the best cuts, first and last included. With ``open_end`` the last
    window's room is no padding (it is carried over or cut into powers of two), only its cuts cost."""
    places, penalties = at.tolist(), pen.tolist()
    back = [0] * len(places)
    queue: deque[tuple[float, int, int]] = deque([(float(places[0]), places[0], 0)])  # (f + c, c, index), rising
    pop, push, head = queue.pop, queue.append, queue.popleft
    for j in range(1, len(places)):
        c = places[j]
        low = c - size
        while queue[0][1] < low:
            head()
        best = queue[0]
        if open_end and j == len(places) - 1:
            best = min(queue, key=lambda q: q[0] - q[1] + INSIDE * (c - q[1]).bit_count())
        back[j] = best[2]
        key = best[0] + size + penalties[j]  # f(j) + c
        while queue and queue[-1][0] > key:
            pop()
        push((key, c, j))
    cuts = [len(places) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def tail_cuts(length: int, size: int = SIZE) -> list[int]:
    """Lengths that a last stretch is cut into: powers of two, while padding costs more than a cut."""
    out = []
    while length:
        padded = 1 << (length - 1).bit_length()
        if length == size or padded == length or size - length <= INSIDE:
            out.append(length)
            break
        part = 1 << (length.bit_length() - 1)
        out.append(part)
        length -= part
    return out


class Stream:
    """The stream of one task: takes documents, gives pieces."""

    def __init__(self, task: int, vocabulary: str, size: int = SIZE) -> None:
        self.next_id = task << 33
        self.stops, self.size = _stops(vocabulary), size
        self.ids = np.zeros(0, np.int32)
        self.doc: list = []               # doc_id of each document that the rest holds
        self.tokens = np.zeros(0, np.int64)
        self.skip = 0                     # tokens of the first document that are already packed

    def add(self, doc: list, ids: np.ndarray, tokens: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.doc += doc
        self.tokens = np.concatenate([self.tokens, tokens])

    def flush(self, last: bool) -> pa.RecordBatch | None:
        """Pieces of all windows that are settled; all of them if ``last``."""
        if len(self.ids) == 0:
            return None
        begins = np.cumsum(self.tokens) - self.tokens - self.skip
        at, pen = cut_points(self.ids, (begins + self.tokens), self.stops)
        cuts = at[best_cuts(at, pen, self.size, True)]
        if last:
            rest = tail_cuts(int(cuts[-1] - cuts[-2]), self.size)
            cuts = np.concatenate([cuts[:-2], cuts[-2] + np.cumsum([0, *rest])])
        else:
            cuts = cuts[:-1]
            if len(cuts) < 2:
                return None
        done = int(cuts[-1])
        edges = np.unique(np.concatenate([cuts, begins[(begins > 0) & (begins < done)]]))
        start, end = edges[:-1], edges[1:]
        doc = np.searchsorted(begins, start, "right") - 1
        seq = np.searchsorted(cuts, start, "right") - 1
        raw = memoryview(self.ids.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        out = pa.RecordBatch.from_arrays([
            pa.array([self.doc[i] for i in doc.tolist()], pa.int64()), pa.array(start - begins[doc]), pa.array(end - start),
            pa.array(crc, pa.int64()), pa.array(self.tokens[doc]), pa.array(self.next_id + seq),
            pa.array(start - cuts[seq])],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        self.next_id += len(cuts) - 1
        first = int(np.searchsorted(begins + self.tokens, done, "right"))  # documents before it are packed
        self.skip = int(done - begins[first]) if first < len(self.doc) else 0
        self.ids, self.doc, self.tokens = self.ids[done:], self.doc[first:], self.tokens[first:]
        return out


def pack(docs: DataFrame, vocabulary: str, size: int = SIZE) -> DataFrame:
    """One row per piece of a document: where it lies in the document, and in which sequence at which offset.

    A sequence belongs to one task; its id holds the task's number, so ids are
    unique, and a task that runs again after a loss makes the same ones.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(TaskContext.get().partitionId(), vocabulary, size)
        for part in bpe.chunks(batches, bpe.load(vocabulary)):
            for batch, lo, hi, flat, cut in bpe.texts(part):
                many = np.diff(cut)
                ids = np.full(len(flat) + len(many), END_ID, np.int32)
                ids[np.arange(len(flat)) + np.repeat(np.arange(len(many)), many)] = flat
                stream.add(batch.column("doc_id").slice(lo, hi - lo).to_pylist(), ids, many + 1)
                if (out := stream.flush(False)) is not None:
                    yield out
        if (out := stream.flush(True)) is not None:
            yield out
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
