"""Near-duplicate documents by DartMinHash signatures and banded joining.

Every text is a weighted set of shingles of five words. Darts are thrown at the
elements: an element with weight x owns the region [0, x) of the weight axis, cut
into dyadic layers, and in each layer the darts arrive as a Poisson process in rank
whose gaps are hashed from (element, layer, dart). So two texts that
share an element see the same darts wherever both regions reach. A dart also
hashes to one of K coordinates, and each coordinate keeps its earliest dart. Two
signatures agree on a coordinate with the probability of the texts' weighted Jaccard
similarity. A text of total weight W looks at ranks up to about (K ln K + 2K) / W,
so the work is the number of elements plus the number of darts, whatever the
weights; a text with an empty coordinate looks twice as far.

The query weights every distinct shingle by 1, for which weighted Jaccard is the
Jaccard similarity of the shingle sets that the 0.8 rule is stated in;
``weights="count"`` weights by occurrences and is tested beside it.

Joining: equal word sequences collapse to one representative first. The
representatives meet in bands of ROWS coordinates. A band's bucket is never
expanded into pairs:

1. every member is checked against the bucket's smallest document, exactly, on
   the shingle sets (``verify``);
2. in buckets that still hold several classes, members are checked against some
   random pivots, in blocks, and only links that join classes are returned;
3. in buckets that still hold several classes, all members are pivots. After
   this no two candidates that were left apart are similar.

Edge cases: a null or empty text (no words) is a class of its own; a text of one to
four words is one shingle; rows with the same doc_id are one document, whose class is
that of any of its texts; a null doc_id takes no part and is kept with a null class; an
empty table gives an empty result; further columns don't matter to ``near_duplicates``
and are kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm import textnp as T
from tillflow.llm.graph import components
from tillflow.session import checkpoint_dir

SHINGLE = 5
THRESHOLD = 0.8
#: 25 bands of 5 coordinates: a pair at 0.8 shares a bucket but for 5 in 100,000,
#: one at 0.9 but for 1 in 10**9; a pair at 0.3 does with 6 in 100.
BANDS, ROWS = 25, 5
K = BANDS * ROWS
PIVOTS = 16
BLOCK = 256

_U = np.uint64
_MULT = T.mix(np.arange(1, SHINGLE + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)) | _U(1)


def shingles(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, 48-bit shingle hash) of every shingle, and two hashes of each text's word sequence."""
    starts, ends, doc = T.word_spans(data, at)
    n = len(at) - 1
    h = T.word_digests(data, starts, ends)
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    place = (np.arange(len(h)) - first[doc]).astype(np.uint64)
    content = []
    for salt in (_U(0x8CB92BA72F3D8DD7), _U(0xABC98388FB8FAC03)):  # each word mixed with its place, so that order counts
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(T.mix(h ^ T.mix(place * _U(2) + salt)))])
        content.append(T.mix(total[first + count] - total[first] + count.astype(np.uint64) * salt))
    wide = np.concatenate([h, np.zeros(SHINGLE - 1, np.uint64)])
    joined = np.zeros(len(h), np.uint64)
    left = (first + count)[doc] - np.arange(len(h))  # words from here to the text's end
    for k in range(SHINGLE):
        joined += np.where(left > k, wide[k: k + len(h)] * _MULT[k], _U(0))
    short = np.minimum(count, SHINGLE)[doc]
    begins = (left >= SHINGLE) | ((count[doc] < SHINGLE) & (left == count[doc]))
    sh = T.mix(joined[begins] + short[begins].astype(np.uint64)) >> _U(16)
    return doc[begins], sh, content[0], content[1]


def elements(doc: np.ndarray, sh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text number, shingle) in order, and how often each occurs."""
    key = np.sort((doc.astype(np.uint64) << _U(48)) | sh)
    if len(key) == 0:
        return np.zeros(0, np.int64), sh, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    times = np.diff(np.append(new, len(key)))
    key = key[new]
    return (key >> _U(48)).astype(np.int64), key & _U((1 << 48) - 1), times


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """An (n, k) array of float32 ranks: the earliest dart of each coordinate (inf for a text without elements)."""
    sig = np.full(n * k, np.inf, np.float32)
    norm = np.bincount(doc, weight, n)
    reach = np.zeros(n)
    todo = norm > 0
    reach[todo] = (k * np.log(k) + 2 * k) / norm[todo]
    while todo.any():
        use = todo[doc]
        d, e, w = doc[use], element[use], weight[use].astype(np.float64)
        # Dyadic layers of the weight axis: [0, 1), [1, 2), [2, 4), …
        layers = 1 + np.ceil(np.log2(np.maximum(w, 1.0))).astype(np.int64)
        cell = np.repeat(np.arange(len(e)), layers)
        level = np.arange(len(cell)) - np.repeat(np.cumsum(layers) - layers, layers)
        low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
        width = np.where(level == 0, 1.0, low)
        d, w = d[cell], w[cell]
        seed = T.mix(e[cell] * _U(0x9E3779B97F4A7C15) + level.astype(np.uint64) + _U(1))
        rank, dart = np.zeros(len(cell)), 0
        while len(seed):
            dart += 1
            x = T.mix(seed + _U(dart * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))
            rank = rank - np.log(((x >> _U(12)).astype(np.float64) + 1.0) * 2.0 ** -52) / width
            near = rank <= reach[d]
            seed, rank, d, low, width, w, x = (v[near] for v in (seed, rank, d, low, width, w, x))
            y = T.mix(x ^ _U(0xE7037ED1A0B428DB))
            at = (y >> _U(32)) * _U(k) >> _U(32)
            inside = low + width * ((y & _U(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32) < w
            slot = d * k + at.astype(np.int64)
            np.minimum.at(sig, slot[inside], rank[inside].astype(np.float32))
        empty = np.isinf(sig.reshape(n, k)).any(1)
        todo &= empty
        reach[todo] *= 2
    return sig.reshape(n, k)


def bands(sig: np.ndarray, count: int = BANDS) -> np.ndarray:
    """An (n, count) array of band hashes, the band's number included."""
    bits = np.ascontiguousarray(sig).view(np.uint32).reshape(len(sig), count, -1)
    h = np.broadcast_to(np.arange(count, dtype=np.uint64), bits.shape[:2]).copy()
    for r in range(bits.shape[2]):
        h = T.mix(h * _U(0xC2B2AE3D27D4EB4F) + bits[:, :, r].astype(np.uint64))
    return h


def _weigh(times: np.ndarray, weights: str) -> np.ndarray:
    return times.astype(np.float64) if weights == "count" else np.ones(len(times))


def signature_table(docs: DataFrame, weights: str = "unit") -> DataFrame:
    """(doc_id, c1, c2, n_shingles, bands): content hashes and band hashes of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = T.large(batch.column("text"))
            for lo, hi in T.steps(text):
                data, at = T.bytes_of(text.slice(lo, hi - lo))
                doc, sh, c1, c2 = shingles(data, at)
                doc, el, times = elements(doc, sh)
                n = hi - lo
                b = bands(signatures(doc, el, _weigh(times, weights), n))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, n), pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)),
                    pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS),
                                             pa.array(b.reshape(-1).view(np.int64)))],
                    ["doc_id", "c1", "c2", "n_shingles", "bands"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, c1 long, c2 long, n_shingles long, bands array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, grams): the sorted distinct shingles of every text, 32 bits of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = T.large(batch.column("text"))
            for lo, hi in T.steps(text):
                data, at = T.bytes_of(text.slice(lo, hi - lo))
                doc, sh, _, _ = shingles(data, at)
                doc, el, _ = elements(doc, sh)
                low = (el >> _U(16)).astype("<u4")  # still in order within a text
                cut = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int64) * 4
                grams = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), hi - lo, [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(low.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), grams.cast(pa.binary())], ["doc_id", "grams"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, grams binary")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repeats."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    whole = len(a) + len(b) - both
    return both / whole if whole else 0.0


def verify(edges: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of ``threshold`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ga, gb = batch.column("ga"), batch.column("gb")
            good = [jaccard(np.frombuffer(x.as_buffer(), "<u4"), np.frombuffer(y.as_buffer(), "<u4")) >= threshold
                    for x, y in zip(ga, gb, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
    left = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("gb"))
    return (edges.join(right, "b").join(left, "a").select("a", "b", "ga", "gb")
            .mapInArrow(run, "a long, b long"))


def link_blocks(frame: pd.DataFrame, threshold: float = THRESHOLD) -> pd.DataFrame:
    """Pivots against members of one block: a link per pivot and class that it reaches.

    Intersections are matrix products over the shingles that occur, in slices
    of bounded width.
    """
    frame = frame.drop_duplicates(["rep", "grams"])  # a doc_id may have several texts
    sets = [np.frombuffer(g, "<u4") for g in frame["grams"]]
    piv = np.flatnonzero(frame["pivot"].to_numpy())
    rep, comp = frame["rep"].to_numpy(), frame["comp"].to_numpy()
    if len(piv) == 0 or len(rep) < 2:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    sizes = np.array([len(s) for s in sets])
    vocab, code = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    both = np.zeros((len(piv), len(sets)), np.float64)
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    step = 1 << 14
    for lo in range(0, len(vocab), step):
        i, j = np.searchsorted(code, [lo, lo + step])
        dense = np.zeros((len(sets), min(step, len(vocab) - lo)), np.float32)
        dense[row[i:j], code[i:j] - lo] = 1
        both += dense[piv] @ dense.T
    whole = sizes[piv][:, None] + sizes[None, :] - both
    good = (both >= threshold * whole - 1e-9) & (comp[piv][:, None] != comp[None, :])
    p, m = np.nonzero(good)
    found = pd.DataFrame({"a": rep[piv[p]], "b": rep[m], "ca": comp[piv[p]], "cb": comp[m]})
    return found.drop_duplicates(["ca", "cb"])[["a", "b"]]


def _wave(members: DataFrame, labels: DataFrame, docs: DataFrame, pivots: int | None) -> DataFrame:
    """Links between classes that share a bucket; ``pivots`` a bucket, or all of its members."""
    rows = (members.join(labels, members["rep"] == labels["v"], "left")
            .select("bucket", "rep", F.coalesce("label", "rep").alias("comp")))
    open_ = (rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                        F.count("*").alias("n"))
             .filter("lo != hi and n > 2").select("bucket", "n"))
    rows = rows.join(open_, "bucket")
    want = F.lit(pivots if pivots else 1 << 62).cast("long")
    rows = rows.withColumn("pivot", F.pmod(F.xxhash64("rep", "bucket", F.lit(pivots or 0)), "n") < want)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    blocks = F.greatest(blocks, F.lit(1))
    mine = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    some = F.least(F.lit(1 << 30) if not pivots else F.lit(1), blocks)
    part = F.pmod(F.xxhash64("rep"), some).cast("int")
    every = F.explode(F.sequence(F.lit(0), some - 1))
    own = rows.select("bucket", mine.alias("mb"), every.alias("pb"), "rep", "comp", F.lit(False).alias("pivot"))
    wide = F.explode(F.sequence(F.lit(0), blocks - 1))
    across = rows.filter("pivot").select("bucket", wide.alias("mb"), part.alias("pb"), "rep", "comp",
                                         F.lit(True).alias("pivot"))
    both = own.union(across).groupBy("bucket", "mb", "pb", "rep").agg(
        F.max("comp").alias("comp"), F.max("pivot").alias("pivot")).checkpoint()
    sets = shingle_sets(docs.join(both.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    full = both.join(sets, both["rep"] == sets["doc_id"]).select("bucket", "mb", "pb", "rep", "comp", "pivot", "grams")
    return full.groupBy("bucket", "mb", "pb").applyInPandas(lambda frame: link_blocks(frame), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, weights: str = "unit") -> DataFrame:
    """(doc_id, class_id, kept, n_shingles): class_id is the smallest doc_id of the near-duplicate class."""
    checkpoint_dir(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sig = signature_table(docs, weights).checkpoint()
    some = sig.filter("n_shingles > 0 and doc_id is not null")
    reps = some.groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"))
    banded = (some.join(reps, ["c1", "c2"]).filter("doc_id = rep")
              .select("rep", F.explode("bands").alias("bucket")))
    pivot = (banded.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.max("rep").alias("top"))
             .filter("pivot != top").select("bucket", "pivot"))
    members = banded.join(pivot, "bucket").distinct().checkpoint()
    edges = members.filter("rep != pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct().checkpoint()
    ends = edges.select(F.col("a").alias("doc_id")).union(edges.select(F.col("b").alias("doc_id"))).distinct()
    links = verify(edges, shingle_sets(docs.join(ends, "doc_id", "left_semi")))
    # Texts of one doc_id are one document, whichever content hash they have.
    ids = some.join(reps, ["c1", "c2"]).select("doc_id", "rep")
    links = links.union(ids.filter("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))).checkpoint()
    labels = components(links)
    for pivots in (PIVOTS, None):
        more = _wave(members.select("bucket", "rep"), labels, docs, pivots).checkpoint()
        if not more.isEmpty():
            links = links.union(more)
            labels = components(labels.select(F.col("v").alias("a"), F.col("label").alias("b")).union(more))
    found = sig.join(labels, sig["doc_id"] == labels["v"], "left")
    cls = F.coalesce("label", "doc_id")
    return found.select("doc_id", cls.alias("class_id"), F.coalesce(cls == F.col("doc_id"), F.lit(True)).alias("kept"),
                        "n_shingles")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its class, with their columns unchanged."""
    gone = near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
