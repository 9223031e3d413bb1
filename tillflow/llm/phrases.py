"""Phrase collocations by external stream estimation: count streams in prefix and in suffix order.

Counting goes level by level. A task numbers its words exactly (a dictionary), forms the
phrases of k words as sorted numbers and sends each distinct one with its count once; Spark sums
them. A phrase of k words can only reach the least count if both its parts of k - 1 words do, so
phrases are sent only where filters say so: a bit array over the frequent phrases of each
level before, whose size follows their number up to MAX_BITS. Before the words' pairs are sent, of which
frequent words form many, their occurrences are counted by slots: each task sends packed slot counts, and a pair
whose slot doesn't reach the least count can't either. Filters may let more through, never less,
and only save shuffling: the sums are exact.

The counts of all levels then form one stream in prefix order (by words from the
left) and one in suffix order (from the right). In prefix order a phrase directly follows
its first part and stands before everything that extends it to the right, so one pass with a
stack as deep as the longest phrase joins the levels in lockstep: it gives a phrase the counts of
all its first parts, and the largest count of its extensions. Suffix order gives the same for last parts and
extensions to the left. Nothing is looked up by a hash. Both results meet in a sort-merge join.
Rows of these streams are distinct frequent phrases; those with one first (last) word stay in one
task, which streams over them.

A candidate goes when a longer one that holds it occurs as often. Such a one exists exactly
if one longer by a single word does, as counts only fall with length.

Edge cases: a null text is empty and a null language is ``und``; an empty text has no
words; a very long text is a step of its own; repeated rows count each; ties in rank are broken by
count and then by the phrase's bytes, so ranks are unique; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm import textnp as T

#: Bytes that end a piece, and bytes that end a word only.
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_BLANKS = b" \t"
LONGEST, LEAST, TOP = 5, 100, 2000
#: Bytes of text of one step, and bounds of the filter in bits.
STEP_BYTES = 6 << 20
LEAST_BITS, MAX_BITS, BITS_EACH, BLOCK_BITS = 1 << 20, 1 << 30, 16, 1 << 16
#: Parts of the table of slots, and places of the corpus a slot has about.
SLOT_BLOCKS, PLACES_EACH = 1024, 4
#: Languages whose totals are broadcast at most; more are joined.
MAX_BROADCAST_LANGS = 100_000
#: Parts of a language that are ranked on their own first.
RANK_PARTS = 64

COUNTS = "lang string, phrase string, n long"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS)] = 1
_KIND[list(_BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words(text: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of some texts, and of every word occurrence its number among them, its piece and its text."""
    raw, at = T.bytes_of(text)
    data = _LOWER[raw]
    kind = _KIND[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    inner = np.zeros(len(data) + 2, bool)
    inner[1:-1] = kind == 0
    starts = np.flatnonzero(inner[1:-1] & (~inner[:-2] | cut[:-1]))
    ends = np.flatnonzero(inner[1:-1] & (~inner[2:] | cut[1:])) + 1
    breaks = np.cumsum(kind == 2, dtype=np.int32)
    owner = np.searchsorted(at, starts, "right") - 1
    if len(starts) == 0:
        return pa.array([], pa.large_string()), starts, starts, owner
    turn = np.ones(len(starts), bool)
    turn[1:] = (breaks[starts[1:]] != breaks[starts[:-1]]) | (owner[1:] != owner[:-1])
    length = ends - starts
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])
    packed = data[kind == 0]
    coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(packed)).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(turn), owner


def _word_hash(names: pa.LargeStringArray) -> np.ndarray:
    data, at = T.bytes_of(names)
    return T.word_hashes(data, at[:-1], at[1:])


def _extend(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase that is one word longer."""
    return T.mix(h * _ODD + word)


class Filter:
    """Bits of the frequent phrases of one level."""

    def __init__(self, bits: int, blocks: dict[int, bytes]) -> None:
        self.bits = bits
        self.table = np.zeros(bits // 8, np.uint8)
        for block, part in blocks.items():
            self.table[block * BLOCK_BITS // 8: (block + 1) * BLOCK_BITS // 8] = np.frombuffer(part, np.uint8)

    def holds(self, h: np.ndarray) -> np.ndarray:
        place = (h & np.uint64(self.bits - 1)).astype(np.int64)
        return (self.table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _unique(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place of each distinct key, its number of places, and the number of every place's key."""
    order = np.argsort(key, kind="stable")
    turn = np.ones(len(key), bool)
    turn[1:] = key[order][1:] != key[order][:-1]
    first = np.flatnonzero(turn)
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(turn) - 1
    return order[first], np.diff(np.append(first, len(key))), number


class Places:
    """The words of some texts, and where phrases of ``k`` words begin that the filters of shorter ones let through."""

    def __init__(self, text: pa.LargeStringArray, lang: pa.Array, k: int, frequent: list[Filter]) -> None:
        self.names, self.number, piece, owner = words(text)
        self.langs = pc.fill_null(lang.cast(pa.string()), "und").dictionary_encode()
        self.code = self.langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner]
        at = np.arange(max(len(self.number) - k + 1, 0))
        if k > 1 and len(at):
            at = at[piece[at] == piece[at + k - 1]]
            tongue = _word_hash(self.langs.dictionary.cast(pa.large_string()))
            self.word = _word_hash(self.names)
            self.first = _extend(tongue[self.code], self.word[self.number])  # hash of the phrase of one word at each place
            ok = frequent[0].holds(self.first)
            at = at[ok[at] & ok[at + 1]]
            for j in range(2, k):
                for d in range(k - j + 1):
                    at = at[frequent[j - 1].holds(self.hashes(at + d, j))]
        self.at = at

    def hashes(self, at: np.ndarray, j: int) -> np.ndarray:
        """Hashes of the phrases of ``j`` words that begin at these places."""
        x = self.first[at]
        for d in range(1, j):
            x = _extend(x, self.word[self.number[at + d]])
        return x


def phrases(text: pa.LargeStringArray, lang: pa.Array, k: int, frequent: list[Filter], slots: Filter | None = None) -> pa.RecordBatch:
    """Distinct phrases of ``k`` words with their counts in some texts, of those that ``frequent``
    (the filters of shorter ones) and ``slots`` let through. With k = 1 the empty phrase counts all words."""
    p = Places(text, lang, k, frequent)
    at, number, names = p.at, p.number, p.names
    if slots is not None and len(at):
        at = at[slots.holds(p.hashes(at, k))]
    if len(at) == 0:
        return pa.RecordBatch.from_pydict({"lang": [], "phrase": [], "n": []}, pa.schema(
            [("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())]))
    many = max(len(names), 1)
    key = p.code[at] * many + number[at]             # a word of a language
    for d in range(1, k):
        _, _, key = _unique(key)
        key = key * many + number[at + d]
    first, count, _ = _unique(key)
    first = at[first]
    shown = pc.binary_join_element_wise(*[names.take(pa.array(number[first + d])) for d in range(k)],
                                        pa.scalar(" ", pa.large_string()))
    tongues = p.langs.dictionary.take(pa.array(p.code[first]))
    if k == 1:
        total = np.bincount(p.code, minlength=len(p.langs.dictionary))
        shown = pa.concat_arrays([shown, pa.array([""] * len(total), pa.large_string())])
        tongues = pa.concat_arrays([tongues, p.langs.dictionary])
        count = np.concatenate([count, total])
    return pa.RecordBatch.from_arrays([tongues, shown.cast(pa.string()), pa.array(count.astype(np.int64))],
                                      ["lang", "phrase", "n"])


def slot_filter(docs: DataFrame, k: int, least: int, filters: list, places: int) -> Filter:
    """The slots, by hash, that ``least`` or more occurrences of phrases of ``k`` words fall into; at most MAX_BITS of them.

    A step sends its slots sorted and packed, a row for each part of the table; a task adds up one part at a time."""
    bits = LEAST_BITS
    while bits < min(MAX_BITS, places // PLACES_EACH):
        bits *= 2
    parts = min(SLOT_BLOCKS, bits // BLOCK_BITS)
    wide = bits // parts

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [f.value for f in filters]
        for batch in batches:
            text = T.large(batch.column(0))
            for lo, hi in T.steps(text, STEP_BYTES):
                p = Places(text.slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), k, known)
                if len(p.at) == 0:
                    continue
                slot = np.sort((p.hashes(p.at, k) & np.uint64(bits - 1)).astype(np.int64))
                first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
                slot, n = slot[first], np.minimum(np.diff(np.append(first, len(slot))), least)
                cut = np.searchsorted(slot, np.arange(parts + 1) * wide)
                some = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array(np.diff(cut)[some], pa.int64()),
                     pa.array([T.squash(np.diff(slot[cut[b]: cut[b + 1]], prepend=b * wide).astype("<u4")) for b in some], pa.binary()),
                     pa.array([T.squash(n[cut[b]: cut[b + 1]].astype("<u4")) for b in some], pa.binary())],
                    ["part", "c", "slots", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(part: int, total: np.ndarray) -> pa.RecordBatch:
            held = np.packbits(total >= least, bitorder="little").reshape(-1, BLOCK_BITS // 8)
            some = np.flatnonzero(held.any(1))
            return pa.RecordBatch.from_pydict({"block": pa.array(some + part * (wide // BLOCK_BITS), pa.int64()),
                                               "bits": pa.array([held[i].tobytes() for i in some], pa.binary())})
        part, total = None, None
        for batch in batches:
            for b, c, slots, n in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if b != part:
                    if part is not None:
                        yield made(part, total)
                    part, total = b, np.zeros(wide, np.int64)
                total[np.cumsum(T.spread(slots, c, "<u4").astype(np.int64))] += T.spread(n, c, "<u4")
        if part is not None:
            yield made(part, total)
    sent = docs.select("text", "lang").mapInArrow(send, "part long, c long, slots binary, n binary")
    whole = sent.repartition("part").sortWithinPartitions("part").mapInArrow(add, "block long, bits binary")
    return Filter(bits, {r["block"]: bytes(r["bits"]) for r in whole.collect()})


def level_counts(docs: DataFrame, k: int, least: int, filters: list, slots=None) -> DataFrame:
    """lang, phrase, n of the phrases of ``k`` words that occur ``least`` times or more (with k = 1 also the empty
    phrase, n being all words). ``filters`` are broadcast filters of the levels below, ``slots`` one of this level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [f.value for f in filters]
        for batch in batches:
            text = T.large(batch.column(0))
            for lo, hi in T.steps(text, STEP_BYTES):
                yield phrases(text.slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), k, known, slots.value if slots else None)
    found = docs.select("text", "lang").mapInArrow(run, COUNTS)
    return (found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
            .where((F.col("n") >= least) | (F.col("phrase") == "")))


def build_filter(counts: DataFrame) -> Filter:
    """The filter of one level's frequent phrases: at most MAX_BITS bits reach the driver."""
    rows = counts.where(F.col("phrase") != "")
    bits = LEAST_BITS
    while bits < min(MAX_BITS, BITS_EACH * rows.count()):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            split = pc.split_pattern(batch.column(1).cast(pa.large_string()), " ")
            word, start = _word_hash(split.flatten()), np.asarray(split.offsets)[:-1].astype(np.int64)
            length = np.diff(np.asarray(split.offsets))
            start -= int(split.offsets[0].as_py())
            h = _extend(_word_hash(batch.column(0).cast(pa.large_string())), word[start])
            for d in range(1, int(length.max())):
                more = length > d
                h[more] = _extend(h[more], word[start[more] + d])
            place = (h & np.uint64(bits - 1)).astype(np.int64)
            for b in np.unique(place // BLOCK_BITS).tolist():
                own = blocks.setdefault(b, np.zeros(BLOCK_BITS // 8, np.uint8))
                mine = place[place // BLOCK_BITS == b] % BLOCK_BITS
                np.bitwise_or.at(own, mine >> 3, (1 << (mine & 7)).astype(np.uint8))
        if blocks:
            yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int64()),
                                              "bits": pa.array([b.tobytes() for b in blocks.values()], pa.binary())})

    def union(key, table):
        whole = np.zeros(BLOCK_BITS // 8, np.uint8)
        for part in table.column("bits").to_pylist():
            whole |= np.frombuffer(part, np.uint8)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([whole.tobytes()], pa.binary())})
    parts = rows.select("lang", "phrase").mapInArrow(run, "block long, bits binary")
    whole = parts.groupBy("block").applyInArrow(union, "block long, bits binary")
    return Filter(bits, {r["block"]: bytes(r["bits"]) for r in whole.collect()})


def count_levels(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """The counts of all frequent phrases of up to ``longest`` words, one level after the other."""
    sc = docs.sparkSession.sparkContext
    filters, out, places = [], None, 0
    for k in range(1, longest + 1):
        slots = sc.broadcast(slot_filter(docs, k, least, filters, places)) if k == 2 else None
        counts = level_counts(docs, k, least, filters, slots).checkpoint()
        if k == 1:
            places = counts.where(F.col("phrase") == "").agg(F.sum("n")).first()[0] or 0
        out = counts if out is None else out.unionByName(counts)
        if k < longest:
            filters.append(sc.broadcast(build_filter(counts)))
    return out


def stream(counts: DataFrame, suffix: bool = False) -> DataFrame:
    """One pass over the counts in prefix (or suffix) order.

    For every phrase of two words or more: ``parts``, the counts of its first (last) 1, 2, … words, and ``more``,
    the largest count of the phrases that are one word longer on the right (left), 0 if there is none.
    """
    spelled = F.split("phrase", " ")
    keyed = counts.where(F.col("phrase") != "").select(
        "lang", "phrase", "n", (F.reverse(spelled) if suffix else spelled).alias("words"))
    dealt = (keyed.repartitionByRange("lang", F.col("words")[0]).sortWithinPartitions("lang", "words")
             .select("lang", "phrase", "n", F.size("words").alias("k")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []   # lang, phrase, n, parts, more: the phrase before and its first parts
        done: list[list] = []

        def made() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string()),
                 pa.array([d[3] for d in done], pa.list_(pa.int64())), pa.array([d[4] for d in done], pa.int64())],
                ["lang", "phrase", "parts", "more"])
            done.clear()
            return out

        def pop(depth: int) -> None:
            while len(stack) > depth:
                top = stack.pop()
                if stack:
                    done.append(top)
                    stack[-1][4] = max(stack[-1][4], top[2])
        for batch in batches:
            for lang, phrase, n, k in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                pop(k - 1)
                stack.append([lang, phrase, n, [s[2] for s in stack], 0])
            if done:
                yield made()
        pop(0)
        if done:
            yield made()
    return dealt.mapInArrow(run, "lang string, phrase string, parts array<long>, more long")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words that occur ``least`` times or more, by the score of their weakest cut."""
    return ranked(count_levels(docs, longest, least), longest, top)


def ranked(counts: DataFrame, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The best ``top`` phrases of each language, from the counts of all levels."""
    left = stream(counts).withColumnRenamed("more", "right_more").withColumnRenamed("parts", "firsts")
    right = stream(counts, True).withColumnRenamed("more", "left_more").withColumnRenamed("parts", "lasts")
    counted = counts.where(F.col("phrase").contains(" ")).withColumnRenamed("n", "a")
    both = (counted.join(left.hint("merge"), ["lang", "phrase"]).join(right.hint("merge"), ["lang", "phrase"])
            .where((F.col("right_more") < F.col("a")) & (F.col("left_more") < F.col("a"))))
    totals = counts.where(F.col("phrase") == "").select("lang", F.col("n").alias("total"))
    few = totals.count() <= MAX_BROADCAST_LANGS
    both = both.join(F.broadcast(totals) if few else totals, "lang")

    def wide(c: str) -> F.Column:
        return F.col(c).cast("decimal(18,0)")
    weight = (F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("total")).cast("decimal(38,0)")
    shown, cuts = both.withColumn("__weight", weight), []
    for k in range(1, longest):
        inside = F.size("firsts") >= k
        l, r = F.get("firsts", F.lit(k - 1)), F.get("lasts", F.size("firsts") - k)
        product = F.when(inside, l.cast("decimal(18,0)") * r.cast("decimal(18,0)"))
        shown = shown.withColumn(f"__product{k}", product)
        cuts.append(F.when(inside, F.struct(F.expr(f"__weight div __product{k}").alias("score"), F.lit(k).alias("k"),
                                            l.alias("l"), r.alias("r"))))
    best = shown.withColumn("__cut", F.array_min(F.array(*cuts)))
    scored = best.select("lang", "phrase", "a", F.col("__cut.l").alias("l"), F.col("__cut.r").alias("r"),
                         F.col("total").alias("n"), F.col("__cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    own = scored.withColumn("__part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).where(F.col("rank") <= top)
    placed = own.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return placed.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
