"""Conversation structure repair by secondary-sorted streaming.

Rows are repartitioned by conversation and sorted by turn inside their partition; mapInPandas
then reads them as one stream, whatever the Arrow batches are, and carries a dynamic
program from row to row. It finds the cheapest edits (Keep 0, Rerole 2, Delete 3, Insert 2, and
1 for a truncated row that stays) that leave the role initials ``(s?(ua)+)?``; of several
cheapest edit sequences it takes the one whose initials are least in ASCII order.

The program has four states, by what is written so far: nothing, an s, a u, an a. For each
it carries the cost and the order of the best edit strings. No such string is the start of
another, as each ends with the edit of the same row, so their order is all that later
comparisons need. States that can't be on a cheapest way any more are dropped. Costs are kept
less the smallest one, so only a few dozen such configurations occur, and a row is one look-up
of (configuration, kind of row). What a row stores to find the way back is that look-up's
number, two bytes. Of a giant conversation these numbers and the rows themselves are spilled
to unnamed temporary files of the task, which end with it.

``damage`` is the fixed damage of the query, ``repair`` gives the edits with their texts, and
``summarise`` streams over those edits without another shuffle.

Edge cases: a null role or text is one space, a null turn comes first, a null conv_id is a
conversation of its own; turns that occur several times are ordered by role and text; an
empty text or one of white space is blank; repeated rows are duplicates, wherever they
stand; very long texts are rows like any other; an empty table gives an empty result, and a
conversation without rows none in ``repair`` (``report`` gives it zeros); further columns are not read.
"""

from __future__ import annotations

import array
import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Costs of the edits, and of a truncated row that isn't deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_BLANKS = " \t\n\x0b\x0c\r"
_ENDS = (".", "!", "?")
FAULTS = ("", "blank", "duplicate", "truncated")

#: Rows of an output frame; rows and their bytes of a conversation that stay in memory.
FRAME_ROWS = 5_000
SPILL_ROWS, SPILL_BYTES = 200_000, 16 << 20

EDITS = ("conv_id string, step long, edit string, fault string, turn string, role string, text string, "
         "new_role string, edit_cost int")
SUMMARY = ("conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """Conversation rows (conv_id, turn, role, text) after the damage that crc32(``conv_id:turn``) % 20 chooses."""
    one = F.lit(" ")
    text, role = F.coalesce("text", one), F.coalesce("role", one)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), one))
    staged = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                         (F.crc32(F.encode(name, "utf-8")) % 20).alias("kind"))
    kind = F.col("kind")
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (staged.where(kind != 0)
            .select("conv_id", "turn",
                    F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(copies).alias("copy")).drop("copy"))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows by conversation and turn, with the kind of each row: its fault and its role's initial.

    One shuffle by conversation: it also holds equal (role, text) of a conversation together,
    which is all that the duplicate test needs.
    """
    one = F.lit(" ")
    dealt = rows.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                        F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text")).repartition("conv_id")
    place = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    body = F.rtrim("text", F.lit(_BLANKS))
    fault = (F.when(body == "", 1).when(F.col("place") > 1, 2)
             .when(~F.substring(body, -1, 1).isin(*_ENDS), 3).otherwise(0))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return (dealt.withColumn("place", place)
            .withColumn("kind", (fault * 4 + letter).cast("int"))
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "place")
            .select("conv_id", F.col("turn").cast("string").alias("turn"), "role", "text", "kind"))


# States: nothing written, after an s, after a u, after an a.
_NONE, _S, _U, _A = range(4)
_NEXT = {_NONE: _U, _S: _U, _U: _A, _A: _U}          # state after one more user or assistant
_TAIL = {_NONE: 0, _S: 2, _U: 1, _A: 0}              # inserts that end the conversation well
_ROLE = {_U: "user", _A: "assistant"}
#: What reaching the end from one state (row) may cost less than from another (column): a state that is
#: dearer than another by more than this is on no cheapest way.
_GAP = ((0, 0, 2, 4), (4, 0, 2, 4), (5, 2, 0, 2), (3, 0, 2, 0))


class Program:
    """The dynamic program as a table that is filled as configurations occur.

    A configuration gives each state None or (cost above the least, place in the order of strings).
    """

    def __init__(self) -> None:
        self.configs: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.steps: dict[int, tuple[int, int, int]] = {}  # config * 16 + kind: next config, cost, back
        self.backs: list[tuple] = []                      # state: (state before, inserts, edit)
        self.start = self._config(((0, 0), None, None, None))

    def _config(self, c: tuple) -> int:
        if c not in self.known:
            self.known[c] = len(self.configs)
            self.configs.append(c)
        return self.known[c]

    def step(self, config: int, kind: int) -> tuple[int, int, int]:
        found = self.steps.get(config << 4 | kind)
        if found is None:
            found = self.steps[config << 4 | kind] = self._step(config, kind)
        return found

    def _step(self, config: int, kind: int) -> tuple[int, int, int]:
        fault, letter = kind >> 2, kind & 3
        rest = TRUNCATED if fault == 3 else 0
        best: list = [None] * 4
        for state, have in enumerate(self.configs[config]):
            if have is None:
                continue
            cost, place = have
            at = state
            for inserts in range(3):
                ways = [("D", at, DELETE)]
                if fault in (0, 3):
                    ways.append(("R", _NEXT[at], REROLE + rest))
                    if letter == 0 and at == _NONE:
                        ways.append(("K", _S, KEEP + rest))
                    elif letter == 1 and at != _U:
                        ways.append(("K", _U, KEEP + rest))
                    elif letter == 2 and at == _U:
                        ways.append(("K", _A, KEEP + rest))
                for edit, to, price in ways:
                    way = (cost + INSERT * inserts + price, place, "I" * inserts + edit, state, inserts, edit)
                    if best[to] is None or way[:3] < best[to][:3]:
                        best[to] = way
                at = _NEXT[at]
        low = min(b[0] for b in best if b)
        costs = [b[0] - low if b else None for b in best]
        alive = [b if b and not any(c is not None and c + _GAP[y][x] < costs[x] for y, c in enumerate(costs)) else None
                 for x, b in enumerate(best)]
        order = sorted((b[1], b[2], x) for x, b in enumerate(alive) if b)
        place = {x: i for i, (_, _, x) in enumerate(order)}
        new = tuple((b[0] - low, place[x]) if b else None for x, b in enumerate(alive))
        self.backs.append(tuple(b[3:] if b else None for b in alive))
        return self._config(new), low, len(self.backs) - 1

    def end(self, config: int) -> tuple[int, int]:
        """The state that the cheapest way ends in, and what its last inserts cost above the configuration."""
        cost, _, state = min((have[0] + INSERT * _TAIL[s], have[1], s)
                             for s, have in enumerate(self.configs[config]) if have)
        return state, cost


class Conversation:
    """The rows of one conversation so far, in memory or spilled, and the way back through them."""

    def __init__(self, name: str | None, program: Program, spill_rows: int = SPILL_ROWS) -> None:
        self.name, self.program, self.config, self.spill_rows = name, program, program.start, spill_rows
        self.rows: list[tuple] = []
        self.back = array.array("H")
        self.size = self.count = 0
        self.row_file = self.back_file = None

    def add(self, turn, role: str, text: str, kind: int) -> None:
        self.config, _, back = self.program.step(self.config, kind)
        self.back.append(back)
        self.rows.append((turn, role, text, kind))
        self.count += 1
        self.size += len(role) + len(text)
        if len(self.rows) >= self.spill_rows or self.size >= SPILL_BYTES:
            if self.row_file is None:
                self.row_file, self.back_file = tempfile.TemporaryFile(), tempfile.TemporaryFile()
            pickle.dump(self.rows, self.row_file, pickle.HIGHEST_PROTOCOL)
            self.back.tofile(self.back_file)
            self.rows, self.back, self.size = [], array.array("H"), 0

    def _backwards(self) -> Iterator[int]:
        """The numbers of the look-ups, last row first."""
        yield from reversed(self.back)
        left = self.back_file.tell() // 2 if self.back_file else 0
        while left:
            n = min(left, self.spill_rows)
            self.back_file.seek(2 * (left - n))
            part = array.array("H")
            part.fromfile(self.back_file, n)
            yield from reversed(part)
            left -= n

    def _forwards(self) -> Iterator[tuple]:
        if self.row_file is not None:
            end = self.row_file.tell()
            self.row_file.seek(0)
            while self.row_file.tell() < end:
                yield from pickle.load(self.row_file)
        yield from self.rows

    def edits(self) -> Iterator[tuple]:
        """The cheapest edits in order, as rows of EDITS."""
        state, _ = self.program.end(self.config)
        tail, codes, backs = _TAIL[state], bytearray(), self.program.backs
        for back in self._backwards():
            state, inserts, edit = backs[back][state]
            codes.append(inserts * 3 + "DKR".index(edit))
        codes.reverse()
        at, step = _NONE, 0
        for code, (turn, role, text, kind) in zip(codes, self._forwards(), strict=True):
            for _ in range(code // 3):
                at = _NEXT[at]
                yield self.name, step, "I", "", None, None, "", _ROLE[at], INSERT
                step += 1
            edit, fault = "DKR"[code % 3], kind >> 2
            rest = TRUNCATED if fault == 3 else 0
            if edit == "D":
                new, price = None, DELETE
            elif edit == "R":
                at = _NEXT[at]
                new, price = _ROLE[at], REROLE + rest
            else:
                at = _S if kind & 3 == 0 else _NEXT[at]
                new, price = role, KEEP + rest
            yield self.name, step, edit, FAULTS[fault], turn, role, text, new, price
            step += 1
        for _ in range(tail):
            at = _NEXT[at]
            yield self.name, step, "I", "", None, None, "", _ROLE[at], INSERT
            step += 1

    def close(self) -> None:
        for f in (self.row_file, self.back_file):
            if f is not None:
                f.close()


def _text(values: pd.Series) -> list:
    return [None if v is None or v != v else v for v in values.tolist()]


def _framed(rows: Iterator[tuple], schema: str) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in schema.split(", ")]
    part: list[tuple] = []
    size = 0
    for row in rows:
        part.append(row)
        size += len(row[6] or "") if len(row) > 6 and isinstance(row[6], str) else 0
        if len(part) >= FRAME_ROWS or size >= SPILL_BYTES:
            yield pd.DataFrame(part, columns=names)
            part, size = [], 0
    if part:
        yield pd.DataFrame(part, columns=names)


def repair(rows: DataFrame, spill_rows: int = SPILL_ROWS) -> DataFrame:
    """The cheapest edits of every conversation of ``rows`` (conv_id, turn, role, text), in order within their partition.

    One row per edit: the edit's initial, the row's first fault, its turn, role and text as they
    were, the role that it has afterwards (null if deleted) and the edit's cost. An inserted
    row has an empty text and no turn or role of before. ``conv_id`` and ``turn`` are texts. A
    conversation of more than ``spill_rows`` rows or SPILL_BYTES is spilled.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        program = Program()

        def edits() -> Iterator[tuple]:
            talk = None
            for frame in frames:
                for name, turn, role, text, kind in zip(
                        _text(frame["conv_id"]), _text(frame["turn"]), frame["role"], frame["text"],
                        frame["kind"].tolist(), strict=True):
                    if talk is None or name != talk.name:
                        if talk is not None:
                            yield from talk.edits()
                            talk.close()
                        talk = Conversation(name, program, spill_rows)
                    talk.add(turn, role, text, kind)
            if talk is not None:
                yield from talk.edits()
                talk.close()
        yield from _framed(edits(), EDITS)
    return ordered(rows).mapInPandas(run, EDITS)


class Summary:
    """What ``summarise`` says of one conversation, edit by edit."""

    def __init__(self, name: str | None) -> None:
        self.name, self.faults = name, dict.fromkeys(FAULTS, 0)
        self.low = self.high = None
        self.turns = self.illegal = self.cost = 0
        self.before: str | None = None
        self.audit: list[str] = []
        self.hash, self.written = hashlib.sha256(), False

    def add(self, edit: str, fault: str, turn, role, text: str, new_role, cost: int) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            self.faults[fault] += 1
            if turn is not None:
                n = int(turn)
                if self.high is None or n != self.high:
                    self.turns += 1
                self.low, self.high = n if self.low is None else self.low, n
            if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = role[:1]
        if new_role is not None:
            self.hash.update(f"{chr(10) if self.written else ''}{new_role}:{text}".encode())
            self.written = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.name, gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal,
                self.cost, "".join(self.audit), self.hash.hexdigest())


def summarise(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s result, which must come unshuffled: its gaps in turns, its rows by first
    fault, its illegal neighbours, the edits' cost and initials, and the digest of the repaired conversation."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found() -> Iterator[tuple]:
            one = None
            for frame in frames:
                columns = (_text(frame["conv_id"]), frame["edit"], frame["fault"], _text(frame["turn"]), _text(frame["role"]),
                           frame["text"], _text(frame["new_role"]), frame["edit_cost"].tolist())
                for name, *rest in zip(*columns, strict=True):
                    if one is None or name != one.name:
                        if one is not None:
                            yield one.row()
                        one = Summary(name)
                    one.add(*rest)
            if one is not None:
                yield one.row()
        yield from _framed(found(), SUMMARY)
    return edits.mapInPandas(run, SUMMARY)


def report(rows: DataFrame, damaged: DataFrame, spill_rows: int = SPILL_ROWS) -> DataFrame:
    """The summary of ``damaged`` for every conv_id of ``rows``, zeros for those without a row left."""
    said = summarise(repair(damaged, spill_rows)).withColumnRenamed("conv_id", "__name")
    names = rows.select("conv_id").distinct()
    zero = {c: F.lit(0).cast("bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    rest = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return (names.join(said, names.conv_id.cast("string").eqNullSafe(said["__name"]), "left")
            .select(names.conv_id, *[F.coalesce(said[c], v).alias(c) for c, v in {**zero, **rest}.items()]))
