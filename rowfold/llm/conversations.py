"""Repair of damaged conversations by the cheapest edits.

Each row of a conversation, in the order of its turns, is blank (nothing but white space), a duplicate (role and text seen
earlier), truncated (its last character that is not white space does not end a sentence) or sound; the first that holds
counts. Edits: Keep a row (0), Rerole it to user or assistant (``REROLE``), Delete it (``DELETE``; blank and duplicate rows
have to go), Insert an empty turn of user or assistant anywhere (``INSERT``); a truncated row that stays costs ``TRUNCATED``
more. The edits chosen are the cheapest ones after which role initials read ``(s?(ua)+)?``, of these the ones whose
initials, in order, are the least text by ASCII.

*Secondary-sorted streaming.* Rows are partitioned by conversation and sorted by turn; ``mapInPandas`` carries the state of a
dynamic program across Arrow batches. Its states are the last role that stands: none, system, user, assistant. Differences of
costs are bounded (states that can no longer win are dropped) and of equal costs only the order of the edit texts counts,
so the program's whole state is one of a few; each step is looked up by (state, kind of row) and leaves one small number, from
which the way back is read.

*Giant conversations.* One that fits a block (``BLOCK_ROWS`` rows, ``BLOCK_BYTES`` of text) is repaired as soon as it ends.
Of any other only its id is passed on. A second pass, over these alone, finds duplicates by a shuffle instead of a set in
memory and writes blocks of rows with their numbers (2 bytes a row) to the shared folder; the numbers alone are then read
backwards, block by block, into edits, which are joined to their blocks. No pass holds more than a block and the
summary of a conversation, of which only ``audit`` grows (a byte for each edit).

A null role or text counts as one space (so the row is blank if the text is null); a null turn comes first; a null
conversation id is a conversation. Rows of one turn are ordered by role, text and ``copy``. Only roles that begin with s, u or
a can be kept; an empty role cannot. Rows that are not ``present`` name their conversation and count for nothing else.
Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowfold.session import new_work_dir, stage

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK_ROWS, BLOCK_BYTES = 4_096, 4 << 20
SPACE = " \t\n\x0b\x0c\r"
SOUND, CUT, GONE = "sound", "truncated", "gone"
# states of the dynamic program: the last role that stands
NONE, SYSTEM, USER, ASSISTANT = range(4)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = frozenset(("su", "ua", "au"))

_TURNS = "array<struct<role:string,text:string>>"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
SUMMARY_SCHEMA = ", ".join(f"{c} long" for c in _COUNTS) + ", audit string"


@dataclass(frozen=True)
class Step:
    """What a row does to a state: the state after it, and for each role the way there (role before, inserts, edit)."""

    after: State
    ways: tuple[tuple[int, str, str] | None, ...]


@dataclass(frozen=True)
class State:
    """Costs of the four last roles above the least one (None: out of reach or out of the race), and the order of their edits.

    Edit texts that end in an edit of the same row cannot begin one another, so their order stays whatever follows.
    """

    costs: tuple[int | None, ...]
    ranks: tuple[int, ...]


START = State((0, None, None, None), (0, 0, 0, 0))


def _inserted(role: int, inserts: int) -> int:
    """The last role after some inserts, which have to alternate."""
    for _ in range(inserts):
        role = ASSISTANT if role == USER else USER
    return role


def _moves(role: int, initial: str, fault: str) -> Iterator[tuple[int, int, str]]:
    """Edits of a row behind ``role``: last role after it, cost, initial of the edit."""
    yield role, DELETE, "D"
    if fault == GONE:
        return
    extra = TRUNCATED if fault == CUT else 0
    turn = ASSISTANT if role == USER else USER
    if (initial == "s" and role == NONE) or initial == _NAMES[turn][0]:
        yield (SYSTEM if initial == "s" else turn), extra, "K"
    yield turn, REROLE + extra, "R"


@functools.cache
def step(state: State, initial: str, fault: str) -> tuple[Step, int]:
    """The step of a row, and what it adds to the least cost."""
    found: list[tuple[int, int, str, tuple[int, str, str]] | None] = [None] * 4
    for role, cost in enumerate(state.costs):
        if cost is None:
            continue
        for inserts in range(3):
            for after, more, edit in _moves(_inserted(role, inserts), initial, fault):
                letters = "I" * inserts + edit
                way = (cost + INSERT * inserts + more, state.ranks[role], letters, (role, "I" * inserts, edit))
                if found[after] is None or way[:3] < found[after][:3]:
                    found[after] = way
    costs = [None if w is None else w[0] for w in found]
    # "none" can do what "assistant" can, and keep a system row; "system" can do less than "assistant"
    for role, room in ((NONE, DELETE), (SYSTEM, 0)):
        if costs[role] is not None and costs[ASSISTANT] is not None and costs[role] > costs[ASSISTANT] + room:
            costs[role] = found[role] = None
    least = min(c for c in costs if c is not None)
    order = sorted((w[1], w[2], r) for r, w in enumerate(found) if w is not None)
    ranks = [0] * 4
    for rank, (_, _, role) in enumerate(order):
        ranks[role] = rank
    after = State(tuple(None if c is None else c - least for c in costs), tuple(ranks))
    return Step(after, tuple(None if w is None else w[3] for w in found)), least


@functools.cache
def ending(state: State) -> tuple[int, int, str]:
    """Cost above the least one, last role before the end, and inserts there."""
    ends = []
    for role, cost in enumerate(state.costs):
        for inserts in range(3):
            if cost is not None and _inserted(role, inserts) in (NONE, ASSISTANT):
                ends.append((cost + INSERT * inserts, state.ranks[role], "I" * inserts, role))
    cost, _, letters, role = min(ends)
    return cost, role, letters


class Steps:
    """Numbers of the steps met so far, the same in every task: states and kinds of rows are few and their order is fixed."""

    def __init__(self) -> None:
        self.numbers: dict[tuple[State, str, str], int] = {}
        self.steps: list[tuple[Step, int]] = []
        states, known = [START], {START}
        for state in states:
            for initial in ("s", "u", "a", ""):
                for fault in (SOUND, CUT, GONE):
                    made = step(state, initial, fault)
                    self.numbers[state, initial, fault] = len(self.steps)
                    self.steps.append(made)
                    if made[0].after not in known:
                        known.add(made[0].after)
                        states.append(made[0].after)


@functools.cache
def all_steps() -> Steps:
    return Steps()


def fault_of(text: str) -> str | None:
    """``blank``, ``truncated`` or None; duplicates are told from the rows before."""
    end = text.rstrip(SPACE)
    return "blank" if not end else None if end[-1] in ".!?" else CUT


def walk_back(numbers: np.ndarray, role: int) -> tuple[list[str], int]:
    """Edits of a block's rows, each with the inserts before it, from the role after the block; and the role before it."""
    steps, edits = all_steps().steps, []
    for number in numbers[::-1].tolist():
        role, inserts, edit = steps[number][0].ways[role]
        edits.append(inserts + edit)
    return edits[::-1], role


def apply_edits(role: int, edits: list[str], rows: list[tuple[str, str]], end: str = "") -> list[tuple[str, str]]:
    """The turns that stand, from the role before the rows; ``end`` are inserts behind the last row."""
    turns = []
    for edit, row in zip([*edits, end], [*rows, None], strict=True):
        for letter in edit:
            if letter == "D":
                continue
            turn = ASSISTANT if role == USER else USER
            if letter == "K":
                role = SYSTEM if row[0][:1] == "s" else turn
                turns.append(row)
                continue
            role = turn
            turns.append((_NAMES[turn], "" if letter == "I" else row[1]))
    return turns


@dataclass
class Progress:
    """A conversation while it streams by."""

    state: State = START
    cost: int = 0
    faults: dict[str, int] = field(default_factory=lambda: {"blank": 0, "duplicate": 0, CUT: 0})
    illegal: int = 0
    before: str | None = None
    low: int | None = None
    high: int | None = None
    turns: int = 0

    def add(self, turn: int | None, role: str, fault: str | None) -> int:
        """Take the next row; returns the number of its step."""
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in _LEGAL:
            self.illegal += 1
        self.before = initial
        if fault is not None:
            self.faults[fault] += 1
        kind = SOUND if fault is None else CUT if fault == CUT else GONE
        found = all_steps()
        number = found.numbers[self.state, initial if initial and initial in "sua" else "", kind]
        made, more = found.steps[number]
        self.state, self.cost = made.after, self.cost + more
        return number

    def summary(self) -> dict[str, int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        more = ending(self.state)[0]
        return {"gaps": gaps, **self.faults, "illegal": self.illegal, "cost": self.cost + more}


_COLUMNS = ["conv", "turn", "role", "text", "present"]
_ORDER = ["turn", "role", "text", "copy"]


def _plain(value, column: str):
    if value is None or (isinstance(value, float) and value != value):
        return None
    return int(value) if column == "turn" else value


def _stream(frames: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple]:
    """Rows, with the null-safe key of their conversation in front; missing numbers are None."""
    for frame in frames:
        # ids and turns come as texts: beside nulls, pandas would make floats of them
        lists = [[_plain(v, c) for v in frame[c].tolist()] for c in columns]
        yield from zip(*lists, strict=True)


def _frames(rows: Iterator[tuple], columns: list[str], size: Callable[[tuple], int]) -> Iterator[pd.DataFrame]:
    """Rows as frames of at most some thousand rows, or a block's bytes."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += size(row)
        if len(held) >= BLOCK_ROWS or weight >= BLOCK_BYTES:
            yield pd.DataFrame(held, columns=columns, dtype=object)
            held, weight = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns, dtype=object)


def _repair_small(frames: Iterator[pd.DataFrame], block_rows: int, block_bytes: int) -> Iterator[pd.DataFrame]:
    """One row per conversation: repaired, or only its id, if it does not fit a block."""

    def repaired(conv, rows: list[tuple]) -> tuple:
        progress, seen, numbers = Progress(), set(), []
        for turn, role, text in rows:
            fault = fault_of(text)
            if fault != "blank":
                if (role, text) in seen:
                    fault = "duplicate"
                seen.add((role, text))
            numbers.append(progress.add(turn, role, fault))
        _, last, end = ending(progress.state)
        edits, first = walk_back(np.array(numbers, np.int64), last)
        turns = apply_edits(first, edits, [r[1:] for r in rows], end)
        found = progress.summary()
        return (conv, False, *[found[c] for c in _COUNTS], "".join(edits) + end, [{"role": r, "text": t} for r, t in turns])

    def run() -> Iterator[tuple]:
        current, rows, weight, giant = None, [], 0, False
        for conv, turn, role, text, present in _stream(frames, _COLUMNS):
            if current is None or current[0] != conv:
                if current is not None and not giant:
                    yield repaired(current[0], rows)
                current, rows, weight, giant = (conv,), [], 0, False
            if giant or not present:
                continue
            rows.append((turn, role, text))
            weight += len(role) + len(text)
            if len(rows) > block_rows or weight > block_bytes:
                giant, rows = True, []
                yield (conv, True, *[None] * len(_COUNTS), None, None)
        if current is not None and not giant:
            yield repaired(current[0], rows)

    columns = ["conv", "giant", *_COUNTS, "audit", "turns"]
    return _frames(run(), columns, lambda r: sum(len(t["text"]) + 16 for t in r[-1] or []))


_BLOCK_SCHEMA = f"conv string, block long, last boolean, numbers binary, rows {_TURNS}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", role int, end string"


def _number_giants(frames: Iterator[pd.DataFrame], block_rows: int, block_bytes: int) -> Iterator[pd.DataFrame]:
    """Blocks of rows with the numbers of their steps; a conversation's last block has its summary and its end."""

    def block(conv, number: int, held: list, progress: Progress | None) -> tuple:
        numbers = np.array([h[0] for h in held], np.uint16).tobytes()
        rows = [{"role": r, "text": t} for _, r, t in held]
        if progress is None:
            return (conv, number, False, numbers, rows, *[None] * len(_COUNTS), None, None)
        found = progress.summary()
        _, role, end = ending(progress.state)
        return (conv, number, True, numbers, rows, *[found[c] for c in _COUNTS], role, end)

    def run() -> Iterator[tuple]:
        current, held, weight, number, progress = None, [], 0, 0, None
        for conv, turn, role, text, first in _stream(frames, ["conv", "turn", "role", "text", "first"]):
            if current is None or current[0] != conv:
                if current is not None:
                    yield block(current[0], number, held, progress)
                current, held, weight, number, progress = (conv,), [], 0, 0, Progress()
            elif held and (len(held) >= block_rows or weight + len(role) + len(text) > block_bytes):
                yield block(conv, number, held, None)
                held, weight, number = [], 0, number + 1
            fault = fault_of(text)
            if fault != "blank" and not first:
                fault = "duplicate"
            held.append((progress.add(turn, role, fault), role, text))
            weight += len(role) + len(text)
        if current is not None:
            yield block(current[0], number, held, progress)

    columns = ["conv", "block", "last", "numbers", "rows", *_COUNTS, "role", "end"]
    for row in run():
        yield pd.DataFrame([row], columns=columns, dtype=object)


def _walk_giants(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of blocks that come last block first: the role before each block and its rows' edits, joined by commas."""
    role = NONE
    for frame in frames:
        out = []
        for conv, number, numbers, own, end in _stream(iter([frame]), ["conv", "block", "numbers", "role", "end"]):
            role = role if own is None else int(own)
            edits, role = walk_back(np.frombuffer(numbers, np.uint16), role)
            out.append((conv, number, role, ",".join(edits), end or ""))
        yield pd.DataFrame(out, columns=["conv", "block", "before", "edits", "end"], dtype=object)


def _edit_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks with their edits to the turns that stand."""
    for frame in frames:
        out = []
        for conv, number, role, letters, rows, end in _stream(iter([frame]), ["conv", "block", "before", "edits", "rows", "end"]):
            turns = apply_edits(int(role), letters.split(","), [(r["role"], r["text"]) for r in rows], end)
            out.append((conv, number, [{"role": r, "text": t} for r, t in turns]))
        yield pd.DataFrame(out, columns=["conv", "part", "turns"], dtype=object)


@dataclass(frozen=True)
class Giants:
    """``summary``: a row per conversation; ``parts``: its repaired turns, ``conv, part, turns``."""

    summary: DataFrame
    parts: DataFrame


@dataclass(frozen=True)
class Repaired:
    """``whole``: conversations of one block with their summary and ``turns``; the others, if there are any."""

    whole: DataFrame
    giants: Giants | None

    def summary(self) -> DataFrame:
        """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation."""
        found = self.whole.drop("turns")
        found = found if self.giants is None else found.unionByName(self.giants.summary)
        return found.withColumn("conv", F.col("conv").cast("long"))

    def parts(self) -> DataFrame:
        """The repaired turns of every conversation, in one part or several: ``conv, part, turns``."""
        found = self.whole.select("conv", F.lit(0).cast("long").alias("part"), "turns")
        found = found if self.giants is None else found.unionByName(self.giants.parts)
        return found.withColumn("conv", F.col("conv").cast("long"))

    def with_digest(self) -> DataFrame:
        """The summary and ``repaired_sha256`` of the turns as ``role:text`` lines; parts of giants are streamed."""
        lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
        found = self.whole.select("conv", *_COUNTS, "audit", F.sha2(lines, 256).alias("sha256"))
        if self.giants is not None:
            ordered = self.giants.parts.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), "part")
            digests = ordered.select("conv", "turns").mapInPandas(_digest, "of string, sha256 string")
            found = found.unionByName(self.giants.summary.join(digests, F.col("conv").eqNullSafe(F.col("of"))).drop("of"))
        return found.select(F.col("conv").cast("long").alias("conv_id"), *_COUNTS, "audit", F.col("sha256").alias("repaired_sha256"))


def repair(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copy_col: str | None = None,
    present_col: str | None = None,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
    work_dir: str | None = None,
) -> Repaired:
    """Find the faults of all conversations and repair them; ids and turns are integers."""
    work_dir = work_dir or new_work_dir(rows.sparkSession, "conversations")
    space = F.lit(" ")
    plain = rows.select(
        F.col(f"`{id_col}`").cast("long").cast("string").alias("conv"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), space).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), space).alias("text"),
        (F.lit(0) if copy_col is None else F.col(f"`{copy_col}`").cast("int")).alias("copy"),
        (F.lit(True) if present_col is None else F.coalesce(F.col(f"`{present_col}`"), F.lit(False))).alias("present"),
    )
    in_order = lambda df: df.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), *_ORDER[1:])
    small = in_order(plain).withColumn("turn", F.col("turn").cast("string")).select(*_COLUMNS).mapInPandas(
        lambda frames: _repair_small(frames, block_rows, block_bytes), f"conv string, giant boolean, {SUMMARY_SCHEMA}, turns {_TURNS}"
    )
    small = stage(small, work_dir, "conversations")
    whole = small.filter("NOT giant").select("conv", *_COUNTS, "audit", "turns")
    giants = small.filter("giant").select(F.col("conv").alias("giant_conv"))
    if giants.isEmpty():
        return Repaired(whole, None)
    return Repaired(whole, _repair_giants(plain, giants, in_order, block_rows, block_bytes, work_dir))


def _repair_giants(plain, giants, in_order, block_rows: int, block_bytes: int, work_dir: str) -> Giants:
    held = plain.filter("present").join(giants, F.col("conv").eqNullSafe(F.col("giant_conv")), "left_semi")
    # texts are told apart by two hashes; a text that is repeated very often is one run of a sorted partition
    same = Window.partitionBy("conv", "role", F.xxhash64("text"), F.md5("text")).orderBy(F.asc_nulls_first("turn"), "copy")
    marked = in_order(held.withColumn("first", F.row_number().over(same) == 1))
    numbered = marked.select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", "first").mapInPandas(
        lambda frames: _number_giants(frames, block_rows, block_bytes), _BLOCK_SCHEMA
    )
    blocks = stage(numbered, work_dir, "blocks")
    backwards = blocks.select("conv", "block", "numbers", "role", "end").repartition("conv")
    backwards = backwards.sortWithinPartitions(F.asc_nulls_first("conv"), F.desc("block"))
    edits = stage(
        backwards.mapInPandas(_walk_giants, "conv string, block long, before int, edits string, end string"), work_dir, "edits"
    )
    key = F.col("b.conv").eqNullSafe(F.col("e.conv")) & (F.col("b.block") == F.col("e.block"))
    met = blocks.select("conv", "block", "rows").alias("b").join(edits.alias("e"), key)
    placed = met.select("b.conv", "b.block", "e.before", "e.edits", "b.rows", "e.end")
    parts = placed.mapInPandas(_edit_blocks, f"conv string, part long, turns {_TURNS}")
    # a byte for each edit, put in order by the numbers of the blocks
    letters = edits.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", F.translate("edits", ",", "").alias("edits"), "end"))).alias("all"))
    audits = letters.select(F.col("conv").alias("of"), F.array_join(F.transform("all", lambda b: F.concat(b["edits"], b["end"])), "").alias("audit"))
    summary = blocks.filter("last").join(audits, F.col("conv").eqNullSafe(F.col("of"))).select("conv", *_COUNTS, "audit")
    return Giants(summary, parts)


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows damaged by ``crc32(id:turn) % 20``, nulls as one space: 0 drops a row (not ``present``), 1 empties its text, 2 removes
    its ends of sentences, 3 repeats it (``copy`` 1), 4 sets its role to user."""
    space = F.lit(" ")
    as_text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), space)
    kind = F.crc32(F.concat(as_text(id_col), F.lit(":"), as_text(turn_col))) % 20
    text, role = as_text(text_col), as_text(role_col)
    return rows.select(
        F.col(f"`{id_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def _digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the turns of conversations whose parts come in order."""
    current, digest, empty = None, None, True
    for frame in frames:
        out = []
        for conv, turns in zip([None if pd.isna(c) else c for c in frame["conv"].tolist()], frame["turns"], strict=True):
            if current is None or current[0] != conv:
                if current is not None:
                    out.append((current[0], digest.hexdigest()))
                current, digest, empty = (conv,), hashlib.sha256(), True
            for turn in turns:
                digest.update(("" if empty else "\n").encode() + f"{turn['role']}:{turn['text']}".encode())
                empty = False
        yield pd.DataFrame(out, columns=["of", "sha256"], dtype=object)
    if current is not None:
        yield pd.DataFrame([(current[0], digest.hexdigest())], columns=["of", "sha256"], dtype=object)
