"""Repair of conversation structure by the cheapest edits.

A conversation is in order if its roles are an optional system turn and then user and assistant
in turn: ``(s?(ua)+)?`` in initials. A row is kept, given another role, or deleted, and empty
turns may be inserted; blank and repeated rows must go. The cheapest edits are found by dynamic
programming over four states, what the repaired turns so far end with.

Rows are dealt by conversation and sorted by turn, and two passes stream over them. The first
goes from the last row to the first: it carries the least cost from each state to the end
across Arrow batches and leaves with every row a back-pointer of one byte, two bits a state. The
second goes from the first row to the last and follows the back-pointers. Neither holds a
conversation: back-pointers travel with the rows, and the sort between the passes spills them
where a conversation is larger than memory. What a lost executor had is streamed again.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import SPACE, quoted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: states: what the repaired turns end with; of roles, those but START by their initials
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: the turn that an insertion or a new role makes of each state
NEXT = (USER, USER, ASSISTANT, USER)
LEGAL = ((SYSTEM, USER), (USER,), (ASSISTANT,), (USER,))
#: edits, in the ASCII order of their initials, and their costs
DELETE, INSERT, KEEP, REROLE = range(4)
LETTERS = "DIKR"
COSTS = (4, 3, 0, 3)
TRUNCATED = 3
#: bits of what is known of a row besides its role
BLANK, DUPLICATE, CUT = 4, 8, 16
#: least cost from each state behind the last row to the end
END = (0, 2 * COSTS[INSERT], COSTS[INSERT], 0)
#: what is left to insert behind the last row
TAIL = ((), (USER, ASSISTANT), (ASSISTANT,), ())


@cache
def edits_before(after: tuple[int, ...], kind: int) -> tuple[tuple[int, ...], int, int]:
    """The back-pointer of a row and the least costs from each state in front of it, less a
    common amount, which is the last value. ``after`` are the costs behind the row."""
    role, cut = kind & 3, TRUNCATED * bool(kind & CUT)
    never = 1 << 40
    options = []
    for s in range(4):
        keep = rerole = never
        if not kind & (BLANK | DUPLICATE):
            keep = after[role] + cut if role in LEGAL[s] else never
            rerole = COSTS[REROLE] + after[NEXT[s]] + cut
        options.append([COSTS[DELETE] + after[s], never, keep, rerole])
    costs = [min(o) for o in options]
    for _ in range(4):
        costs = [min(c, COSTS[INSERT] + costs[NEXT[s]]) for s, c in enumerate(costs)]
    pointer = 0
    for s, o in enumerate(options):
        o[INSERT] = COSTS[INSERT] + costs[NEXT[s]]
        pointer |= o.index(costs[s]) << 2 * s
    least = min(costs)
    return tuple(c - least for c in costs), pointer, least


@cache
def path(state: int, pointer: int, role: int) -> tuple[str, tuple[int, ...], int, int]:
    """What is done at a row: initials of the edits, states of the turns put in before it, the
    edit of the row itself, and the state behind it."""
    letters, added = "", []
    while (edit := pointer >> 2 * state & 3) == INSERT:
        state = NEXT[state]
        letters += LETTERS[INSERT]
        added.append(state)
    after = {DELETE: state, KEEP: role, REROLE: NEXT[state]}[edit]
    return letters + LETTERS[edit], tuple(added), edit, after


def backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First pass, over rows from the last to the first: sets ``pointer``."""
    known, after = None, END
    for batch in batches:
        out = []
        for key, kind in zip(batch["key"], batch["kind"].tolist(), strict=True):
            if key != known:
                known, after = key, END
            after, pointer, _ = edits_before(after, kind)
            out.append(pointer)
        yield batch.assign(pointer=np.array(out, np.int32))


def traced(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Follows the back-pointers: for each row (batch, its place there, edits' initials, turns put
    in before it, its edit, its state before and behind), and (None, key, turns put in behind
    the last row) at the end of a conversation."""
    known, state = None, START
    for batch in batches:
        rows = zip(batch["key"], batch["pointer"].tolist(), batch["kind"].tolist(), strict=True)
        for i, (key, pointer, kind) in enumerate(rows):
            if key != known:
                if known is not None:
                    yield None, known, TAIL[state]
                known, state = key, START
            letters, added, edit, after = path(state, pointer, kind & 3)
            yield batch, i, letters, added, edit, state, after
            state = after
    if known is not None:
        yield None, known, TAIL[state]


SUMMARY = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
#: conversations that a task returns at once
RETURNED = 4096


class Summary:
    """Counts and running hash of one conversation."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.first = self.last = self.role = None
        self.audit: list[str] = []
        self.sha, self.any = hashlib.sha256(), False

    def line(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.any else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.any = True

    def insert(self, states: tuple[int, ...]) -> None:
        for s in states:
            self.line(ROLES[s], "")

    def seen(self, kind: int, turn: int, has_turn: bool) -> None:
        self.blank += bool(kind & BLANK)
        self.duplicate += bool(kind & DUPLICATE)
        self.truncated += bool(kind & CUT)
        role = kind & 3
        self.illegal += self.role is not None and (not role or role not in LEGAL[self.role] or not self.role)
        self.role = role
        if has_turn:
            self.turns += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn

    def row(self, key: str) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        audit = "".join(self.audit)
        return key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, audit, self.sha.hexdigest()


def forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Second pass, over rows from the first to the last: one row a conversation."""
    names = [c.split(" ")[0] for c in SUMMARY.split(", ")]
    out, now, of = [], Summary(), None
    for batch, i, *step in traced(batches):
        if batch is None:
            now.insert(step[0])
            now.audit.append(LETTERS[INSERT] * len(step[0]))
            now.cost += COSTS[INSERT] * len(step[0])
            out.append(now.row(i))
            now = Summary()
            if len(out) >= RETURNED:
                yield pd.DataFrame(out, columns=names)
                out = []
            continue
        if batch is not of:
            of, columns = batch, [batch[c].tolist() for c in ("kind", "turn", "has_turn", "role", "text")]
        kind, turn, has_turn, role, text = (c[i] for c in columns)
        letters, added, edit, state, after = step
        now.seen(kind, turn, has_turn)
        now.insert(added)
        if edit != DELETE:
            now.line(role if edit == KEEP else ROLES[after], text)
        now.audit.append(letters)
        now.cost += sum(COSTS[LETTERS.index(x)] for x in letters) + TRUNCATED * (edit != DELETE and bool(kind & CUT))
    if out:
        yield pd.DataFrame(out, columns=names)


TURNS = "key string, position long, edit string, role string, text string, turn long"


def edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Second pass that returns the repaired turns themselves."""
    names = [c.split(" ")[0] for c in TURNS.split(", ")]
    out, position, key = [], 0, None
    for batch, i, *step in traced(batches):
        added = step[0] if batch is None else step[1]
        for s in added:
            out.append((i if batch is None else batch["key"].iat[i], position, "I", ROLES[s], "", None))
            position += 1
        if batch is None:
            position = 0
        elif step[2] != DELETE:
            row = batch.iloc[i]
            role = row["role"] if step[2] == KEEP else ROLES[step[4]]
            out.append((row["key"], position, LETTERS[step[2]], role, row["text"], int(row["turn"]) if row["has_turn"] else None))
            position += 1
        if len(out) >= RETURNED:
            yield pd.DataFrame(out, columns=names).astype({"turn": "Int64"})
            out = []
    if out:
        yield pd.DataFrame(out, columns=names).astype({"turn": "Int64"})


def _key(conv: Column) -> Column:
    """Conversation id as a text that is never null."""
    return F.concat(F.when(conv.isNull(), F.lit("n")).otherwise(F.lit("v")), F.coalesce(conv.cast("string"), F.lit("")))


def _rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows with what is known of them, dealt by conversation."""
    space = F.lit(" ")
    rows = turns.select(
        _key(quoted(conv_col)).alias("key"),
        F.coalesce(quoted(turn_col).cast("bigint"), F.lit(0)).alias("turn"),
        quoted(turn_col).isNotNull().alias("has_turn"),
        F.coalesce(quoted(role_col).cast("string"), space).alias("role"),
        F.coalesce(quoted(text_col).cast("string"), space).alias("text"),
    ).repartition("key")
    # equal rows differ in ``nth`` alone, so the order of rows is total but for such that are the same
    nth = F.row_number().over(Window.partitionBy("key", "role", "text").orderBy("has_turn", "turn"))
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    cut = ~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    initial = F.substring("role", 1, 1)
    code = F.lit(0)
    for letter, state in INITIALS.items():
        code = F.when(initial == letter, F.lit(state)).otherwise(code)
    fault = F.when(blank, F.lit(BLANK)).when(F.col("nth") > 1, F.lit(DUPLICATE)).when(cut, F.lit(CUT)).otherwise(F.lit(0))
    rows = rows.withColumn("nth", nth)
    return rows.withColumn("kind", (code + fault).cast("int"))


def _pointed(turns: DataFrame, *names: str) -> DataFrame:
    """Rows with their back-pointers, each conversation from its first row to its last."""
    rows = _rows(turns, *names)
    order = ["has_turn", "turn", "role", "text", "nth"]
    last_first = rows.sortWithinPartitions("key", *[F.desc(c) for c in order])
    schema = "key string, turn long, has_turn boolean, role string, text string, nth int, kind int, pointer int"
    pointed = last_first.mapInPandas(backward, schema)
    return pointed.sortWithinPartitions("key", *order)


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation of ``turns``: (``conv_col``, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256).

    Rows are taken by turn, nulls first, then by role and text, where turns are equal. A null
    role or text is one space; a null id is a conversation. ``blank``, ``duplicate`` and
    ``truncated`` count rows by their first fault, ``illegal`` the neighbours whose initials do
    not follow each other, ``gaps`` the missing turn numbers. Costs: keep 0, insert 3, rerole 3,
    delete 4, and 3 for a truncated row that stays. ``audit`` has the initials of the cheapest
    edits, of equally cheap ones the least in ASCII; the hash is that of the repaired turns, a
    line ``role:text`` each. Repeated rows are duplicates and must go. An empty table gives an
    empty result; further columns are left out.
    """
    ids = turns.select(quoted(conv_col).alias("conv")).distinct().withColumn("key", _key(F.col("conv")))
    found = _pointed(turns, conv_col, turn_col, role_col, text_col).mapInPandas(forward, SUMMARY)
    return ids.join(found, "key").drop("key").withColumnRenamed("conv", conv_col)


def repaired_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired turns: (``conv_col``, position, edit, role, text, turn). ``edit`` is K, R or
    I, ``turn`` the number the turn had, null for an inserted one. Rows as in ``repair``."""
    ids = turns.select(quoted(conv_col).alias("conv")).distinct().withColumn("key", _key(F.col("conv")))
    found = _pointed(turns, conv_col, turn_col, role_col, text_col).mapInPandas(edited, TURNS)
    return ids.join(found, "key").select(F.col("conv").alias(conv_col), "position", "edit", "role", "text", "turn")


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``turns`` with faults put in by a hash of conversation and turn: (conv_id, turn, role,
    text). Of twenty classes, 0 loses the row, 1 its text, 2 its full stops, exclamation and
    question marks, 3 repeats the row, 4 makes it the user's. Nulls count as one space."""
    space = F.lit(" ")
    conv, turn = quoted(conv_col), quoted(turn_col)
    label = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    rows = turns.select(
        conv.alias("conv_id"),
        turn.alias("turn"),
        F.coalesce(quoted(role_col), space).alias("role"),
        F.coalesce(quoted(text_col), space).alias("text"),
        (F.crc32(label) % 20).alias("class"),
    ).where(F.col("class") != 0)
    kind = F.col("class")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def repaired_after_damage(turns: DataFrame) -> DataFrame:
    """``repair`` of ``damaged`` rows, with every conversation of ``turns``: those that lost all
    rows have zeros, an empty audit and the hash of the empty text."""
    ids = turns.select("conv_id").distinct()
    found = repair(damaged(turns)).withColumnRenamed("conv_id", "of")
    rows = ids.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    none = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return rows.select("conv_id", *[F.coalesce(F.col(c), F.lit(none.get(c, 0))).alias(c) for c in names])
