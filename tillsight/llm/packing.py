"""Packing of tokenised documents into sequences of a fixed capacity by bin completion.

Documents are tokenised where they lie and cut into pieces; a piece is known by its length alone
from then on. Lengths are at most the capacity, so the pieces of any corpus are a table of
at most ``capacity`` counts, and a packing of them is a list of fillings, each used so many
times. That list is found by bin completion over the counts:

* the incumbent is the best-fit-decreasing packing;
* the search takes the largest length left and enumerates the undominated fillings around it,
  fullest first, and uses a filling as often as counts allow, then less often;
* a branch ends where the tokens left need as many sequences as the incumbent has, given the
  space wasted so far; the search ends where the incumbent meets the lower bound.

Pieces find their places without being brought together: tasks number the pieces of each
length as they cut them, sums over tasks turn these into ranks, and the fillings give every
rank of a length its sequence and offset.
"""

from __future__ import annotations

import os
import sys
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tillsight.llm.common import quoted, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k"
#: id behind each document
END = 0
#: characters of a text that are tokenised at once, and of a run that can't be parted there
SLICE, RUN = 1 << 18, 1 << 16
#: branches that the search tries, fillings tried at one, and steps of their enumeration
BRANCHES, FILLINGS, STEPS = 10_000, 4, 400
#: (length, pieces of it) of a sequence, and number of sequences so filled
Filling = tuple[tuple[tuple[int, int], ...], int]


class Encoder:
    """Ids of texts by a byte-level vocabulary in two forms of one content: ranks, which are
    read about three times as fast, and the file of the tokenizers library, which is used for
    texts with white space or a word of over ``RUN`` characters."""

    def __init__(self, name: str = TOKENIZER):
        import base64

        import public_tokenizers
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path = public_tokenizers.path(f"{name}.json")
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.special = {"<|endoftext|>": len(ranks)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.whole = None

    def slow(self, text: str) -> list[int]:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return self.whole.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> np.ndarray:
        """Ids of ``text``. It is parted only before a space that follows another character
        than white space; no token goes over such a place."""
        parts, at = [], 0
        while at < len(text):
            end = at + SLICE
            while end < len(text) and not (text[end] == " " and not text[end - 1].isspace()):
                end += 1
            part = text[at:end]
            long = len(part) > RUN and (max(map(len, part.split(" "))) > RUN or " " * RUN in part)
            ids = self.slow(part) if long else self.fast.encode(part, allowed_special="all")
            parts.append(np.array(ids, "<u4"))
            at = end
        return np.concatenate([*parts, np.zeros(0, "<u4")]) if parts else np.zeros(0, "<u4")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; all but the first are full."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def _pieces(capacity: int, encoder: Callable[[], Callable[[str], np.ndarray]], with_ids: bool):
    kind = T.StructType().add("start", T.LongType()).add("length", T.LongType()).add("ids_crc32", T.LongType()).add("nth", T.LongType())
    if with_ids:
        kind = kind.add("ids", T.ArrayType(T.LongType()))

    @pandas_udf(T.ArrayType(kind))
    def pieces(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode, numbered = encoder(), [0] * (capacity + 1)
        for batch in texts:
            out = []
            for text in batch:
                ids = np.append(encode(text), np.uint32(END)).astype("<u4")
                own = []
                for start, length in cut(len(ids), capacity):
                    part = ids[start : start + length]
                    piece = {"start": start, "length": length, "ids_crc32": zlib.crc32(part.tobytes()), "nth": numbered[length]}
                    if with_ids:
                        piece["ids"] = part.tolist()
                    numbered[length] += 1
                    own.append(piece)
                out.append(own)
            yield pd.Series(out)

    return pieces.asNondeterministic()


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, encoder: Callable = Encoder, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, nth), and ids if asked for: ``nth`` counts the
    pieces of that length in the task. To be written before it is read twice."""
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    cut_up = _pieces(capacity, encoder, with_ids)(text)
    rows = docs.select(quoted(id_col).alias("id"), cut_up.alias("pieces"), F.spark_partition_id().alias("task"))
    each = rows.select("id", "task", F.posexplode("pieces").alias("piece", "p"))
    return each.select("id", "piece", "p.*", "task")


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best-fit-decreasing over counts: each length in turn goes into the fullest sequences that
    have room for it, sequences filled alike being handled at once. Each length parts at most
    one kind of filling and opens two, so there are at most 4 kinds for each length."""
    room: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(filling: tuple, times: int, left: int) -> None:
        if times:
            if not room.setdefault(left, []):
                insort(rooms, left)
            room[left].append([filling, times])

    for length in sorted(counts, reverse=True):
        rest = counts[length]
        while rest:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                filling, times, left = (), (rest + capacity // length - 1) // (capacity // length), capacity
            else:
                left = rooms[at]
                filling, times = room[left].pop()
                if not room[left]:
                    rooms.pop(at)
            most = left // length
            full = min(times, rest // most)
            put((*filling, (length, most)), full, left - most * length)
            times, rest = times - full, rest - full * most
            if times and rest:
                put((*filling, (length, rest)), 1, left - rest * length)
                times, rest = times - 1, 0
            put(filling, times, left) if filling else None
    return [(tuple(f), n) for kinds in room.values() for f, n in kinds]


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's bound: for each a, pieces above capacity - a are alone, pieces above
    half the capacity share no sequence, and pieces of a or more fill what room is left there."""
    n, size = np.zeros(capacity + 2, np.int64), np.zeros(capacity + 2, np.int64)
    for length, count in counts.items():
        n[length], size[length] = count, count * length
    total, most = int(size.sum()), 0
    above = lambda x, a: int(x[a:].sum())
    half = capacity // 2
    for a in range(capacity // 2 + 1):
        alone, big = above(n, capacity - a + 1), above(n, half + 1)
        space = (big - alone) * capacity - (above(size, half + 1) - above(size, capacity - a + 1))
        most = max(most, big + max(0, -(-(above(size, a) - above(size, half + 1) - space) // capacity)))
    return max(most, -(-total // capacity))


def undominated(filling: tuple, left: int, counts: list[int], free: int) -> bool:
    """Whether no single piece that is left over could take the place of some pieces of the
    filling, or be added, and leave less space: such a filling need not be tried. ``free`` has
    a bit for each length of which pieces are left before the filling is taken."""
    sums, used = 1, 0
    for i, (length, times) in enumerate(filling):
        used |= 1 << length
        if counts[length] == times:
            free &= ~(1 << length)
        if i:
            for _ in range(times):
                sums |= sums << length
    more, width = sums << 1, 1  # sums that up to ``left`` more would be
    while width < left:
        step = min(width, left - width)
        more |= more << step
        width += step
    if left and more & free:
        return False
    # of equal length only a piece in place of several is better
    return not sums & free & ~used


def fillings(counts: list[int], largest: int, capacity: int, waste: int, sizes: list[int], free: int) -> list[tuple]:
    """Undominated fillings around one piece of the largest length with at most ``waste`` left,
    fullest first: [(length, pieces), ...]. ``sizes`` are the lengths left, ascending.
    ``STEPS`` bounds how long fillings are looked for."""
    found: list[tuple[int, tuple]] = []
    steps = STEPS
    stack = [(len(sizes) - 1, capacity - largest, ((largest, 1),))]
    while stack and steps and len(found) < FILLINGS:
        steps -= 1
        at, left, filling = stack.pop()
        at = min(at, bisect_right(sizes, left) - 1)
        if at < 0:
            if left <= waste and undominated(filling, left, counts, free):
                found.append((left, filling))
            continue
        size = sizes[at]
        most = min(left // size, counts[size] - (size == largest))
        for times in range(most + 1):  # the last is tried first
            new = filling if not times else ((largest, 1 + times),) if size == largest else (*filling, (size, times))
            stack.append((at - 1, left - times * size, new))
    return [f for _, f in sorted(found, key=lambda x: x[0])]


def complete(counts: dict[int, int], capacity: int, branches: int = BRANCHES) -> list[Filling]:
    """Fillings of as few sequences as the search finds, for counts of pieces by length."""
    counts = {x: n for x, n in counts.items() if n}
    best = best_fit(counts, capacity)
    used = sum(n for _, n in best)
    bound = least_sequences(counts, capacity)
    if used <= bound:
        return best
    left = [0] * (capacity + 1)
    for x, n in counts.items():
        left[x] = n
    sizes, free, sequences = sorted(counts), sum(1 << x for x in counts), 0

    def taken(f: tuple, n: int) -> None:
        """Take a filling ``n`` times out of what is left, or put it back if ``n`` is below 0."""
        nonlocal free, sequences, tokens
        for x, k in f:
            before, left[x] = left[x], left[x] - k * n
            if not left[x]:
                sizes.pop(bisect_left(sizes, x))
                free &= ~(1 << x)
            elif not before:
                insort(sizes, x)
                free |= 1 << x
        sequences += n
        tokens -= n * sum(x * k for x, k in f)

    tokens = sum(x * n for x, n in counts.items())
    chosen: list[Filling] = []

    def choices(largest: int) -> Iterator[Filling]:
        # space that may be wasted here if the incumbent is to be beaten
        waste = (used - 1 - sequences) * capacity - tokens
        for f in fillings(left, largest, capacity, waste, sizes, free):
            most = min(left[x] // n for x, n in f)
            yield f, most
            if most > 1:
                yield f, 1

    stack = [choices(sizes[-1])]
    opened: list[bool] = [False]
    while stack and branches and used > bound:
        branches -= 1
        if opened[-1]:  # take back the last choice here
            f, n = chosen.pop()
            taken(f, -n)
            opened[-1] = False
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            opened.pop()
            continue
        taken(*step)
        chosen.append(step)
        opened[-1] = True
        if sequences + -(-tokens // capacity) >= used:
            continue
        if not sizes:
            best, used = list(chosen), sequences
            continue
        stack.append(choices(sizes[-1]))
        opened.append(False)
    return best


class Places(NamedTuple):
    """Runs of ranks of one length: where a run starts, pieces a sequence has of the length,
    first sequence of the run, and offset of the first piece there. ``start`` is sorted and has
    the length in its upper bits."""

    start: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


RANK_BITS = 50


def places(filled: list[Filling]) -> Places:
    at: dict[int, int] = {}
    rows, sequence = [], 0
    for filling, n in filled:
        offset = 0
        for length, times in filling:
            rows.append((length << RANK_BITS | at.get(length, 0), times, sequence, offset))
            at[length] = at.get(length, 0) + n * times
            offset += length * times
        sequence += n
    columns = np.array(sorted(rows), np.int64).reshape(-1, 4).T
    return Places(*columns)


def _placed(where: Places):
    @pandas_udf(T.StructType().add("sequence_id", T.LongType()).add("offset", T.LongType()))
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        length, rank = lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
        run = np.searchsorted(where.start, length << RANK_BITS | rank, "right") - 1
        behind = rank - (where.start[run] & (1 << RANK_BITS) - 1)
        each = where.times[run]
        return pd.DataFrame({"sequence_id": where.sequence[run] + behind // each, "offset": where.offset[run] + behind % each * length})

    return place


def packed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    encoder: Callable = Encoder, with_ids: bool = False, branches: int = BRANCHES,
) -> DataFrame:
    """One row per piece of a document: (``id_col``, piece, start, length, ids_crc32,
    sequence_id, offset), and ``ids`` if asked for.

    A document is its ids and ``END``; only one of more than ``capacity`` is cut, into pieces of
    that length, of which the first may be shorter. Null and empty texts are one id. Sequences
    have no gaps and at most ``capacity`` ids. Repeated rows and null ids are packed like any
    other. An empty table gives an empty result; further columns are left out.

    The driver gets a count for each length, ``capacity`` of them at most, and tasks get the
    runs of ranks, which are at most 4 kinds of fillings for each length, of 63 lengths each.
    """
    rows = stored(pieces(docs, id_col, text_col, capacity, encoder, with_ids), "pieces")
    by_task = rows.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = by_task.select("length", "task", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = rows.join(starts, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    ranked = ranked.withColumn("at", _placed(places(complete(counts, capacity, branches)))("length", "rank"))
    more = ["ids"] if with_ids else []
    return ranked.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset", *more)


def sequences(packed_rows: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces that carry their ids; no sequence is longer than the capacity."""
    parts = packed_rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
