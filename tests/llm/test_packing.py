"""Packing: ids by the tokenizers library, places without gaps, and sequences against the optimum."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest

from tests.llm import edge
from tillsight.llm import packing


@cache
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text: str | None) -> list[int]:
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [0]


def optimum(lengths: list[int], capacity: int) -> int:
    """Fewest sequences, by trying every place for each piece."""
    best = [len(lengths)]

    def place(i: int, rooms: list[int]) -> None:
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for r in {r for r in rooms if r >= lengths[i]}:
            at = rooms.index(r)
            place(i + 1, rooms[:at] + [r - lengths[i]] + rooms[at + 1 :])
        place(i + 1, [*rooms, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best[0]


def checked(filled, counts: dict, capacity: int) -> int:
    """Number of sequences; each fits, and every piece is there once."""
    seen = Counter()
    for filling, n in filled:
        assert n > 0 and sum(x * k for x, k in filling) <= capacity
        assert len({x for x, _ in filling}) == len(filling)
        for x, k in filling:
            seen[x] += n * k
    assert seen == Counter({x: n for x, n in counts.items() if n})
    return sum(n for _, n in filled)


def test_bin_completion_finds_the_optimum():
    r = random.Random(2)
    better = 0
    for _ in range(400):
        capacity = r.choice([10, 17, 30])
        lengths = [r.randrange(1, capacity + 1) if r.random() < 0.3 else r.randrange(capacity // 5 + 1, capacity // 2 + 2) for _ in range(r.randrange(1, 11))]
        counts = dict(Counter(lengths))
        got = checked(packing.complete(counts, capacity), counts, capacity)
        first = checked(packing.best_fit(counts, capacity), counts, capacity)
        best = optimum(lengths, capacity)
        assert packing.least_sequences(counts, capacity) <= best == got <= first
        better += got < first
    assert better > 0  # the search has something to do
    assert checked(packing.complete({}, 10), {}, 10) == 0
    assert checked(packing.complete({4: 2, 3: 4}, 10), {4: 2, 3: 4}, 10) == 2


def test_many_pieces():
    """Counts of a large corpus: few kinds of fillings, near the bound."""
    r = np.random.default_rng(1)
    for sizes in (r.integers(1, 2049, 200_000), r.integers(400, 900, 100_000), np.minimum(2048, r.exponential(300, 500_000).astype(int) + 1)):
        counts = {int(x): int(n) * 1000 for x, n in zip(*np.unique(sizes, return_counts=True), strict=True)}
        filled = packing.complete(counts, 2048, branches=50)
        assert checked(filled, counts, 2048) <= 1.1 * packing.least_sequences(counts, 2048)
        assert len(filled) <= 4 * 2048


def test_undominated():
    counts = [0] * 11
    for x, n in {6: 1, 4: 1, 3: 1, 2: 2}.items():
        counts[x] = n
    best = lambda filling, left: packing.undominated(filling, left, counts, 1 << 6 | 1 << 4 | 1 << 3 | 1 << 2)
    assert best(((6, 1), (4, 1)), 0)
    assert not best(((6, 1), (3, 1)), 1)  # 4 for 3
    assert not best(((6, 1), (2, 2)), 0)  # 4 for 2 and 2
    assert not best(((6, 1), (2, 1)), 2)  # room for another


TEXTS = [
    None, "", " ", "a", "<|endoftext|> in <|endoftext|>a text", "two  blanks \n and\tmore   x　 y", "don't WE'LL 123 4567 été 漢字 \U0001f600‍",
    " lead", "trail ", "\x00\x1c\x1d a\x1e b \x85c", "a" * 200_000, " " * 200_000 + "x", "\n" * 100_000, edge.words(60_000, 3), "x " * 300_000, "<|endoftext|>" * 3000,
]


def test_ids():
    encode = packing.Encoder()
    for text in TEXTS:
        assert encode(text or "").tolist() == ids_of(text)[:-1]


@pytest.mark.parametrize("run", [5, 1 << 16])
def test_ids_in_slices(monkeypatch, run):
    monkeypatch.setattr(packing, "SLICE", 7)
    monkeypatch.setattr(packing, "RUN", run)
    encode, r = packing.Encoder(), random.Random(5)
    for _ in range(300):
        text = "".join(r.choice(["a", "'s", " ", " ", "\n", " ", "9", "é", ".", "\t", "word", "<|endoftext|>"]) for _ in range(60))
        assert encode(text).tolist() == ids_of(text)[:-1]


def verified(rows, docs, capacity):
    """Pieces of each document as the contract has them, and sequences without gaps."""
    want, sizes = Counter(), Counter()
    for i, text in docs:
        ids = ids_of(text)
        first = len(ids) % capacity or capacity
        for piece, (a, b) in enumerate([(0, first)] + [(x, x + capacity) for x in range(first, len(ids), capacity)]):
            part = np.array(ids[a:b], "<u4")
            want[i, piece, a, len(part), zlib.crc32(part.tobytes())] += 1
            sizes[len(part)] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    inside = defaultdict(list)
    for r in rows:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in inside.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(inside), sizes


@pytest.mark.parametrize("which", ["edge", "table", "empty"])
def test_packed(spark, sf_dir, which):
    if which == "table":
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    else:
        docs = edge.frame(spark, None if which == "edge" else []).repartition(3)
    given = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    for capacity in (2048, 64):
        got = packing.packed(docs, capacity=capacity)
        assert got.dtypes == [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")]
        n, sizes = verified(got.collect(), given, capacity)
        assert n <= 1.02 * packing.least_sequences(sizes, capacity) + 1


def test_whole_sequences(spark):
    """The sequences themselves hold every document's ids once."""
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    rows = packing.packed(docs, with_ids=True)
    got = [r["ids"] for r in packing.sequences(rows).collect()]
    assert Counter(x for ids in got for x in ids) == Counter(x for t in TEXTS for x in ids_of(t))
    assert max(map(len, got)) <= packing.CAPACITY
    by = {r["sequence_id"]: r["ids"] for r in packing.sequences(rows).collect()}
    for r in rows.collect():
        assert by[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
