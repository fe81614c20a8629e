"""Repair of conversations against a search over whole edit scripts."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from tillsight.llm import conversation
from tillsight.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """First fault of each (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]+", "", text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, closed=True):
    """(cost, audit, repaired lines) by a search in order of cost and audit over all scripts;
    without ``closed`` no two scripts are merged."""
    bad = faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        place = (i, roles[-1:] if len(roles) != 1 else roles + "1")
        if closed and place in done:
            continue
        done.add(place)
        if i == len(rows) and GOOD.fullmatch(roles):
            return cost, audit, lines
        options = [("I", 3, r) for r in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            more = 3 * (bad[i] == "truncated")
            options.append(("D", 4, None))
            if bad[i] not in ("blank", "duplicate"):
                options += [("K", more, role), *(("R", 3 + more, r) for r in ("user", "assistant"))]
        for letter, extra, role in options:
            new = roles if role is None else roles + role[:1]
            if role is not None and (not role or not re.fullmatch(r"s?(ua)*u?", new)):
                continue
            line = () if role is None else (f"{role}:{'' if letter == 'I' else rows[i][2]}",)
            if cost + extra <= 6 * len(rows) + 6:
                heapq.heappush(heap, (cost + extra, audit + letter, i + (letter != "I"), new, lines + line))


def result(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    bad = Counter(faults(rows))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest(rows)
    return gaps, bad["blank"], bad["duplicate"], bad["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def by_conversation(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return by


def table():
    """Nulls, empty and long texts, ties, repeated rows, other roles, short and long conversations."""
    r = random.Random(4)
    texts = ["Fine.", "Good!", "cut", "", " \t", "end. \n", "é?", None, "Fine.", "a:b\nc."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "udo", "agent"]
    rows = []
    for conv in range(160):
        for turn in range(r.randrange(1, 9)):
            few = r.random() < 0.8
            rows.append((conv, turn * r.choice((1, 1, 2)), r.choice(roles[:2] if few else roles), r.choice(texts) if r.random() < 0.4 else f"text {r.randrange(10**6)}."))
    rows += [(None, None, "user", "x"), (None, 3, None, None), (None, 3, "user", "x."), (None, 1, "assistant", "y.")]
    rows += [(1000, None, "user", "q."), (1000, None, "user", "q."), (1001, 5, "user", edge.words(30000, 8) + ".")]
    rows += [(1002, 1 << 60, "user", "far."), (1002, -5, "system", "s."), (1002, (1 << 60) + 1, "assistant", "near.")]
    rows += [(1003, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(0, 3000)]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("x") for c in ("key", "kind", "pointer", "nth", "gaps", "audit", "copy", "class", "conv", "of", "a b")}).withColumn("m", F.create_map(F.lit(1), F.lit(2)))


def test_search_by_scripts_and_by_places_agree():
    r = random.Random(1)
    for _ in range(300):
        rows = [(t, r.choice(["user", "assistant", "system", "x"]), r.choice(["a.", "b.", "c", "", "d."])) for t in range(r.randrange(0, 5))]
        assert cheapest(rows) == cheapest(rows, closed=False)


def test_repair(spark):
    rows = table()
    got = conversation.repair(frame(spark, rows))
    want = {c: result(x) for c, x in by_conversation(rows).items()}
    assert {x[0]: tuple(x[1:]) for x in got.collect()} == want
    assert got.count() == len(want)


def test_repair_in_small_batches(spark):
    """A conversation that spans many Arrow batches."""
    rows = table()
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {x[0]: tuple(x[1:]) for x in conversation.repair(frame(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == {c: result(x) for c, x in by_conversation(rows).items()}


def test_repaired_turns(spark):
    """The turns themselves give the hash and the order of roles that the summary claims."""
    docs = frame(spark, table())
    turns = defaultdict(list)
    for x in conversation.repaired_turns(docs).orderBy("conv_id", "position").collect():
        assert x["position"] == len(turns[x["conv_id"]])
        assert (x["edit"] == "I") <= (x["turn"] is None and x["text"] == "")
        turns[x["conv_id"]].append(x)
    for x in conversation.repair(docs).collect():
        own = turns[x["conv_id"]]
        assert GOOD.fullmatch("".join(t["role"][0] for t in own))
        assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in own).encode()).hexdigest() == x["repaired_sha256"]
        assert [t["edit"] for t in own] == [e for e in x["audit"] if e != "D"]


def test_damage(spark):
    rows = table()
    got = conversation.damaged(frame(spark, rows))
    assert got.columns == ["conv_id", "turn", "role", "text"]
    assert Counter(map(tuple, got.collect())) == Counter(damage(rows))


def test_empty(spark):
    none = frame(spark, [])
    assert conversation.repair(none).count() == conversation.repaired_turns(none).count() == 0
    assert conversation.repaired_after_damage(none).count() == 0


@pytest.mark.parametrize("which", ["made up", "sf0.01"])
def test_query(spark, which):
    if which == "made up":
        rows = table() + [(x, 0, "user", "lost.") for x in range(5000, 5100)]  # some lose all rows
        got = conversation.repaired_after_damage(frame(spark, rows))
    else:
        rows = [tuple(x) for x in spark.read.parquet(f"/root/testdata/{which}/conversations.parquet").collect()]
        got = QUERIES["op11_conversation"](spark, f"/root/testdata/{which}")
    after = by_conversation(damage(rows))
    want = {c: result(after.get(c, [])) for c in {x[0] for x in rows}}
    assert {x[0]: tuple(x[1:]) for x in got.collect()} == want
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert [t for c, t in got.dtypes if c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] == ["bigint"] * 6
    assert which != "made up" or len(after) < len(want)
