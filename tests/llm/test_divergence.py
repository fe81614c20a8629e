"""Divergence of sources against plain Python, and the skyband against counting dominators."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm import brute, edge
from tillsight.llm import divergence


def wanted(rows: list[tuple], least: int = 3, k: int = 200) -> Counter:
    """(lang, source, part, item, value, rank) of rows (text, lang, source)."""
    n, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", brute.lower_az(text))
        n[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = Counter()
    for lang, has in docs.items():
        kept = {t for t, d in has.items() if d >= least}
        own = {s: Counter({t: c for t, c in w.items() if t in kept}) for (x, s), w in n.items() if x == lang}
        whole = sum(own.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        q, shares = share(whole), {s: share(c) for s, c in own.items()}
        far = lambda a, b: (a - b) ** 2 // b
        for s, p in shares.items():
            pairs = [(sum(far(p[t], o[t]) for t in kept), x) for x, o in shares.items() if x != s]
            terms = [(far(p[t], q[t]), t) for t in kept if own[s][t] and p[t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(items if part == "pair" else items[:k], 1):
                    out[lang, s, part, item, value, rank] += 1
    return out


def found(df) -> Counter:
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert [t for _, t in df.dtypes][-2:] == ["bigint", "int"]
    return Counter(map(tuple, df.collect()))


def rows_of(df) -> list[tuple]:
    return [tuple(r) for r in df.select("text", "lang", "source").collect()]


def many(seed: int, sources: int = 9) -> list[tuple]:
    """Many terms with equal counts, so that ties decide; some groups without a term."""
    r = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{'é' * (i % 3)}" for i in range(900)]
    rows = []
    for i in range(500):
        source = f"s{r.randrange(sources)}"
        words = [vocabulary[min(int(r.expovariate(0.01)), 899)] for _ in range(r.randrange(60))]
        rows.append((i, " ".join(words), r.choice(["x", "y"]), source, 0))
    rows += [(600, None, "x", "none", 0), (601, "123 !", "z", "a", 0), (602, "", "z", "b", 0), (603, "once", "z", None, 0), (604, "w", None, None, 0)]
    return rows


@pytest.mark.parametrize("which", ["edge", "table", "many", "empty"])
def test_audit(spark, sf_dir, which):
    if which == "table":
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    else:
        docs = edge.frame(spark, {"edge": None, "many": many(1), "empty": []}[which])
    want = wanted(rows_of(docs))
    assert bool(want) == (which != "empty")
    assert found(divergence.audit(docs)) == want


def test_audit_in_small_blocks(spark, monkeypatch):
    """Blocks of few sources, buckets of few terms, and few rows counted or thinned at once."""
    for name, value in (("SOURCES", 2), ("TERMS", 50), ("COUNTED", 40), ("CHUNK", 7), ("SLICE", 5)):
        monkeypatch.setattr(divergence, name, value)
    monkeypatch.setattr(divergence.thinned, "__defaults__", (30,))
    docs = edge.frame(spark, many(2)).repartition(5)
    assert found(divergence.audit(docs, k=20)) == wanted(rows_of(docs), k=20)


def test_skyband():
    r = np.random.default_rng(3)
    for most in (3, 512):
        n, lang = r.integers(1, 30, 3000), r.integers(1, 60, 3000)
        lang = np.maximum(n, lang)
        kept = set(divergence.skyband(n, lang, 10, most).tolist())
        better = np.array([np.sum((n[:i] >= n[i]) & (lang[:i] <= lang[i])) for i in range(len(n))])
        exact = set(np.nonzero(better < 10)[0].tolist())
        assert exact <= kept and (most == 3 or exact == kept)
        assert len(kept) < len(n)


def test_large_counts(spark):
    """Counts near the end of 64 bits give exact shares."""
    big = 4 * 10**18
    df = spark.createDataFrame([(big, big + 7, 5), (0, 1, 1)], "n bigint, total bigint, terms bigint")
    got = [x[0] for x in df.select(divergence.share(F.col("n"), F.col("total"), F.col("terms"))).collect()]
    assert got == [1 + 10**9 * (big + 1) // (big + 12), 1 + 10**9 // 2]
    sources = pd.DataFrame({"source": ["a", "a\0"], "block": [0, 0], "base": [1, 10**9 + 1]})
    cell = divergence.compared(("x", 0, 0, 0), pd.DataFrame({"source": ["a"], "term": ["t"], "p": [2]}), sources)
    assert set(cell.itertuples(index=False, name=None)) == {
        ("x", "a", "a\0", (10**9 - 1) ** 2 // (10**9 + 1), 1),
        ("x", "a\0", "a", (10**9 - 1) ** 2 // 2, 1),
    }
