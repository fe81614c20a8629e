"""Text quality by a sparse ensemble of rules.

Statistics of whole texts are taken in Arrow batches. On a bounded sample of labelled texts,
small boosted trees are grown; every path from a root to another node is a rule, a conjunction
of comparisons. Lasso-penalised logistic regression weighs the rules, most of which drop out.
The rest is compiled into one Spark column over the statistics.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tillsight.llm.common import number_of, quoted, whole_row

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: labelled rows that are learned from, at most (about, since a hash decides)
SAMPLE = 20_000
TREES, DEPTH, CUTS, RATE = 24, 3, 24, 0.3
PENALTY, ROUNDS = 5e-4, 400
STATISTICS = [
    "log_words", "word_length", "longest_word", "upper", "digits", "space", "beyond_ascii", "punctuation", "symbols",
    "bars", "bangs", "stops", "distinct_words", "commonest_word", "repeated_next", "distinct_lines",
]


def _bytes(which) -> np.ndarray:
    return np.array([chr(i) in which if i < 128 else False for i in range(256)])


def statistics(text: bytes | None) -> list[float]:
    """Statistics of a text in UTF-8, in the order of ``STATISTICS``."""
    from collections import Counter

    text = text or b""
    n = max(1, len(text))
    seen = np.zeros(256, np.int64)
    for at in range(0, len(text), 1 << 20):
        seen += np.bincount(np.frombuffer(text, np.uint8, min(1 << 20, len(text) - at), at), minlength=256)
    count = lambda a, b: int(seen[a : b + 1].sum())
    these = lambda s: sum(int(seen[ord(c)]) for c in s)
    upper, lower = count(65, 90), count(97, 122)
    words = text.split()
    kinds = Counter(words)
    w = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    bare = n - these(" \t\n\v\f\r") if text else 1
    bare = max(1, bare)
    return [
        float(np.log1p(len(words))),
        sum(map(len, words)) / w,
        float(np.log1p(max(map(len, kinds), default=0))),
        upper / max(1, upper + lower),
        count(48, 57) / bare,
        1 - bare / n if text else 0.0,
        count(128, 255) / bare,
        these(",;:'\"()-?") / bare,
        these("#$%&*@^~<>{}[]\\/=+_`") / bare,
        these("|") / bare,
        these("!") / bare,
        these(".") / w,
        len(kinds) / w,
        max(kinds.values(), default=0) / w,
        sum(map(bytes.__eq__, words[1:], words)) / w,
        len(set(lines)) / max(1, len(lines)),
    ]


@pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([statistics(t) for t in batch])


def with_statistics(text: Column) -> Column:
    return _statistics(F.coalesce(text, F.lit("")).cast("binary"))


class Rule(NamedTuple):
    """All of (statistic, above, limit): its value is above the limit, or not above it."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for j, above, limit in self.terms:
            out &= (x[:, j] > limit) == above
        return out

    def column(self, stats: Column) -> Column:
        tests = [stats[j] > limit if above else stats[j] <= limit for j, above, limit in self.terms]
        return reduce(lambda a, b: a & b, tests)


class RuleEnsemble(NamedTuple):
    constant: float
    weights: list[tuple[float, Rule]]

    def column(self, stats: Column) -> Column:
        """Probability of label 1."""
        parts = [F.when(rule.column(stats), F.lit(w)).otherwise(F.lit(0.0)) for w, rule in self.weights]
        while len(parts) > 1:
            parts = [reduce(lambda a, b: a + b, parts[i : i + 8]) for i in range(0, len(parts), 8)]
        return 1 / (1 + F.exp(-(F.lit(self.constant) + (parts[0] if parts else 0.0))))


def _grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple[list[tuple], np.ndarray]:
    """Paths of a tree fitted to gradients g with curvature h, and its step for each row."""
    paths, step = [], np.zeros(len(g))
    todo = [(np.arange(len(g)), ())]
    while todo:
        rows, path = todo.pop()
        if path:
            paths.append(path)
        best = (1e-6, 0, 0)
        if len(path) < DEPTH and len(rows) >= 20:
            total_g, total_h = g[rows].sum(), h[rows].sum()
            for j, limits in enumerate(cuts):
                if not len(limits):
                    continue
                left_g = np.bincount(bins[rows, j], g[rows], len(limits) + 1).cumsum()[:-1]
                left_h = np.bincount(bins[rows, j], h[rows], len(limits) + 1).cumsum()[:-1]
                n = np.bincount(bins[rows, j], minlength=len(limits) + 1).cumsum()[:-1]
                gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
                gain[(n < 5) | (n > len(rows) - 5)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], j, k)
        if best[0] > 1e-6:
            _, j, k = best
            above = bins[rows, j] > k
            for side in (False, True):
                todo.append((rows[above == side], (*path, (j, side, float(cuts[j][k])))))
        else:
            step[rows] = -g[rows].sum() / (h[rows].sum() + 1)
    return paths, step


def fit(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    """Rules and weights from statistics and labels. One label alone, or none at all, gives a
    constant: the share of label 1, each count one higher."""
    share = (y.sum() + 1) / (len(y) + 2)
    constant = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return RuleEnsemble(constant, [])
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, CUTS + 2)[1:-1])) for j in range(x.shape[1])]
    cuts = [c[c < x[:, j].max()] for j, c in enumerate(cuts)]
    bins = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    level, found = np.full(len(y), constant), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-level))
        paths, step = _grow(x, bins, cuts, p - y, p * (1 - p))
        level += RATE * step
        found |= dict.fromkeys(tuple(sorted(set(path))) for path in paths)
    rules, columns, known = [], [], set()
    for path in found:  # rules that hold for the same rows, or for all others, count once
        holds = (rule := Rule(path)).holds(x)
        mark = min(np.packbits(holds).tobytes(), np.packbits(~holds).tobytes())
        if mark not in known and holds.any() and not holds.all():
            known.add(mark)
            rules.append(rule)
            columns.append(holds)
    weights, constant = _lasso(np.stack(columns, 1).astype(np.float32), y.astype(np.float32), constant) if rules else ([], constant)
    return RuleEnsemble(constant, [(float(w), r) for w, r in zip(weights, rules, strict=True) if w])


def _lasso(a: np.ndarray, y: np.ndarray, constant: float) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient descent on the logistic loss with an absolute penalty."""
    n, k = a.shape
    wide = np.concatenate([a, np.ones((n, 1), np.float32)], 1)
    w = np.zeros(k + 1, np.float32)
    w[-1] = constant
    v = np.ones(k + 1, np.float32)
    for _ in range(20):
        v = wide.T @ (wide @ v)
        norm = float(np.linalg.norm(v))
        v /= norm
    rate = 4 * n / (norm * 1.05)
    ahead, t = w.copy(), 1.0
    for _ in range(ROUNDS):
        slope = wide.T @ (1 / (1 + np.exp(-(wide @ ahead))) - y) / n
        new = ahead - rate * slope
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * PENALTY, 0)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    return w[:-1], float(w[-1])


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> RuleEnsemble:
    """Learn from about ``sample`` labelled ids that are not held out, or all, chosen by hash. Of
    repeated labels the majority counts; of repeated documents, one."""
    known = labels.where(quoted(id_col).isNotNull() & quoted(label_col).isNotNull() & ~held_out(quoted(id_col)))
    known = known.groupBy(quoted(id_col).alias("id")).agg((F.avg(quoted(label_col)) >= 0.5).cast("double").alias("y"))
    # at most about ``sample`` ids of 8 bytes
    chosen = F.broadcast(number_of(known, F.col("id"), sample))
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).join(chosen, "id")
    rows = rows.select("id", "y", with_statistics(F.col("text")).alias("x")).groupBy("id").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    table = rows.orderBy("id").toPandas()
    x = np.array(table["x"].tolist(), float).reshape(len(table), len(STATISTICS))
    return fit(x, table["y"].to_numpy(float))


def scored(docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (``id_col``, held_out, score, predicted). Null and empty
    texts are scored by the statistics of an empty text; repeated rows and null ids stay.
    Further columns are left out."""
    rows = docs.select(quoted(id_col).alias("id"), with_statistics(quoted(text_col)).alias("x"))
    rows = rows.select("id", model.column(F.col("x")).alias("score"))
    return rows.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that a classifier trained on its labelled rows accepts, all columns."""
    model = train(docs, labels, id_col, text_col)
    rows = docs.select(whole_row(docs), with_statistics(quoted(text_col)).alias("x"))
    return rows.where(model.column(F.col("x")) >= 0.5).select("row.*")
