"""Language of a text by a byte-level convolutional network.

Texts are cut into windows of ``LENGTH`` bytes, the last one filled up. Filters of several
widths run over the one-hot bytes of a window; each is reduced to its maximum, and a softmax
layer gives the window's languages. A text's probabilities are the mean over all its windows,
weighed by their bytes. The network is trained in numpy on a bounded sample of labelled texts;
only the place of each maximum has a gradient, so a step touches few weights.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tillsight.llm.common import quoted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH, WIDTHS, FILTERS = 256, (2, 3, 4), 16
#: texts of a language that are learned from, texts of all languages together, and windows of
#: each text, at most (texts about, since a hash decides), and texts of a language in any case
SAMPLE, TEXTS, WINDOWS, LEAST = 1000, 20_000, 6, 8
EPOCHS, BATCH, RATE, SEED = 4, 64, 0.01, 7
#: windows that are worked on at once
BLOCK = 64
UNKNOWN = "und"


class Network(NamedTuple):
    languages: list[str]
    filters: list[np.ndarray]  # a width w: (w, 256, FILTERS)
    bias: np.ndarray  # (widths, FILTERS)
    layer: np.ndarray  # (widths * FILTERS + 1, languages), the last row is the constant


def windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(windows, LENGTH) bytes and how many of each are of the text."""
    n = max(1, -(-len(text) // LENGTH))
    flat = np.zeros(n * LENGTH, np.uint8)
    flat[: len(text)] = np.frombuffer(text, np.uint8)
    size = np.full(n, LENGTH)
    size[-1] = len(text) - (n - 1) * LENGTH
    return flat.reshape(n, LENGTH), np.maximum(size, 1)


def _convolved(net: Network, x: np.ndarray) -> list[np.ndarray]:
    """For each width, (windows, places, FILTERS)."""
    out = []
    for f in net.filters:
        places = x.shape[1] - len(f) + 1
        total = f[0].take(x[:, :places], 0)
        for j in range(1, len(f)):
            total += f[j].take(x[:, j : j + places], 0)
        out.append(total)
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def probabilities(net: Network, x: np.ndarray) -> np.ndarray:
    """(windows, languages)."""
    out = np.empty((len(x), len(net.languages)), np.float32)
    for at in range(0, len(x), BLOCK):
        pooled = [c.max(1) for c in _convolved(net, x[at : at + BLOCK])]
        hidden = np.maximum(np.concatenate(pooled, 1) + net.bias.reshape(-1), 0)
        out[at : at + BLOCK] = _softmax(hidden @ net.layer[:-1] + net.layer[-1])
    return out


def fit(x: np.ndarray, y: np.ndarray, languages: list[str]) -> Network:
    """Network from windows and the numbers of their languages, by Adam, the same in every run.
    Languages count alike however many windows they have."""
    r = np.random.default_rng(SEED)
    net = Network(
        languages,
        [r.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros((len(WIDTHS), FILTERS), np.float32),
        r.normal(0, 0.1, (len(WIDTHS) * FILTERS + 1, len(languages))).astype(np.float32),
    )
    if not len(y):
        return net
    weights = [*net.filters, net.bias, net.layer]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    share = 1 / np.maximum(1, np.bincount(y, minlength=len(languages)))
    importance = (share / share.max()).astype(np.float32)
    columns, t = np.arange(FILTERS), 0
    for _ in range(EPOCHS):
        order = r.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            b, want = x[rows], y[rows]
            conv = _convolved(net, b)
            at_max = [c.argmax(1) for c in conv]
            pooled = np.concatenate([np.take_along_axis(c, m[:, None], 1)[:, 0] for c, m in zip(conv, at_max, strict=True)], 1)
            z = pooled + net.bias.reshape(-1)
            hidden = np.maximum(z, 0)
            p = _softmax(hidden @ net.layer[:-1] + net.layer[-1])
            p[np.arange(len(rows)), want] -= 1
            p *= importance[want][:, None] / importance[want].sum()
            back = (p @ net.layer[:-1].T) * (z > 0)
            slopes = []
            for k, (f, m) in enumerate(zip(net.filters, at_max, strict=True)):
                d = back[:, k * FILTERS : (k + 1) * FILTERS]
                slope = np.zeros_like(f)
                for j in range(len(f)):
                    np.add.at(slope[j], (np.take_along_axis(b, m + j, 1), np.broadcast_to(columns, m.shape)), d)
                slopes.append(slope)
            slopes += [back.sum(0).reshape(net.bias.shape), np.concatenate([hidden.T @ p, p.sum(0, keepdims=True)])]
            t += 1
            for w, g, m1, m2 in zip(weights, slopes, first, second, strict=True):
                m1 += 0.1 * (g - m1)
                m2 += 0.001 * (g * g - m2)
                w -= RATE * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
    return net


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def _chosen(text: bytes, key: int) -> bytes:
    """Up to ``WINDOWS`` windows of a text, from all over it."""
    x, _ = windows(text)
    pick = np.sort(np.random.default_rng(key & 0xFFFFFFFF).permutation(len(x))[:WINDOWS])
    return x[pick].tobytes()


@pandas_udf(T.BinaryType())
def _samples(texts: pd.Series, keys: pd.Series) -> pd.Series:
    return pd.Series([_chosen(t, k) for t, k in zip(texts, keys, strict=True)])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Network:
    """Learn from about ``sample`` texts of each language, or all if there are fewer, chosen by
    a hash of id and text, among rows with text and language that are not held out. Every
    language is learned; where there are many, each has fewer texts, but ``LEAST`` at least.
    Windows are cut out where the text lies; the driver gets those alone."""
    rows = docs.where(quoted(lang_col).isNotNull() & (F.length(quoted(text_col)) > 0) & ~held_out(quoted(id_col)))
    rows = rows.select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).alias("text"), F.xxhash64(quoted(id_col), quoted(text_col)).alias("key"))
    # repeated rows hash alike, so keys are counted, not rows
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()
    if not sizes:
        return fit(np.zeros((0, LENGTH), np.uint8), np.zeros(0, int), [])
    languages = sorted(r["lang"] for r in sizes)
    sample = min(sample, max(LEAST, TEXTS // len(languages)))
    shares = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1 << 31, int(sample / max(1, r["n"]) * (1 << 31))))])
    few = rows.where(F.pmod("key", F.lit(1 << 31)) < shares[F.col("lang")])
    few = few.select("lang", "key", _samples(F.col("text").cast("binary"), F.col("key")).alias("x")).dropDuplicates(["lang", "key"])
    table = few.orderBy("lang", "key").toPandas()
    parts = [np.frombuffer(b, np.uint8).reshape(-1, LENGTH) for b in table["x"]]
    number = {lang: i for i, lang in enumerate(languages)}
    y = np.repeat([number[x] for x in table["lang"]], [len(p) for p in parts]).astype(int)
    return fit(np.concatenate(parts), y, languages)


def identified(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (``id_col``, held_out, lang_pred, score).

    ``lang_pred`` is ``und`` with score 0 for null texts, texts without a letter, and where no
    language was learned. Repeated rows and null ids stay; further columns are left out."""
    kind = T.StructType().add("lang_pred", T.StringType()).add("score", T.DoubleType())

    @pandas_udf(kind)
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            out = []
            for text in batch:
                if text is None or not net.languages:
                    out.append((UNKNOWN, 0.0))
                    continue
                total, n = np.zeros(len(net.languages)), 0
                for at in range(0, max(1, len(text)), LENGTH * 1024):
                    x, size = windows(text[at : at + LENGTH * 1024])
                    total += size @ probabilities(net, x).astype(float)
                    n += size.sum()
                best = int(total.argmax())
                out.append((net.languages[best], float(min(1.0, total[best] / n))))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    text = quoted(text_col)
    seen = F.when(text.rlike(r"\p{L}"), text.cast("binary"))
    rows = docs.select(quoted(id_col).alias("id"), predict(seen).alias("p"))
    return rows.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "p.lang_pred", "p.score")
