"""Quality classifier and language identification: labels used, edge cases, held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from tillsight.llm import langid, quality
from tillsight.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def held(i, by, rest):
    return i is not None and zlib.crc32(str(i).encode()) % by == rest


def test_statistics():
    s = dict(zip(quality.STATISTICS, quality.statistics(b"The the. The!\n\nA|1 caf\xc3\xa9"), strict=True))
    assert s["distinct_words"] == 5 / 5 and s["repeated_next"] == 0 and s["distinct_lines"] == 1
    assert s["upper"] == pytest.approx(3 / 13) and s["bars"] == pytest.approx(1 / 19)
    assert len(quality.statistics(None)) == len(quality.statistics(b"")) == len(quality.STATISTICS)
    assert all(np.isfinite(quality.statistics(t)).all() for t in (None, b"", b" \n", b"\xff" * 99, b"a" * 3_000_000))


def test_rules_are_the_column(spark):
    """The compiled column gives the probability that the rules give in numpy."""
    r = np.random.default_rng(0)
    x = r.normal(size=(500, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.2) & (x[:, 3] <= 0.5) | (x[:, 5] > 1)).astype(float)
    model = quality.fit(x, y)
    assert 0 < len(model.weights) < 200
    p = 1 / (1 + np.exp(-(model.constant + sum(w * rule.holds(x) for w, rule in model.weights))))
    assert ((p >= 0.5) == y).mean() > 0.95
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "i int, x array<double>")
    got = [s for _, s in sorted((r["i"], r["s"]) for r in df.select("i", model.column(F.col("x")).alias("s")).collect())]
    assert got == pytest.approx(p.tolist(), abs=1e-6)


def test_one_label_or_none():
    x = np.zeros((4, len(quality.STATISTICS)))
    assert quality.fit(x, np.ones(4)).weights == [] and quality.fit(x, np.ones(4)).constant > 0
    assert quality.fit(x[:0], np.ones(0)).constant == 0


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op8_quality"](spark, SF).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == held(i, 3, 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for i, r in got.items())
    truth = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert np.mean([p == q for p, q in truth]) > 0.95
    assert np.mean([p == 0 for p, q in truth if q == 0]) > 0.8


def test_held_out_labels_do_not_matter(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, labels) == quality.train(docs.repartition(3), turned)


def test_quality_edges(spark):
    docs = edge.frame(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (5, 0), (6, None), (None, 0), (10, 0), (9, 1)], "doc_id bigint, quality int")
    for few in (labels, labels.limit(0), labels.where("quality = 1")):
        model = quality.train(docs, few)
        got = quality.scored(docs, model).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
        kept = quality.accepted(docs, few)
        assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in got)
    assert quality.scored(edge.frame(spark, []), model).count() == 0


def test_windows():
    x, size = langid.windows(b"a" * (2 * langid.LENGTH + 1))
    assert x.shape == (3, langid.LENGTH) and size.tolist() == [langid.LENGTH, langid.LENGTH, 1]
    assert (x.reshape(-1)[: 2 * langid.LENGTH + 1] == 97).all() and not x[2, 1:].any()


def test_network_by_hand():
    r = np.random.default_rng(2)
    net = langid.fit(np.zeros((0, langid.LENGTH), np.uint8), np.zeros(0, int), ["x", "y"])
    x = r.integers(0, 256, (5, langid.LENGTH)).astype(np.uint8)
    want = []
    for row in x:
        hidden = []
        for f, b in zip(net.filters, net.bias, strict=True):
            conv = [sum(f[j, row[i + j]] for j in range(len(f))) for i in range(langid.LENGTH - len(f) + 1)]
            hidden.append(np.maximum(np.max(conv, 0) + b, 0))
        z = np.concatenate(hidden) @ net.layer[:-1] + net.layer[-1]
        want.append(np.exp(z) / np.exp(z).sum())
    assert np.allclose(langid.probabilities(net, x), want, atol=1e-5)


def test_language_held_out(spark, docs):
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = QUERIES["op10_language"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(lang)
    assert all(r["held_out"] == held(r["doc_id"], 4, 2) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"]]) > 0.95


def test_language_edges(spark):
    docs = edge.frame(spark)
    net = langid.train(docs)
    assert net.languages == ["de", "en", "es", "fr"]
    got = langid.identified(docs, net).collect()
    assert len(got) == docs.count()
    assert sum(r["lang_pred"] == "und" for r in got) == sum(not any(c.isalpha() for c in t or "") for _, t, *_ in edge.documents())
    none = langid.train(docs.where("lang is null"))
    assert {r["lang_pred"] for r in langid.identified(docs, none).collect()} == {"und"}
    assert langid.identified(edge.frame(spark, []), net).count() == 0


def test_long_text_uses_all_windows(spark):
    """A text is judged as a whole: with the first tenth in another language the rest decides."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = langid.train(docs)
    some = {lang: " ".join(r["text"] for r in docs.where(F.col("lang") == lang).limit(40).collect()) for lang in ("en", "de")}
    mixed = some["en"][:60000] + " " + (some["de"] * 9)[:600000]
    df = spark.createDataFrame([(1, mixed)], "doc_id bigint, text string")
    assert langid.identified(df, net).first()["lang_pred"] == "de"


def test_every_language_is_learned(spark):
    """More languages than a small sample has room for: none is left out."""
    rows = [(i * 300 + n, f"{chr(0x4E00 + n)}{chr(0x5000 + n)} " * 40, f"l{n:03}", "s", 0) for n in range(300) for i in range(5)]
    docs = edge.frame(spark, rows)
    net = langid.train(docs)
    assert net.languages == [f"l{n:03}" for n in range(300)]
    seen = {r["lang_pred"] for r in langid.identified(docs, net).select("lang_pred").collect()}
    assert len(seen) > 256


def test_quality_query_by_hand(spark, docs):
    """Every score of the query is that of the rules, evaluated in Python over the whole text."""
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = dict(docs.select("doc_id", "text").collect())
    x = np.array([quality.statistics(None if t is None else t.encode()) for t in texts.values()])
    p = 1 / (1 + np.exp(-(model.constant + sum(w * rule.holds(x) for w, rule in model.weights))))
    want = dict(zip(texts, p, strict=True))
    for r in QUERIES["op8_quality"](spark, SF).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-6)
        assert r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == held(r["doc_id"], 3, 1)


def test_language_query_by_hand(spark, docs):
    """Every prediction of the query: windows weighed by the bytes of the text in them."""
    net = langid.train(docs)
    texts = dict(docs.select("doc_id", "text").collect())
    for r in QUERIES["op10_language"](spark, SF).collect():
        text = texts[r["doc_id"]]
        assert r["held_out"] == held(r["doc_id"], 4, 2)
        if text is None or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        data = text.encode()
        parts = [data[i : i + langid.LENGTH] for i in range(0, len(data), langid.LENGTH)]
        each = langid.probabilities(net, np.array([list(part.ljust(langid.LENGTH, b"\0")) for part in parts], np.uint8))
        weighed = sum(len(part) * row for part, row in zip(parts, each.astype(float), strict=True)) / len(data)
        assert r["score"] == pytest.approx(weighed.max(), abs=1e-5)
        assert weighed[net.languages.index(r["lang_pred"])] == pytest.approx(weighed.max(), abs=1e-5)
