"""The pipeline stage by stage against plain Python."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute, edge
from tillsight.llm import mixing, quality, simhash

SF = "/root/testdata/sf0.01"


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r["doc_id"] for r in quality.scored(docs, model).where("predicted = 1").collect()}
    names = [f for _, f in corpus_pipeline.STAGES]
    out = []
    before = docs
    for f in names:
        before = corpus_pipeline.stored(f(spark, before, SF), "test")
        out.append(before)
    assert all(x.columns == docs.columns for x in out[:-1])
    kept = [rows(x) for x in out]
    assert {i for i, _ in kept[0]} == good
    assert sorted(i for i, _ in kept[1]) == sorted(x[0] for x in brute.exact(kept[0]) if x[3])
    assert sorted(i for i, _ in kept[2]) == sorted({c for _, _, c in brute.components(kept[1])})
    assert sorted(i for i, _ in kept[3]) == sorted(i for i, t in kept[2] if not brute.hit_words(t, bench)[-1])
    mix = Counter({r["doc_id"]: r["taken"] for r in mixing.mixture(out[3]).collect() if r["taken"]})
    assert Counter({r["doc_id"]: r["mix_taken"] for r in out[4].collect()}) == mix
    run = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, run.collect())) == Counter(map(tuple, out[4].collect()))


def test_stages_on_edges(spark):
    docs = edge.frame(spark).withColumn("lang", F.lit(None).cast("string"))
    for _, f in corpus_pipeline.STAGES:
        got = f(spark, docs, SF)
        assert set(docs.columns) <= set(got.columns)
        assert got.count() <= docs.count()
        assert f(spark, docs.limit(0), SF).count() == 0


def roots(docs):
    """Component of each text, by comparing all pairs."""
    texts = sorted({t or "" for _, t in docs})
    prints = {t: brute.fingerprint(t) for t in texts}
    near = [(a, b) for a in prints.values() for b in prints.values() if (a ^ b).bit_count() <= simhash.DISTANCE]
    root = brute.unions(near)
    return lambda t: root[prints[t or ""]]


def test_near_dedup_keeps_one_text_of_each_component(spark):
    """Ids that name several texts, and rows without an id that are linked."""
    base = edge.words(300, 1)
    near = base.split(" ")
    near[100] = "changed"
    near = " ".join(near)
    assert brute.fingerprint(base) != brute.fingerprint(near)
    other = [edge.words(40 + i, 70 + i) for i in range(8)]
    cases = [
        edge.documents(),
        [(1, base), (1, other[0]), (2, near), (2, other[1]), (1, other[2]), (3, other[0])],  # id 1 heads three components
        [(5, other[3]), (4, other[3]), (5, other[4]), (6, other[4])],  # id 5 heads one component, not the other
        [(None, base), (None, near), (None, base), (None, other[5]), (7, other[5]), (None, other[6])],
    ]
    for rows_ in cases:
        rows_ = [(*r, None, None, None)[:5] for r in rows_]
        given = [r[:2] for r in rows_]
        of = roots(given)
        want = {}
        for i, t in given:
            want[of(t)] = min(want.get(of(t), (True, 0)), (i is None, i or 0))
        kept = rows(simhash.one_of_each(edge.frame(spark, rows_)))
        assert Counter(of(t) for _, t in kept) == Counter(want.keys())
        assert all((i is None, i or 0) == want[of(t)] for i, t in kept)
        assert set(kept) <= set(given)
