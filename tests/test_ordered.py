"""Bucketed operators against the plain window and against brute force, with a hot key."""

from __future__ import annotations

import hashlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tillsight.operators.ordered import (
    as_of,
    balanced_bucket,
    equal_depth,
    global_row_number,
    min_after,
    next_row,
    running_position,
    time_bucket,
)

START = datetime(2024, 1, 1)


def events(seed: int, n: int):
    """A third of all rows has one key; times collide and sit on bucket edges."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rng.randrange(1, 8)
        at = START + timedelta(seconds=rng.choice([0, 3599, 3600, 7200, rng.randrange(0, 90000)]))
        out.append((key, at, i))
    return out


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(events(1, 400), "key int, at timestamp, id int").cache()


@pytest.mark.parametrize("dense", [False, True])
def test_running_position_equals_window(df, dense):
    order = ["at"] if dense else ["at", "id"]
    got = running_position(df, ["key"], order, time_bucket("at"), "pos", dense)
    w = Window.partitionBy("key").orderBy(*order)
    want = df.withColumn("pos", (F.dense_rank() if dense else F.row_number()).over(w))
    assert rows(got, "id", "pos") == rows(want, "id", "pos")


def test_next_row_equals_lead(df):
    got = next_row(df, ["key"], ["at", "id"], time_bucket("at"), ["id", "at"], "next")
    want = df.withColumn("n", F.lead("id").over(Window.partitionBy("key").orderBy("at", "id")))
    assert rows(got.select("id", F.col("next")["id"].alias("n"))) == rows(want, "id", "n")


@pytest.mark.parametrize("direction", ["next", "prev"])
def test_as_of_equals_brute_force(spark, df, direction):
    right_rows = events(2, 150)
    right = spark.createDataFrame(right_rows, "key int, seen timestamp, code int")
    got = as_of(df, right, ["key"], "at", "seen", ["code"], direction)
    want = []
    for key, at, i in events(1, 400):
        if direction == "next":
            hits = [(s, c) for k, s, c in right_rows if k == key and s > at]
            best = min(hits, default=(None, None))
        else:
            hits = [(s, c) for k, s, c in right_rows if k == key and s < at]
            best = max(hits, default=(None, None))
        want.append((i, best[0], best[1]))
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows(got, "id", "seen", "code") == sorted(want, key=key)


def test_as_of_keeps_left_rows_without_time_or_key(spark):
    left = spark.createDataFrame([(1, None, 1), (None, START, 2), (1, START, 3)], "key int, at timestamp, id int")
    right = spark.createDataFrame([(1, START + timedelta(hours=30), 9)], "key int, seen timestamp, code int")
    got = rows(as_of(left, right, ["key"], "at", "seen", ["code"]), "id", "code")
    assert got == [(1, None), (2, None), (3, 9)]


def test_hot_key_is_split(df):
    """No window of the operators is partitioned by the key alone over the rows."""
    plan = running_position(df, ["key"], ["at", "id"], time_bucket("at"), "pos")
    text = plan._jdf.queryExecution().executedPlan().toString()
    row_windows = [x for x in text.splitlines() if "row_number" in x and "Window" in x]
    assert row_windows and all("_cell" in x for x in row_windows)


def test_rows_are_moved_once(spark, df):
    """One exchange of the rows each: window and join use the same partitioning, null keys too."""
    right = df.select("key", F.col("at").alias("seen"), F.col("id").alias("code"))
    made = {
        "running": running_position(df, ["key"], ["at", "id"], time_bucket("at"), "out"),
        "next": next_row(df, ["key"], ["at", "id"], time_bucket("at"), ["id"], "out"),
        "as_of": as_of(df, right, ["key"], "at", "seen", ["code"]),
        "min_after": min_after(df, right, ["key"], "at", "seen", "code", "out"),
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, frame in made.items():
            plan = frame._jdf.queryExecution().executedPlan().toString()
            exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
            # rows by cell; cells by cell, by key, and by cell again
            assert len(exchanges) == 4, (name, plan)
            assert "isnull(key" not in plan and "coalesce(key" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_global_row_number(spark):
    words = [f"{c}{d}x" for c in "ba" for d in range(20)]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: r.n for r in global_row_number(df, "word", "n").collect()}
    by_hash = sorted(words, key=lambda w: (hashlib.md5(w.encode()).hexdigest()[:3], w))
    assert got == {w: i + 1 for i, w in enumerate(by_hash)}
    plan = global_row_number(df, "word", "n")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_min_after_equals_brute_force(spark, df):
    right_rows = events(3, 120)
    right = spark.createDataFrame(right_rows, "key int, seen timestamp, code int")
    got = min_after(df, right, ["key"], "at", "seen", "code", "least")
    want = [
        (i, min((c for k, s, c in right_rows if k == key and s > at), default=None))
        for key, at, i in events(1, 400)
    ]
    order = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows(got, "id", "least") == sorted(want, key=order)


def crowded(seed: int, n: int):
    """One key has 90 % of all rows in one minute, half of them at one and the same time; nulls too."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if i % 10 == 0:
            at = None if i % 100 == 0 else START + timedelta(seconds=rng.randrange(0, 90000))
            out.append((None if i % 50 == 0 else rng.randrange(1, 8), at, i))
        else:
            out.append((0, START + timedelta(seconds=30, microseconds=rng.randrange(10**6) if i % 2 else 0), i))
    return out


@pytest.fixture(scope="module")
def crowd(spark):
    return spark.createDataFrame(crowded(4, 3000), "key int, at timestamp, id int").cache()


def test_ranges_have_equal_depth(crowd):
    """90 % of the rows in one minute of one key: no range has twice the median."""
    bucket = equal_depth(crowd, ["at", "id"], 16)
    sizes = sorted(r["n"] for r in crowd.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect())
    assert len(sizes) >= 14 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    ordered = crowd.select("at", "id", bucket.alias("b")).orderBy("at", "id").collect()
    assert [r["b"] for r in ordered] == sorted(r["b"] for r in ordered)


def test_buckets_are_hours_unless_crowded(crowd):
    hours = crowd.select(balanced_bucket(crowd, ["key"], ["at", "id"]).alias("b")).distinct().count()
    assert hours == crowd.select(time_bucket("at")).distinct().count()
    cut = crowd.select(balanced_bucket(crowd, ["key"], ["at", "id"], depth=100).alias("b"))
    assert cut.groupBy("b").count().agg(F.max("count")).first()[0] < 300
    assert crowd.limit(0).select(balanced_bucket(crowd.limit(0), ["key"], ["at"])).count() == 0
    assert crowd.limit(0).select(equal_depth(crowd.limit(0), ["at"])).count() == 0


@pytest.mark.parametrize("dense", [False, True])
def test_positions_by_depth(crowd, dense):
    order = ["at"] if dense else ["at", "id"]
    bucket = balanced_bucket(crowd, ["key"], order, depth=100)
    got = running_position(crowd, ["key"], order, bucket, "pos", dense)
    w = Window.partitionBy("key").orderBy(*order)
    want = crowd.withColumn("pos", (F.dense_rank() if dense else F.row_number()).over(w))
    assert rows(got, "id", "pos") == rows(want, "id", "pos")


def test_next_row_by_depth(crowd):
    bucket = balanced_bucket(crowd, ["key"], ["at", "id"], depth=100)
    got = next_row(crowd, ["key"], ["at", "id"], bucket, ["id"], "next")
    want = crowd.withColumn("n", F.lead("id").over(Window.partitionBy("key").orderBy("at", "id")))
    assert rows(got.select("id", F.col("next")["id"].alias("n"))) == rows(want, "id", "n")


@pytest.mark.parametrize("direction", ["next", "prev"])
def test_as_of_by_depth(spark, crowd, direction):
    right_rows = crowded(5, 600)
    right = spark.createDataFrame(right_rows, "key int, seen timestamp, code int")
    got = as_of(crowd, right, ["key"], "at", "seen", ["code"], direction, depth=100)
    want = as_of(crowd, right, ["key"], "at", "seen", ["code"], direction)
    assert rows(got, "id", "seen", "code") == rows(want, "id", "seen", "code")
    ids = {}
    for key, at, i in crowded(4, 3000):
        if at is None or key is None:
            continue
        ok = [(s, c) for k, s, c in right_rows if k == key and s and (s > at if direction == "next" else s < at)]
        ids[i] = (min if direction == "next" else max)(ok, default=(None, None))
    assert all((r["seen"], r["code"]) == ids.get(r["id"], (None, None)) for r in got.collect())


def test_min_after_by_depth(spark, crowd):
    right = spark.createDataFrame(crowded(6, 600), "key int, seen timestamp, code int")
    got = min_after(crowd, right, ["key"], "at", "seen", "code", "least", depth=100)
    want = min_after(crowd, right, ["key"], "at", "seen", "code", "least")
    assert rows(got, "id", "least") == rows(want, "id", "least")
