from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillsight.plans.ingest import BUILDERS
from tillsight.plans.daily import PARTITION_COLUMNS, RULE_STEPS
from tillsight.sources import readers, writers
from tillsight.sources.session import scratch_path, shared_folder
from tillsight.sources.testdata import TestTables
from tillsight.sources.widedata import wide_table
from tillsight.streaming.batches import batch_by_store, ingest_steps, run_batch, stream_batches
from workload.rules import class_texts


def test_scratch_lies_in_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_latest_snapshot_ignores_unfinished_batches(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(10).selectExpr("id % 3 as RetailStoreID", "id")
    writers.write_snapshot(df, root, "t", 5)
    writers.write_snapshot(df.where("id < 4"), root, "t", 12)
    for batch in (5, 12):
        writers.finish_batch(spark, root, batch)
    df.write.parquet(f"{root}/t/99")
    assert readers.snapshot_batches(spark, root, "t") == [5, 12]
    assert readers.latest_snapshot(spark, root, "t").count() == 4
    with pytest.raises(FileNotFoundError):
        readers.latest_snapshot(spark, root, "missing")


def test_snapshot_spreads_a_hot_store(spark, tmp_path):
    df = spark.range(0, 4000, 1, 40).selectExpr("1L as RetailStoreID", "id", "id * 7 as b")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        path = writers.write_snapshot(df, str(tmp_path), "t", 1)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = list((tmp_path / "t" / "1" / "RetailStoreID=1").glob("*.parquet"))
    assert len(files) > 8  # a store is written by as many tasks as its bytes need
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == sum(range(4000))
    limited = writers.write_snapshot(df, str(tmp_path), "t", 2, rows_per_file=500)
    assert len(list((tmp_path / "t" / "2" / "RetailStoreID=1").glob("*.parquet"))) >= 8
    assert spark.read.parquet(limited).count() == 4000


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a;b\n1;2;3\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        readers.read_csv_strict(spark, str(tmp_path / "bad.csv"), ["a", "b"]).collect()


def test_tab_lookup_with_missing_field(spark, tmp_path):
    (tmp_path / "l.txt").write_text("A\tone\teins\nB\ttwo\n")
    got = readers.read_tab_lookup(spark, str(tmp_path / "l.txt"), ["id", "en", "gr"])
    assert rows(got) == [("A", "one", "eins"), ("B", "two", None)]


def test_batches_hold_at_most_n_stores(spark):
    df = spark.createDataFrame([(s,) for s in (7, 3, 3, 900, 2500, 11)], "RetailStoreID bigint")
    got = rows(batch_by_store(df, 2).distinct(), "RetailStoreID", "batch")
    assert sorted(got) == [(3, 1), (7, 1), (11, 2), (900, 2), (2500, 3)]


def test_failed_step_ends_its_batch_only(spark, tmp_path):
    tables = {"t": spark.range(3).withColumnRenamed("id", "RetailStoreID").withColumn("x", F.lit(1))}

    def broken(known):
        return known["first"].select(F.raise_error(F.lit("boom")).alias("x"), "RetailStoreID")

    steps = [("first", lambda k: k["t"]), ("second", broken), ("third", lambda k: k["t"])]
    status = run_batch(tables, 1, str(tmp_path), steps)
    assert not status.ok and status.written == ["first"] and "second" in status.error
    assert readers.snapshot_batches(spark, str(tmp_path), "second") == []
    assert run_batch(tables, 2, str(tmp_path), steps[:1]).ok


def test_failed_batch_is_not_read(spark, tmp_path):
    """After a failure in its second step no table is read from the failed batch."""
    root, now = str(tmp_path), {"v": 1}

    def step(known):
        return known["t"].withColumn("v", F.lit(now["v"]))

    def sometimes(known):
        return step(known) if now["v"] != 2 else known["t"].select("RetailStoreID", F.raise_error(F.lit("boom")).alias("v"))

    tables = {"t": spark.range(3).withColumnRenamed("id", "RetailStoreID")}
    steps = [("a", step), ("b", sometimes), ("c", step)]
    for batch in (1, 2):
        now["v"] = batch
        assert run_batch(tables, batch, root, steps).ok == (batch == 1)
    for table in "abc":
        assert {r.v for r in readers.latest_snapshot(spark, root, table).collect()} == {1}
    now["v"] = 3
    assert run_batch(tables, 3, root, steps).ok
    for table in "abc":
        assert {r.v for r in readers.latest_snapshot(spark, root, table).collect()} == {3}


def test_failed_micro_batch_is_processed_again(spark, tmp_path):
    source, root, marks = (str(tmp_path / x) for x in ("in", "out", "marks"))
    spark.range(5).selectExpr("id as RetailStoreID", "id * 2 as x").write.parquet(source)
    seen, broken = [], [True]

    def step(known):
        if broken:
            raise ValueError("not yet")
        return known["transactions"]

    def run():
        stream_batches(spark, source, root, marks, [("t", step)], seen.append).awaitTermination()

    with pytest.raises(Exception, match="not yet"):
        run()
    assert readers.snapshot_batches(spark, root, "t") == []
    broken.clear()
    run()
    assert [s.ok for s in seen] == [False, True] and seen[0].batch_id == seen[1].batch_id
    assert readers.latest_snapshot(spark, root, "t").count() == 5


def test_stream_consumes_each_file_once(spark, sf_dir, tmp_path):
    source, root, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    wide = wide_table(TestTables(spark, sf_dir), "lineitem")
    seen = []

    def run():
        stream_batches(spark, source, root, marks, ingest_steps(["lineitem"]), seen.append).awaitTermination()

    wide.where("cast(SequenceNumber as bigint) % 2 = 0").write.parquet(source)
    run()
    run()
    wide.where("cast(SequenceNumber as bigint) % 2 = 1").write.mode("append").parquet(source)
    run()
    assert all(s.ok for s in seen) and len(seen) >= 2
    written = [readers.read_transactions(spark, f"{root}/lineitem/{s.batch_id}") for s in seen]
    keys = written[0].select("SequenceNumber", "LineItemSequenceNumber")
    for part in written[1:]:
        keys = keys.unionByName(part.select("SequenceNumber", "LineItemSequenceNumber"))
    assert keys.count() == keys.distinct().count()
    whole = BUILDERS["lineitem"](wide)
    assert keys.count() == whole.count() > 0


def test_daily_rule_run(spark, sf_dir, tmp_path):
    t = TestTables(spark, sf_dir)
    names = (
        "header retailheader lineitem sale return tender loyalty addon modifier stores control functionlog "
        "pickup deposit loan tillsettle safesettle articles hierarchy headeraddon"
    ).split()
    tables = {n: t[n] for n in names} | {"class_texts": class_texts(t)}
    status = run_batch(tables, 1704067200, str(tmp_path), RULE_STEPS, PARTITION_COLUMNS)
    assert status.error is None
    assert status.written == [n for n, _ in RULE_STEPS]
    classes = readers.latest_snapshot(spark, str(tmp_path), "classification")
    assert classes.count() == t["header"].count()


def test_steps_of_a_batch_run_side_by_side(spark, tmp_path):
    """Steps that do not read each other are written at the same time, one that reads another waits
    for it; a failure names the step it began in and leaves nothing of a batch that is placed."""
    together = threading.Barrier(2, timeout=60)
    tables = {"t": spark.range(4).selectExpr("id as RetailStoreID", "id * 2 as v")}

    def meets(known):
        together.wait()
        return known["t"]

    steps = [("a", meets), ("b", meets), ("c", lambda k: k["a"].join(k["b"], ["RetailStoreID", "v"]))]
    status = run_batch(tables, 1, str(tmp_path), steps, at_once=2)
    assert status.error is None and status.written == ["a", "b", "c"]
    assert readers.latest_snapshot(spark, str(tmp_path), "c").count() == 4

    def broken(known):
        return known["t"].withColumn("x", F.raise_error(F.lit("boom")).cast("int"))

    place = lambda name, batch: f"{tmp_path}/placed/{name}/{batch}"
    steps = [("a", broken), ("b", lambda k: k["a"]), ("c", lambda k: k["t"]), ("d", lambda k: k["b"])]
    status = run_batch(tables, 2, str(tmp_path), steps, place=place, at_once=4)
    assert status.error.startswith("a: ") and "boom" in status.error and "a" not in status.written
    assert not list((tmp_path / "placed").rglob("*.parquet"))
    assert run_batch(tables, 3, str(tmp_path), [("x", lambda k: k["y"]), ("y", lambda k: k["t"])], at_once=2).error.startswith("x: ")


def test_shuffle_files_go_with_their_execution(spark, tmp_path):
    """What a write has shuffled is removed when it ends; a frame can still be read again."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        files = blocks.getAllFiles().iterator()
        return {f for f in iter(lambda: files.next().getName() if files.hasNext() else "", "") if f.startswith("shuffle_")}

    before = shuffled()
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    df.write.parquet(f"{tmp_path}/counts")
    until = time.monotonic() + 20
    while (left := shuffled() - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert sorted(df.collect()) == sorted(df.collect()) == sorted(spark.read.parquet(f"{tmp_path}/counts").collect())
