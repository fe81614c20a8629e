"""Sinks: partitioned snapshots, staging tables, single-file reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.sources.readers import BATCHES

#: rows of one file at most; a big store has as many files as that takes
ROWS_PER_FILE = 5_000_000


def write_snapshot(
    df: DataFrame,
    root: str,
    table: str,
    batch_id: int,
    partition_by: str = "RetailStoreID",
    rows_per_file: int = ROWS_PER_FILE,
    path: str | None = None,
) -> str:
    """Write ``<root>/<table>/<batch_id>``, or ``path``, partitioned by store.

    Rows are brought together by store, and adaptive execution splits stores that exceed the
    advisory partition size in bytes and merges small ones: a store of any size is written by
    as many tasks as its bytes need.
    """
    path = path or f"{root}/{table}/{batch_id}"
    (
        df.hint("rebalance", F.col(partition_by))
        .write.partitionBy(partition_by)
        .option("maxRecordsPerFile", rows_per_file)
        .mode("overwrite")
        .parquet(path)
    )
    return path


def finish_batch(spark: SparkSession, root: str, batch_id: int) -> None:
    """Mark a batch as finished; from now on readers see its tables. Creating the empty file
    is one step, so readers see all of them or none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{BATCHES}/{batch_id}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()


def write_table(df: DataFrame, root: str, table: str) -> str:
    """Overwrite an unpartitioned table (master data, lookups, staging results)."""
    path = f"{root}/{table}"
    df.write.mode("overwrite").parquet(path)
    return path


def append_register(df: DataFrame, root: str, table: str) -> str:
    path = f"{root}/{table}"
    df.write.mode("append").parquet(path)
    return path


def write_csv_report(df: DataFrame, path: str, order: Sequence) -> str:
    """One ordered CSV file with a header, for reports of a few rows per day."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
