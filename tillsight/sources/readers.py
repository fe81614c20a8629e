"""Sources: columnar tables, snapshots, semicolon CSV, tab-separated text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_transactions(spark: SparkSession, path: str, file_type: str = "parquet") -> DataFrame:
    """Wide transaction table in any columnar format Spark knows."""
    return spark.read.format(file_type).load(path)


def read_csv_strict(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Semicolon CSV with a header, all columns text; a malformed row fails the read."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, header=True, sep=";", mode="FAILFAST")


def read_tab_lookup(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Text lines split on tabs; missing trailing fields give null."""
    parts = F.split(F.col("value"), "\t")
    return spark.read.text(path).select(
        *[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)]
    )


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A published table; swap for ``spark.read.jdbc`` where results live in a database."""
    return spark.read.parquet(f"{root}/{table}")


def read_catalog(spark: SparkSession, database: str | None, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}" if database else table)


#: folder below a run's root with an empty file for every batch that ended without a failure
BATCHES = "_batches"


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is missing. Lists one directory, reads no data."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def finished_batches(spark: SparkSession, root: str) -> list[int]:
    """Ids of the batches of which every step succeeded."""
    return sorted(int(n) for n in _names(spark, f"{root}/{BATCHES}") if n.isdigit())


def snapshot_batches(spark: SparkSession, root: str, table: str) -> list[int]:
    """Finished batches that wrote the table. What a failed or running batch has written so
    far is not among them, so all tables are read from the same last good batch."""
    written = {int(n) for n in _names(spark, f"{root}/{table}") if n.isdigit()}
    return [b for b in finished_batches(spark, root) if b in written]


def latest_snapshot(
    spark: SparkSession, root: str, table: str, schema: StructType | None = None
) -> DataFrame:
    """A snapshot table as of the newest finished batch. Give the schema where the batch may
    be empty or the type of the partition column matters."""
    batches = snapshot_batches(spark, root, table)
    if not batches:
        raise FileNotFoundError(f"{root}/{table} holds no finished batch")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{root}/{table}/{batches[-1]}")


def unprocessed_files(candidates: DataFrame, register: DataFrame, name: str = "part_filename") -> DataFrame:
    """Candidate files not yet in the register of consumed files (status 1)."""
    return candidates.join(register.where("status = 1").select(name), name, "left_anti")


def file_register_rows(files: DataFrame, name: str = "part_filename") -> DataFrame:
    return files.select(name).distinct().withColumn("status", F.lit(1))
