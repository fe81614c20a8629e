"""Registry of queries: a builder over the receipt model and the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.scalars import iso_timestamp
from tillsight.sources.session import configure
from tillsight.sources.testdata import TestTables


class Entry(NamedTuple):
    build: Callable[[TestTables], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a builder; ``sql`` names model tables and views in braces."""

    def add(build: Callable[[TestTables], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(build, sql)
        return build

    return add


def presented(df: DataFrame) -> DataFrame:
    """Plain column types for the comparison: timestamps and dates as ISO text, whole
    numbers as bigint, decimals as double."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType):
            c = iso_timestamp(c)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ByteType | T.ShortType | T.IntegerType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DecimalType | T.FloatType):
            c = c.cast("double")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def runnable(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return presented(entry.build(TestTables(spark, str(sf_dir))))

    return run
