"""Helpers shared by the operators: scratch tables, text normalisation, row keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return
SPACE = r"\x20\x09-\x0D"


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir`` of the session, or
    one below the warehouse where that is unset (as in tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, and a lost
    executor costs only the tasks it was running."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_az(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(*columns: Column) -> Column:
    """Key of a row by the content of ``columns``, defined for nulls. Rows with equal
    content share it, and what is computed from that content alone is equal for them."""
    flags = F.concat(*[F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns])
    return F.md5(F.concat_ws("\x00", flags, *[c.cast("string") for c in columns]))


def quoted(name: str) -> Column:
    """Column by its name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def number_of(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """All rows of ``df`` if there are ``bound`` or fewer, else about ``bound`` of them, chosen by
    a hash of ``key`` alone, so the choice is the same in every run. The share is set from a
    count first; no task sorts its rows."""
    n = df.count()
    if n <= bound:
        return df
    share = int(bound / n * (1 << 31))
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 31)) < share)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``row``, so that helper columns beside it cannot
    clash with them; ``select("row.*")`` brings them back."""
    return F.struct(*[quoted(c) for c in df.columns]).alias("row")


def content_order(row: Column) -> Column:
    """Key that orders rows (a struct) by all they hold, columns that have no order included, such
    as maps. Only rows with the same content share it."""
    return F.md5(F.to_json(row, {"ignoreNullFields": "false"}))


#: a key with more than this part of the rows is joined without being dealt; there are fewer such keys
HOT = 1000


def hot_join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` joined by ``key``, a number, to ``table``, which has one row for each key. Keys that
    have more than a thousandth of all rows, of which there are fewer than a thousand, meet
    their row of ``table`` by broadcast, so their rows stay where they are; the others are dealt
    by the key. ``rows`` is read three times and should be in store."""
    total = rows.count()
    sizes = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") * HOT > total)
    hot = F.col(key).isin([r[0] for r in sizes.select(key).collect()])
    here = rows.where(hot).join(F.broadcast(table.where(hot)), key)
    return here.unionByName(rows.where(~hot).join(table.where(~hot), key))


def spread(df: DataFrame, column: str) -> DataFrame:
    """``df`` dealt by ``column`` to as many partitions as the session shuffles to, which
    adaptive execution leaves as they are: for few rows that are about to become many."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), column)
