"""Line tables stored by bucket, so that they are joined without being moved.

All tables of lines are cut into the same number of buckets by columns that both line keys
share and the block of lines (``classify.BLOCK_SPREAD``), so a receipt with very many lines
spreads over all buckets. A join or an aggregate by either line key then reads bucket by bucket;
only the step to receipts moves rows, and those are partial sums.

Buckets are kept by the catalog: a table is registered where it is written, under a name of its
own for each run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tillsight.plans.classify import BLOCK_SPREAD, in_blocks, item_facts

#: tables with a row or several for each receipt line
LINE_TABLES = ("lineitem", "lineitemderived", "items", "loyalty", "modifier", "addon")


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str] = tuple(BLOCK_SPREAD)) -> DataFrame:
    """``df`` written to ``path`` in ``buckets`` files by ``keys`` and registered as ``name``."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").option("path", path).bucketBy(buckets, *keys).saveAsTable(name)
    return df.sparkSession.table(name)


def bucketed_lines(
    spark: SparkSession, tables: Mapping[str, DataFrame], database: str, root: str, buckets: int
) -> dict[str, DataFrame]:
    """``tables`` with the line tables among them written once by bucket, each as
    ``<database>.<table>``, and ``items``, the item facts of sales and returns. ``buckets`` is
    set by the bytes of the largest table, so that a bucket fits a task: a multiple of the
    cores at least."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    out = dict(tables) | {"items": item_facts(tables["sale"], tables["return"])}
    for name in LINE_TABLES:
        if name in out:
            out[name] = write_bucketed(in_blocks(out[name]), f"`{database}`.`{name}`", f"{root}/{name}", buckets)
    return out
