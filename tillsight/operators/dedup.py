"""Deduplication with a deterministic survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of every key in ``order``.

    ``row_number() = 1`` plans a group limit in front of the shuffle, so each map task
    sends at most one row per key and a hot key does not pile up in one reducer.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, k: int, rank: str) -> DataFrame:
    """The first ``k`` rows of every key with their position in ``rank``."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, position).where(F.col(rank) <= k)


def dedup_by_key(df: DataFrame, keys: Sequence[str], prefer: Sequence = ()) -> DataFrame:
    """Keep one row per key. Ties are settled by all remaining columns, so the result
    does not depend on row order or on which executor ran."""
    rest = [c for c in df.columns if c not in set(keys)]
    order = [*prefer, *rest] or list(keys)
    return first_per_key(df, keys, order)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))
