"""Join shapes that recur in the receipt audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, keys: Sequence[str], marker: str) -> DataFrame:
    """Distinct keys with a true marker: left join it to ask whether a child exists
    without multiplying the parent rows."""
    return df.select(*keys).distinct().withColumn(marker, F.lit(True))


def with_presence(df: DataFrame, child: DataFrame, keys: Sequence[str], marker: str) -> DataFrame:
    return df.join(present(child, keys, marker), list(keys), "left").withColumn(
        marker, F.coalesce(F.col(marker), F.lit(False))
    )


def anti_by_null(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` without a partner in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def lookup_chain(
    df: DataFrame, attempts: Sequence[tuple[Column | str, DataFrame, str, str]], out: str
) -> DataFrame:
    """Try one lookup after the other and keep the first hit.

    Each attempt is ``(key of df, table, key of table, value of table)``; the table
    must hold one row per key.
    """
    hits = []
    for i, (key, table, table_key, value) in enumerate(attempts):
        side = table.select(
            F.col(table_key).alias(f"_key{i}"), F.col(value).alias(f"_hit{i}")
        )
        own = F.col(key) if isinstance(key, str) else key
        df = df.join(side, own == F.col(f"_key{i}"), "left").drop(f"_key{i}")
        hits.append(f"_hit{i}")
    return df.withColumn(out, F.coalesce(*hits)).drop(*hits)


def linked_lines(lines: DataFrame, receipt: Sequence[str], line: str, link: str, where: Column) -> DataFrame:
    """Keys of the lines that some other qualifying line of the receipt points to."""
    return (
        lines.where(where & F.col(link).isNotNull())
        .select(*receipt, F.col(link).alias(line))
        .distinct()
    )


def pivot_values(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: str,
    columns: dict[str, str],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows that carry *every* one of the named values, one column per name.

    ``columns`` maps a name in the data to its output column; ``carry`` columns are
    taken from the rows of the first name. A name that occurs several times for one key
    yields every combination; rows with a null among the keys go. The rows are read and
    shuffled once: the distinct values of each name are gathered per key, which is as few
    as one line has, and then spread out.
    """
    first = next(iter(columns))

    def values(n: str, alias: str):
        parts = [F.col(value).alias(alias), *(carry if n == first else ())]
        return F.collect_set(F.when(F.col(name) == n, F.struct(*parts))).alias(f"_{alias}")

    wide = df.where(F.col(name).isin(*columns)).dropna(subset=list(keys)).groupBy(*keys)
    out = wide.agg(*[values(n, alias) for n, alias in columns.items()])
    for alias in columns.values():
        out = out.withColumn(f"_{alias}", F.explode(f"_{alias}"))
    picked = [F.col(f"_{alias}")[alias].alias(alias) for alias in columns.values()]
    carried = [F.col(f"_{columns[first]}")[c].alias(c) for c in carry]
    return out.select(*keys, *carried, *picked)
