"""Flattening of parallel arrays.

A repeated element arrives as one array per leaf; entries with the same position
belong together. ``arrays_zip`` pads the shorter arrays with nulls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zip_explode(
    df: DataFrame,
    arrays: Sequence[str],
    keep: Sequence[str | Column],
    outer: bool = False,
) -> DataFrame:
    """One row per array position. With ``outer`` a row whose arrays are all null or
    empty survives with null leaves, otherwise it vanishes."""
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    generator = F.inline_outer(zipped) if outer else F.inline(zipped)
    return df.select(*keep, generator.alias(*arrays))


def zip_explode_nested(
    df: DataFrame,
    outer_arrays: Sequence[str],
    inner_arrays: Sequence[str],
    keep: Sequence[str | Column],
    inner_outer: bool = False,
) -> DataFrame:
    """Two levels: positions of ``outer_arrays`` first, then the arrays that each
    position of ``inner_arrays`` holds. Leaves that only exist at the first level are
    repeated on every second-level row."""
    first = zip_explode(df, outer_arrays, keep)
    scalars = [c for c in first.columns if c not in set(inner_arrays)]
    return zip_explode(first, inner_arrays, scalars, outer=inner_outer)


def named_totals(df: DataFrame, names: str, values: str, picks: dict[str, str]) -> DataFrame:
    """Pick named amounts out of a pair of name / value arrays; absent names give null.

    ``picks`` maps the wanted column to the name it has in the array. A name that
    occurs twice takes its last value, independent of session settings: the entry is
    found by filtering instead of building a map, which would reject duplicates.
    """
    pairs = F.arrays_zip(F.col(names).alias("name"), F.col(values).alias("value"))

    def last_value(wanted: str) -> Column:
        hits = F.filter(pairs, lambda pair: pair["name"] == F.lit(wanted))
        return F.try_element_at(hits, F.lit(-1))["value"]

    return df.withColumns({out: last_value(name) for out, name in picks.items()})


def join_lines(df: DataFrame, lines: str, out: str, separator: str = ",") -> DataFrame:
    return df.withColumn(out, F.concat_ws(separator, F.col(lines)))
