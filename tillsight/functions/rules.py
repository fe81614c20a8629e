"""Ordered rule lists: the first rule whose condition holds gives the value."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    value: str | Column
    condition: Column


def first_match(rules: Iterable[Rule], default=None) -> Column:
    """Compile an ordered list into one searched CASE, null conditions not matching."""
    out = None
    for rule in rules:
        value = rule.value if isinstance(rule.value, Column) else F.lit(rule.value)
        out = F.when(rule.condition, value) if out is None else out.when(rule.condition, value)
    if out is None:
        return F.lit(default)
    return out if default is None else out.otherwise(F.lit(default))
