"""Rule results that later rules read. As in a daily run they are written once and read
back, so a query over them neither repeats the earlier rules nor carries their lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillsight.plans.daily import RULE_STEPS
from tillsight.sources.testdata import TestTables

BUILD = dict(RULE_STEPS)

#: earlier results a step reads
NEEDS = {
    "classification": ("lineitemderived",),
    "booked": ("lineitemderived", "classification"),
    "void_followup": ("booked",),
    "empties": ("lineitemderived", "classification"),
}


def with_stages(t: TestTables, *names: str) -> TestTables:
    for name in names:
        t[name] = stage(t, name)
    return t


def stage(t: TestTables, name: str) -> DataFrame:
    return t.keep(name, lambda: BUILD[name](with_stages(t, *NEEDS.get(name, ()))))
