"""All registered queries."""

from __future__ import annotations

from oracle.model import with_model
from oracle.rules import VIEWS, sql
from oracle.typed import with_plain_types
from workload import control, ingest, operators, publish, rules, storage  # noqa: F401
from workload.registry import ENTRIES, runnable


def all_queries():
    return {name: runnable(entry) for name, entry in ENTRIES.items()}


def all_sql() -> dict[str, str]:
    raw = {
        name: with_model(sql(entry.sql), VIEWS)
        for name, entry in ENTRIES.items()
        if entry.sql is not None
    }
    return with_plain_types(raw)
