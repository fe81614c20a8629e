"""Renders the receipt model of the benchmark adapter as common table expressions."""

from __future__ import annotations

import re

from tillsight.sources.testdata import DERIVED, MODELS

RELATION = re.compile(r"\{([a-z]\w*)\}")


def native(expr: str) -> str:
    each = re.sub(r"@each\((\d+)\)", r"unnest(generate_series(1, \1))", expr)
    return each.replace("@ts(", "make_timestamp(")


def quoted(name: str) -> str:
    return f"m_{name}"


def depends_on(name: str) -> list[str]:
    if name in DERIVED:
        return [n for n in RELATION.findall(DERIVED[name]) if n in MODELS or n in DERIVED]
    source = MODELS[name].source
    return [source] if (source in MODELS or source in DERIVED) else []


def body(name: str) -> str:
    if name in DERIVED:
        return RELATION.sub(
            lambda m: m[1][2:] if m[1].startswith("b_") else quoted(m[1]),
            native(DERIVED[name]),
        )
    model = MODELS[name]
    known = model.source in MODELS or model.source in DERIVED
    sql = f"select * from {quoted(model.source) if known else model.source}"
    if model.where:
        sql += f" where {native(model.where)}"
    for layer in model.layers:
        cols = ", ".join(f"{native(e)} as {a}" for a, e in layer.items())
        sql = f"select *, {cols} from ({sql}) q"
    if model.keep:
        sql = f"select {', '.join(model.keep)} from ({sql}) q"
    return sql


def closure(names: list[str]) -> list[str]:
    """The named tables and all they build on, in definition order."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in depends_on(n):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return order


def with_model(sql: str, views: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the model tables (written ``{name}``) and views it refers to.

    ``views`` maps further names to SQL that may itself refer to tables and views.
    """
    views = views or {}
    ctes: list[tuple[str, str]] = []
    done: set[str] = set()

    def expand(text: str) -> str:
        def put(m: re.Match) -> str:
            name = m[1]
            if name in views:
                if name not in done:
                    inner = expand(views[name])
                    done.add(name)
                    ctes.append((f"v_{name}", inner))
                return f"v_{name}"
            if name in MODELS or name in DERIVED:
                for n in closure([name]):
                    if n not in done:
                        done.add(n)
                        ctes.append((quoted(n), body(n)))
                return quoted(name)
            raise KeyError(name)

        return RELATION.sub(put, text)

    final = expand(sql)
    if not ctes:
        return final
    head = ",\n".join(f"{n} as materialized ({s})" for n, s in ctes)
    return f"with {head}\n{final}"
