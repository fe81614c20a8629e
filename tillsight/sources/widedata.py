"""Wide transaction rows derived from the benchmark tables, to feed the table builders.

Every order becomes one wide row, its positions become the line arrays. Leaves without a
meaning of their own take values computed from order, line and entry number by one rule,
so the checking SQL can state the expected flat rows from the same rule.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.plans.ingest import (
    BUILDERS,
    CUSTOMER_ADDRESS,
    KEYS,
    SPECS,
    TOTAL_NAMES,
    TOTAL_VALUES,
    TableSpec,
    item_spec,
    modifier_spec,
    position_addon_spec,
    rebate_spec,
)
from tillsight.sources.testdata import TestTables, for_spark

#: tables whose array entries are receipt positions; the others get ``k % 3`` entries
LINE_TABLES = (
    "lineitem", "loyaltyreward", "return", "sale", "tender", "retailpricemodifier",
    "salereturn_rebate", "receiptpositionaddonlist",
)

KIND = {
    "ControlTransaction__Version": "case when k % 20 = 7 then '1' end",
    "GK_FunctionLog_GK_StoreInfoID": "case when k % 20 = 9 then k end",
    "RetailTransaction__Version": "case when k % 20 not in (7, 8, 9, 10) then '1' end",
    "TenderControlTransaction__Version": "case when k % 20 = 8 then '1' end",
}

#: column -> meaning; everything else follows ``leaf``
MEANING = {
    "LineItemSequenceNumber": "n",
    "PriceModifierSequenceNumber": "m",
    "RetailPriceModifierSequenceNumber": "m",
    "LineItemBeginDateTime": "ReceiptDateTime",
    "TransactionLinkReceiptDateTime": "ReceiptDateTime",
    "FunctionLogStoreInfoID": KIND["GK_FunctionLog_GK_StoreInfoID"],
    "StoreInfoID": KIND["GK_FunctionLog_GK_StoreInfoID"],
    "xmlfilename": "'/in/' || lpad(cast(RetailStoreID as string), 4, '0') || '.t_log.' || "
    "cast(20240101 + blk % 30 as string) || '083000.' || lpad(cast(k % 100000 as string), 5, '0') || '.xml.gz'",
}


def _salt(name: str, side: str) -> int:
    return sum(map(ord, name + side)) % 89


def leaf(name: str, kind: str, table: str, side: str = "", level: int = 0) -> str:
    """Value of a leaf in terms of order ``k``, entry ``n`` and nested entry ``m``."""
    if name == "ItemType":
        here = "= 0" if side == "Return" else "<> 0"
        return f"case when (k + n) % 3 {here} then 'Stock' end"
    if name in MEANING:
        return MEANING[name]
    salt = _salt(name, side)
    v = f"(k * 31 + {'n * 7 + ' if level >= 1 else ''}{'m * 3 + ' if level >= 2 else ''}{salt})"
    if kind == "double":
        value = f"({v} % 41) * 5e-1"
    elif kind == "boolean":
        value = f"{v} % 2 = 0"
    elif kind == "string":
        value = f"'t' || cast({v} % 13 as string)"
    else:
        value = f"{v} % 97"
    return f"case when {v} % 11 <> 0 then {value} end"


#: numbers after which the values of a leaf by the common rule repeat, by type
PERIOD = {"double": 11 * 41, "boolean": 11 * 2, "string": 11 * 13, "long": 11 * 97}


def _period_kind(kind: str) -> str:
    return kind if kind in PERIOD else "long"


def _looked_up(name: str, kind: str, side: str) -> str:
    """Text of the common rule at the place ``i`` that ``_places`` gives. The list is a constant once
    planned, and reading it is cheaper than computing the rule for each entry of each leaf."""
    kind = _period_kind(kind)
    text = {"double": lambda v: str(v % 41 / 2), "boolean": lambda v: str(v % 2 == 0).lower(), "string": lambda v: f"t{v % 13}"}
    numbers = range(_salt(name, side), _salt(name, side) + PERIOD[kind])
    texts = [text.get(kind, lambda v: str(v % 97))(v) if v % 11 else None for v in numbers]
    return f"from_json('{json.dumps(texts, separators=(',', ':'))}', 'array<string>')[i]"


def _places(entries: str) -> dict[str, str]:
    """Place of each entry, and of each nested entry, of the receipts in the texts of a leaf of each
    type; order keys are not negative."""
    out = {f"{entries}_m": f"transform({entries}, n -> {_entries('(k + n) % 3')})"}
    for kind, period in PERIOD.items():
        out[f"{entries}_{kind}"] = f"transform({entries}, n -> cast(pmod(k * 31 + n * 7, {period}) as int))"
        nested = f"transform({_entries('(k + n) % 3')}, m -> cast(pmod(k * 31 + n * 7 + m * 3, {period}) as int))"
        out[f"{entries}_m_{kind}"] = f"transform({entries}, n -> {nested})"
    return out


def parts(name: str) -> list[tuple[TableSpec, str]]:
    """The specifications a builder reads, with the side each one is for."""
    two_sided = {
        "retailpricemodifier": modifier_spec,
        "salereturn_rebate": rebate_spec,
        "receiptpositionaddonlist": position_addon_spec,
    }
    if name in two_sided:
        return [(two_sided[name](s), s) for s in ("Return", "Sale")]
    if name in ("return", "sale"):
        return [(item_spec(name.capitalize()), name.capitalize())]
    return [(SPECS[name], "")]


def _entries(count: str) -> str:
    return f"case when {count} = 0 then cast(array() as array<bigint>) else sequence(cast(1 as bigint), {count}) end"


def _columns(name: str, entries: str) -> dict[str, str]:
    """Wide columns builder ``name`` needs, all leaves as text, and their values; ``entries`` is
    the column with the numbers of a receipt's array entries."""
    out: dict[str, str] = {}
    for spec, side in parts(name):
        for f in spec.scalars:
            out.setdefault(f.path, f"cast({leaf(f.name, f.type, name, side)} as string)")
        for f in spec.arrays:
            kind = _period_kind(f.type)
            if MEANING.get(f.name) == "ReceiptDateTime":
                value = f"transform({entries}, n -> stamp)"
            elif f.name in MEANING or f.name == "ItemType":
                value = f"transform({entries}, n -> cast({leaf(f.name, f.type, name, side, 1)} as string))"
            else:
                value = f"transform({entries}_{kind}, i -> {_looked_up(f.name, kind, side)})"
            out.setdefault(f.path, value)
        for f in spec.nested:
            kind = _period_kind(f.type)
            if MEANING.get(f.name) == "m":
                value = f"transform({entries}_m, e -> transform(e, m -> cast(m as string)))"
            else:
                value = f"transform({entries}_m_{kind}, e -> transform(e, i -> {_looked_up(f.name, kind, side)}))"
            out.setdefault(f.path, value)
    if name == "customer":
        out[CUSTOMER_ADDRESS] = f"transform({_entries('k % 4')}, a -> 'street ' || cast((k + a) % 5 as string))"
    if name == "retailtransactionheader":
        out[TOTAL_NAMES] = (
            "array('TransactionGrandAmount', case when k % 2 = 0 then 'TransactionTaxAmount' else 'a' end, "
            "case when k % 5 = 0 then 'GK:NegativeTransactionTaxAmount' else 'b' end, "
            "case when k % 7 = 0 then 'TransactionGrandAmount' else 'c' end)"
        )
        out[TOTAL_VALUES] = "transform(array(1, 2, 3, 4), i -> cast((k % 100) * i * 5e-1 as string))"
    return out


def _wide(t: TestTables, names: tuple[str, ...]) -> DataFrame:
    # building nested text costs far more than moving the receipts, so both sides are moved once, to
    # several tasks a core: a join that deals them itself has its partitions merged to one a core
    spread = max(4 * t.spark.sparkContext.defaultParallelism, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    receipts = t["receipt"].repartition(spread, "k")
    if any(n in LINE_TABLES for n in names):
        lines = t["position"].select("k", "n").repartition(spread, "k")
        lines = lines.groupBy("k").agg(F.sort_array(F.collect_list("n")).alias("ns"))
        receipts = receipts.join(lines, "k", "left")
    receipts = receipts.selectExpr("*", _entries("k % 3") + " as ks", "cast(ReceiptDateTime as string) as stamp")
    places = _places("ks")
    if "ns" in receipts.columns:
        places |= _places("ns")
    receipts = receipts.selectExpr("*", *[f"{for_spark(e)} as {c}" for c, e in places.items()])
    out = {f.path: f"cast({f.name} as string)" for f in KEYS} | {p: f"cast({e} as string)" for p, e in KIND.items()}
    for name in names:
        out = _columns(name, "ns" if name in LINE_TABLES else "ks") | out
    return receipts.selectExpr(*[f"{for_spark(e)} as `{p}`" for p, e in out.items()])


def wide_table(t: TestTables, name: str) -> DataFrame:
    """Wide rows with the columns builder ``name`` needs, all leaves as text."""
    return _wide(t, (name,))


def wide_transactions(t: TestTables) -> DataFrame:
    """Wide rows with the columns of all builders."""
    return _wide(t, tuple(BUILDERS))


def stored_wide_table(t: TestTables, name: str) -> DataFrame:
    """The wide rows as a source file, written once per session and directory."""
    return t.keep(f"wide_{name}", lambda: wide_table(t, name))
