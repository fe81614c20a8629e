"""Expected flat rows of the table builders, stated without arrays."""

from __future__ import annotations

from typing import NamedTuple

from oracle.model import with_model
from tillsight.sources.widedata import KIND, LINE_TABLES, leaf, parts

KEY_COLUMNS = "RetailStoreID WorkstationID SequenceNumber ReceiptDateTime ReceiptNumber".split()
LINE_COLUMNS = [*KEY_COLUMNS, "LineItemSequenceNumber"]
ALL = "all columns"


class Rules(NamedTuple):
    """What a table keeps: the column that must be present in the source, rows of one key or
    of one content, columns that must not be null (checked after the deduplication if ``late``),
    and whether entries without a list (``keep``) or without a nested list are kept as nulls."""

    marker: str | None = None
    required: tuple[str, ...] = ()
    one: object = None
    late: bool = False
    keep: bool = False
    keep_nested: bool = False


#: Fixed values, stated here and not taken from the builders, so that neither can drift alone
RULES = {
    "transactionheader": Rules(),
    "controltransaction": Rules(marker="ControlTransaction__Version", one=KEY_COLUMNS),
    "functionlog": Rules(required=("StoreInfoID",), one=ALL),
    "lineitem": Rules(one=LINE_COLUMNS),
    "loyaltyreward": Rules(required=("PointsAwarded",), one=LINE_COLUMNS, late=True),
    "receiptheaderaddonlist": Rules(one=ALL),
    "receiptpositionaddonlist": Rules(),
    "customer": Rules(one=KEY_COLUMNS, keep=True),
    "retailpricemodifier": Rules(required=("PriceModifierSequenceNumber",)),
    "return": Rules(required=("ItemType",), one=LINE_COLUMNS, keep_nested=True),
    "sale": Rules(required=("ItemType",), one=LINE_COLUMNS, keep_nested=True),
    "retailtransactionheader": Rules(
        marker="RetailTransaction__Version", required=("RetailTransactionReceiptDateTime",), one=KEY_COLUMNS
    ),
    "tender": Rules(required=("TenderID",), one=LINE_COLUMNS, keep_nested=True),
    "tendercontrolloan": Rules(
        required=("TenderLoanType", "TenderLoanTotalAmount", "TenderLoanTotalCurrency"), one=KEY_COLUMNS
    ),
    "tendercontrolpickup": Rules(one=ALL),
    "tendercontrolsafesettle": Rules(
        required=(
            "TenderOpenBalanceTotalAmount", "TenderCloseBalanceTotalAmount", "TenderLoanTotalAmount",
            "TotalTenderLoanCount", "TenderPickupTotalAmount", "TotalTenderPickupCount",
            "TenderDepositTotalAmount", "TenderReceiptTotalAmount",
        ),
        one=KEY_COLUMNS,
        late=True,
    ),
    "tendercontroltillsettle": Rules(required=("TransactionCount",), one=ALL, keep=True),
    "tendercontrolpaymentdeposit": Rules(marker="TenderControlTransaction__Version", one=KEY_COLUMNS, keep=True),
    "salereturn_rebate": Rules(),
}


def _rows(spec, name: str, where: str = "true") -> str:
    rules = RULES[name]
    src = "{receipt}"
    columns = ["r.*"]
    if spec.arrays:
        if name in LINE_TABLES:
            src += " r join (select distinct k as pk_, n from {position}) p on r.k = p.pk_"
        else:
            src += " r"
            empty = "[cast(null as bigint)]" if rules.keep else "cast([] as bigint[])"
            columns.append(f"unnest(case when k % 3 = 0 then {empty} else range(1, k % 3 + 1) end) as n")
    else:
        src += " r"
    sql = f"select {', '.join(columns)}{', n' if name in LINE_TABLES else ''} from {src} where {where}"
    if spec.nested:
        empty = "[cast(null as bigint)]" if rules.keep_nested else "cast([] as bigint[])"
        sql = (
            f"select *, unnest(case when (k + n) % 3 = 0 then {empty} else range(1, (k + n) % 3 + 1) end) as m "
            f"from ({sql}) q"
        )
    return sql


def _typed(expr: str, kind: str) -> str:
    native = {"long": "bigint", "timestamp": "timestamp", "string": "varchar"}.get(kind, kind)
    return f"cast({expr} as {native})"


def flat(name: str, spec, side: str, extra: dict[str, str] | None = None) -> tuple[str, list[str]]:
    marker = RULES[name].marker
    where = f"({KIND[marker]}) is not null" if marker else "true"
    cols = {c: c for c in KEY_COLUMNS}
    for level, group in enumerate((spec.scalars, spec.arrays, spec.nested)):
        for f in group:
            cols[f.name] = _typed(leaf(f.name, f.type, name, side, level), f.type)
        if level == 0:
            cols.update(extra or {})
    body = ", ".join(f"{e} as {c}" for c, e in cols.items())
    return f"select {body} from ({_rows(spec, name, where)}) q", list(cols)


def first_row(sql: str, keys: list[str], columns: list[str]) -> str:
    rest = [c for c in columns if c not in keys]
    order = ", ".join(f"{c} nulls first" for c in rest) or "1"
    return (
        f"select {', '.join(columns)} from (select *, row_number() over (partition by {', '.join(keys)} "
        f"order by {order}) as rn_ from ({sql}) q) q where rn_ = 1"
    )


def needed(sql: str, columns) -> str:
    return f"select * from ({sql}) q where " + " and ".join(f"{c} is not null" for c in columns)


def finish(sql: str, columns: list[str], name: str, day: bool = True) -> str:
    rules = RULES[name]
    if rules.required and not rules.late:
        sql = needed(sql, rules.required)
    if rules.one == ALL:
        sql = f"select distinct * from ({sql}) q"
    elif rules.one:
        sql = first_row(sql, list(rules.one), columns)
    if rules.required and rules.late:
        sql = needed(sql, rules.required)
    return f"select *, cast(ReceiptDateTime as date) as Date from ({sql}) q" if day else sql


def expected(name: str) -> str:
    """SQL for the table ``name``, model tables still in braces."""
    pieces = parts(name)
    spec, side = pieces[0]
    if name == "transactionheader":
        kind = (
            "case when k % 20 = 7 then 'ControlTransaction' when k % 20 = 9 then 'FunctionLog' "
            "when k % 20 = 8 then 'TenderControlTransaction' when k % 20 <> 10 then 'RetailTransaction' end"
        )
        sql, cols = flat(name, spec, side, {"TransactionType": kind})
        name_part = r"regexp_extract(xmlfilename, '[0-9]{4}\.(\w+)\.[a-zA-Z0-9]+\.+[0-9]{5}.[a-zA-Z].+', 0)"
        sql = (
            f"select * replace ({name_part} as xmlfilename), cast(ReceiptDateTime as date) as BusinessDay "
            f"from ({needed(sql, ['TransactionType'])}) q"
        )
        return first_row(sql, [*KEY_COLUMNS, "TransactionType", "FunctionLogStoreInfoID"], [*cols, "BusinessDay"])
    if name == "controltransaction":
        sql, cols = flat(name, spec, side)
        kind = (
            "case when SignOnStartDateTimestamp is not null then 'OperatorSignOn' "
            "when SignOffStartDateTimestamp is not null then 'OperatorSignOff' "
            "when NoSale is not null then 'NoSale' when StartDateTimestamp is not null then 'SessionSettle' "
            "else 'SystemProgram' end"
        )
        return f"select *, {kind} as ControlTransactionType from ({finish(sql, cols, name)}) q"
    if name in ("return", "sale"):
        sql, cols = flat(name, spec, side)
        return f"select * replace (nullif(Units, 0) as Units) from ({finish(sql, cols, name)}) q"
    if name == "receiptpositionaddonlist":
        return " union all ".join(finish(*flat(name, s, d), name) for s, d in pieces)
    if name == "retailpricemodifier":
        both = " union all by name ".join(needed(flat(name, s, d)[0], RULES[name].required) for s, d in pieces)
        cols = [c for c in flat(name, spec, side)[1] if c != "SequenceNumber"]
        keys = [c for c in LINE_COLUMNS if c != "SequenceNumber"] + ["PriceModifierSequenceNumber"]
        return first_row(f"select {', '.join(cols)} from ({both}) q", keys, cols)
    if name == "salereturn_rebate":
        flag = {"Return": 0, "Sale": 1}
        both = " union all by name ".join(
            f"select *, {flag[d]} as SaleReturnFlag from ({flat(name, s, d)[0]}) q" for s, d in pieces
        )
        cols = [*flat(name, spec, side)[1], "SaleReturnFlag"]
        keys = [c for c in LINE_COLUMNS if c != "SequenceNumber"] + ["RetailPriceModifierSequenceNumber"]
        return first_row(both, keys, cols)
    if name == "customer":
        address = "array_to_string(list_transform(range(1, k % 4 + 1), lambda i: 'street ' || cast((k + i) % 5 as varchar)), ',')"
        sql, cols = flat(name, spec, side, {"Address": address})
        return finish(sql, cols, name)
    if name == "retailtransactionheader":
        amounts = {
            "TransactionGrandAmount": "(k % 100) * case when k % 7 = 0 then 4 else 1 end * 5e-1",
            "TransactionTaxAmount": "case when k % 2 = 0 then (k % 100) * 2 * 5e-1 end",
            "NegativeTransactionTaxAmount": "case when k % 5 = 0 then (k % 100) * 3 * 5e-1 end",
        }
        sql, cols = flat(name, spec, side, amounts)
        return finish(sql, cols, name)
    sql, cols = flat(name, spec, side)
    return finish(sql, cols, name)
