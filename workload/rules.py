"""The receipt audits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillsight.plans import classify, daily, empties, followup, masterdata, pricelookup, receiptvoid, void
from tillsight.sources.bucketed import bucketed_lines
from tillsight.sources.session import scratch_path
from workload.registry import query
from workload.stages import stage, with_stages

RULE_TABLES = ("lineitemderived", "classification")


def _items(t):
    return t["lineitemderived"], t["sale"], t["return"]


@query("void_propagation", "select * from {lineitemderived}")
def _(t):
    return void.propagate_voids(t["lineitem"], t["sale"], t["return"])


@query("addon_pivot", "select * from {slip}")
def _(t):
    return classify.slip_addons(t["addon"])


@query("product_group_ratio", "select * from {ratio}")
def _(t):
    with_stages(t, "lineitemderived")
    return classify.product_group_ratio(t["header"], *_items(t))


@query("price_modifier_net", "select * from {modnet}")
def _(t):
    return classify.net_modifiers(t["modifier"])


@query("price_check", "select * from {price}")
def _(t):
    with_stages(t, "lineitemderived")
    return classify.price_check(*_items(t), t["modifier"])


def _flags(t):
    with_stages(t, "lineitemderived")
    return classify.receipt_flags(
        t["header"], t["retailheader"], *_items(t), t["tender"], t["loyalty"], t["addon"],
        t["modifier"], t["stores"],
    )


@query("receipt_flags", "select * from {flags}")
def _(t):
    return _flags(t)


def bucketed(t, database):
    """Line tables stored by bucket."""
    with_stages(t, "lineitemderived")
    tables = {n: t[n] for n in ("lineitemderived", "sale", "return", "loyalty", "modifier", "addon")}
    buckets = max(8, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    return bucketed_lines(t.spark, tables, database, scratch_path(t.spark, "buckets"), buckets)


@query("receipt_flags_bucketed", "select * from {flags}")
def _(t):
    """The flags from line tables that lie in buckets: no table of lines is moved."""
    database = f"tillsight_{uuid.uuid4().hex[:12]}"
    b = bucketed(t, database)
    try:
        out = classify.receipt_flags(
            t["header"], t["retailheader"], b["lineitemderived"], b["sale"], b["return"], t["tender"], b["loyalty"],
            b["addon"], b["modifier"], t["stores"], b["items"],
        )
        return out
    finally:  # the plan has its files and buckets already
        t.spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@query("classify_retail", "select * from {class_retail}")
def _(t):
    t["header"] = t["header"].where("TransactionType = 'RetailTransaction'")
    return classify.classify_retail(_flags(t))


@query("classify_control", "select * from {class_control}")
def _(t):
    return classify.classify_control(classify.header_rows(t["header"]), t["control"])


@query("classify_function", "select * from {class_function}")
def _(t):
    return classify.classify_function(classify.header_rows(t["header"]), t["functionlog"])


@query("classify_tender", "select * from {class_tender}")
def _(t):
    return classify.classify_tender(
        classify.header_rows(t["header"]), t["pickup"], t["deposit"], t["loan"], t["tillsettle"],
        t["safesettle"],
    )


@query("classify_all", "select * from {classification}")
def _(t):
    return classify.classify_all(with_stages(t, "lineitemderived"))


@query("pricelookup_events", "select * from {events_l}")
def _(t):
    return pricelookup.lookup_events(t["functionlog"])


@query("pricelookup_attach", "select * from {attached}")
def _(t):
    return pricelookup.attach_receipts(pricelookup.lookup_events(t["functionlog"]), t["retailheader"])


@query("pricelookup_enrich", "select * from {enriched}")
def _(t):
    return pricelookup.enriched_lookups(t)


@query("pricelookup_flag", "select * from {flagged}")
def _(t):
    with_stages(t, "lookups", "classification")
    return pricelookup.flag_lookups(
        t["lookups"], t["lineitem"], t["sale"], t["return"], t["classification"]
    )


@query("pricelookup_final", "select * from {lookups}")
def _(t):
    return pricelookup.price_lookups(with_stages(t, "lookups", "classification"))


@query("void_followup_match", "select * from {followup}")
def _(t):
    return receiptvoid.void_followup(stage(t, "booked"))


@query("void_tender_code", "select * from {tender_codes}")
def _(t):
    return receiptvoid.tender_codes(stage(t, "void_followup"), t["tender"])


def _unmatched(t, intended=False):
    with_stages(t, "booked", "void_followup")
    return receiptvoid.unmatched_codes(
        t["booked"], t["void_followup"], t["tender"], t["stores"], t["header"], intended
    )


@query("void_unmatched_code", "select * from {unmatched_codes}")
def _(t):
    return _unmatched(t)


@query("void_unmatched_code_intended", "select * from {unmatched_intended}")
def _(t):
    return _unmatched(t, intended=True)


def class_texts(t):
    rows = [(c, f"Class {c}", f"Klasse {c}") for c in classify.class_catalog()]
    return t.spark.createDataFrame(rows, "class_id string, class_desc_en string, class_desc_gr string")


def void_report(t):
    with_stages(t, "classification", "booked", "void_followup")
    t["class_texts"] = class_texts(t)
    return daily.receiptvoiding(t)


@query("void_report", "select * from {void_report}")
def _(t):
    return void_report(t)


def _issued(t):
    return empties.issued_slips(t["classification"], t["header"], t["retailheader"])


def _redeemed(t):
    return empties.redemptions(
        t["classification"], t["header"], t["lineitemderived"], t["return"], t["addon"]
    )


@query("empties_issue", "select * from {issued}")
def _(t):
    with_stages(t, *RULE_TABLES)
    return _issued(t)


@query("empties_redemption", "select * from {redeemed}")
def _(t):
    with_stages(t, *RULE_TABLES)
    return _redeemed(t)


@query("empties_totals", "select * from {slip_totals}")
def _(t):
    with_stages(t, *RULE_TABLES)
    return empties.slip_totals(_redeemed(t), t["lineitemderived"])


@query(
    "empties_timing",
    "select RetailStoreID, WorkstationID, ReceiptNumber, ReceiptDateTime, EmptiesStoreID, EmptiesWorkstationID, "
    "EmptiesReceiptNumber, EmptiesTotal, EmployeeID, FLAG, Concatenated_Empties_ID, class_id, LineItemSequenceNumber, "
    "IsVoided, EmptiesTimingFlag from {timed}",
)
def _(t):
    with_stages(t, *RULE_TABLES)
    return empties.timing(empties.slip_totals(_redeemed(t), t["lineitemderived"]), _issued(t))


@query("empties_all", "select * from {empties_all}")
def _(t):
    return empties.empties_report(with_stages(t, *RULE_TABLES))


def suspended_report(t):
    return daily.suspendedfraud(with_stages(t, "classification", "empties"))


@query("suspended_match", "select * from {suspended}")
def _(t):
    return suspended_report(t)


@query("voided_is_last", "select * from {last}")
def _(t):
    return void.voided_is_last(t["lineitem"], t["sale"], t["return"])


@query("voided_in_followup", "select * from {shown}")
def _(t):
    return followup.voided_in_followup(t["lineitem"], t["sale"], t["return"])


def header_with_class(t):
    from tillsight.plans.publish import HEADER_COLUMNS, RECEIPT

    none = {"FunctionLogStoreInfoID": 0}
    with_stages(t, "classification")
    return t["header"].fillna(none).join(
        t["classification"].fillna(none), [*RECEIPT, "TransactionType", "FunctionLogStoreInfoID"]
    ).select(*HEADER_COLUMNS)


@query("employee_followup", "select * from {employee}")
def _(t):
    return followup.employee_followup(header_with_class(t), t["retailheader"])


@query("void_counters", "select * from {counters}")
def _(t):
    with_stages(t, "lineitemderived")
    return void.void_counters(*_items(t))


@query("full_rebate_flag", "select * from {rebate}")
def _(t):
    return void.full_rebate_flag(t["modifier"], t["sale"], t["return"])


@query("item_code_lookup", "select * from {resolved}")
def _(t):
    from tillsight.plans.publish import merge_sale_return

    return masterdata.resolve_item_codes(merge_sale_return(t["sale"], t["return"]), t["articles"])
