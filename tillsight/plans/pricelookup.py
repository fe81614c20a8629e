"""Price lookups: which receipt followed, and was the looked-up item booked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.keys import RECEIPT
from tillsight.functions.rules import Rule, first_match
from tillsight.functions.scalars import business_day
from tillsight.operators.dedup import dedup_by_key
from tillsight.operators.joins import pivot_values
from tillsight.operators.ordered import DEPTH, as_of, min_after
from tillsight.plans.classify import LOOKUP, LOOKUP_FUNCTION_ID

LANE = ["RetailStoreID", "WorkstationID"]
EVENT = [*RECEIPT, "StoreInfoID"]
LOOKUP_PARAMETERS = {"ITEM_EAN": "EAN", "ACTUAL_PRICE": "ACTUALPRICE"}


def lookup_events(functionlog: DataFrame) -> DataFrame:
    """Lookups with item code and price; ``seqFlag`` 0 marks those outside a receipt."""
    calls = functionlog.where(
        (F.col("FunctionID") == LOOKUP_FUNCTION_ID) & (F.col("FunctionName") == LOOKUP)
    )
    events = pivot_values(
        calls, EVENT, "ParameterName", "ParameterValue", LOOKUP_PARAMETERS, carry=["ReceiptNumber"]
    )
    return events.withColumn("seqFlag", F.when(F.col("SequenceNumber") == 0, 0).otherwise(1))


ATTACHED = [*EVENT, "EAN", "ACTUALPRICE", "seqFlag", "ReceiptDateTimeAT"]


def attach_receipts(events: DataFrame, retailheader: DataFrame) -> DataFrame:
    """The receipt each lookup belongs to.

    A lookup inside a receipt names it by sequence number; one outside belongs to the
    next receipt of the lane that day. Of several outside lookups at one time of a lane
    only one is kept.
    """
    day = business_day("ReceiptDateTime")
    receipts = retailheader.select(
        *LANE, "SequenceNumber", F.col("ReceiptDateTime").alias("ReceiptDateTimeAT"),
        business_day("ReceiptDateTime").alias("_day"),
    )
    inside = (
        events.where("SequenceNumber <> 0").withColumn("_day", day)
        .join(receipts, [*LANE, "SequenceNumber", "_day"], "left")
        .select(*ATTACHED)
    )
    outside = dedup_by_key(
        events.where("SequenceNumber = 0").drop("SequenceNumber", "ReceiptNumber"),
        [*LANE, "ReceiptDateTime"],
        prefer=["StoreInfoID", "EAN", "ACTUALPRICE"],
    )
    found = as_of(
        outside.withColumn("_day", day), receipts, [*LANE, "_day"],
        "ReceiptDateTime", "ReceiptDateTimeAT", ["SequenceNumber"], "next", depth=DEPTH,
    ).select(*ATTACHED)
    # the inside rows are distinct per event and receipt, the outside rows per lane time
    return inside.distinct().unionByName(found)


def article_by_code(articles: DataFrame) -> DataFrame:
    """One article per code, where a code is an item number or a master-data id."""
    facts = ["MerchandiseHierarchyLevel_Main", "MerchandiseHierarchyLevel_EBUS",
             F.col("Description").alias("ArticleDescription")]
    codes = articles.select("EAN", *facts).unionByName(
        articles.select(F.col("SAP_ID").alias("EAN"), *facts)
    )
    return dedup_by_key(codes, ["EAN"])


def enrich(
    attached: DataFrame,
    retailheader: DataFrame,
    header: DataFrame,
    articles: DataFrame,
    hierarchy: DataFrame,
    stores: DataFrame,
) -> DataFrame:
    """Add receipt number, employee, total, article and product group to the lookups."""
    totals = retailheader.select(
        *LANE, "SequenceNumber", business_day("ReceiptDateTime").alias("_day"),
        F.col("ReceiptDateTime").alias("_rt"), "TransactionGrandAmount",
    )
    retail = header.where("TransactionType = 'RetailTransaction'").select(
        *LANE, "SequenceNumber", F.col("ReceiptDateTime").alias("_rt"), "ReceiptNumber",
        F.col("EmployeeID").alias("_receipt_employee"),
    )
    logged = header.where("TransactionType = 'FunctionLog'").select(
        *LANE, "ReceiptDateTime", F.col("SequenceNumber").alias("_seq0"),
        F.col("FunctionLogStoreInfoID").alias("StoreInfoID"),
        F.col("EmployeeID").alias("_log_employee"),
    )
    codes = article_by_code(articles).withColumn("EAN", F.col("EAN").cast("string"))
    store_type = stores.select(
        F.col("StoreID").alias("RetailStoreID"), F.col("IsEBUSStore").alias("IsEBUS")
    ).distinct()
    groups = hierarchy.select(
        F.col("MerchandiseHierarchyLevel"),
        F.col("DescriptionDE").alias("MerchandiseHierachyDescription"),
        (F.col("IsEBUS") == 1).alias("_ebus"),
    ).distinct()
    level = F.when(F.coalesce(F.col("IsEBUS"), F.lit(False)), F.col("MerchandiseHierarchyLevel_EBUS")).otherwise(
        F.col("MerchandiseHierarchyLevel_Main")
    )
    return (
        attached.withColumn("_day", business_day("ReceiptDateTime"))
        .join(totals, [*LANE, "SequenceNumber", "_day"], "left")
        .join(retail, [*LANE, "SequenceNumber", "_rt"], "left")
        .withColumn("_seq0", F.coalesce("SequenceNumber", F.lit(0)))
        .join(logged, [*LANE, "ReceiptDateTime", "_seq0", "StoreInfoID"], "left")
        .join(codes, "EAN", "left")
        .join(store_type, "RetailStoreID", "left")
        .withColumn("_level", level)
        .join(
            groups,
            (F.col("_level") == F.col("MerchandiseHierarchyLevel")) & (F.col("IsEBUS") == F.col("_ebus")),
            "left",
        )
        .withColumn("EmployeeID", F.coalesce("_receipt_employee", "_log_employee"))
        .select(
            *ATTACHED, "ReceiptNumber", "EmployeeID", "TransactionGrandAmount", "ArticleDescription",
            "MerchandiseHierarchyLevel", "MerchandiseHierachyDescription", "IsEBUS",
        )
    )


def flag_lookups(
    enriched: DataFrame,
    lineitem: DataFrame,
    sale: DataFrame,
    returns: DataFrame,
    classification: DataFrame,
) -> DataFrame:
    """Add the first line booked after the lookup, the class of the receipt, and the flag:
    Q no regular receipt, N the item was booked, M something was keyed in, P other."""
    looked = enriched.withColumn("_day", business_day("ReceiptDateTime"))
    spot = [*LANE, "SequenceNumber", "_day"]
    # only receipts that a lookup points at take part; all line tables are narrowed to them first
    spots = looked.select(*spot).distinct()

    def near(lines: DataFrame) -> DataFrame:
        return lines.withColumn("_day", business_day("ReceiptDateTime")).join(spots, spot, "left_semi")

    lines = near(
        lineitem.select(
            *RECEIPT, "LineItemSequenceNumber", "LineItemBeginDateTime", "EntryMethod"
        )
    )
    first_line = min_after(
        looked.select(*spot, "ReceiptDateTime").distinct(), lines, spot, "ReceiptDateTime",
        "LineItemBeginDateTime", "LineItemSequenceNumber", "minLineItemSequenceNumber",
    )
    code = [*RECEIPT, "LineItemSequenceNumber", "POSItemID", "MerchandiseHierarchyLevel"]
    items = near(sale.select(*code).unionByName(returns.select(*code))).distinct()
    booked = items.join(
        lines.select(*RECEIPT, "LineItemSequenceNumber", "EntryMethod"),
        [*RECEIPT, "LineItemSequenceNumber"], "left",
    ).select(
        *LANE, "SequenceNumber", "_day",
        F.col("LineItemSequenceNumber").alias("minLineItemSequenceNumber"),
        F.col("POSItemID").cast("string").alias("_code"), "EntryMethod",
    )
    classes = classification.where("TransactionType = 'RetailTransaction'").select(
        *LANE, "SequenceNumber", F.col("ReceiptDateTime").alias("ReceiptDateTimeAT"), "class_id"
    )
    rules = [
        Rule("Q", ~F.col("class_id").rlike("^[AEC]N[0-9]$")),
        Rule("N", F.col("EAN") == F.col("_code")),
        Rule("M", F.col("EntryMethod") == "Keyed"),
    ]
    return (
        looked.join(first_line, [*spot, "ReceiptDateTime"], "left")
        .join(booked, [*spot, "minLineItemSequenceNumber"], "left")
        .join(classes, [*LANE, "SequenceNumber", "ReceiptDateTimeAT"], "left")
        .withColumn("PriceLookupFlag", first_match(rules, "P"))
        .select(*enriched.columns, "minLineItemSequenceNumber", "class_id", "PriceLookupFlag")
    )


def final_lookups(flagged: DataFrame, events: DataFrame) -> DataFrame:
    logged = events.select(*EVENT, F.col("ReceiptNumber").alias("_number"))
    number = F.coalesce("_number", F.lit(0))
    return flagged.join(logged, EVENT, "left").select(
        *LANE,
        F.col("ReceiptDateTime").alias("ReceiptDateTimeFL"),
        "ReceiptDateTimeAT",
        F.when(F.col("seqFlag") == 0, F.col("ReceiptNumber")).otherwise(number).alias("ReceiptNumberAT"),
        number.alias("ReceiptNumberFL"),
        "EmployeeID", "PriceLookupFlag", "EAN", F.col("ACTUALPRICE").alias("ActualPrice"),
        "ArticleDescription", "MerchandiseHierarchyLevel", "MerchandiseHierachyDescription",
        "TransactionGrandAmount", "StoreInfoID", "IsEBUS",
    )


def enriched_lookups(t) -> DataFrame:
    """Lookups with receipt, employee, article and product group."""
    attached = attach_receipts(lookup_events(t["functionlog"]), t["retailheader"])
    return enrich(
        attached, t["retailheader"], t["header"], t["articles"], t["hierarchy"], t["stores"]
    )


def price_lookups(t) -> DataFrame:
    """Final table from the written ``lookups`` and the ``classification``."""
    flagged = flag_lookups(t["lookups"], t["lineitem"], t["sale"], t["return"], t["classification"])
    return final_lookups(flagged, lookup_events(t["functionlog"]))
