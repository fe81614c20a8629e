"""Published result tables: projection, enrichment and dictionary encoding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.keys import LINE_BY_NUMBER, RECEIPT, RECEIPT_BY_NUMBER
from tillsight.functions.scalars import equals_ignore_case, literal_map, signed_amount
from tillsight.operators.dedup import dedup_by_key
from tillsight.operators.dictionaries import dictionary_values
from tillsight.operators.encode import Dictionaries, encode_columns
from tillsight.plans.followup import employee_followup, voided_in_followup
from tillsight.plans.masterdata import resolve_item_codes
from tillsight.plans.void import full_rebate_flag, void_counters, voided_is_last
from tillsight.sources.lookups import TRANSACTION_STATUS, TRANSACTION_TYPE

Store = Callable[[str, DataFrame], DataFrame]


#: raw columns that carry the texts of each dictionary: (table, column)
ENCODED = {
    "EntryMethod": [("lineitem", "EntryMethod")],
    "ItemType": [("sale", "ItemType"), ("return", "ItemType")],
    "CardType": [("tender", "CardType")],
    "TypeCode": [("tender", "TypeCode")],
    "TenderID": [("tender", "TenderID")],
}


def _in_place(name: str, extended: DataFrame) -> DataFrame:
    return extended


def _values(known: bool, tables: dict[str, DataFrame], *names: str) -> dict[str, DataFrame | None]:
    """Texts of the named dictionaries from the raw tables; none where all are known."""
    found = dictionary_values(tables, {n: ENCODED[n] for n in names})
    return {n: None if known else found[n] for n in names}


def publish_lineitem(
    lineitem: DataFrame,
    sale: DataFrame,
    returns: DataFrame,
    dictionaries: Dictionaries,
    store: Store = _in_place,
    known: bool = False,
) -> tuple[DataFrame, Dictionaries]:
    """Lines with void position, reappearance and derived void, entry method encoded. With
    ``known`` the dictionary has all texts already."""
    last = voided_is_last(lineitem, sale, returns).select(*LINE_BY_NUMBER, "VoidedIsLastItem")
    lines = voided_in_followup(lineitem, sale, returns).join(last, LINE_BY_NUMBER, "left").select(
        *LINE_BY_NUMBER, "EntryMethod", "VoidFlag", "LineItemBeginDateTime", "DirectVoidFlag",
        "Amount", "VoidedIsLastItem", "VoidedIsInFollowup", "VoidFlagDerived",
    )
    values = _values(known, {"lineitem": lineitem}, "EntryMethod")
    return encode_columns(lines, dictionaries, ["EntryMethod"], store, values)


HEADER_COLUMNS = [
    "RetailStoreID", "WorkstationID", "SequenceNumber", "ReceiptNumber", "ReceiptDateTime",
    "FunctionLogStoreInfoID", "TransactionType", "CancelFlag", "TrainingModeFlag", "EmployeeID",
    "ApproverEmployeeID", "class_id",
]


def publish_header(
    header: DataFrame, classification: DataFrame, retailheader: DataFrame, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Transactions with class, encoded type and the employee's next transaction. A missing
    log id is published as 0."""
    no_log = {"FunctionLogStoreInfoID": 0}
    classes = classification.fillna(no_log)
    joined = header.fillna(no_log).join(
        classes, [*RECEIPT, "TransactionType", "FunctionLogStoreInfoID"]
    ).select(*HEADER_COLUMNS, *extra)
    chained = employee_followup(joined, retailheader)
    return chained.withColumn("TransactionType", literal_map("TransactionType", TRANSACTION_TYPE))


def publish_loyalty(loyalty: DataFrame) -> DataFrame:
    """Points per receipt and rule; missing references and descriptions count as 0."""
    return (
        loyalty.withColumns(
            {
                "ReferenceID": F.coalesce("ReferenceID", F.lit(0)),
                "RuleDescription": F.coalesce("RuleDescription", F.lit("0")),
            }
        )
        .groupBy(*RECEIPT_BY_NUMBER, "ReferenceID", "RuleDescription")
        .agg(F.sum("PointsAwarded").alias("PointsAwarded"))
    )


def publish_retailheader(
    retailheader: DataFrame,
    lineitemderived: DataFrame,
    sale: DataFrame,
    returns: DataFrame,
    rebates: DataFrame,
    customer: DataFrame,
) -> DataFrame:
    """Receipts with signed total, void counters, rebate mark and loyalty customer."""
    members = customer.where(equals_ignore_case("CustomerType", "DC")).select(
        *RECEIPT, "CustomerType", "CustomerTypeDescription", "AccountNumber"
    )
    published = (
        retailheader.join(void_counters(lineitemderived, sale, returns), RECEIPT_BY_NUMBER, "left")
        .join(full_rebate_flag(rebates, sale, returns), RECEIPT_BY_NUMBER, "left")
        .join(members, RECEIPT, "left")
        .select(
            *RECEIPT_BY_NUMBER,
            literal_map("TransactionStatus", TRANSACTION_STATUS).alias("TransactionStatus"),
            signed_amount("TransactionGrandAmount", "NegativeTotalFlag").alias("TransactionGrandAmount"),
            "CustomerType", "CustomerTypeDescription", "AccountNumber",
            "NonVoidedItemCount", "VoidedItemCount", "VoidedItemTotal", "DirectVoidedItemCount",
            "LineVoidedItemCount", "Rebate100Percent",
        )
    )
    return dedup_by_key(published, RECEIPT_BY_NUMBER)


MODIFIER_COLUMNS = [
    *LINE_BY_NUMBER, "PriceModifierSequenceNumber", "AmountAction", "AmountValue", "PromotionID",
    "PreviousPrice", "NewPrice", "ReasonCode", "RebateID",
]


def publish_modifiers(modifiers: DataFrame) -> DataFrame:
    return dedup_by_key(
        modifiers.select(*MODIFIER_COLUMNS), [*LINE_BY_NUMBER, "PriceModifierSequenceNumber"]
    )


POSITION_COLUMNS = [
    *LINE_BY_NUMBER, "ItemType", "POSItemID", "ItemID", "MerchandiseHierarchyLevel", "Description",
    "RegularSalesUnitPrice", "ExtendedAmount", "UnitOfMeasureCode", "Quantity", "Units",
    "MerchandiseStructureItemFlag", "SpecialPriceDescription",
]


def merge_sale_return(sale: DataFrame, returns: DataFrame) -> DataFrame:
    """Both sides in one table: returns flagged 1 with a negated amount."""
    back = returns.select(*POSITION_COLUMNS).withColumns(
        {"ExtendedAmount": -F.col("ExtendedAmount"), "ReturnFlag": F.lit(1)}
    )
    return sale.select(*POSITION_COLUMNS).withColumn("ReturnFlag", F.lit(0)).unionByName(back)


def publish_salereturn(
    sale: DataFrame,
    returns: DataFrame,
    articles: DataFrame,
    stores: DataFrame,
    dictionaries: Dictionaries,
    store: Store = _in_place,
    known: bool = False,
) -> tuple[DataFrame, Dictionaries]:
    store_type = stores.select(F.col("StoreID").alias("RetailStoreID"), "IsEBUSStore")
    resolved = resolve_item_codes(merge_sale_return(sale, returns), articles).join(
        store_type, "RetailStoreID"
    )
    values = _values(known, {"sale": sale, "return": returns}, "ItemType")
    return encode_columns(resolved, dictionaries, ["ItemType"], store, values)


TENDER_COLUMNS = [
    *LINE_BY_NUMBER, "TypeCode", "TenderID", "Amount", "TenderChangeType", "TenderChangeID",
    "TenderChangeAmount", "CardType", "PrimaryAccountNumber", "Cashback",
    "IssuerIdentificationNumber", "SerialNumber",
]


def publish_tender(
    tender: DataFrame, dictionaries: Dictionaries, store: Store = _in_place, known: bool = False
) -> tuple[DataFrame, Dictionaries]:
    rows = tender.select(*TENDER_COLUMNS, F.lit(None).cast("int").alias("Tip"))
    names = ["CardType", "TypeCode", "TenderID"]
    return encode_columns(rows, dictionaries, names, store, _values(known, {"tender": tender}, *names))


def publish_suspended(suspended: DataFrame) -> DataFrame:
    """One row per suspended receipt."""
    key = ["RetailStoreID", "WorkStationID", "ReceiptDateTime", "ReceiptNumber"]
    return dedup_by_key(suspended, [f"{c}_suspended" for c in key])


EMPTIES_COLUMNS = [
    "RetailStoreID", "WorkstationID", "ReceiptDateTime", "ReceiptNumber", "EmptiesStoreID",
    "EmptiesWorkstationID", "EmptiesReceiptNumber", "EmptiesTotal", "EmployeeID", "FLAG",
    "Concatenated_Empties_ID", "class_id", "LineItemSequenceNumber", "IsVoided", "EmptiesTimingFlag",
]

PRICELOOKUP_COLUMNS = [
    "RetailStoreID", "WorkstationID", "ReceiptDateTimeFL", "ReceiptDateTimeAT", "ReceiptNumberAT",
    "ReceiptNumberFL", "EmployeeID", "PriceLookupFlag", "EAN", "ActualPrice", "ArticleDescription",
    "MerchandiseHierarchyLevel", "MerchandiseHierachyDescription", "TransactionGrandAmount",
    "StoreInfoID", "IsEBUS",
]

RECEIPTVOID_COLUMNS = [
    "RetailStoreID_1", "WorkstationID_1", "SequenceNumber_1", "ReceiptDateTime_1", "ReceiptNumber_1",
    "RetailStoreID_2", "WorkstationID_2", "SequenceNumber_2", "ReceiptDateTime_2", "ReceiptNumber_2",
    "BonStornoFlag", "TransactionClassID_1", "TransactionClassDescr_1", "TransactionClassID_2",
    "TransactionClassDescr_2", "TransactionGrandAmount", "NegativeTotalFlag", "Approver",
]


def publish_empties(empties: DataFrame) -> DataFrame:
    return empties.select(*EMPTIES_COLUMNS)


def publish_pricelookup(lookups: DataFrame) -> DataFrame:
    return lookups.select(*PRICELOOKUP_COLUMNS)


def publish_receiptvoid(report: DataFrame) -> DataFrame:
    return report.select(*RECEIPTVOID_COLUMNS)


def publish_hierarchy(hierarchy: DataFrame) -> DataFrame:
    return hierarchy.select("MerchandiseHierarchyLevel", "DescriptionDE", "IsEBUS")


def publish_articles(articles: DataFrame) -> DataFrame:
    return articles.drop("IsMainEAN").withColumnRenamed("Description", "ArticleDescription")
