"""Deposit slips: issued, redeemed, and the time between the two."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.keys import LINE, LINE_BY_NUMBER, RECEIPT, RECEIPT_BY_NUMBER
from tillsight.functions.rules import Rule, first_match
from tillsight.functions.scalars import business_day, minutes_between, money, slip_id
from tillsight.operators.joins import pivot_values
from tillsight.plans.classify import EMPTIES_TYPES, SLIP_ADDONS
from tillsight.sources.session import kept

# Class of slip receipts and of receipts with scanned empties only, minutes
# within which a redemption is normal, first lane number that is not a checkout.
SLIP_CLASS, SCANNED_ONLY_CLASS = "HNL", "EN9"
QUICK_MINUTES = 20
FIRST_OTHER_LANE = 100

SLIP = ["EmptiesStoreID", "EmptiesWorkstationID", "EmptiesReceiptNumber"]
COLUMNS = [
    *RECEIPT_BY_NUMBER, *SLIP, "EmptiesTotal", "EmployeeID", "FLAG", "Concatenated_Empties_ID",
    "class_id", "LineItemSequenceNumber", "IsVoided", "EmptiesTimingFlag",
]


def slip_number(number: str, digits: int | None):
    """Receipt number of a slip as text. ``digits`` cuts it, as the rule was first stated with
    4; numbers of more digits then never meet their issue, so the default is no cut."""
    text = F.col(number).cast("string")
    return text if digits is None else F.left(text, F.lit(digits))


def issued_slips(
    classification: DataFrame, header: DataFrame, retailheader: DataFrame, digits: int | None = None
) -> DataFrame:
    """Receipts that hand out a deposit slip."""
    slips = classification.where(F.col("class_id") == SLIP_CLASS).select(*RECEIPT, "class_id")
    staff = header.where("TransactionType = 'RetailTransaction'").select(*RECEIPT, "EmployeeID")
    totals = retailheader.select(*RECEIPT, "ReceiptNumber", "TransactionGrandAmount")
    return (
        slips.join(staff, RECEIPT)
        .join(totals, RECEIPT, "left")
        .select(
            *RECEIPT_BY_NUMBER,
            F.col("RetailStoreID").cast("string").alias("EmptiesStoreID"),
            F.col("WorkstationID").cast("string").alias("EmptiesWorkstationID"),
            slip_number("ReceiptNumber", digits).alias("EmptiesReceiptNumber"),
            F.col("TransactionGrandAmount").alias("EmptiesTotal"),
            "EmployeeID",
            F.lit(None).cast("string").alias("FLAG"),
            slip_id("RetailStoreID", "WorkstationID", "ReceiptNumber", "TransactionGrandAmount").alias(
                "Concatenated_Empties_ID"
            ),
            "class_id",
            F.lit(0).cast("bigint").alias("LineItemSequenceNumber"),
            F.lit(None).cast("int").alias("IsVoided"),
            F.lit(None).cast("int").alias("EmptiesTimingFlag"),
        )
    )


def redemptions(
    classification: DataFrame,
    header: DataFrame,
    lineitemderived: DataFrame,
    returns: DataFrame,
    addons: DataFrame,
    digits: int | None = None,
) -> DataFrame:
    """Returned-empties positions that refer to a slip, with how they were voided. Written to
    the scratch folder: they are read more than once, and are few among the lines they are found in."""
    slips = pivot_values(
        addons, LINE_BY_NUMBER, "AddonKey", "AddonValue", SLIP_ADDONS, carry=["SequenceNumber"]
    ).withColumn("EmptiesReceiptNumber", slip_number("EmptiesReceiptNumber", digits))
    classes = classification.where(F.col("class_id") != SLIP_CLASS).select(*RECEIPT, "class_id")
    staff = header.where("TransactionType = 'RetailTransaction'").select(*RECEIPT, "EmployeeID")
    positions = returns.where(F.col("ItemType").isin(*EMPTIES_TYPES)).select(*LINE, "ExtendedAmount")
    voids = lineitemderived.select(*LINE, "VoidFlag", "DirectVoidFlag")
    kind = first_match(
        [
            Rule("PF+SO", F.col("VoidFlag") & F.col("DirectVoidFlag")),
            Rule("PF+ZS", F.col("VoidFlag") & ~F.col("DirectVoidFlag")),
        ],
        "PF",
    )
    found = (
        positions.join(slips.distinct(), LINE)
        .join(voids, LINE, "left")
        .join(classes, RECEIPT)
        .join(staff, RECEIPT)
        .select(
            *RECEIPT_BY_NUMBER, *SLIP,
            F.col("ExtendedAmount").alias("EmptiesTotal"),
            "EmployeeID",
            kind.alias("FLAG"),
            slip_id("EmptiesStoreID", "EmptiesWorkstationID", "EmptiesReceiptNumber", "ExtendedAmount").alias(
                "Concatenated_Empties_ID"
            ),
            "class_id",
            "LineItemSequenceNumber",
        )
    )
    return kept(found, "redemptions")


def slip_totals(redeemed: DataFrame, lineitemderived: DataFrame) -> DataFrame:
    """Replace position amounts by the total of the slip within the receipt: its live part
    if any position is live, else its void part. Adds ``IsVoided``. Positions of one slip are
    those of one receipt, so a window takes them; the result is written to the scratch folder."""
    derived = lineitemderived.select(*LINE_BY_NUMBER, "VoidFlagDerived")
    lines = redeemed.join(derived, LINE_BY_NUMBER, "left")
    plain, void = F.col("FLAG") == "PF", F.col("VoidFlagDerived")

    slip = Window.partitionBy(*RECEIPT_BY_NUMBER, *SLIP)
    named = F.lit(True)
    for c in SLIP:
        named &= F.col(c).isNotNull()

    def total(part):
        return F.sum(money(F.when(part & plain, F.col("EmptiesTotal")).otherwise(0.0))).over(slip)

    of_slip = F.when(F.count_if(~void).over(slip) > 0, total(~void)).otherwise(total(void)).cast("double")
    totalled = (
        lines.withColumn("_total", F.when(named, of_slip))
        .withColumn("EmptiesTotal", F.col("_total"))
        .withColumn(
            "Concatenated_Empties_ID",
            slip_id("EmptiesStoreID", "EmptiesWorkstationID", "EmptiesReceiptNumber", "EmptiesTotal"),
        )
        .withColumn("IsVoided", F.when(void, 1).otherwise(0))
        .select(*[c for c in COLUMNS if c != "EmptiesTimingFlag"])
    )
    return kept(totalled, "slip_totals")


def timing(redeemed: DataFrame, issued: DataFrame) -> DataFrame:
    """Add ``EmptiesTimingFlag`` from the distance to the issue of the slip.

    One issue time is taken per slip: the latest one before *any* of its redemptions. It
    follows from the latest redemption alone, so redemptions are reduced to one row per
    slip before the join and no pair of issue and redemption is ever formed.
    """
    key = ["_store", "_lane", "_number"]
    numbered = redeemed.withColumns(
        {k: F.col(c).try_cast("bigint") for k, c in zip(key, SLIP)}
    )
    last_use = numbered.groupBy(*key).agg(F.max("ReceiptDateTime").alias("_last_use"))
    issues = issued.select(
        F.col("RetailStoreID").alias("_store"), F.col("WorkstationID").alias("_lane"),
        F.col("ReceiptNumber").alias("_number"), F.col("ReceiptDateTime").alias("_issue"),
    )
    issue = (
        issues.join(last_use, key)
        .where(F.col("_issue") < F.col("_last_use"))
        .groupBy(*key)
        .agg(F.max("_issue").alias("_issue"))
    )
    gap = minutes_between("_issue", "ReceiptDateTime")
    same_day = business_day("_issue") == business_day("ReceiptDateTime")
    late = (gap > QUICK_MINUTES) & same_day
    scanned = F.col("class_id") == SCANNED_ONLY_CLASS
    flag = (
        F.when(gap <= QUICK_MINUTES, 0)
        .when(late & scanned, 1)
        .when(late & ~scanned, 2)
        .when(~same_day | (F.col("_issue").isNull() & (F.col("_lane") >= FIRST_OTHER_LANE)), 3)
    )
    return numbered.join(issue, key, "left").withColumn("EmptiesTimingFlag", flag).select(*COLUMNS)


def empties_report(t) -> DataFrame:
    """Redemptions with timing, and the issued slips, duplicates removed."""
    issued = issued_slips(t["classification"], t["header"], t["retailheader"])
    redeemed = redemptions(
        t["classification"], t["header"], t["lineitemderived"], t["return"], t["addon"]
    )
    timed = timing(slip_totals(redeemed, t["lineitemderived"]), issued)
    return timed.unionByName(issued.select(*COLUMNS)).distinct()
