"""Suspended receipts and the receipts that fetched them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.keys import RECEIPT, RECEIPT_BY_NUMBER
from tillsight.functions.scalars import business_day
from tillsight.operators.joins import present

# Add-on keys that tie a parked receipt to its retrieval.
PARKED, FETCHED = "PARK_NUMBER", "SERVER_PARKING_FETCHED_NUMBER"
FINISHED = "Totaled"


def suspended_receipts(
    headeraddons: DataFrame,
    retailheader: DataFrame,
    header: DataFrame,
    classification: DataFrame,
    empties: DataFrame,
) -> DataFrame:
    """Every parked receipt with the other receipts of its store and day that fetched its
    number. ``Suspended_Flag``: 0/1 empties receipt finished / not finished, 2/3 the same
    for other receipts.

    Whether a fetched number was finished is asked once per store, day and number, so
    receipts sharing a number do not multiply.
    """
    number = headeraddons.withColumn("_day", business_day("ReceiptDateTime"))
    by_number = retailheader.select(*RECEIPT_BY_NUMBER, "TransactionStatus", "TransactionGrandAmount")
    classes = classification.where("TransactionType = 'RetailTransaction'").select(*RECEIPT, "class_id")
    staff = header.where("TransactionType = 'RetailTransaction'").select(*RECEIPT, "EmployeeID")
    spot = ["RetailStoreID", "_day", "AddonValue"]

    parked = (
        number.where(F.col("AddonKey") == PARKED)
        .join(by_number, RECEIPT_BY_NUMBER, "left")
        .join(classes, RECEIPT, "left")
        .join(staff, RECEIPT, "left")
        .join(present(empties, RECEIPT_BY_NUMBER, "_empties"), RECEIPT_BY_NUMBER, "left")
    )
    fetched_rows = number.where(F.col("AddonKey") == FETCHED)
    fetched = (
        fetched_rows.join(by_number.drop("TransactionGrandAmount"), RECEIPT_BY_NUMBER, "left")
        .where(F.col("TransactionStatus") != "PostVoided")
        .groupBy(*RECEIPT, "ReceiptNumber", "_day", "TransactionStatus")
        .agg(F.max("AddonValue").alias("AddonValue"))
        .join(classes, RECEIPT, "left")
    )
    finished = fetched_rows.join(
        retailheader.where(F.col("TransactionStatus") == FINISHED).select(*RECEIPT),
        RECEIPT, "left_semi",
    )
    retrieved = fetched.join(present(finished, spot, "_finished"), spot, "left").select(
        *spot,
        F.col("WorkstationID").alias("WorkStationID_retrieved"),
        F.col("ReceiptDateTime").alias("ReceiptDateTime_retrieved"),
        F.col("ReceiptNumber").alias("ReceiptNumber_retrieved"),
        F.col("TransactionStatus").alias("TransactionStatus_retrieved"),
        F.when(F.col("_finished"), FINISHED).alias("_final"),
        F.col("class_id").alias("class_id_retrived"),
        F.lit(True).alias("_hit"),
    )
    own = F.col("ReceiptNumber") != F.col("ReceiptNumber_retrieved")
    left = parked.alias("p")
    right = retrieved.alias("r")
    same = (
        (F.col("p.RetailStoreID") == F.col("r.RetailStoreID"))
        & (F.col("p._day") == F.col("r._day"))
        & (F.col("p.AddonValue") == F.col("r.AddonValue"))
    )
    is_empties, done = F.col("_empties").isNotNull(), F.col("_final").isNotNull()
    return left.join(right, same & own, "left").select(
        F.col("p.RetailStoreID").alias("RetailStoreID_suspended"),
        F.col("p.WorkstationID").alias("WorkStationID_suspended"),
        F.col("p.ReceiptDateTime").alias("ReceiptDateTime_suspended"),
        F.col("p.ReceiptNumber").alias("ReceiptNumber_suspended"),
        F.col("p.TransactionStatus").alias("TransactionStatus_suspended"),
        F.col("p.class_id").alias("class_id_suspended"),
        F.col("p.EmployeeID").alias("EmployeeID_suspended"),
        F.col("p.TransactionGrandAmount").alias("Total_suspended"),
        F.when(F.col("_hit"), F.col("r.RetailStoreID")).alias("RetailStoreID_retrieved"),
        "WorkStationID_retrieved",
        "ReceiptDateTime_retrieved",
        "ReceiptNumber_retrieved",
        "TransactionStatus_retrieved",
        F.coalesce("_final", "TransactionStatus_retrieved").alias("TransactionStatus_derived_retrived"),
        "class_id_retrived",
        F.when(is_empties & done, 0).when(is_empties, 1).when(done, 2).otherwise(3).alias("Suspended_Flag"),
    )
