"""Load control: store status, load logs and events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.scalars import file_name_parts

# Status texts of the store list and their codes.
STORE_STATUS = {"Aktiv": "A", "Inaktiv": "I", "Inaktiv (temp.)": "T"}
ACTIVE, TEMPORARILY_INACTIVE = "Aktiv", "T"

# Wording of the events.
NO_DATA_TYPE = "Active store but no data"
NO_DATA_MESSAGE = "Store is active but did not receive the data"
UNEXPECTED_TYPE = "Inactive store but received the data"
UNEXPECTED_MESSAGE = ("Store ", " is temporarily inactive but still received the data for ")

EVENT_COLUMNS = ["EventDateTime", "RetailStoreID", "Level", "EventType", "EventMessage", "LoadID"]


def store_status(stores: DataFrame, run_date: str) -> DataFrame:
    """Expected status of every store for the day before ``run_date``."""
    code = None
    for text, letter in STORE_STATUS.items():
        hit = F.col("Status") == text
        code = F.when(hit, letter) if code is None else code.when(hit, letter)
    return stores.select(
        F.col("StoreID").alias("RetailStoreID"),
        F.date_sub(F.lit(run_date).cast("date"), 1).alias("Date"),
        code.alias("Status"),
        F.lit(None).cast("bigint").alias("LoadID"),
        "Reason",
    )


def next_load_id(log: DataFrame, column: str = "LoadID") -> DataFrame:
    """One row: highest load id so far plus one, starting at 1."""
    return log.agg((F.coalesce(F.max(column).cast("bigint"), F.lit(0)) + 1).alias("LoadID"))


def stamp_load_id(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Rows with the next load id of ``log``; a one-row join, nothing goes to the driver."""
    return rows.drop("LoadID").crossJoin(next_load_id(log))


def merge_load_status(loadcontrol: DataFrame, store_log: DataFrame, history: DataFrame) -> DataFrame:
    """Loaded (L) and failed (E) store days override the expected status and carry the
    load id of this run."""
    loaded = store_log.select(
        "RetailStoreID", F.col("BusinessDate").alias("Date"), F.col("Status").alias("_status")
    )
    return (
        loadcontrol.join(loaded, ["RetailStoreID", "Date"], "left")
        .crossJoin(next_load_id(history).withColumnRenamed("LoadID", "_next"))
        .select(
            "RetailStoreID",
            F.when(F.col("_status").isNotNull(), F.col("_next")).otherwise(F.col("LoadID")).alias("LoadID"),
            F.when(F.col("_status").isin("L", "E"), F.col("_status"))
            .otherwise(F.col("Status"))
            .alias("Status"),
            "Date",
            "Reason",
        )
    )


def _event(rows: DataFrame, at: str, level: str, kind: str, message) -> DataFrame:
    return rows.select(
        F.lit(at).alias("EventDateTime"),
        "RetailStoreID",
        F.lit(level).alias("Level"),
        F.lit(kind).alias("EventType"),
        message.alias("EventMessage"),
        F.lit(0).alias("LoadID"),
    )


def stores_missing_data(stores: DataFrame, received: DataFrame, at: str) -> DataFrame:
    """Error event for each active store without any received row."""
    silent = (
        stores.where(F.col("Status") == ACTIVE)
        .select(F.col("StoreID").alias("RetailStoreID"))
        .distinct()
        .join(received.select("RetailStoreID"), "RetailStoreID", "left_anti")
    )
    return _event(silent, at, "E", NO_DATA_TYPE, F.lit(NO_DATA_MESSAGE))


def stores_unexpected_data(received: DataFrame, at: str) -> DataFrame:
    """Warning for each date on which a temporarily inactive store did send data."""
    odd = (
        received.where(F.col("Status") == TEMPORARILY_INACTIVE)
        .select("RetailStoreID", "Date")
        .distinct()
    )
    before, after = UNEXPECTED_MESSAGE
    message = F.concat(
        F.lit(before), F.col("RetailStoreID").cast("string"), F.lit(after), F.col("Date").cast("string")
    )
    return _event(odd, at, "W", UNEXPECTED_TYPE, message)


def store_days(transactions: DataFrame, ts: str = "ReceiptDateTime") -> DataFrame:
    return transactions.select("RetailStoreID", F.to_date(ts).alias("BusinessDate")).distinct()


def store_load_log(
    days: DataFrame, status: str, started: str, ended: str, warnings: int, errors: int, history: DataFrame
) -> DataFrame:
    """One log row per received store day of this run."""
    rows = days.select(
        "RetailStoreID",
        F.lit(status).alias("Status"),
        "BusinessDate",
        F.lit(started).alias("StartDateTime"),
        F.lit(ended).alias("EndDateTime"),
        F.lit(warnings).alias("WarningsCount"),
        F.lit(errors).alias("ErrorsCount"),
    )
    return stamp_load_id(rows, history)


def run_load_log(
    days: DataFrame,
    folders: Sequence[str],
    started: str,
    ended: str,
    warnings: int,
    errors: int,
    history: DataFrame,
) -> DataFrame:
    """One summary row of the run."""
    row = days.agg(F.count_distinct("RetailStoreID").alias("StoreCount")).select(
        F.lit(",".join(folders)).alias("SourceFolder"),
        "StoreCount",
        F.lit(warnings).alias("WarningsCount"),
        F.lit(errors).alias("ErrorsCount"),
        F.lit(started).alias("StartDateTime"),
        F.lit(ended).alias("EndDateTime"),
    )
    return stamp_load_id(row, history)


def file_register(transactions: DataFrame, name: str = "xmlfilename", store_prefix: str = "") -> DataFrame:
    """One row per source file with the facts carried in its name."""
    return (
        transactions.select(name)
        .where(F.col(name).isNotNull())
        .distinct()
        .withColumns(file_name_parts(name, store_prefix))
        .withColumn("IsDeleted", F.lit(0))
    )
