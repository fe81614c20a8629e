"""Seed lookups: id <-> description pairs every installation starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Ids and descriptions of the seed dictionaries.
CARD_TYPE = {"Credit": 0, "Debit": 1}
ENTRY_METHOD = {"Scanned": 0, "Keyed": 1}
ITEM_TYPE = {"Deposit": 0, "Stock": 1, "DepositRefund": 2}
TRANSACTION_STATUS = {"PostVoided": 0, "Suspended": 1, "SuspendedRetrieved": 2, "Totaled": 3}
TRANSACTION_TYPE = {
    "ControlTransaction": 0,
    "FunctionLog": 1,
    "RetailTransaction": 2,
    "TenderControlTransaction": 3,
}
TYPE_CODE = {"Refund": 0, "Sale": 1}
TENDER_ID = {
    code: i
    for i, code in enumerate(
        "YTEC YTVC YTSX YTER YTAM YTVO YTCE YTKR YTDT YTSZ YTVP YTVB YTVG YTMC YTDP YTEM "
        "YTSO YTVI YTPG YTMA YTNG YTCS".split()
    )
}

SEEDS = {
    "CardType": CARD_TYPE,
    "EntryMethod": ENTRY_METHOD,
    "ItemType": ITEM_TYPE,
    "TenderID": TENDER_ID,
    "TransactionStatus": TRANSACTION_STATUS,
    "TransactionType": TRANSACTION_TYPE,
    "TypeCode": TYPE_CODE,
}


def seed(spark: SparkSession, name: str) -> DataFrame:
    """Dictionary table with columns ``name`` (id) and ``name + 'Desc'`` (text)."""
    rows = [(i, text) for text, i in SEEDS[name].items()]
    return spark.createDataFrame(rows, f"{name} bigint, {name}Desc string")
