"""Line-item voids: propagation to linked lines and counters per receipt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.keys import LINE, LINE_BY_NUMBER, LINE_NUMBER, RECEIPT, RECEIPT_BY_NUMBER
from tillsight.functions.scalars import is_true, money
from tillsight.operators.joins import linked_lines


def item_links(sale: DataFrame, returns: DataFrame, keys: list[str]) -> DataFrame:
    """Sale and return lines with the line they point to."""
    return sale.select(*keys, F.col("SaleItemLink").alias("ItemLink")).unionByName(
        returns.select(*keys, F.col("ReturnItemLink").alias("ItemLink"))
    )


def propagate_voids(
    lineitem: DataFrame, sale: DataFrame, returns: DataFrame, by_number: bool = False
) -> DataFrame:
    """Add ``VoidFlagDerived``: a sale or return line is void if it is void itself or if
    a void line of the same receipt points to it. Other lines get null."""
    line = LINE_BY_NUMBER if by_number else LINE
    receipt = RECEIPT_BY_NUMBER if by_number else RECEIPT
    links = item_links(sale, returns, line)
    voids = (
        lineitem.where(F.col("VoidFlag")).select(*line)
        .join(links.where(F.col("ItemLink").isNotNull()), line)
    )
    hit = linked_lines(voids, receipt, LINE_NUMBER, "ItemLink", F.lit(True))
    return (
        lineitem.join(links.select(*line, F.lit(True).alias("_item")), line, "left")
        .join(hit.withColumn("_hit", F.lit(True)), line, "left")
        .withColumn(
            "VoidFlagDerived",
            F.when(F.col("_item"), is_true("VoidFlag") | F.col("_hit").isNotNull()),
        )
        .select(*lineitem.columns, "VoidFlagDerived")
    )


def item_amounts(sale: DataFrame, returns: DataFrame) -> DataFrame:
    """Amount of every sale and return position, each distinct position once."""
    columns = [*LINE_BY_NUMBER, "ExtendedAmount"]
    return sale.select(*columns).unionByName(returns.select(*columns)).distinct()


def void_counters(lineitemderived: DataFrame, sale: DataFrame, returns: DataFrame) -> DataFrame:
    """Live and void positions per receipt."""
    lines = lineitemderived.join(item_amounts(sale, returns), LINE_BY_NUMBER)
    void = is_true("VoidFlag")
    return lines.groupBy(*RECEIPT_BY_NUMBER).agg(
        F.count_if(~F.col("VoidFlagDerived")).alias("NonVoidedItemCount"),
        F.count_if(F.col("VoidFlag")).alias("VoidedItemCount"),
        F.sum(money(F.when(void, F.col("ExtendedAmount")).otherwise(0.0)))
        .cast("double")
        .alias("VoidedItemTotal"),
        F.count_if(F.col("DirectVoidFlag")).alias("DirectVoidedItemCount"),
        F.count_if(~F.col("DirectVoidFlag")).alias("LineVoidedItemCount"),
    )


# Fixed value: description of the price rule behind full-rebate stickers.
FULL_REBATE_RULE = "Kleberabatt"


def full_rebate_flag(rebates: DataFrame, sale: DataFrame, returns: DataFrame) -> DataFrame:
    """1 for receipts with a position whose price a sticker rebate took down to zero."""
    hit = (
        (F.col("RuleDescription") == FULL_REBATE_RULE)
        & (F.col("NewPrice") == 0.0)
        & (F.col("ExtendedAmount") == 0.0)
    )
    return (
        rebates.select(*LINE_BY_NUMBER, "RuleDescription", "NewPrice")
        .join(item_amounts(sale, returns), LINE_BY_NUMBER)
        .groupBy(*RECEIPT_BY_NUMBER)
        .agg(F.max(F.when(hit, 1).otherwise(0)).alias("Rebate100Percent"))
    )


def voided_is_last(lineitem: DataFrame, sale: DataFrame, returns: DataFrame) -> DataFrame:
    """Add ``VoidedIsLastItem``: for void positions 1 if the position is the last one of
    its receipt, else 0; null for everything else."""
    items = item_links(sale, returns, LINE_BY_NUMBER).select(*LINE_BY_NUMBER).distinct()
    last = items.groupBy(*RECEIPT_BY_NUMBER).agg(F.max(LINE_NUMBER).alias("_last"))
    return (
        lineitem.join(items.withColumn("_item", F.lit(True)), LINE_BY_NUMBER, "left")
        .join(last, RECEIPT_BY_NUMBER, "left")
        .withColumn(
            "VoidedIsLastItem",
            F.when(
                F.col("_item") & F.col("VoidFlag"),
                F.when(F.col("_last") == F.col(LINE_NUMBER), 1).otherwise(0),
            ),
        )
        .select(*lineitem.columns, "VoidedIsLastItem")
    )
