"""Master data: hierarchy levels, articles, item-code lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.operators.dedup import dedup_by_key

# Column titles of the delivered files.
HIERARCHY_FILE = ["Warengruppe", "char255"]
ARTICLE_FILE = {
    "Artikelnummer": ("SAP_ID", "bigint"),
    "Mengeneinheit für Anzeige": ("Unit", "string"),
    "Global Trade Item Number (GTIN)": ("EAN", "bigint"),
    "Kennzeichen Haupt-GTIN": ("IsMainEAN", "string"),
    "Artikelkurztext": ("Description", "string"),
    "CCG-Klassifikation": ("MerchandiseHierarchyLevel_Main", "two characters"),
    "Externe Warengruppe": ("MerchandiseHierarchyLevel_EBUS", "smallint"),
}
MATERIAL_FILE = {
    "MaterialID": ("SAP_ID", "bigint"),
    "BaseUOM": ("Unit", "string"),
    "GTIN": ("EAN", "bigint"),
    "GTINDesc": ("Description", "string"),
    "MaterialGroup1": ("MerchandiseHierarchyLevel_Main", "two characters"),
}
ARTICLE_COLUMNS = [
    "SAP_ID", "EAN", "Unit", "IsMainEAN", "Description",
    "MerchandiseHierarchyLevel_Main", "MerchandiseHierarchyLevel_EBUS",
]


def _typed(file_columns: dict[str, tuple[str, str]]):
    for title, (name, kind) in file_columns.items():
        c = F.col(f"`{title}`")
        if kind == "two characters":
            c = F.left(c, F.lit(2)).cast("smallint")
        elif kind != "string":
            c = c.cast(kind)
        yield c.alias(name)


def hierarchy_levels(main: DataFrame, special: DataFrame) -> DataFrame:
    """Product groups of both store types in one table, told apart by ``IsEBUS``."""
    level = F.col("Warengruppe").cast("int").alias("MerchandiseHierarchyLevel")
    text = F.col("char255").alias("DescriptionDE")
    return main.select(level, text, F.lit(0).alias("IsEBUS")).unionByName(
        special.select(level, text, F.lit(1).alias("IsEBUS"))
    )


def articles(raw: DataFrame) -> DataFrame:
    return raw.select(*_typed(ARTICLE_FILE)).select(*ARTICLE_COLUMNS)


def articles_from_materials(items: DataFrame, materials: DataFrame) -> DataFrame:
    """Variant delivered as two tables that share a material id."""
    return (
        items.join(materials, "MaterialID")
        .select(*_typed(MATERIAL_FILE))
        .withColumn("IsMainEAN", F.lit(""))
        .withColumn("MerchandiseHierarchyLevel_EBUS", F.lit(0).cast("smallint"))
        .select(*ARTICLE_COLUMNS)
    )


def resolve_item_codes(items: DataFrame, articles: DataFrame) -> DataFrame:
    """Add ``EAN_Lookup``: the booked code if (code, unit) is a known article, else the
    code of the article with the booked article id.

    Few codes are booked often, and there may be very many articles. Articles are cut to the booked
    codes first, so that what the lines are joined with stays small enough to be sent to them where
    a code is hot, however long the list of articles is.
    """
    by_code = articles.select(F.col("EAN").alias("_code"), F.lit(" ").alias("_ean"), "Unit")
    by_id = articles.select(
        F.col("SAP_ID").alias("_code"), F.col("EAN").cast("string").alias("_ean"), "Unit"
    )
    booked = items.select(F.col("POSItemID").cast("decimal(22,0)").alias("_booked")).unionByName(
        items.select(F.col("ItemID").cast("decimal(22,0)").alias("_booked"))
    ).distinct()
    listed = by_code.unionByName(by_id)
    listed = listed.join(booked, listed["_code"].cast("decimal(22,0)") == booked["_booked"], "left_semi")
    known = dedup_by_key(listed, ["_code", "Unit"])
    first = known.select(F.col("_code").alias("_hit1"), F.col("Unit").alias("_unit"))
    second = known.select(F.col("_code").alias("_id"), F.col("_ean").alias("_hit2")).distinct()
    return (
        items.join(
            first,
            (F.col("POSItemID") == F.col("_hit1")) & (F.col("UnitOfMeasureCode") == F.col("_unit")),
            "left",
        )
        .join(second, F.col("ItemID") == F.col("_id"), "left")
        .select(*items.columns, F.coalesce(F.col("_hit1").cast("string"), "_hit2").alias("EAN_Lookup"))
    )
