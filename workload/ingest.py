"""Flattening operators and table builders over wide rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle.ingest import expected
from tillsight.functions.rules import Rule, first_match
from tillsight.functions.scalars import business_day, file_base_name, file_name_parts, xor_mask, zero_to_null
from tillsight.operators.dedup import dedup_by_key, require
from tillsight.operators.flatten import join_lines, named_totals, zip_explode, zip_explode_nested
from tillsight.plans import masterdata
from tillsight.plans.ingest import (
    BUILDERS,
    CUSTOMER_ADDRESS,
    SPECS,
    TOTAL_NAMES,
    TOTAL_VALUES,
    TOTALS,
    TYPE_MARKERS,
    build,
    build_transactionheader,
    item_spec,
    position_addon_spec,
)
from tillsight.sources.widedata import MEANING, leaf, stored_wide_table as wide_table
from workload.registry import query

KEYS = {
    "transactionheader": "build_transactionheader",
    "controltransaction": "build_controltransaction",
    "functionlog": "build_functionlog",
    "lineitem": "build_lineitem",
    "loyaltyreward": "build_loyaltyreward",
    "receiptheaderaddonlist": "build_headeraddon",
    "receiptpositionaddonlist": "build_positionaddon",
    "customer": "build_customer",
    "retailpricemodifier": "build_pricemodifier",
    "return": "build_return",
    "sale": "build_sale",
    "retailtransactionheader": "build_retailheader",
    "tender": "build_tender",
    "tendercontrolloan": "build_tenderloan",
    "tendercontrolpickup": "build_tenderpickup",
    "tendercontrolsafesettle": "build_safesettle",
    "tendercontroltillsettle": "build_tillsettle",
    "tendercontrolpaymentdeposit": "build_paymentdeposit",
    "salereturn_rebate": "build_rebate",
}


def _register(table: str, key: str) -> None:
    @query(key, expected(table))
    def _(t):
        return BUILDERS[table](wide_table(t, table))


for _table, _key in KEYS.items():
    _register(_table, _key)


def _paths(table: str) -> dict[str, str]:
    return {f.name: f.path for f in SPECS[table].leaves}


_LINE = _paths("lineitem")
_SEQ = "RetailTransaction_LineItem_SequenceNumber"


@query(
    "zip_explode",
    "select k as SequenceNumber, n as line, cast("
    + leaf("EntryMethod", "string", "lineitem", "", 1)
    + " as varchar) as entry from (select distinct k, n from {position}) q",
)
def _(t):
    wide = wide_table(t, "lineitem")
    out = zip_explode(wide, [_SEQ, _LINE["EntryMethod"]], [F.col("SequenceNumber").cast("bigint")])
    return out.select("SequenceNumber", F.col(_SEQ).cast("bigint").alias("line"), F.col(_LINE["EntryMethod"]).alias("entry"))


_TILL = _paths("tendercontroltillsettle")


@query(
    "zip_explode_outer",
    "select k as SequenceNumber, "
    + leaf("TenderType", "string", "x", "", 1)
    + " as kind from (select k, unnest(case when k % 3 = 0 then [cast(null as bigint)] else range(1, k % 3 + 1) end) as n from {receipt}) q",
)
def _(t):
    wide = wide_table(t, "tendercontroltillsettle")
    arrays = [_TILL["TenderType"], _TILL["BeginningAmount"]]
    out = zip_explode(wide, arrays, [F.col("SequenceNumber").cast("bigint")], outer=True)
    return out.select("SequenceNumber", F.col(arrays[0]).alias("kind"))


_TAX = {f.name: f.path for f in item_spec("Sale").leaves}


@query(
    "zip_explode_nested",
    "select k as SequenceNumber, n as line, "
    + leaf("TaxAmount", "double", "sale", "Sale", 1)
    + " as amount, "
    + leaf("TaxPercent", "double", "sale", "Sale", 2)
    + " as percent from (select k, n, unnest(case when (k + n) % 3 = 0 then [cast(null as bigint)] "
    "else range(1, (k + n) % 3 + 1) end) as m from (select distinct k, n from {position}) p) q",
)
def _(t):
    wide = wide_table(t, "sale")
    inner = [_TAX["TaxPercent"], _TAX["TaxType"]]
    out = zip_explode_nested(
        wide, [_SEQ, _TAX["TaxAmount"], *inner], inner, [F.col("SequenceNumber").cast("bigint")], inner_outer=True
    )
    return out.select(
        "SequenceNumber",
        F.col(_SEQ).cast("bigint").alias("line"),
        F.col(_TAX["TaxAmount"]).cast("double").alias("amount"),
        F.col(_TAX["TaxPercent"]).cast("double").alias("percent"),
    )


@query(
    "dedup_by_key",
    "select * exclude (pick) from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_extendedprice) as pick "
    "from lineitem) q where pick = 1",
)
def _(t):
    rows = t.base("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return dedup_by_key(rows, ["l_orderkey", "l_linenumber"])


@query(
    "dedup_full_row",
    "select distinct l_returnflag, l_linestatus, l_partkey % 20 as item, cast(l_quantity as int) as q from lineitem",
)
def _(t):
    return t.base("lineitem").select(
        "l_returnflag", "l_linestatus", (F.col("l_partkey") % 20).alias("item"),
        F.col("l_quantity").cast("int").alias("q"),
    ).distinct()


@query(
    "type_discriminator",
    "select k as SequenceNumber, case when k % 20 = 7 then 'ControlTransaction' when k % 20 = 9 then 'FunctionLog' "
    "when k % 20 = 8 then 'TenderControlTransaction' else 'RetailTransaction' end as kind from {receipt} where k % 20 <> 10",
)
def _(t):
    kind = first_match([Rule(v, F.col(c).isNotNull()) for c, v in TYPE_MARKERS.items()])
    wide = wide_table(t, "tendercontrolloan")
    return require(wide.select(F.col("SequenceNumber").cast("bigint"), kind.alias("kind")), ["kind"])


@query(
    "require_not_null",
    "select k as SequenceNumber from (select k, "
    + ", ".join(f"{leaf(f.name, f.type, 'x')} as c{i}" for i, f in enumerate(SPECS["tendercontrolloan"].scalars))
    + " from {receipt}) q where c0 is not null and c1 is not null and c2 is not null",
)
def _(t):
    wide = wide_table(t, "tendercontrolloan")
    needed = [f.path for f in SPECS["tendercontrolloan"].scalars]
    return require(wide, needed).select(F.col("SequenceNumber").cast("bigint"))


@query(
    "totals_map_lookup",
    "select k as SequenceNumber, (k % 100) * case when k % 7 = 0 then 4 else 1 end * 5e-1 as TransactionGrandAmount, "
    "case when k % 2 = 0 then (k % 100) * 2 * 5e-1 end as TransactionTaxAmount, "
    "case when k % 5 = 0 then (k % 100) * 3 * 5e-1 end as NegativeTransactionTaxAmount from {receipt}",
)
def _(t):
    picked = named_totals(wide_table(t, "retailtransactionheader"), TOTAL_NAMES, TOTAL_VALUES, TOTALS)
    return picked.select(
        F.col("SequenceNumber").cast("bigint"), *[F.col(c).cast("double").alias(c) for c in TOTALS]
    )


_SAFE = SPECS["tendercontrolsafesettle"]


@query(
    "typed_projection",
    "select k as SequenceNumber, "
    + ", ".join(
        f"cast({leaf(f.name, f.type, 'x')} as {'bigint' if f.type == 'long' else f.type}) as {f.name}" for f in _SAFE.scalars
    )
    + " from {receipt}",
)
def _(t):
    wide = wide_table(t, "tendercontrolsafesettle")
    return wide.select(
        F.col("SequenceNumber").try_cast("long").alias("SequenceNumber"),
        *[F.col(f.path).try_cast(f.type).alias(f.name) for f in _SAFE.scalars],
    )


@query("business_day", "select k as SequenceNumber, cast(ReceiptDateTime as date) as BusinessDay from {receipt}")
def _(t):
    wide = wide_table(t, "tendercontrolloan")
    return wide.select(F.col("SequenceNumber").cast("bigint"), business_day("GK_ReceiptDateTime").alias("BusinessDay"))


_FILE = MEANING["xmlfilename"]


@query(
    "filename_parse",
    "select distinct xmlfilename, substring(xmlfilename, 1, 4) as RetailStoreID, "
    "strptime(substring(xmlfilename, 12, 8), '%Y%m%d')::date as BusinessDate, "
    "strptime(substring(xmlfilename, 12, 14), '%Y%m%d%H%M%S') as CreationDateTime, "
    "substring(xmlfilename, 27, 5) as ConsecutiveNumber "
    "from (select replace(" + _FILE + ", '/in/', '') as xmlfilename from {receipt}) q",
)
def _(t):
    wide = wide_table(t, "transactionheader")
    names = wide.select(file_base_name("InputFileName").alias("xmlfilename")).distinct()
    return names.withColumns(file_name_parts("xmlfilename"))


@query(
    "xor_mask",
    "select k as SequenceNumber, xor(EmployeeID, cast(12345 as bigint)) as masked, EmployeeID as unmasked from {receipt}",
)
def _(t):
    masked = t["receipt"].select("SequenceNumber", xor_mask("EmployeeID", 12345).alias("masked"))
    return masked.withColumn("unmasked", xor_mask("masked", 12345))


@query(
    "concat_address",
    "select k as SequenceNumber, coalesce(a, '') as Address from (select k, string_agg('street ' || cast((k + i) % 5 as varchar), ',' order by i) as a "
    "from (select k, unnest(case when k % 4 = 0 then [cast(null as bigint)] else range(1, k % 4 + 1) end) as i from {receipt}) q group by k) q",
)
def _(t):
    wide = wide_table(t, "customer")
    return join_lines(wide, CUSTOMER_ADDRESS, "Address").select(F.col("SequenceNumber").cast("bigint"), "Address")


@query(
    "zero_to_null",
    "select o_orderkey, nullif(cast(o_orderkey % 4 as double), 0) as Units from orders",
)
def _(t):
    return t.base("orders").select(
        "o_orderkey", zero_to_null((F.col("o_orderkey") % 4).cast("double")).alias("Units")
    )


@query(
    "tagged_union",
    "select RetailStoreID, LineItemSequenceNumber, SequenceNumber, ExtendedAmount, 1 as SaleReturnFlag from {sale} "
    "union all select RetailStoreID, LineItemSequenceNumber, SequenceNumber, ExtendedAmount, 0 from {return}",
)
def _(t):
    cols = ["RetailStoreID", "LineItemSequenceNumber", "SequenceNumber", "ExtendedAmount"]
    sale = t["sale"].select(*cols, F.lit(1).alias("SaleReturnFlag"))
    return sale.unionByName(t["return"].select(*cols, F.lit(0).alias("SaleReturnFlag")))


# -- master data ------------------------------------------------------------------------


def raw_articles(t):
    """Delivered article file: all columns text."""
    part = t["articles"]
    text = {
        "Artikelnummer": "SAP_ID", "Mengeneinheit für Anzeige": "Unit",
        "Global Trade Item Number (GTIN)": "EAN", "Kennzeichen Haupt-GTIN": "IsMainEAN",
        "Artikelkurztext": "Description", "Externe Warengruppe": "MerchandiseHierarchyLevel_EBUS",
    }
    group = F.concat(F.lpad(F.col("MerchandiseHierarchyLevel_Main").cast("string"), 2, "0"), F.lit("-99"))
    return part.select(
        *[F.col(c).cast("string").alias(a) for a, c in text.items()], group.alias("CCG-Klassifikation")
    ).select(*masterdata.ARTICLE_FILE)


ARTICLES_SQL = (
    "select SAP_ID, EAN, Unit, IsMainEAN, Description, MerchandiseHierarchyLevel_Main, "
    "MerchandiseHierarchyLevel_EBUS from {articles}"
)


@query("build_articles", ARTICLES_SQL)
def _(t):
    return masterdata.articles(raw_articles(t))


@query(
    "build_articles_joined",
    "select SAP_ID, EAN, Unit, '' as IsMainEAN, Description, MerchandiseHierarchyLevel_Main, "
    "0 as MerchandiseHierarchyLevel_EBUS from {articles} where SAP_ID % 10 <> 3",
)
def _(t):
    raw = raw_articles(t)
    items = raw.select(
        F.col("Artikelnummer").alias("MaterialID"),
        F.col("`Global Trade Item Number (GTIN)`").alias("GTIN"),
        F.col("Artikelkurztext").alias("GTINDesc"),
    )
    materials = raw.where(F.col("Artikelnummer").cast("bigint") % 10 != 3).select(
        F.col("Artikelnummer").alias("MaterialID"),
        F.col("`Mengeneinheit für Anzeige`").alias("BaseUOM"),
        F.col("`CCG-Klassifikation`").alias("MaterialGroup1"),
    )
    return masterdata.articles_from_materials(items, materials)


@query("build_hierarchy", "select MerchandiseHierarchyLevel, DescriptionDE, IsEBUS from {hierarchy}")
def _(t):
    h = t["hierarchy"].select(
        F.col("MerchandiseHierarchyLevel").cast("string").alias("Warengruppe"),
        F.col("DescriptionDE").alias("char255"), "IsEBUS",
    )
    return masterdata.hierarchy_levels(h.where("IsEBUS = 0"), h.where("IsEBUS = 1"))
