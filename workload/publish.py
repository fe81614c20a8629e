"""Published tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle.rules import NL5, N4
from tillsight.operators.encode import encode, extend_dictionary
from tillsight.plans import publish
from tillsight.plans.pricelookup import price_lookups
from tillsight.sources.lookups import SEEDS, seed
from tillsight.sources.session import scratch_path
from tillsight.sources.writers import write_table
from workload.registry import query
from workload.rules import suspended_report, void_report
from workload.stages import stage, with_stages


def dictionaries(t, *names):
    return {n: (seed(t.spark, n), n, f"{n}Desc") for n in names}


def lookup_store(t):
    """Writes an extended dictionary to its lookup table and reads it back."""
    root = scratch_path(t.spark, "lookups")
    return lambda name, extended: t.spark.read.parquet(write_table(extended, root, name))


def dictionary_sql(name: str, table: str) -> str:
    """Known ids, and new values counted on in order of hash bucket and text."""
    known = ", ".join(f"({i}, '{s}')" for s, i in SEEDS[name].items())
    top = max(SEEDS[name].values())
    return (
        f"(select id, text_ from (values {known}) v(id, text_) union all select {top} + row_number() over (order by substring(md5(text_), 1, 3), text_), text_ "
        f"from (select distinct {name} as text_ from {table} where {name} is not null) q where text_ not in (select text_ from (values {known}) v(id, text_)))"
    )


@query(
    "dictionary_encode",
    "select SequenceNumber, d.id as CardType from {tender} t left join " + dictionary_sql("CardType", "{tender}") + " d on t.CardType = d.text_",
)
def _(t):
    known = seed(t.spark, "CardType")
    values = t["tender"].select(F.col("CardType").alias("CardTypeDesc"))
    full = extend_dictionary(known, values, "CardType", "CardTypeDesc")
    rows = t["tender"].select("SequenceNumber", "CardType")
    return encode(rows, full, "CardType", "CardType", "CardTypeDesc")


@query(
    "publish_lineitem",
    f"select {NL5}, d.id as EntryMethod, VoidFlag, LineItemBeginDateTime, DirectVoidFlag, Amount, VoidedIsLastItem, VoidedIsInFollowup, VoidFlagDerived "
    f"from {{shown}} s left join (select {NL5}, VoidedIsLastItem from {{last}}) l using ({NL5}) left join "
    + dictionary_sql("EntryMethod", "{lineitem}") + " d on s.EntryMethod = d.text_",
)
def _(t):
    out, _ = publish.publish_lineitem(t["lineitem"], t["sale"], t["return"], dictionaries(t, "EntryMethod"), lookup_store(t))
    return out


@query("publish_projection", "select * from {void_report}")
def _(t):
    return void_report(t)


@query("publish_empties", "select " + ", ".join(publish.EMPTIES_COLUMNS) + " from {empties_all}")
def _(t):
    return publish.publish_empties(stage(t, "empties"))


@query("publish_pricelookup", "select " + ", ".join(publish.PRICELOOKUP_COLUMNS) + " from {lookups}")
def _(t):
    return publish.publish_pricelookup(price_lookups(with_stages(t, "lookups", "classification")))


@query("publish_receiptvoid", "select " + ", ".join(publish.RECEIPTVOID_COLUMNS) + " from {void_report}")
def _(t):
    return publish.publish_receiptvoid(void_report(t))


@query("publish_hierarchy", "select MerchandiseHierarchyLevel, DescriptionDE, IsEBUS from {hierarchy}")
def _(t):
    return publish.publish_hierarchy(t["hierarchy"])


@query(
    "publish_suspended",
    "select * exclude (pick) from (select *, row_number() over (partition by RetailStoreID_suspended, WorkStationID_suspended, ReceiptDateTime_suspended, ReceiptNumber_suspended "
    "order by TransactionStatus_suspended nulls first, class_id_suspended nulls first, EmployeeID_suspended nulls first, Total_suspended nulls first, RetailStoreID_retrieved nulls first, "
    "WorkStationID_retrieved nulls first, ReceiptDateTime_retrieved nulls first, ReceiptNumber_retrieved nulls first) as pick from {suspended}) q where pick = 1",
)
def _(t):
    return publish.publish_suspended(suspended_report(t))


@query(
    "publish_header",
    "select * replace (case TransactionType when 'ControlTransaction' then 0 when 'FunctionLog' then 1 when 'RetailTransaction' then 2 when 'TenderControlTransaction' then 3 end as TransactionType) from {employee}",
)
def _(t):
    with_stages(t, "classification")
    return publish.publish_header(t["header"], t["classification"], t["retailheader"])


@query(
    "publish_loyalty",
    f"select {N4}, coalesce(ReferenceID, 0) as ReferenceID, coalesce(RuleDescription, '0') as RuleDescription, sum(PointsAwarded) as PointsAwarded from {{loyalty}} group by all",
)
def _(t):
    return publish.publish_loyalty(t["loyalty"])


@query(
    "publish_retailheader",
    f"select {N4}, case r.TransactionStatus when 'PostVoided' then 0 when 'Suspended' then 1 when 'SuspendedRetrieved' then 2 when 'Totaled' then 3 end as TransactionStatus, "
    "case when NegativeTotalFlag then -TransactionGrandAmount else TransactionGrandAmount end as TransactionGrandAmount, c.CustomerType, c.CustomerTypeDescription, c.AccountNumber, "
    "NonVoidedItemCount, VoidedItemCount, VoidedItemTotal, DirectVoidedItemCount, LineVoidedItemCount, Rebate100Percent "
    f"from {{retailheader}} r left join {{counters}} k using ({N4}) left join {{rebate}} b using ({N4}) "
    f"left join (select {N4}, CustomerType, CustomerTypeDescription, AccountNumber from {{customer}} where lower(CustomerType) = 'dc') c using ({N4})",
)
def _(t):
    with_stages(t, "lineitemderived")
    return publish.publish_retailheader(
        t["retailheader"], t["lineitemderived"], t["sale"], t["return"], t["modifier"], t["customer"]
    )


@query("publish_modifiers", "select " + ", ".join(publish.MODIFIER_COLUMNS) + " from {modifier}")
def _(t):
    return publish.publish_modifiers(t["modifier"])


@query(
    "publish_salereturn",
    "select m.* replace (d.id as ItemType), st.IsEBUSStore from {resolved} m join {stores} st on st.StoreID = m.RetailStoreID left join "
    + dictionary_sql("ItemType", "{merged}") + " d on m.ItemType = d.text_",
)
def _(t):
    out, _ = publish.publish_salereturn(
        t["sale"], t["return"], t["articles"], t["stores"], dictionaries(t, "ItemType"), lookup_store(t)
    )
    return out


@query(
    "publish_tender",
    f"select {NL5}, y.id as TypeCode, i.id as TenderID, Amount, TenderChangeType, TenderChangeID, TenderChangeAmount, c.id as CardType, PrimaryAccountNumber, Cashback, "
    "IssuerIdentificationNumber, SerialNumber, cast(null as int) as Tip from {tender} t left join " + dictionary_sql("TypeCode", "{tender}")
    + " y on t.TypeCode = y.text_ left join " + dictionary_sql("TenderID", "{tender}") + " i on t.TenderID = i.text_ left join "
    + dictionary_sql("CardType", "{tender}") + " c on t.CardType = c.text_",
)
def _(t):
    out, _ = publish.publish_tender(t["tender"], dictionaries(t, "CardType", "TypeCode", "TenderID"), lookup_store(t))
    return out


@query(
    "publish_masterdata",
    "select SAP_ID, EAN, Unit, MerchandiseHierarchyLevel_Main, MerchandiseHierarchyLevel_EBUS, Description as ArticleDescription from {articles}",
)
def _(t):
    return publish.publish_articles(t["articles"])
