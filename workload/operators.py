"""Relational operators on the receipt model: filters, joins, aggregates, windows, sets,
scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillsight.functions import scalars
from tillsight.functions.keys import LINE, LINE_BY_NUMBER, RECEIPT
from tillsight.functions.rules import Rule, first_match
from tillsight.operators.dedup import first_per_key, top_per_key
from tillsight.operators.joins import anti_by_null, linked_lines, lookup_chain, pivot_values, with_presence
from tillsight.operators.ordered import as_of, balanced_bucket, global_row_number, next_row, running_position, time_bucket
from tillsight.plans import control, reports
from tillsight.plans.pricelookup import article_by_code
from tillsight.plans.receiptvoid import CARD_TENDERS, void_kind
from tillsight.sources.lookups import TRANSACTION_TYPE
from workload.registry import query
from workload.stages import stage

KEY = "RetailStoreID, WorkstationID, SequenceNumber"
KEYS = KEY.split(", ")

# -- projections and predicates ---------------------------------------------------------


@query(
    "project_rename",
    f"select {KEY}, EmployeeID as Cashier, ReceiptDateTime as SoldAt, cast(TrainingModeFlag as int) as Training from {{receipt}}",
)
def _(t):
    return t["receipt"].select(*KEYS, "EmployeeID", "ReceiptDateTime", "TrainingModeFlag").withColumnsRenamed(
        {"EmployeeID": "Cashier", "ReceiptDateTime": "SoldAt"}
    ).withColumn("Training", F.col("TrainingModeFlag").cast("int")).drop("TrainingModeFlag")


@query(
    "filter_conj",
    f"select {KEY}, ParameterValue from {{functionlog}} where FunctionID = 12 and FunctionName = 'X_ARTICLE_INFORMATION' and ParameterName = 'ITEM_EAN'",
)
def _(t):
    return t["functionlog"].where(
        (F.col("FunctionID") == 12) & (F.col("FunctionName") == "X_ARTICLE_INFORMATION")
        & (F.col("ParameterName") == "ITEM_EAN")
    ).select(*KEYS, "ParameterValue")


@query(
    "filter_in",
    f"select {KEY}, TenderID, Amount from {{tender}} where TenderID in ('" + "', '".join(CARD_TENDERS) + "') and TenderType not in ('Cash')",
)
def _(t):
    return t["tender"].where(F.col("TenderID").isin(CARD_TENDERS) & ~F.col("TenderType").isin("Cash")).select(
        *KEYS, "TenderID", "Amount"
    )


@query(
    "class_prefix_group",
    "select case when class_id like 'AA%' or class_id like 'EA%' or class_id like 'CA%' then '1' when class_id like 'AN%' "
    "or class_id like 'EN%' or class_id like 'CN%' then '0' else 'I' end as kind, count(*) as n from {classification} group by 1",
)
def _(t):
    return stage(t, "classification").groupBy(void_kind("class_id").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("filter_ci", f"select {KEY}, CustomerType from {{customer}} where CustomerType in ('DC', 'dc', 'Dc', 'dC')")
def _(t):
    return t["customer"].where(scalars.equals_ignore_case("CustomerType", "dc")).select(*KEYS, "CustomerType")


@query("filter_null_safe", f"select {KEY}, CardType from {{tender}} where CardType <> 'Debit' or CardType is null")
def _(t):
    return t["tender"].where(scalars.differs("CardType", "Debit")).select(*KEYS, "CardType")


@query(
    "filter_compound",
    f"select {KEY}, ParameterName from {{functionlog}} where (FunctionID = 89 and FunctionName = 'X_PAUSE') "
    "or (FunctionName = 'X_ARTICLE_INFORMATION' and ParameterName in ('ITEM_EAN', 'BEGIN', 'END'))",
)
def _(t):
    name = F.col("FunctionName")
    pause = (F.col("FunctionID") == 89) & (name == "X_PAUSE")
    lookup = (name == "X_ARTICLE_INFORMATION") & F.col("ParameterName").isin("ITEM_EAN", "BEGIN", "END")
    return t["functionlog"].where(pause | lookup).select(*KEYS, "ParameterName")


@query("having_filter", "select RetailStoreID, EmployeeID, count(*) as n from {receipt} group by 1, 2 having count(*) > 100")
def _(t):
    return t["receipt"].groupBy("RetailStoreID", "EmployeeID").agg(F.count(F.lit(1)).alias("n")).where("n > 100")


@query(
    "case_rules",
    f"select {KEY}, LineItemSequenceNumber, case when VoidFlag and DirectVoidFlag then 'PF+SO' when VoidFlag then 'PF+ZS' "
    "when Amount < 0 then null else case when EntryMethod = 'Keyed' then 'K' else 'S' end end as kind from {lineitem}",
)
def _(t):
    rules = [
        Rule("PF+SO", F.col("VoidFlag") & F.col("DirectVoidFlag")),
        Rule("PF+ZS", F.col("VoidFlag")),
        Rule(F.lit(None).cast("string"), F.col("Amount") < 0),
        Rule("K", F.col("EntryMethod") == "Keyed"),
    ]
    return t["lineitem"].select(*KEYS, "LineItemSequenceNumber", first_match(rules, "S").alias("kind"))


# -- joins ------------------------------------------------------------------------------


@query(
    "join_inner_composite",
    "select $L5, l.VoidFlag, r.ItemType from {lineitem} l join {return} r using ($L5)",
)
def _(t):
    return t["lineitem"].select(*LINE, "VoidFlag").join(t["return"].select(*LINE, "ItemType"), LINE)


@query(
    "join_left_chain",
    "select $R4, h.TransactionType, r.TransactionGrandAmount, t.change, l.lines from {header} h "
    "left join {retailheader} r using ($R4) left join (select $R4, sum(TenderChangeAmount) as change from {tender} group by $R4) t using ($R4) "
    "left join (select $R4, count(*) as lines from {lineitem} group by $R4) l using ($R4)",
)
def _(t):
    change = t["tender"].groupBy(*RECEIPT).agg(F.sum("TenderChangeAmount").alias("change"))
    lines = t["lineitem"].groupBy(*RECEIPT).agg(F.count(F.lit(1)).alias("lines"))
    return (
        t["header"].select(*RECEIPT, "TransactionType")
        .join(t["retailheader"].select(*RECEIPT, "TransactionGrandAmount"), RECEIPT, "left")
        .join(change, RECEIPT, "left")
        .join(lines, RECEIPT, "left")
    )


@query(
    "join_full_outer",
    "select coalesce(a.EAN, b.POSItemID) as code, a.n as articles, b.n as booked from "
    "(select EAN, count(*) as n from {articles} group by EAN) a full join (select POSItemID, count(*) as n from {sale} group by POSItemID) b on a.EAN = b.POSItemID",
)
def _(t):
    a = t["articles"].groupBy(F.col("EAN").alias("code")).agg(F.count(F.lit(1)).alias("articles"))
    b = t["sale"].groupBy(F.col("POSItemID").alias("code")).agg(F.count(F.lit(1)).alias("booked"))
    return a.join(b, "code", "full")


@query("join_anti", "select $R4 from {retailheader} r where not exists (select 1 from {tender} t where t.SequenceNumber = r.SequenceNumber and t.RetailStoreID = r.RetailStoreID and t.WorkstationID = r.WorkstationID and t.ReceiptDateTime = r.ReceiptDateTime)")
def _(t):
    return t["retailheader"].select(*RECEIPT).join(t["tender"].select(*RECEIPT), RECEIPT, "left_anti")


@query("join_anti_null", "select $L5 from {lineitem} l left join (select distinct $L5, 1 as x from {sale}) s using ($L5) where s.x is null")
def _(t):
    return anti_by_null(t["lineitem"].select(*LINE), t["sale"], LINE)


@query(
    "join_semi_flag",
    "select $R4, r.TransactionGrandAmount, h.x is not null as parked from {retailheader} r left join (select distinct $R4, 1 as x from {headeraddon}) h using ($R4)",
)
def _(t):
    return with_presence(t["retailheader"].select(*RECEIPT, "TransactionGrandAmount"), t["headeraddon"], RECEIPT, "parked")


@query("kv_pivot", "select * from {slip}")
def _(t):
    names = {"RECEIPT_NUMBER": "EmptiesReceiptNumber", "STORE_NUMBER": "EmptiesStoreID", "WORKSTATION_ID": "EmptiesWorkstationID"}
    return pivot_values(t["addon"], LINE_BY_NUMBER, "AddonKey", "AddonValue", names, carry=["SequenceNumber"])


@query(
    "join_self_link",
    "select distinct $R4, Link as LineItemSequenceNumber from {position} where VoidFlag and Link is not null",
)
def _(t):
    return linked_lines(t["position"], RECEIPT, "LineItemSequenceNumber", "Link", F.col("VoidFlag"))


@query(
    "join_range_later",
    "select RetailStoreID, WorkstationID, SequenceNumber, ReceiptDateTime, FollowTime, row_num, item_match, TrnAmtMatch from {matches} where row_num <= 10",
)
def _(t):
    from tillsight.plans.receiptvoid import followup_matches

    return followup_matches(stage(t, "booked"))


_ASOF = (
    "select e.event_id, e.ReceiptDateTime, x.SequenceNumber, x.at_time from (select e as event_id, RetailStoreID, WorkstationID, ReceiptDateTime, Date from {{logevent}}) e "
    "left join lateral (select r.SequenceNumber, r.ReceiptDateTime as at_time from {{receipt}} r where r.RetailStoreID = e.RetailStoreID "
    "and r.WorkstationID = e.WorkstationID and r.Date = e.Date and r.ReceiptDateTime {op} e.ReceiptDateTime order by r.ReceiptDateTime {dir}, r.SequenceNumber {dir} limit 1) x on true"
)


def _as_of(t, direction):
    events = t["logevent"].select(F.col("e").alias("event_id"), "RetailStoreID", "WorkstationID", "ReceiptDateTime", "Date")
    receipts = t["receipt"].select(
        "RetailStoreID", "WorkstationID", "SequenceNumber", F.col("ReceiptDateTime").alias("at_time"), "Date"
    )
    return as_of(
        events, receipts, ["RetailStoreID", "WorkstationID", "Date"], "ReceiptDateTime", "at_time",
        ["SequenceNumber"], direction,
    ).select("event_id", "ReceiptDateTime", "SequenceNumber", "at_time")


@query("asof_next", _ASOF.replace("{{", "{").replace("}}", "}").replace("{op}", ">").replace("{dir}", "asc"))
def _(t):
    return _as_of(t, "next")


@query("asof_prev", _ASOF.replace("{{", "{").replace("}}", "}").replace("{op}", "<").replace("{dir}", "desc"))
def _(t):
    return _as_of(t, "prev")


@query(
    "followup_next",
    f"select {KEY}, ReceiptDateTime, lead(SequenceNumber) over w as next_sequence, lead(ReceiptDateTime) over w as next_time "
    "from {receipt} window w as (partition by RetailStoreID, WorkstationID order by ReceiptDateTime, SequenceNumber)",
)
def _(t):
    rows = t["receipt"].select(*KEYS, "ReceiptDateTime")
    out = next_row(
        rows, ["RetailStoreID", "WorkstationID"], ["ReceiptDateTime", "SequenceNumber"],
        time_bucket("ReceiptDateTime"), ["SequenceNumber", "ReceiptDateTime"], "next",
    )
    return out.select(
        *rows.columns, F.col("next")["SequenceNumber"].alias("next_sequence"),
        F.col("next")["ReceiptDateTime"].alias("next_time"),
    )


@query(
    "join_same_day_neq",
    "select p.RetailStoreID, p.AddonValue, p.ReceiptNumber as parked, f.ReceiptNumber as fetched from {headeraddon} p join {headeraddon} f "
    "on f.RetailStoreID = p.RetailStoreID and f.AddonValue = p.AddonValue and cast(f.ReceiptDateTime as date) = cast(p.ReceiptDateTime as date) "
    "and f.ReceiptNumber <> p.ReceiptNumber where p.AddonKey = 'PARK_NUMBER' and f.AddonKey = 'SERVER_PARKING_FETCHED_NUMBER'",
)
def _(t):
    rows = t["headeraddon"].withColumn("day", F.to_date("ReceiptDateTime"))
    spot = ["RetailStoreID", "AddonValue", "day"]
    parked = rows.where("AddonKey = 'PARK_NUMBER'").select(*spot, F.col("ReceiptNumber").alias("parked"))
    fetched = rows.where("AddonKey = 'SERVER_PARKING_FETCHED_NUMBER'").select(*spot, F.col("ReceiptNumber").alias("fetched"))
    return parked.join(fetched, spot).where("parked <> fetched").drop("day")


@query(
    "join_post_void",
    "select v.SequenceNumber as voiding, v.ReceiptDateTime as voided_at, o.SequenceNumber as original, o.TransactionGrandAmount from {retailheader} v "
    "join {retailheader} o on v.TransactionLinkRetailStoreID = o.RetailStoreID and v.TransactionLinkWorkstationID = o.WorkstationID "
    "and v.TransactionLinkSequenceNumber = o.SequenceNumber and v.TransactionLinkReceiptDateTime = o.ReceiptDateTime where v.TransactionStatus = 'PostVoided'",
)
def _(t):
    h = t["retailheader"]
    voiding = h.where("TransactionStatus = 'PostVoided'").select(
        F.col("TransactionLinkRetailStoreID").alias("RetailStoreID"),
        F.col("TransactionLinkWorkstationID").alias("WorkstationID"),
        F.col("TransactionLinkSequenceNumber").alias("SequenceNumber"),
        F.col("TransactionLinkReceiptDateTime").alias("ReceiptDateTime"),
        F.col("SequenceNumber").alias("voiding"), F.col("ReceiptDateTime").alias("voided_at"),
    )
    return voiding.join(h.select(*RECEIPT, "TransactionGrandAmount"), RECEIPT).select(
        "voiding", "voided_at", F.col("SequenceNumber").alias("original"), "TransactionGrandAmount"
    )


@query(
    "join_conditional_key",
    "select s.StoreID, a.SAP_ID, h.DescriptionDE from {stores} s cross join {articles} a left join {hierarchy} h on h.MerchandiseHierarchyLevel = "
    "case when s.IsEBUSStore then a.MerchandiseHierarchyLevel_EBUS else a.MerchandiseHierarchyLevel_Main end and h.IsEBUS = cast(s.IsEBUSStore as int) "
    "where s.StoreID = a.SAP_ID % 12",
)
def _(t):
    pairs = t["articles"].join(t["stores"], F.col("SAP_ID") % 12 == F.col("StoreID"))
    level = F.when(F.col("IsEBUSStore"), F.col("MerchandiseHierarchyLevel_EBUS")).otherwise(
        F.col("MerchandiseHierarchyLevel_Main")
    )
    groups = t["hierarchy"].select("MerchandiseHierarchyLevel", "DescriptionDE", (F.col("IsEBUS") == 1).alias("_e"))
    keyed = pairs.withColumn("_level", level)
    return keyed.join(
        groups,
        (F.col("_level") == F.col("MerchandiseHierarchyLevel")) & (F.col("IsEBUSStore") == F.col("_e")),
        "left",
    ).select("StoreID", "SAP_ID", "DescriptionDE")


@query(
    "join_fallback",
    "select p.k as order_key, p.n as line, coalesce(a.d, b.d) as description from {position} p "
    "left join (select EAN, min(Description) as d from {articles} where Unit = 'ST' group by EAN) a on p.POSItemID = a.EAN "
    "left join (select SAP_ID, min(Description) as d from {articles} group by SAP_ID) b on p.ItemID = b.SAP_ID",
)
def _(t):
    by_code = t["articles"].where("Unit = 'ST'").groupBy("EAN").agg(F.min("Description").alias("d"))
    by_id = t["articles"].groupBy("SAP_ID").agg(F.min("Description").alias("d"))
    rows = t["position"].select(F.col("k").alias("order_key"), F.col("n").alias("line"), "POSItemID", "ItemID")
    return lookup_chain(
        rows, [("POSItemID", by_code, "EAN", "d"), ("ItemID", by_id, "SAP_ID", "d")], "description"
    ).select("order_key", "line", "description")


@query(
    "join_cross_summary",
    "select a.TransactionType, a.n, b.lines, b.amount from (select TransactionType, count(*) as n from {header} group by 1) a "
    "cross join (select count(*) as lines, cast(sum(cast(round(Amount, 2) as decimal(20,2))) as double) as amount from {lineitem}) b",
)
def _(t):
    kinds = t["header"].groupBy("TransactionType").agg(F.count(F.lit(1)).alias("n"))
    totals = t["lineitem"].agg(F.count(F.lit(1)).alias("lines"), F.sum(scalars.money("Amount")).cast("double").alias("amount"))
    return kinds.crossJoin(totals)


@query(
    "join_using",
    "select RetailStoreID, s.SequenceNumber, s.LineItemSequenceNumber, s.ExtendedAmount, st.IsEBUSStore from {sale} s join (select StoreID as RetailStoreID, IsEBUSStore from {stores}) st using (RetailStoreID)",
)
def _(t):
    st = t["stores"].select(F.col("StoreID").alias("RetailStoreID"), "IsEBUSStore")
    return t["sale"].select("RetailStoreID", "SequenceNumber", "LineItemSequenceNumber", "ExtendedAmount").join(st, ["RetailStoreID"])


# -- aggregates -------------------------------------------------------------------------


@query(
    "agg_conditional_count",
    "select RetailStoreID, Date as day, count(case when TransactionType = 'RetailTransaction' then 1 end) as retail, "
    "count(case when TransactionType = 'ControlTransaction' then 1 end) as control, count(case when CancelFlag then 1 end) as cancelled from {header} group by 1, 2",
)
def _(t):
    return t["header"].groupBy("RetailStoreID", F.col("Date").alias("day")).agg(
        F.count_if(F.col("TransactionType") == "RetailTransaction").alias("retail"),
        F.count_if(F.col("TransactionType") == "ControlTransaction").alias("control"),
        F.count_if("CancelFlag").alias("cancelled"),
    )


@query(
    "agg_conditional_sum",
    "select $R4, cast(sum(cast(round(case when VoidFlag then 0 else Amount end, 2) as decimal(20,2))) as double) as live, cast(sum(cast(round(case when VoidFlag then Amount end, 2) as decimal(20,2))) as double) as void from {lineitem} group by $R4",
)
def _(t):
    void = F.col("VoidFlag")
    return t["lineitem"].groupBy(*RECEIPT).agg(
        F.sum(scalars.money(F.when(void, 0.0).otherwise(F.col("Amount")))).cast("double").alias("live"),
        F.sum(scalars.money(F.when(void, F.col("Amount")))).cast("double").alias("void"),
    )


@query(
    "agg_ratio",
    "select $R4, count(case when EntryMethod = 'Keyed' and not VoidFlag then 1 end) * 1e0 / nullif(count(case when not VoidFlag then 1 end), 0) as ratio, "
    "count(case when EntryMethod = 'Keyed' then 1 end) = count(*) as whole from {lineitem} group by $R4",
)
def _(t):
    keyed, live = F.col("EntryMethod") == "Keyed", ~F.col("VoidFlag")
    ratio = F.count_if(keyed & live).cast("double") / F.nullif(F.count_if(live), F.lit(0))
    all_keyed = F.count_if(keyed).cast("double") / F.count(F.lit(1))
    return t["lineitem"].groupBy(*RECEIPT).agg(ratio.alias("ratio"), (all_keyed.cast("int") == 1).alias("whole"))


@query("agg_min_max", "select RetailStoreID, WorkstationID, min(ReceiptDateTime) as first_at, max(ReceiptDateTime) as last_at, max(SequenceNumber) as top from {receipt} group by 1, 2")
def _(t):
    return t["receipt"].groupBy("RetailStoreID", "WorkstationID").agg(
        F.min("ReceiptDateTime").alias("first_at"), F.max("ReceiptDateTime").alias("last_at"),
        F.max("SequenceNumber").alias("top"),
    )


@query("agg_max_string", "select RetailStoreID, AddonKey, max(AddonValue) as AddonValue from {headeraddon} group by 1, 2")
def _(t):
    return t["headeraddon"].groupBy("RetailStoreID", "AddonKey").agg(F.max("AddonValue").alias("AddonValue"))


@query("agg_count_vs_distinct", "select $R4, count(Amount) > count(distinct Amount) as repeated from {lineitem} group by $R4")
def _(t):
    return t["lineitem"].groupBy(*RECEIPT).agg(
        (F.count("Amount") > F.count_distinct("Amount")).alias("repeated")
    )


@query(
    "agg_match_ratio",
    "select RetailStoreID, POSItemID, count(case when VoidFlag then 1 end) * 1e0 / count(distinct SequenceNumber) as voids_per_receipt from {position} group by 1, 2",
)
def _(t):
    return t["position"].groupBy("RetailStoreID", "POSItemID").agg(
        (F.count_if("VoidFlag").cast("double") / F.count_distinct("SequenceNumber")).alias("voids_per_receipt")
    )


@query(
    "agg_coalesced_sum",
    "select RetailStoreID, coalesce(ReferenceID, 0) as ReferenceID, coalesce(RuleDescription, '0') as RuleDescription, sum(PointsAwarded) as points from {loyalty} group by 1, 2, 3",
)
def _(t):
    return t["loyalty"].groupBy(
        "RetailStoreID", F.coalesce("ReferenceID", F.lit(0)).alias("ReferenceID"),
        F.coalesce("RuleDescription", F.lit("0")).alias("RuleDescription"),
    ).agg(F.sum("PointsAwarded").alias("points"))


@query(
    "agg_before_join",
    "select $R4, r.TransactionGrandAmount, t.change from {retailheader} r left join (select $R4, sum(TenderChangeAmount) as change from {tender} group by $R4) t using ($R4)",
)
def _(t):
    change = t["tender"].groupBy(*RECEIPT).agg(F.sum("TenderChangeAmount").alias("change"))
    return t["retailheader"].select(*RECEIPT, "TransactionGrandAmount").join(change, RECEIPT, "left")


@query(
    "agg_all_any_flags",
    "select $R4, bool_and(EntryMethod = 'Scanned') as all_scanned, bool_or(VoidFlag) as any_void from {lineitem} group by $R4",
)
def _(t):
    return t["lineitem"].groupBy(*RECEIPT).agg(
        F.bool_and(F.col("EntryMethod") == "Scanned").alias("all_scanned"), F.bool_or("VoidFlag").alias("any_void")
    )


@query("agg_distribution", 'select class_id, count(*) as "count" from {classification} group by class_id')
def _(t):
    return reports.class_distribution(stage(t, "classification"))


@query("agg_distinct_count", "select count(distinct coalesce(class_id, '')) as classes from {classification}")
def _(t):
    return stage(t, "classification").agg(F.count_distinct(F.coalesce("class_id", F.lit(""))).alias("classes"))


@query("next_load_id", "select coalesce(max(o_custkey), 0) + 1 as LoadID from orders")
def _(t):
    return control.next_load_id(t.base("orders").select(F.col("o_custkey").alias("LoadID")))


@query("agg_last_line", "select $R4, max(LineItemSequenceNumber) as last_line, arg_max(EntryMethod, LineItemSequenceNumber) as how from {lineitem} group by $R4")
def _(t):
    return t["lineitem"].groupBy(*RECEIPT).agg(
        F.max("LineItemSequenceNumber").alias("last_line"),
        F.max_by("EntryMethod", "LineItemSequenceNumber").alias("how"),
    )


# -- windows, order, sets ---------------------------------------------------------------


@query(
    "win_row_number",
    f"select {KEY}, EmployeeID, row_number() over (partition by RetailStoreID, EmployeeID, Date order by ReceiptDateTime, SequenceNumber) as row_id from {{receipt}}",
)
def _(t):
    rows = t["receipt"].select(*KEYS, "EmployeeID", "Date", "ReceiptDateTime")
    return running_position(
        rows, ["RetailStoreID", "EmployeeID", "Date"], ["ReceiptDateTime", "SequenceNumber"],
        balanced_bucket(rows, ["RetailStoreID", "EmployeeID"], ["ReceiptDateTime", "SequenceNumber"]), "row_id",
    ).drop("Date", "ReceiptDateTime")


@query(
    "win_dense_rank",
    "select $L5, dense_rank() over (partition by RetailStoreID, WorkstationID, cast(ReceiptDateTime as date) order by ReceiptDateTime) as row_id from {lineitem}",
)
def _(t):
    rows = t["lineitem"].select(*LINE, F.to_date("ReceiptDateTime").alias("day"))
    bucket = balanced_bucket(rows, ["RetailStoreID", "WorkstationID"], ["ReceiptDateTime"])
    return running_position(
        rows, ["RetailStoreID", "WorkstationID", "day"], ["ReceiptDateTime"], bucket, "row_id", dense=True
    ).drop("day")


@query(
    "win_running_order",
    "select $L5, row_number() over (partition by RetailStoreID, WorkstationID order by ReceiptDateTime, SequenceNumber, LineItemSequenceNumber) as row_id from {lineitem}",
)
def _(t):
    rows, lane = t["lineitem"].select(*LINE), ["RetailStoreID", "WorkstationID"]
    order = ["ReceiptDateTime", "SequenceNumber", "LineItemSequenceNumber"]
    return running_position(rows, lane, order, balanced_bucket(rows, lane, order), "row_id")


@query(
    "win_over_agg",
    "select RetailStoreID, POSItemID, n, row_number() over (partition by RetailStoreID order by n desc, POSItemID) as place "
    "from (select RetailStoreID, POSItemID, count(*) as n from {sale} group by 1, 2) q",
)
def _(t):
    counts = t["sale"].groupBy("RetailStoreID", "POSItemID").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("RetailStoreID").orderBy(F.desc("n"), "POSItemID"))
    return counts.withColumn("place", place)


@query("win_first_per_group", "select EAN, MerchandiseHierarchyLevel_Main, MerchandiseHierarchyLevel_EBUS, ArticleDescription from {codes}")
def _(t):
    return article_by_code(t["articles"])


@query(
    "win_last_per_group",
    f"select {KEY}, EmployeeID, ReceiptDateTime from (select *, row_number() over (partition by RetailStoreID, WorkstationID, Date, EmployeeID order by ReceiptDateTime desc, SequenceNumber desc) as pick from {{receipt}}) q where pick = 1",
)
def _(t):
    last = first_per_key(
        t["receipt"], ["RetailStoreID", "WorkstationID", "Date", "EmployeeID"],
        [F.col("ReceiptDateTime").desc(), F.col("SequenceNumber").desc()],
    )
    return last.select(*KEYS, "EmployeeID", "ReceiptDateTime")


@query("win_global_number", "select c_name, row_number() over (order by substring(md5(c_name), 1, 3), c_name) as id from (select distinct c_name from customer) q")
def _(t):
    return global_row_number(t.base("customer").select("c_name").distinct(), "c_name", "id")


@query(
    "win_moving_avg",
    "select RetailStoreID, day, n, avg(n) over (partition by RetailStoreID, dayofweek(day) order by day rows between 7 preceding and current row) as average from (select RetailStoreID, Date as day, count(*) as n from {receipt} group by 1, 2) q",
)
def _(t):
    days = t["receipt"].groupBy("RetailStoreID", F.col("Date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("RetailStoreID", F.dayofweek("day")).orderBy("day").rowsBetween(-7, 0)
    return days.withColumn("average", F.avg("n").over(w))


@query("sort_multi", f"select {KEY}, TransactionGrandAmount from {{retailheader}} order by TransactionGrandAmount desc, {KEY}")
def _(t):
    return t["retailheader"].select(*KEYS, "TransactionGrandAmount").orderBy(F.desc("TransactionGrandAmount"), *KEYS)


@query(
    "topk_per_group",
    f"select {KEY}, TransactionGrandAmount, place from (select {KEY}, TransactionGrandAmount, row_number() over (partition by RetailStoreID order by TransactionGrandAmount desc, SequenceNumber) as place from {{retailheader}}) q where place <= 10",
)
def _(t):
    rows = t["retailheader"].select(*KEYS, "TransactionGrandAmount")
    return top_per_key(rows, ["RetailStoreID"], [F.desc("TransactionGrandAmount"), "SequenceNumber"], 10, "place")


@query("limit_one", f"select {KEY}, TransactionGrandAmount from {{retailheader}} order by TransactionGrandAmount desc, {KEY} limit 1")
def _(t):
    rows = t["retailheader"].select(*KEYS, "TransactionGrandAmount")
    return rows.orderBy(F.desc("TransactionGrandAmount"), *KEYS).limit(1)


@query("set_union_all", "select $L5, ExtendedAmount from {sale} union all select $L5, ExtendedAmount from {return}")
def _(t):
    return t["sale"].select(*LINE, "ExtendedAmount").unionByName(t["return"].select(*LINE, "ExtendedAmount"))


@query("set_union_distinct", "select RetailStoreID, POSItemID, ExtendedAmount from {sale} union select RetailStoreID, POSItemID, ExtendedAmount from {return}")
def _(t):
    cols = ["RetailStoreID", "POSItemID", "ExtendedAmount"]
    return t["sale"].select(*cols).unionByName(t["return"].select(*cols)).distinct()


@query(
    "set_union_nullpad",
    f"select {KEY}, TransactionGrandAmount, cast(null as varchar) as NoSale from {{retailheader}} union all select {KEY}, null, NoSale from {{control}}",
)
def _(t):
    return t["retailheader"].select(*KEYS, "TransactionGrandAmount").unionByName(
        t["control"].select(*KEYS, "NoSale"), allowMissingColumns=True
    )


# -- scalar functions -------------------------------------------------------------------


@query(
    "str_slice_price",
    "select k as order_key, n as line, try_cast(left(right(cast(POSItemID as varchar), 6), 5) as int) / 100e0 as price from {position}",
)
def _(t):
    return t["position"].select(
        F.col("k").alias("order_key"), F.col("n").alias("line"), scalars.embedded_price("POSItemID").alias("price")
    )


def _slip_sql():
    from oracle.rules import slip_text

    return f"select {KEY}, " + slip_text("RetailStoreID", "WorkstationID", "ReceiptNumber", "TransactionGrandAmount") + " as id from {retailheader}"


@query("str_composite_id", _slip_sql())
def _(t):
    return t["retailheader"].select(
        *KEYS, scalars.slip_id("RetailStoreID", "WorkstationID", "ReceiptNumber", "TransactionGrandAmount").alias("id")
    )


@query("str_receipt_key", "select cast(RetailStoreID as varchar) || ':' || cast(WorkstationID as varchar) || ':' || cast(SequenceNumber as varchar) as receipt_key from {receipt}")
def _(t):
    return t["receipt"].select(scalars.receipt_key_text(KEYS).alias("receipt_key"))


@query("str_split_part", "select p_partkey, split_part(p_brand, '#', 2) as brand_no, split_part(p_name, ' ', 1) as first_word from part")
def _(t):
    return t.base("part").select(
        "p_partkey", F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("brand_no"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first_word"),
    )


@query("null_coalesce", "select k as order_key, n as line, coalesce(Units, 1e0) as units, coalesce(Link, -1) as link from {position}")
def _(t):
    return t["position"].select(
        F.col("k").alias("order_key"), F.col("n").alias("line"),
        F.coalesce("Units", F.lit(1.0)).alias("units"), F.coalesce("Link", F.lit(-1)).alias("link"),
    )


@query(
    "null_fill",
    "select k as order_key, n as line, coalesce(Link, 0) as link, nullif(pk % 4, 0) as code from {position}",
)
def _(t):
    return t["position"].select(
        F.col("k").alias("order_key"), F.col("n").alias("line"), F.col("Link").alias("link"),
        F.nullif(F.col("pk") % 4, F.lit(0)).alias("code"),
    ).fillna({"link": 0})


@query(
    "math_tolerance",
    "select k as order_key, n as line, abs(cast(round(RegularSalesUnitPrice * Quantity, 2) as decimal(20,2)) - cast(round(ExtendedAmount, 2) as decimal(20,2))) > 0.02 as off from {position}",
)
def _(t):
    return t["position"].select(
        F.col("k").alias("order_key"), F.col("n").alias("line"),
        scalars.outside_tolerance(F.col("RegularSalesUnitPrice") * F.col("Quantity"), "ExtendedAmount").alias("off"),
    )


@query("cast_decimal", "select k as order_key, n as line, cast(ExtendedAmount as decimal(20,2)) as amount, cast(POSItemID as decimal(22,0)) as code from {position}")
def _(t):
    return t["position"].select(
        F.col("k").alias("order_key"), F.col("n").alias("line"),
        F.col("ExtendedAmount").cast("decimal(20,2)").alias("amount"), F.col("POSItemID").cast("decimal(22,0)").alias("code"),
    )


@query("math_signed_amount", "select $L5, case when NegativeAmountFlag then -Amount else Amount end as signed from {lineitem}")
def _(t):
    return t["lineitem"].select(*LINE, scalars.signed_amount("Amount", "NegativeAmountFlag").alias("signed"))


@query(
    "date_parse_format",
    "select o_orderkey, strftime(o_orderdate, '%Y%m%d') as text_day, cast(o_orderdate as date) as day, strftime(o_orderdate, '%Y-%m') as month from orders",
)
def _(t):
    text = F.date_format("o_orderdate", "yyyyMMdd")
    return t.base("orders").select(
        "o_orderkey", text.alias("text_day"), F.to_date(text, "yyyyMMdd").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )


@query("date_prev_day", "select $R4, cast(ReceiptDateTime as date) - 1 as previous_day from {receipt}")
def _(t):
    return t["receipt"].select(*RECEIPT, F.date_sub(F.to_date("ReceiptDateTime"), 1).alias("previous_day"))


@query(
    "date_minute_diff",
    "select SequenceNumber, abs(epoch(ReceiptDateTime) - epoch(TransactionLinkReceiptDateTime)) / 60e0 as minutes from {retailheader} where TransactionStatus = 'PostVoided'",
)
def _(t):
    return t["retailheader"].where("TransactionStatus = 'PostVoided'").select(
        "SequenceNumber", scalars.minutes_between("ReceiptDateTime", "TransactionLinkReceiptDateTime").alias("minutes")
    )


@query(
    "map_literal_lookup",
    f"select {KEY}, case TransactionType when 'ControlTransaction' then 0 when 'FunctionLog' then 1 when 'RetailTransaction' then 2 when 'TenderControlTransaction' then 3 end as code from {{header}}",
)
def _(t):
    return t["header"].select(*KEYS, scalars.literal_map("TransactionType", TRANSACTION_TYPE).alias("code"))
