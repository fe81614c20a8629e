"""The receipt audits in SQL, written from the rule definitions and without the
reductions the Spark plans use (line-by-line joins, range joins, plain windows)."""

from __future__ import annotations

R4 = "RetailStoreID, WorkstationID, SequenceNumber, ReceiptDateTime"
L5 = R4 + ", LineItemSequenceNumber"
N4 = "RetailStoreID, WorkstationID, ReceiptNumber, ReceiptDateTime"
NL5 = N4 + ", LineItemSequenceNumber"


def sql(text: str) -> str:
    for token, value in (("$NL5", NL5), ("$N4", N4), ("$L5", L5), ("$R4", R4)):
        text = text.replace(token, value)
    return text


EMPTIES = "('Deposit', 'DepositRefund')"

_LINKS = """
select $L5, ReceiptNumber, SaleItemLink as ItemLink from {sale}
union all select $L5, ReceiptNumber, ReturnItemLink from {return}
"""

_DERIVED = """
with links as (""" + _LINKS + """),
voids as (select distinct $R4, i.ItemLink as LineItemSequenceNumber
  from {lineitem} l join links i using ($L5) where l.VoidFlag and i.ItemLink is not null)
select l.*, case when i.ReceiptNumber is not null
  then coalesce(l.VoidFlag, false) or v.hit is not null end as VoidFlagDerived
from {lineitem} l left join links i using ($L5)
left join (select *, 1 as hit from voids) v using ($L5)
"""

_SLIP = """
select distinct a.RetailStoreID, a.WorkstationID, a.SequenceNumber, a.ReceiptNumber, a.ReceiptDateTime,
  a.LineItemSequenceNumber, a.AddonValue as EmptiesReceiptNumber, b.AddonValue as EmptiesStoreID,
  c.AddonValue as EmptiesWorkstationID
from {addon} a join {addon} b using ($NL5) join {addon} c using ($NL5)
where a.AddonKey = 'RECEIPT_NUMBER' and b.AddonKey = 'STORE_NUMBER' and c.AddonKey = 'WORKSTATION_ID'
"""

_MODNET = """
select $NL5,
  cast(sum(cast(round(case when AmountAction = 'Replace' then 0 when AmountAction = 'Subtract' then -AmountValue
    else AmountValue end, 2) as decimal(20,2))) as decimal(20,2)) as final_modifier,
  cast(sum(cast(round(case when AmountAction = 'Replace' then AmountValue else 0 end, 2) as decimal(20,2))) as decimal(20,2)) as Replace_amount,
  case when count(case when AmountAction = 'Replace' then 1 end) > 0 then 'With_Replace'
    else 'Without_Replace' end as action
from (select distinct * from {modifier}) m group by $NL5
"""

_ITEMS_N = """
select *, 'sale' as side from (select $L5, ReceiptNumber, ItemType, POSItemID, MerchandiseHierarchyLevel,
  RegularSalesUnitPrice, ExtendedAmount, Quantity, Units, MerchandiseStructureItemFlag from {sale}) s
union all
select *, 'return' as side from (select $L5, ReceiptNumber, ItemType, POSItemID, MerchandiseHierarchyLevel,
  RegularSalesUnitPrice, ExtendedAmount, Quantity, Units, MerchandiseStructureItemFlag from {return}) r
"""
_ITEMS = "select * exclude (ReceiptNumber) from {items_n}"


def off(expected: str) -> str:
    return (
        f"abs(cast(round({expected}, 2) as decimal(20,2)) - cast(round(ExtendedAmount, 2) as decimal(20,2)))"
        " > cast(0.02 as decimal(20,2))"
    )


_EXTRA = "coalesce(cast(final_modifier as double), 0e0)"
_WRONG = (
    "case when action = 'With_Replace' then "
    + off(f"cast(Replace_amount as double) * Quantity * coalesce(Units, 1e0) + {_EXTRA}")
    + " else "
    + off(f"RegularSalesUnitPrice * Quantity * coalesce(Units, 1e0) + {_EXTRA}")
    + " and "
    + off(
        "try_cast(left(right(cast(POSItemID as varchar), 6), 5) as integer) / 100e0 + " + _EXTRA
    )
    + " end"
)

_PRICE = """
select $L5, """ + _WRONG + """ as PriceError
from {lineitemderived} l join {items} i using ($L5)
left join {modnet} m using ($NL5)
"""

_RATIO_COLS = """
count(case when EntryMethod = 'Keyed' and MerchandiseStructureItemFlag and not VoidFlagDerived then 1 end) * 1e0
  / nullif(count(case when not VoidFlagDerived then 1 end), 0) as productgroupbookingsratio_Val,
count(case when EntryMethod = 'Keyed' and MerchandiseStructureItemFlag and VoidFlagDerived is not null then 1 end) * 1e0
  / nullif(count(VoidFlagDerived), 0) as productgroupbookingsratio_Val_ALL
"""

_RATIO = """
select h.RetailStoreID, h.WorkstationID, h.SequenceNumber, h.ReceiptDateTime, h.TransactionType, """ + _RATIO_COLS + """
from (select distinct $R4, TransactionType from {header} where TransactionType = 'RetailTransaction') h
left join {lineitemderived} l using ($R4)
left join {items} i using ($L5)
group by all
"""

_LINES = """
select l.*, i.* exclude (RetailStoreID, WorkstationID, SequenceNumber, ReceiptDateTime, LineItemSequenceNumber),
  p.PriceError, y.rewarded, s.has_slip
from {lineitemderived} l
left join {items} i using ($L5)
left join {price} p using ($L5)
left join (select distinct $L5, true as rewarded from {loyalty} where PointsAwarded is not null) y using ($L5)
left join (select distinct $NL5, true as has_slip from {slip}) s using ($NL5)
"""

_PER_RECEIPT = """
select $R4, """ + _RATIO_COLS + """,
  count(*) as n_lines,
  count(case when not VoidFlagDerived then 1 end) as n_live,
  count(case when not VoidFlagDerived and side = 'return' then 1 end) as n_live_ret,
  count(case when not VoidFlagDerived and side = 'sale' then 1 end) as n_live_sale,
  count(case when not VoidFlagDerived and e then 1 end) as n_live_e,
  count(case when not VoidFlagDerived and e and EntryMethod = 'Scanned' then 1 end) as n_live_e_scan,
  count(case when not VoidFlagDerived and g then 1 end) as n_live_g,
  count(case when e then 1 end) as n_e,
  count(case when not VoidFlagDerived and e and (Quantity > 1 or (EntryMethod = 'Keyed' and ExtendedAmount > 5)) then 1 end) as n_big,
  sum(cast(round(case when not VoidFlagDerived and e then ExtendedAmount end, 2) as decimal(20,2))) as e_total,
  count(distinct case when not VoidFlagDerived and e then ExtendedAmount end) as n_e_amounts,
  count(case when DirectVoidFlag then 1 end) as n_direct,
  count(case when VoidFlagDerived and DirectVoidFlag then 1 end) as n_vd,
  count(case when VoidFlagDerived and not DirectVoidFlag then 1 end) as n_vnd,
  count(case when VoidFlagDerived and not MerchandiseStructureItemFlag then 1 end) as n_vscan,
  count(case when not VoidFlagDerived and side = 'return' and MerchandiseHierarchyLevel = 83 then 1 end) as n_lot_ret,
  count(case when not VoidFlagDerived and side = 'sale' and MerchandiseHierarchyLevel = 83 then 1 end) as n_lot_sale,
  count(has_slip) as n_slip, count(rewarded) as n_points,
  count(case when PriceError then 1 end) as n_wrong,
  sum(cast(round(case when not VoidFlagDerived and side = 'return' then ExtendedAmount end, 2) as decimal(20,2))) as ret_total,
  sum(cast(round(case when not VoidFlagDerived and side = 'sale' then ExtendedAmount end, 2) as decimal(20,2))) as sale_total
from (select *, side = 'return' and ItemType in """ + EMPTIES + """ as e,
  side = 'return' and ItemType not in """ + EMPTIES + """ as g from {lines}) q
group by $R4
"""

_FACTS = """
select h.*, a.TransactionStatus, a.TransactionGrandAmount, a.NegativeTotalFlag, p.* exclude (RetailStoreID,
  WorkstationID, SequenceNumber, ReceiptDateTime), t.change, t.tendered, v.voided, st.IsEBUSStore,
  coalesce(a.TransactionLinkReasonCode = 'Voided' and a.TransactionStatus = 'PostVoided'
    and a.TransactionLinkRetailStoreID is not null, false) as is_post_void,
  coalesce(a.TransactionTaxAmount = 0 and a.NegativeTransactionTaxAmount is null, false) as untaxed
from (select $R4, FunctionLogStoreInfoID, TransactionType, max(cast(CancelFlag as int)) as cancel,
    max(cast(TrainingModeFlag as int)) as training
  from {header} group by $R4, FunctionLogStoreInfoID, TransactionType) h
left join {retailheader} a using ($R4)
left join {perreceipt} p using ($R4)
left join (select $R4, sum(TenderChangeAmount) as change, true as tendered from {tender} group by $R4) t using ($R4)
left join (select distinct TransactionLinkRetailStoreID as RetailStoreID, TransactionLinkWorkstationID as WorkstationID,
    TransactionLinkSequenceNumber as SequenceNumber, TransactionLinkReceiptDateTime as ReceiptDateTime, true as voided
  from {retailheader} where TransactionLinkReasonCode = 'Voided' and TransactionStatus = 'PostVoided') v using ($R4)
left join {stores} st on st.StoreID = h.RetailStoreID
"""


def _f(cond: str) -> str:
    return f"case when {cond} then 1 else 0 end"


FLAGS = {
    "Cancel_Flag": "coalesce(cancel, 0)",
    "TrainingMode_Flag": "coalesce(training, 0)",
    "Incorrect_receipt_Flag": _f(
        "abs(sale_total - ret_total) <> cast(round(TransactionGrandAmount, 2) as decimal(20,2)) or n_wrong > 0"
    ),
    "Void_flag": "case when is_post_void then 'Z' when voided then '1' else '0' end",
    "put_on_hold_Flag": _f("TransactionStatus in ('Suspended', 'SuspendedRetrieved')"),
    "empty_receipt_Flag": _f(
        "n_live_ret > 0 and tendered is null and n_live_e = n_live and n_slip = 0 and untaxed"
    ),
    "Receipt_withonlyScannedempties_flag": _f("n_live_ret > 0 and n_live_e_scan = n_live"),
    "With_CashBack_Flag": _f("change > 0 or NegativeTotalFlag"),
    "LoyaltyRewards_Flag": _f("TransactionStatus = 'Totaled' and n_points > 0 and n_lines = 1"),
    "Positive_total_Flag": _f("not NegativeTotalFlag and TransactionGrandAmount > 0"),
    "only_returns_Flag": _f("n_live_ret > 0 and n_live_g = n_live"),
    "only_EmptiesPayOut_withAllproductgroup_flag": _f(
        "n_live_ret > 0 and n_live_e = n_live and productgroupbookingsratio_Val >= 1"
    ),
    "Special_Empties_Flag": _f("n_big > 0 or e_total > 20 or n_live_e > n_e_amounts"),
    "mostlyproductgroupbookingsratio_Flag": _f(
        "productgroupbookingsratio_Val > 0.5 and productgroupbookingsratio_Val < 1"
    ),
    "only_EmptiesPayOut_withproductgroup_flag": _f(
        "n_live_ret > 0 and n_live_e = n_live and productgroupbookingsratio_Val > 0"
    ),
    "atleastoneemptiesreturn_Flag": _f("n_e >= 1"),
    "lineitemcancellation_nodirectvoid_Flag": _f("n_direct = 0 and n_vnd > 0"),
    "has_lineitemcancellation_nodirectvoid_Flag": _f("n_vnd > 0"),
    "lineitemcancellation_directvoid_Flag": _f("n_vd > 0"),
    "onlyproductgroupbooking_empty_Flag": _f("n_e > 0 and productgroupbookingsratio_Val >= 1"),
    "onlyproductgroupbooking_Flag": _f("productgroupbookingsratio_Val_ALL >= 1"),
    "productgroupbooking_Flag": _f(
        "productgroupbookingsratio_Val > 0 and productgroupbookingsratio_Val < 0.5"
    ),
    "return_receipt_Flag": _f("n_live_g >= 1"),
    "Voided_Scanned_Flag": _f("n_vscan > 0"),
    "lotto_return_flag": "case when coalesce(n_live_ret, 0) = 0 then 0 "
    "when n_lot_ret = n_live_ret and not IsEBUSStore then 1 end",
    "lotto_sale_flag": "case when coalesce(n_live_sale, 0) = 0 then 0 "
    "when n_lot_sale = n_live_sale and not IsEBUSStore then 1 end",
    "min2of3are_empties_immediatevoid_void_Flag": _f(
        "(case when n_e > 0 then 1 else 0 end) + (case when n_vnd > 0 then 1 else 0 end)"
        " + (case when n_vd > 0 then 1 else 0 end) >= 2"
    ),
}

_FLAGS = (
    "select $R4, FunctionLogStoreInfoID, TransactionType, productgroupbookingsratio_Val, "
    + ", ".join(f"{e} as {n}" for n, e in FLAGS.items())
    + " from {facts}"
)

_S, _H = "case when Void_flag = '0' then '{n}' else '{v}' end", "put_on_hold_Flag = 1"
_BOOK = (
    (0, "Special_Empties_Flag = 1"),
    (9, "mostlyproductgroupbookingsratio_Flag = 1"),
    (8, "Voided_Scanned_Flag = 1 and productgroupbooking_Flag = 1"),
    (7, "onlyproductgroupbooking_empty_Flag = 1 and onlyproductgroupbooking_Flag = 1 and atleastoneemptiesreturn_Flag = 1"),
    (6, "onlyproductgroupbooking_Flag = 1"),
    (5, "min2of3are_empties_immediatevoid_void_Flag = 1"),
    (4, "atleastoneemptiesreturn_Flag = 1"),
    (3, "lineitemcancellation_nodirectvoid_Flag = 1"),
    (2, "lineitemcancellation_directvoid_Flag = 1"),
    (1, "true"),
)
_PAY = (
    (0, "only_EmptiesPayOut_withAllproductgroup_flag = 1"),
    (9, "Receipt_withonlyScannedempties_flag = 1"),
    (8, "only_returns_Flag = 1 and return_receipt_Flag = 1"),
    (6, "only_EmptiesPayOut_withproductgroup_flag = 1"),
    (7, "Special_Empties_Flag = 1"),
    (5, "productgroupbooking_Flag = 1"),
    (4, "atleastoneemptiesreturn_Flag = 1 and (lineitemcancellation_directvoid_Flag = 1 or lineitemcancellation_nodirectvoid_Flag = 1)"),
    (3, "atleastoneemptiesreturn_Flag = 1"),
    (2, "lineitemcancellation_nodirectvoid_Flag = 1 or lineitemcancellation_directvoid_Flag = 1"),
    (1, "has_lineitemcancellation_nodirectvoid_Flag = 0 and lineitemcancellation_directvoid_Flag = 0 "
        "and Positive_total_Flag = 0 and atleastoneemptiesreturn_Flag = 0"),
)


def _pair(normal: str, voided: str) -> str:
    return f"case when Void_flag = '0' then '{normal}' else '{voided}' end"


def retail_case() -> str:
    arms = [
        ("Cancel_Flag = 1", "'JV1'"), ("TrainingMode_Flag = 1", "'JVS'"),
        ("Incorrect_receipt_Flag = 1", _pair("HNK", "HAK")),
        ("Void_flag = 'Z' and With_CashBack_Flag = 0", "'ZN1'"),
        ("Void_flag = 'Z' and With_CashBack_Flag = 1", "'ZN2'"),
        (_H + " and empty_receipt_Flag = 1", _pair("HNL", "HAL")),
        (_H + " and atleastoneemptiesreturn_Flag = 0", "'HNT'"),
        (_H + " and atleastoneemptiesreturn_Flag = 1", "'HLT'"),
        ("LoyaltyRewards_Flag = 1", "'HND'"),
        ("lotto_return_flag = 0 and lotto_sale_flag = 1", _pair("LN1", "LA1")),
        ("lotto_sale_flag = 0 and lotto_return_flag = 1", _pair("LN2", "LA2")),
        ("lotto_sale_flag = 1 and lotto_return_flag = 1", _pair("LN0", "LA0")),
    ]
    for letter, ladder, guard in (
        ("A", _BOOK, "Positive_total_Flag = 1"), ("E", _PAY, "true"), ("C", _BOOK, "return_receipt_Flag = 1"),
    ):
        arms += [
            (f"{guard} and ({c})", _pair(f"{letter}N{d}", f"{letter}A{d}")) for d, c in ladder
        ]
    return "case " + " ".join(f"when {c} then {v}" for c, v in arms) + " end"


_CLASS_COLS = "$R4, FunctionLogStoreInfoID, TransactionType"
_RETAIL = f"select {_CLASS_COLS}, " + retail_case() + " as class_id from {flags} where TransactionType = 'RetailTransaction'"
_CONTROL = f"select distinct {_CLASS_COLS}, " + """
  case when TrainingMode_Flag = 1 then 'JVN' when ControlTransactionType = 'OperatorSignOn' then 'XN1'
    when ControlTransactionType = 'OperatorSignOff' then 'XN5'
    when NoSale is not null and ReasonCode is null then 'HNW'
    when ControlTransactionType = 'SessionSettle' then 'HNJ' else 'HNG' end as class_id
from {flags} f left join (select $R4, ControlTransactionType, NoSale, ReasonCode from {control}) c using ($R4)
where TransactionType = 'ControlTransaction'
"""
_FUNCTION = f"select distinct {_CLASS_COLS}, " + """
  case when TrainingMode_Flag = 1 then 'JVN'
    when FunctionID = 89 and FunctionName = 'X_PAUSE' and ParameterName = 'FUNCTION_STATE'
      then case when ParameterValue = 'BEGIN' then 'XN7' else 'XN3' end
    when FunctionName = 'X_ARTICLE_INFORMATION' and SequenceNumber = 0 and ParameterName = 'ITEM_EAN' then 'XPL'
    when SequenceNumber = 0 and (FunctionName <> 'X_ARTICLE_INFORMATION' or FunctionName is null) then 'XNF' end as class_id
from {flags} f left join (select $R4, StoreInfoID as FunctionLogStoreInfoID, FunctionID, FunctionName, ParameterName, ParameterValue
  from {functionlog} where (FunctionID = 89 and FunctionName = 'X_PAUSE') or (FunctionName = 'X_ARTICLE_INFORMATION'
    and ParameterName in ('ITEM_EAN', 'BEGIN', 'END'))) g using ($R4, FunctionLogStoreInfoID)
where TransactionType = 'FunctionLog'
"""
_TENDERC = f"select distinct {_CLASS_COLS}, " + """
  case when TrainingMode_Flag = 1 then 'JVN' when a.p and TenderPickUpReason is null then 'HNM' when d.p then 'HNO'
    when a.p and TenderPickUpReason = 'AT' then 'HNP' when s.p then 'HNP' when c.p then 'HNR'
    when b.p and PaidInAmount is not null then 'GN1' when b.p and PaidOutAmount is not null then 'GN5'
    when b.p then 'GN6' else 'TDF' end as class_id
from {flags} f
left join (select distinct $R4, TenderPickUpReason, true as p from {pickup}) a using ($R4)
left join (select distinct $R4, PaidInAmount, PaidOutAmount, true as p from {deposit}) b using ($R4)
left join (select distinct $R4, true as p from {loan}) c using ($R4)
left join (select distinct $R4, true as p from {tillsettle}) d using ($R4)
left join (select distinct $R4, true as p from {safesettle}) s using ($R4)
where TransactionType = 'TenderControlTransaction'
"""
_CLASSIFICATION = (
    "select * from {class_retail} union select * from {class_control} "
    "union select * from {class_function} union select * from {class_tender}"
)

_EVENTS = """
select distinct a.RetailStoreID, a.WorkstationID, a.SequenceNumber, a.ReceiptNumber, a.ReceiptDateTime, a.StoreInfoID,
  a.ParameterValue as EAN, b.ParameterValue as ACTUALPRICE, case when a.SequenceNumber = 0 then 0 else 1 end as seqFlag
from {functionlog} a join {functionlog} b using ($R4, StoreInfoID)
where a.FunctionID = 12 and a.FunctionName = 'X_ARTICLE_INFORMATION' and a.ParameterName = 'ITEM_EAN'
  and b.FunctionID = 12 and b.FunctionName = 'X_ARTICLE_INFORMATION' and b.ParameterName = 'ACTUAL_PRICE'
"""
_ATTACHED = """
select p.RetailStoreID, p.WorkstationID, p.SequenceNumber, p.ReceiptDateTime, p.StoreInfoID, p.EAN, p.ACTUALPRICE,
  p.seqFlag, r.ReceiptDateTime as ReceiptDateTimeAT
from {events_l} p left join {retailheader} r on p.RetailStoreID = r.RetailStoreID and p.WorkstationID = r.WorkstationID
  and p.SequenceNumber = r.SequenceNumber and cast(p.ReceiptDateTime as date) = cast(r.ReceiptDateTime as date)
where p.SequenceNumber <> 0
union
select RetailStoreID, WorkstationID, rseq, ReceiptDateTime, StoreInfoID, EAN, ACTUALPRICE, seqFlag, rt from (
  select p.*, r.SequenceNumber as rseq, r.ReceiptDateTime as rt, row_number() over (
    partition by p.RetailStoreID, p.WorkstationID, p.ReceiptDateTime
    order by p.StoreInfoID, p.EAN, p.ACTUALPRICE, epoch(r.ReceiptDateTime) - epoch(p.ReceiptDateTime), r.SequenceNumber) as pick
  from {events_l} p left join {retailheader} r on p.RetailStoreID = r.RetailStoreID and p.WorkstationID = r.WorkstationID
    and cast(p.ReceiptDateTime as date) = cast(r.ReceiptDateTime as date) and r.ReceiptDateTime > p.ReceiptDateTime
  where p.SequenceNumber = 0) q where pick = 1
"""
_CODES = """
select * from (select *, row_number() over (partition by EAN order by MerchandiseHierarchyLevel_Main,
  MerchandiseHierarchyLevel_EBUS, ArticleDescription) as pick from (
    select EAN, MerchandiseHierarchyLevel_Main, MerchandiseHierarchyLevel_EBUS, Description as ArticleDescription from {articles}
    union select SAP_ID, MerchandiseHierarchyLevel_Main, MerchandiseHierarchyLevel_EBUS, Description from {articles}) q) q
where pick = 1
"""
_ENRICHED = """
select f.*, th.ReceiptNumber, coalesce(th.EmployeeID, tl.EmployeeID) as EmployeeID, r.TransactionGrandAmount,
  a.ArticleDescription, mh.MerchandiseHierarchyLevel, mh.DescriptionDE as MerchandiseHierachyDescription,
  st.IsEBUSStore as IsEBUS
from {attached} f
left join {retailheader} r on f.RetailStoreID = r.RetailStoreID and f.WorkstationID = r.WorkstationID
  and f.SequenceNumber = r.SequenceNumber and cast(f.ReceiptDateTime as date) = cast(r.ReceiptDateTime as date)
left join {header} th on r.RetailStoreID = th.RetailStoreID and r.WorkstationID = th.WorkstationID
  and r.SequenceNumber = th.SequenceNumber and r.ReceiptDateTime = th.ReceiptDateTime and th.TransactionType = 'RetailTransaction'
left join {header} tl on f.RetailStoreID = tl.RetailStoreID and f.WorkstationID = tl.WorkstationID
  and f.ReceiptDateTime = tl.ReceiptDateTime and coalesce(f.SequenceNumber, 0) = tl.SequenceNumber
  and f.StoreInfoID = tl.FunctionLogStoreInfoID and tl.TransactionType = 'FunctionLog'
left join {codes} a on f.EAN = cast(a.EAN as varchar)
left join (select distinct StoreID, IsEBUSStore from {stores}) st on f.RetailStoreID = st.StoreID
left join (select distinct MerchandiseHierarchyLevel, DescriptionDE, IsEBUS from {hierarchy}) mh
  on mh.MerchandiseHierarchyLevel = case when st.IsEBUSStore then a.MerchandiseHierarchyLevel_EBUS
    else a.MerchandiseHierarchyLevel_Main end and cast(st.IsEBUSStore as int) = mh.IsEBUS
"""
_FLAGGED = """
select p.*, m.minLineItemSequenceNumber, c.class_id,
  case when c.class_id not similar to '[AEC]N[0-9]' then 'Q' when p.EAN = cast(s.POSItemID as varchar) then 'N'
    when l.EntryMethod = 'Keyed' then 'M' else 'P' end as PriceLookupFlag
from {enriched} p
left join (select p.RetailStoreID, p.WorkstationID, p.SequenceNumber, p.ReceiptDateTime,
    min(l.LineItemSequenceNumber) as minLineItemSequenceNumber
  from {enriched} p join {lineitem} l on p.RetailStoreID = l.RetailStoreID and p.WorkstationID = l.WorkstationID
    and p.SequenceNumber = l.SequenceNumber and cast(p.ReceiptDateTime as date) = cast(l.ReceiptDateTime as date)
    and l.LineItemBeginDateTime > p.ReceiptDateTime
  group by p.RetailStoreID, p.WorkstationID, p.SequenceNumber, p.ReceiptDateTime) m
  on p.RetailStoreID = m.RetailStoreID and p.WorkstationID = m.WorkstationID and p.SequenceNumber = m.SequenceNumber
  and p.ReceiptDateTime = m.ReceiptDateTime
left join (select $L5, POSItemID, MerchandiseHierarchyLevel from {return}
  union select $L5, POSItemID, MerchandiseHierarchyLevel from {sale}) s
  on p.RetailStoreID = s.RetailStoreID and p.WorkstationID = s.WorkstationID and p.SequenceNumber = s.SequenceNumber
  and cast(p.ReceiptDateTime as date) = cast(s.ReceiptDateTime as date) and m.minLineItemSequenceNumber = s.LineItemSequenceNumber
left join {lineitem} l on s.RetailStoreID = l.RetailStoreID and s.WorkstationID = l.WorkstationID
  and s.SequenceNumber = l.SequenceNumber and s.ReceiptDateTime = l.ReceiptDateTime
  and s.LineItemSequenceNumber = l.LineItemSequenceNumber
left join {classification} c on p.RetailStoreID = c.RetailStoreID and p.WorkstationID = c.WorkstationID
  and p.SequenceNumber = c.SequenceNumber and p.ReceiptDateTimeAT = c.ReceiptDateTime and c.TransactionType = 'RetailTransaction'
"""
_LOOKUPS = """
select p.RetailStoreID, p.WorkstationID, p.ReceiptDateTime as ReceiptDateTimeFL, p.ReceiptDateTimeAT,
  case when p.seqFlag = 0 then p.ReceiptNumber else coalesce(d.ReceiptNumber, 0) end as ReceiptNumberAT,
  coalesce(d.ReceiptNumber, 0) as ReceiptNumberFL, p.EmployeeID, p.PriceLookupFlag, p.EAN, p.ACTUALPRICE as ActualPrice,
  p.ArticleDescription, p.MerchandiseHierarchyLevel, p.MerchandiseHierachyDescription, p.TransactionGrandAmount,
  p.StoreInfoID, p.IsEBUS
from {flagged} p left join {events_l} d on p.RetailStoreID = d.RetailStoreID and p.WorkstationID = d.WorkstationID
  and p.SequenceNumber = d.SequenceNumber and p.ReceiptDateTime = d.ReceiptDateTime and p.StoreInfoID = d.StoreInfoID
"""

_BOOKED = """
select l.RetailStoreID, l.WorkstationID, l.SequenceNumber, l.ReceiptDateTime, l.LineItemSequenceNumber,
  cast(l.ReceiptDateTime as date) as ReceiptDate, c.class_id,
  case when substring(class_id, 1, 2) in ('AA', 'EA', 'CA') then '1'
    when substring(class_id, 1, 2) in ('AN', 'EN', 'CN') then '0' else 'I' end as void_class_flag,
  h.TransactionGrandAmount, i.MerchandiseHierarchyLevel,
  coalesce(cast(i.POSItemID as varchar), cast(i.MerchandiseHierarchyLevel as varchar)) as item_key,
  case when i.RegularSalesUnitPrice <> 0 then i.RegularSalesUnitPrice else i.ExtendedAmount end as price_key
from {lineitemderived} l join {items} i using ($L5) join {retailheader} h using ($R4)
join {classification} c using ($R4)
where i.ItemType <> 'Deposit' and not l.VoidFlagDerived and c.TransactionType = 'RetailTransaction'
"""
_MATCHES = """
select RetailStoreID, WorkstationID, SequenceNumber, ReceiptDateTime, FollowTime,
  row_number() over (partition by RetailStoreID, WorkstationID, SequenceNumber, ReceiptDateTime order by FollowTime) as row_num,
  matches * 1e0 / lines_ as item_match, TrnAmtMatch
from (select c.RetailStoreID, c.WorkstationID, c.SequenceNumber, c.ReceiptDateTime, s.ReceiptDateTime as FollowTime,
    count(case when c.TransactionGrandAmount = s.TransactionGrandAmount then 1 end) as TrnAmtMatch,
    count(case when c.item_key = s.item_key and c.price_key = s.price_key then 1 end) as matches,
    count(distinct c.row_id) as lines_
  from (select * from {ordered} where void_class_flag = '1') c join {ordered} s
    on s.RetailStoreID = c.RetailStoreID and s.WorkstationID = c.WorkstationID and s.ReceiptDate = c.ReceiptDate
    and s.row_id >= c.row_id and s.void_class_flag = '0'
  group by c.RetailStoreID, c.WorkstationID, c.SequenceNumber, c.ReceiptDateTime, s.ReceiptDateTime) q
"""
_ORDERED = """
select *, row_number() over (partition by RetailStoreID, WorkstationID
  order by ReceiptDateTime, SequenceNumber, LineItemSequenceNumber) as row_id from {booked}
"""
_FOLLOWUP = """
select $R4, row_num, item_match, TrnAmtMatch from (select *, row_number() over (partition by $R4 order by row_num) as pick
  from {matches} where item_match >= 0.5 and row_num <= 10) q where pick = 1
"""
_CARDS = (
    "'YOAM','YOMA','YOMC','YOV0','YOVI','YOVO','YTAC','YTAM','YTDC','YTDD','YTDI','YTDK','YTDP','YTEA','YTEC',"
    "'YTEK','YTGG','YTGK','YTKR','YTKT','YTLV','YTMA','YTMB','YTMC','YTNG','YTOF','YTSO','YTVB','YTVC','YTVE',"
    "'YTVG','YTVI','YTVO','YTVP','YTVQ'"
)
_TCODES = """
select $R4, case when cash > 0 then 'V' || rank_ when TrnAmtMatch > 0 and card > 0 then 'K' || rank_ end as Bonstorno_Flag
from (select *, case when row_num > 8 then '9' else cast(row_num as varchar) end as rank_ from {followup}) f
left join (select $R4, count(case when TenderID = 'YTCS' then 1 end) as cash,
  count(case when TenderID in (""" + _CARDS + """) then 1 end) as card from {tender} group by $R4) t using ($R4)
"""


def unmatched(intended: bool) -> str:
    if intended:
        alone = """select v.RetailStoreID, v.WorkstationID, v.SequenceNumber, v.ReceiptDateTime from
  (select distinct $R4, ReceiptDate, EmployeeID from {booked} join {header} using ($R4) where void_class_flag = '1') v
  where not exists (select 1 from {booked} n join {header} h using ($R4) where n.void_class_flag = '0'
    and n.RetailStoreID = v.RetailStoreID and n.WorkstationID = v.WorkstationID and n.ReceiptDate = v.ReceiptDate
    and h.EmployeeID = v.EmployeeID and n.ReceiptDateTime > v.ReceiptDateTime)"""
    else:
        alone = """select $R4 from (select b.*, row_number() over (partition by RetailStoreID, WorkstationID,
    ReceiptDate, EmployeeID order by ReceiptDateTime desc, SequenceNumber desc) as pick
    from {booked} b join (select $R4, EmployeeID from {header}) h using ($R4) where void_class_flag = '0') q where pick = 1"""
    return (
        """
select v.RetailStoreID, v.WorkstationID, v.SequenceNumber, v.ReceiptDateTime,
  (case when grp then 'W' else 'A' end) || (case when change is null then (case when a.x is null then 'A' else 'C' end)
    else (case when a.x is null then 'B' else 'D' end) end) as Bonstorno_Flag
from (select $R4, max(case when coalesce(st.IsEBUSStore, false) then MerchandiseHierarchyLevel in (1, 2, 3, 15, 21, 22)
      else MerchandiseHierarchyLevel in (1, 4, 6, 12, 17) end) as grp
  from {booked} b left join {stores} st on st.StoreID = b.RetailStoreID where void_class_flag = '1' group by $R4) v
left join (select $R4, max(TenderChangeAmount) as change from {tender} group by $R4) t using ($R4)
left join (select distinct $R4, 1 as x from ("""
        + alone
        + """) q) a using ($R4)
where not exists (select 1 from {followup} f where f.RetailStoreID = v.RetailStoreID and f.WorkstationID = v.WorkstationID
  and f.SequenceNumber = v.SequenceNumber and f.ReceiptDateTime = v.ReceiptDateTime)
"""
    )


_REPORT = """
select b.RetailStoreID as RetailStoreID_1, b.WorkstationID as WorkstationID_1, b.SequenceNumber as SequenceNumber_1,
  b.ReceiptDateTime as ReceiptDateTime_1, o.ReceiptNumber as ReceiptNumber_1, v.RetailStoreID as RetailStoreID_2,
  v.WorkstationID as WorkstationID_2, v.SequenceNumber as SequenceNumber_2, v.ReceiptDateTime as ReceiptDateTime_2,
  v.ReceiptNumber as ReceiptNumber_2, b.Bonstorno_Flag as BonStornoFlag, c1.class_id as TransactionClassID_1,
  'Class ' || c1.class_id as TransactionClassDescr_1, c2.class_id as TransactionClassID_2,
  'Class ' || c2.class_id as TransactionClassDescr_2, o.TransactionGrandAmount, o.NegativeTotalFlag,
  h.ApproverEmployeeID as Approver
from (select * from {tender_codes} union all select * from {unmatched_codes}) b
join {retailheader} o using ($R4)
join {retailheader} v on v.TransactionLinkRetailStoreID = b.RetailStoreID and v.TransactionLinkWorkstationID = b.WorkstationID
  and v.TransactionLinkSequenceNumber = b.SequenceNumber and v.TransactionLinkReceiptDateTime = b.ReceiptDateTime
join {classification} c1 on c1.RetailStoreID = o.RetailStoreID and c1.WorkstationID = o.WorkstationID
  and c1.SequenceNumber = o.SequenceNumber and c1.ReceiptDateTime = o.ReceiptDateTime and c1.TransactionType = 'RetailTransaction'
join {classification} c2 on c2.RetailStoreID = v.RetailStoreID and c2.WorkstationID = v.WorkstationID
  and c2.SequenceNumber = v.SequenceNumber and c2.ReceiptDateTime = v.ReceiptDateTime and c2.TransactionType = 'RetailTransaction'
join {header} h on h.RetailStoreID = v.RetailStoreID and h.WorkstationID = v.WorkstationID
  and h.SequenceNumber = v.SequenceNumber and h.ReceiptDateTime = v.ReceiptDateTime
"""


def slip_text(store: str, lane: str, number: str, amount: str) -> str:
    return (
        f"lpad(cast({store} as varchar), 6, '0') || '-' || cast({lane} as varchar) || '-' || "
        f"case when try_cast({number} as bigint) < 100 then lpad(cast({number} as varchar), 3, '0') "
        f"else cast({number} as varchar) end || '-' || "
        f"case when {amount} < 100 then lpad(cast(cast(round({amount}, 2) as decimal(20,2)) as varchar), 5, '0') "
        f"else cast({amount} as varchar) end"
    )


_ISSUED = (
    """
select c.RetailStoreID, c.WorkstationID, r.ReceiptNumber, c.ReceiptDateTime,
  cast(c.RetailStoreID as varchar) as EmptiesStoreID, cast(c.WorkstationID as varchar) as EmptiesWorkstationID,
  left(cast(r.ReceiptNumber as varchar), 4) as EmptiesReceiptNumber, r.TransactionGrandAmount as EmptiesTotal,
  h.EmployeeID, cast(null as varchar) as FLAG, """
    + slip_text("c.RetailStoreID", "c.WorkstationID", "r.ReceiptNumber", "r.TransactionGrandAmount")
    + """ as Concatenated_Empties_ID, c.class_id, cast(0 as bigint) as LineItemSequenceNumber,
  cast(null as int) as IsVoided, cast(null as int) as EmptiesTimingFlag
from {classification} c join {header} h using ($R4) left join {retailheader} r using ($R4)
where c.class_id = 'HNL' and h.TransactionType = 'RetailTransaction'
"""
)
_REDEEMED = (
    """
select a.RetailStoreID, a.WorkstationID, a.ReceiptNumber, a.ReceiptDateTime, a.EmptiesStoreID, a.EmptiesWorkstationID,
  left(a.EmptiesReceiptNumber, 4) as EmptiesReceiptNumber, r.ExtendedAmount as EmptiesTotal, h.EmployeeID,
  case when l.VoidFlag and l.DirectVoidFlag then 'PF+SO' when l.VoidFlag and not l.DirectVoidFlag then 'PF+ZS' else 'PF' end as FLAG,
  """
    + slip_text("a.EmptiesStoreID", "a.EmptiesWorkstationID", "left(a.EmptiesReceiptNumber, 4)", "r.ExtendedAmount")
    + """ as Concatenated_Empties_ID, c.class_id, r.LineItemSequenceNumber
from {classification} c join {return} r using ($R4) join {header} h using ($R4)
left join {lineitemderived} l using ($L5) join {slip} a using ($L5)
where c.class_id <> 'HNL' and h.TransactionType = 'RetailTransaction' and r.ItemType in """
    + EMPTIES
)
_SLIPKEY = "EmptiesStoreID, EmptiesWorkstationID, EmptiesReceiptNumber"
_TOTALS = (
    """
select $N4, """ + _SLIPKEY + """, EmptiesTotal, EmployeeID, FLAG, """
    + slip_text("EmptiesStoreID", "EmptiesWorkstationID", "EmptiesReceiptNumber", "EmptiesTotal")
    + """ as Concatenated_Empties_ID, class_id, LineItemSequenceNumber, IsVoided
from (select e.* replace (cast(case when live_ > 0 then live_total else void_total end as double) as EmptiesTotal),
    case when d.VoidFlagDerived then 1 else 0 end as IsVoided
  from {redeemed} e
  left join (select $N4, """ + _SLIPKEY + """, count(case when not VoidFlagDerived then 1 end) as live_,
      sum(cast(round(case when not VoidFlagDerived and FLAG = 'PF' then EmptiesTotal else 0 end, 2) as decimal(20,2))) as live_total,
      sum(cast(round(case when VoidFlagDerived and FLAG = 'PF' then EmptiesTotal else 0 end, 2) as decimal(20,2))) as void_total
    from {redeemed} left join (select $NL5, VoidFlagDerived from {lineitemderived}) l using ($NL5)
    group by $N4, """ + _SLIPKEY + """) t using ($N4, """ + _SLIPKEY + """)
  left join (select $NL5, VoidFlagDerived from {lineitemderived}) d using ($NL5)) q
"""
)
_TIMED = """
select r.* , case when gap <= 20 then 0 when gap > 20 and same and class_id = 'EN9' then 1
  when gap > 20 and same and class_id <> 'EN9' then 2
  when (not same and issue is not null) or (issue is null and try_cast(EmptiesWorkstationID as bigint) >= 100) then 3
  end as EmptiesTimingFlag
from (select t.*, e.issue, abs(epoch(e.issue) - epoch(t.ReceiptDateTime)) / 60e0 as gap,
    cast(e.issue as date) = cast(t.ReceiptDateTime as date) as same
  from {slip_totals} t left join (select h.RetailStoreID as s_, h.WorkstationID as w_, h.ReceiptNumber as n_, max(h.ReceiptDateTime) as issue
    from {issued} h join {slip_totals} x on try_cast(x.EmptiesStoreID as bigint) = h.RetailStoreID
      and try_cast(x.EmptiesWorkstationID as bigint) = h.WorkstationID
      and try_cast(x.EmptiesReceiptNumber as bigint) = h.ReceiptNumber and h.ReceiptDateTime < x.ReceiptDateTime
    group by 1, 2, 3) e on try_cast(t.EmptiesStoreID as bigint) = e.s_ and try_cast(t.EmptiesWorkstationID as bigint) = e.w_
      and try_cast(t.EmptiesReceiptNumber as bigint) = e.n_) r
"""
_TIMED_COLUMNS = "$N4, " + _SLIPKEY + ", EmptiesTotal, EmployeeID, FLAG, Concatenated_Empties_ID, class_id, LineItemSequenceNumber, IsVoided, EmptiesTimingFlag"
_EMPTIES_ALL = (
    f"select {_TIMED_COLUMNS} from {{timed}} union select {_TIMED_COLUMNS} from {{issued}}"
)

_SUSPENDED = """
select p.RetailStoreID as RetailStoreID_suspended, p.WorkstationID as WorkStationID_suspended,
  p.ReceiptDateTime as ReceiptDateTime_suspended, p.ReceiptNumber as ReceiptNumber_suspended,
  h.TransactionStatus as TransactionStatus_suspended, c.class_id as class_id_suspended, t.EmployeeID as EmployeeID_suspended,
  h.TransactionGrandAmount as Total_suspended, f.RetailStoreID as RetailStoreID_retrieved,
  f.WorkstationID as WorkStationID_retrieved, f.ReceiptDateTime as ReceiptDateTime_retrieved,
  f.ReceiptNumber as ReceiptNumber_retrieved, f.TransactionStatus as TransactionStatus_retrieved,
  coalesce(f.final, f.TransactionStatus) as TransactionStatus_derived_retrived, f.class_id as class_id_retrived,
  (case when e.x is null then 2 else 0 end) + (case when f.final = 'Totaled' then 0 else 1 end) as Suspended_Flag
from {headeraddon} p
left join {retailheader} h using ($N4)
left join {classification} c on c.RetailStoreID = p.RetailStoreID and c.WorkstationID = p.WorkstationID
  and c.SequenceNumber = p.SequenceNumber and c.ReceiptDateTime = p.ReceiptDateTime and c.TransactionType = 'RetailTransaction'
left join (select * from {header} where TransactionType = 'RetailTransaction') t on t.RetailStoreID = p.RetailStoreID
  and t.WorkstationID = p.WorkstationID and t.SequenceNumber = p.SequenceNumber and t.ReceiptDateTime = p.ReceiptDateTime
left join (select g.*, k.class_id, case when exists (select 1 from {headeraddon} o join {retailheader} q using ($R4)
      where o.AddonKey = 'SERVER_PARKING_FETCHED_NUMBER' and q.TransactionStatus = 'Totaled'
        and o.RetailStoreID = g.RetailStoreID and o.AddonValue = g.AddonValue
        and cast(o.ReceiptDateTime as date) = cast(g.ReceiptDateTime as date)) then 'Totaled' end as final
  from (select $R4, a.ReceiptNumber, s.TransactionStatus, max(AddonValue) as AddonValue
    from {headeraddon} a join (select $N4, TransactionStatus from {retailheader}) s using ($N4)
    where AddonKey = 'SERVER_PARKING_FETCHED_NUMBER' and s.TransactionStatus <> 'PostVoided'
    group by $R4, a.ReceiptNumber, s.TransactionStatus) g
  left join (select * from {classification} where TransactionType = 'RetailTransaction') k using ($R4)) f
  on f.RetailStoreID = p.RetailStoreID and f.AddonValue = p.AddonValue and f.ReceiptNumber <> p.ReceiptNumber
  and cast(f.ReceiptDateTime as date) = cast(p.ReceiptDateTime as date)
left join (select distinct $N4, 1 as x from {empties_all}) e on e.RetailStoreID = p.RetailStoreID
  and e.WorkstationID = p.WorkstationID and e.ReceiptNumber = p.ReceiptNumber and e.ReceiptDateTime = p.ReceiptDateTime
where p.AddonKey = 'PARK_NUMBER'
"""

_AMOUNTS = "select $NL5, ExtendedAmount from {sale} union select $NL5, ExtendedAmount from {return}"
_COUNTERS = """
select $N4, count(case when not VoidFlagDerived then 1 end) as NonVoidedItemCount,
  count(case when VoidFlag then 1 end) as VoidedItemCount,
  cast(sum(cast(round(case when VoidFlag then b.ExtendedAmount else 0 end, 2) as decimal(20,2))) as double) as VoidedItemTotal,
  count(case when DirectVoidFlag then 1 end) as DirectVoidedItemCount,
  count(case when not DirectVoidFlag then 1 end) as LineVoidedItemCount
from {lineitemderived} a join {amounts} b using ($NL5) group by $N4
"""
_REBATE = """
select $N4, max(case when RuleDescription = 'Kleberabatt' and NewPrice = 0 and b.ExtendedAmount = 0 then 1 else 0 end) as Rebate100Percent
from {modifier} a join (select $NL5, ExtendedAmount from {amounts}) b using ($NL5) group by $N4
"""
_LAST = """
select l.*, case when i.x is null or not l.VoidFlag then null
  when m.last_ = l.LineItemSequenceNumber then 1 else 0 end as VoidedIsLastItem
from {lineitem} l
left join (select distinct $NL5, 1 as x from {items_n}) i using ($NL5)
left join (select $N4, max(LineItemSequenceNumber) as last_ from {items_n} group by $N4) m using ($N4)
"""
_SHOWN = """
with numbered as (select l.*, i.side, i.POSItemID, i.MerchandiseHierarchyLevel,
    dense_rank() over (partition by l.RetailStoreID, l.WorkstationID, cast(l.ReceiptDateTime as date) order by l.ReceiptDateTime) as row_id
  from {lineitemderived} l join {items} i using ($L5)),
again as (select distinct c.RetailStoreID, c.WorkstationID, c.ReceiptNumber, c.ReceiptDateTime, c.LineItemSequenceNumber, 1 as x
  from numbered c join numbered f on f.RetailStoreID = c.RetailStoreID and f.WorkstationID = c.WorkstationID
    and cast(f.ReceiptDateTime as date) = cast(c.ReceiptDateTime as date) and f.row_id = c.row_id + 1
  where c.VoidFlag and not f.VoidFlagDerived and c.side = f.side
    and ((c.EntryMethod = 'Scanned' and c.POSItemID = f.POSItemID)
      or (c.EntryMethod = 'Keyed' and c.MerchandiseHierarchyLevel = f.MerchandiseHierarchyLevel)))
select l.*, case when l.VoidFlag and l.VoidFlagDerived is not null then coalesce(a.x, 0) end as VoidedIsInFollowup
from {lineitemderived} l left join again a using ($NL5)
"""
_HEADER_CLASS = """
select h.RetailStoreID, h.WorkstationID, h.SequenceNumber, h.ReceiptNumber, h.ReceiptDateTime,
  coalesce(h.FunctionLogStoreInfoID, 0) as FunctionLogStoreInfoID, h.TransactionType, h.CancelFlag, h.TrainingModeFlag,
  h.EmployeeID, h.ApproverEmployeeID, c.class_id
from {header} h join {classification} c on c.RetailStoreID = h.RetailStoreID and c.WorkstationID = h.WorkstationID
  and c.SequenceNumber = h.SequenceNumber and c.ReceiptDateTime = h.ReceiptDateTime and c.TransactionType = h.TransactionType
  and coalesce(c.FunctionLogStoreInfoID, 0) = coalesce(h.FunctionLogStoreInfoID, 0)
"""
_EMPLOYEE = """
with numbered as (select t.*, case when t.TransactionType = 'RetailTransaction' then r.TransactionGrandAmount end as total_,
    row_number() over (partition by t.RetailStoreID, t.EmployeeID, cast(t.ReceiptDateTime as date)
      order by t.ReceiptDateTime, t.FunctionLogStoreInfoID, t.SequenceNumber, t.WorkstationID) as row_id
  from {header_class} t left join (select $N4, TransactionGrandAmount from {retailheader}) r using ($N4)
  where t.class_id is not null)
select a.* exclude (total_, row_id), b.RetailStoreID as RetailStoreID_Followup, b.WorkstationID as WorkStationID_Followup,
  b.ReceiptNumber as ReceiptNumber_Followup, b.ReceiptDateTime as ReceiptDateTime_Followup,
  b.FunctionLogStoreInfoID as FunctionLogStoreInfoID_Followup, b.total_ as TransactionGrandAmount_Followup,
  b.class_id as class_id_Followup
from numbered a left join numbered b on b.RetailStoreID = a.RetailStoreID and b.EmployeeID = a.EmployeeID
  and cast(b.ReceiptDateTime as date) = cast(a.ReceiptDateTime as date) and b.row_id = a.row_id + 1
union all by name select * from {header_class} where class_id is null
"""
_MERGED = """
select $NL5, ItemType, POSItemID, ItemID, MerchandiseHierarchyLevel, Description, RegularSalesUnitPrice, ExtendedAmount,
  UnitOfMeasureCode, Quantity, Units, MerchandiseStructureItemFlag, SpecialPriceDescription, 0 as ReturnFlag from {sale}
union all
select $NL5, ItemType, POSItemID, ItemID, MerchandiseHierarchyLevel, Description, RegularSalesUnitPrice, -ExtendedAmount,
  UnitOfMeasureCode, Quantity, Units, MerchandiseStructureItemFlag, SpecialPriceDescription, 1 from {return}
"""
_RESOLVED = """
with known as (select * from (select *, row_number() over (partition by code_, Unit order by ean_) as pick from (
    select EAN as code_, ' ' as ean_, Unit from {articles} union select SAP_ID, cast(EAN as varchar), Unit from {articles}) q) q
  where pick = 1)
select s.*, coalesce(cast(a.code_ as varchar), b.ean_) as EAN_Lookup
from {merged} s left join known a on s.POSItemID = a.code_ and s.UnitOfMeasureCode = a.Unit
left join (select distinct code_, ean_ from known) b on s.ItemID = b.code_
"""

VIEWS = {
    name: sql(text)
    for name, text in {
        "lineitemderived": _DERIVED, "slip": _SLIP, "modnet": _MODNET, "items_n": _ITEMS_N, "items": _ITEMS, "price": _PRICE,
        "ratio": _RATIO, "lines": _LINES, "perreceipt": _PER_RECEIPT, "facts": _FACTS, "flags": _FLAGS,
        "class_retail": _RETAIL, "class_control": _CONTROL, "class_function": _FUNCTION,
        "class_tender": _TENDERC, "classification": _CLASSIFICATION, "events_l": _EVENTS,
        "attached": _ATTACHED, "codes": _CODES, "enriched": _ENRICHED, "flagged": _FLAGGED,
        "lookups": _LOOKUPS, "booked": _BOOKED, "ordered": _ORDERED, "matches": _MATCHES,
        "followup": _FOLLOWUP, "tender_codes": _TCODES, "unmatched_codes": unmatched(False),
        "unmatched_intended": unmatched(True), "void_report": _REPORT, "issued": _ISSUED,
        "redeemed": _REDEEMED, "slip_totals": _TOTALS, "timed": _TIMED, "empties_all": _EMPTIES_ALL,
        "suspended": _SUSPENDED, "amounts": _AMOUNTS, "counters": _COUNTERS, "rebate": _REBATE,
        "last": _LAST, "shown": _SHOWN, "header_class": _HEADER_CLASS, "employee": _EMPLOYEE,
        "merged": _MERGED, "resolved": _RESOLVED,
    }.items()
}
