"""Rule branches on hand-made receipts."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillsight.plans import classify, empties, receiptvoid, void
from tillsight.plans.classify import class_catalog, classify_retail, flag_rules, retail_rules
from oracle.rules import FLAGS

T0 = datetime(2024, 1, 5, 10, 0)

FLAG_NAMES = [f for f in FLAGS if f != "Void_flag"]


def on(*names, void="0", **values):
    return {**dict.fromkeys(FLAG_NAMES, 0), **dict.fromkeys(names, 1), "Void_flag": void, **values}


P, HOLD, EMPTIES = "Positive_total_Flag", "put_on_hold_Flag", "atleastoneemptiesreturn_Flag"
RETURNS, NODIRECT, DIRECT = (
    "return_receipt_Flag", "lineitemcancellation_nodirectvoid_Flag", "lineitemcancellation_directvoid_Flag",
)
HAS_NODIRECT = "has_lineitemcancellation_nodirectvoid_Flag"
ONLY, ONLY_E = "onlyproductgroupbooking_Flag", "onlyproductgroupbooking_empty_Flag"
TWO = "min2of3are_empties_immediatevoid_void_Flag"
BOOKED, SCANNED_VOID = "productgroupbooking_Flag", "Voided_Scanned_Flag"
MOSTLY, SPECIAL = "mostlyproductgroupbookingsratio_Flag", "Special_Empties_Flag"

#: flags -> class of a normal and of a voided receipt
CASES = [
    (on("Cancel_Flag", P), "JV1", "JV1"),
    (on("TrainingMode_Flag", P), "JVS", "JVS"),
    (on("Incorrect_receipt_Flag", P), "HNK", "HAK"),
    (on(HOLD, "empty_receipt_Flag", EMPTIES), "HNL", "HAL"),
    (on(HOLD), "HNT", "HNT"),
    (on(HOLD, EMPTIES), "HLT", "HLT"),
    (on("LoyaltyRewards_Flag", P), "HND", "HND"),
    (on(P, lotto_sale_flag=1), "LN1", "LA1"),
    (on(lotto_return_flag=1), "LN2", "LA2"),
    (on(lotto_return_flag=1, lotto_sale_flag=1), "LN0", "LA0"),
    (on(P, SPECIAL, MOSTLY), "AN0", "AA0"),
    (on(P, MOSTLY), "AN9", "AA9"),
    (on(P, SCANNED_VOID, BOOKED), "AN8", "AA8"),
    (on(P, ONLY_E, ONLY, EMPTIES), "AN7", "AA7"),
    (on(P, ONLY), "AN6", "AA6"),
    (on(P, TWO, EMPTIES), "AN5", "AA5"),
    (on(P, EMPTIES), "AN4", "AA4"),
    (on(P, NODIRECT), "AN3", "AA3"),
    (on(P, DIRECT), "AN2", "AA2"),
    (on(P), "AN1", "AA1"),
    (on("only_EmptiesPayOut_withAllproductgroup_flag", EMPTIES), "EN0", "EA0"),
    (on("Receipt_withonlyScannedempties_flag", EMPTIES), "EN9", "EA9"),
    (on("only_returns_Flag", RETURNS), "EN8", "EA8"),
    (on("only_EmptiesPayOut_withproductgroup_flag", EMPTIES), "EN6", "EA6"),
    (on(SPECIAL, EMPTIES), "EN7", "EA7"),
    (on(BOOKED), "EN5", "EA5"),
    (on(EMPTIES, DIRECT), "EN4", "EA4"),
    (on(EMPTIES), "EN3", "EA3"),
    (on(NODIRECT), "EN2", "EA2"),
    (on(RETURNS), "EN1", "EA1"),
    # what remains for the goods-return family: a plain void next to a direct-void mark
    (on(HAS_NODIRECT, RETURNS, MOSTLY), "CN9", "CA9"),
    (on(HAS_NODIRECT, RETURNS, ONLY), "CN6", "CA6"),
    (on(HAS_NODIRECT, RETURNS), "CN1", "CA1"),
    (on(HAS_NODIRECT), None, None),
    # precedence
    (on("Cancel_Flag", "TrainingMode_Flag", "Incorrect_receipt_Flag"), "JV1", "JV1"),
    (on(HOLD, "LoyaltyRewards_Flag"), "HNT", "HNT"),
    (on(P, lotto_return_flag=None, lotto_sale_flag=1), "AN1", "AA1"),
]


def test_retail_classes(spark):
    data, wanted = [], {}
    for i, (flags, normal, voided) in enumerate(CASES):
        for j, (mark, code) in enumerate((("0", normal), ("1", voided))):
            key = i * 2 + j
            data.append({**flags, "Void_flag": mark, "SequenceNumber": key})
            wanted[key] = code
    data.append({**on(P), "Void_flag": "Z", "SequenceNumber": 9000})
    data.append({**on(P, "With_CashBack_Flag"), "Void_flag": "Z", "SequenceNumber": 9001})
    wanted |= {9000: "ZN1", 9001: "ZN2"}
    schema = ", ".join([f"{f} int" for f in FLAG_NAMES] + ["Void_flag string", "SequenceNumber bigint"])
    df = spark.createDataFrame(data, schema).selectExpr(
        "*", "1L as RetailStoreID", "1L as WorkstationID", "timestamp'2024-01-01' as ReceiptDateTime",
        "cast(null as bigint) as FunctionLogStoreInfoID", "'RetailTransaction' as TransactionType",
    )
    got = {r.SequenceNumber: r.class_id for r in classify_retail(df).collect()}
    assert got == wanted


def test_rule_list_length_and_catalog(spark):
    assert list(flag_rules()) == list(FLAGS)
    assert len(retail_rules()) == 12 + 30
    catalog = class_catalog()
    assert len(catalog) == len(set(catalog)) == 17 + 60 + 18


def receipt(seq, at=T0, ws=1, store=1):
    return {"RetailStoreID": store, "WorkstationID": ws, "SequenceNumber": seq, "ReceiptDateTime": at,
            "ReceiptNumber": seq}


KEY_SCHEMA = (
    "RetailStoreID bigint, WorkstationID bigint, SequenceNumber bigint, ReceiptDateTime timestamp, "
    "ReceiptNumber bigint"
)


@pytest.fixture(scope="module")
def make(spark):
    def build(data, extra):
        return spark.createDataFrame(data, f"{KEY_SCHEMA}, {extra}")

    return build


def test_void_propagates_over_links_only_within_receipt(make):
    line = "LineItemSequenceNumber bigint, VoidFlag boolean"
    lines = make(
        [receipt(1) | {"LineItemSequenceNumber": n, "VoidFlag": v} for n, v in ((1, False), (2, True), (3, None), (4, False))]
        + [receipt(2) | {"LineItemSequenceNumber": 1, "VoidFlag": False}],
        line,
    )
    sale = make(
        [receipt(1) | {"LineItemSequenceNumber": n, "SaleItemLink": k} for n, k in ((1, None), (2, 1))]
        + [receipt(2) | {"LineItemSequenceNumber": 1, "SaleItemLink": None}],
        "LineItemSequenceNumber bigint, SaleItemLink bigint",
    )
    returns = make(
        [receipt(1) | {"LineItemSequenceNumber": 3, "ReturnItemLink": None}],
        "LineItemSequenceNumber bigint, ReturnItemLink bigint",
    )
    got = void.propagate_voids(lines, sale, returns)
    assert rows(got, "SequenceNumber", "LineItemSequenceNumber", "VoidFlagDerived") == [
        (1, 1, True), (1, 2, True), (1, 3, False), (1, 4, None), (2, 1, False),
    ]


def test_modifiers_net(make):
    extra = "LineItemSequenceNumber bigint, PriceModifierSequenceNumber bigint, AmountAction string, AmountValue double"
    data = [
        receipt(1) | {"LineItemSequenceNumber": 1, "PriceModifierSequenceNumber": m, "AmountAction": a, "AmountValue": v}
        for m, a, v in ((1, "Subtract", 0.3), (2, "Add", 0.1), (3, "Replace", 2.0), (3, "Replace", 2.0))
    ]
    got = classify.net_modifiers(make(data, extra)).selectExpr(
        "cast(final_modifier as string)", "cast(Replace_amount as string)", "action"
    )
    assert rows(got) == [("-0.20", "2.00", "With_Replace")]


def lines_frame(spark, receipts):
    """receipts: (sequence, minutes after start, kind, total, [(item, price)])."""
    out = []
    for seq, minutes, kind, total, items in receipts:
        at = T0 + timedelta(minutes=minutes)
        for n, (item, price) in enumerate(items, 1):
            out.append((1, 1, seq, at, n, at.date(), "AA1", kind, total, 1, item, price))
    return spark.createDataFrame(
        out,
        "RetailStoreID bigint, WorkstationID bigint, SequenceNumber bigint, ReceiptDateTime timestamp, "
        "LineItemSequenceNumber bigint, ReceiptDate date, class_id string, void_class_flag string, "
        "TransactionGrandAmount double, MerchandiseHierarchyLevel bigint, item_key string, price_key double",
    )


def brute_force_followup(receipts):
    out = {}
    for seq, minutes, kind, total, items in receipts:
        if kind != "1":
            continue
        later = {}
        for s2, m2, k2, t2, i2 in receipts:
            if k2 == "0" and (m2, s2) > (minutes, seq):
                later.setdefault(m2, []).append((t2, i2))
        for rank, m2 in enumerate(sorted(later), 1):
            hits = sum(a == b for _, i2 in later[m2] for a in items for b in i2)
            same = sum(len(items) * len(i2) for t2, i2 in later[m2] if t2 == total)
            if rank <= 10 and hits / len(items) >= 0.5:
                out[seq] = (rank, hits / len(items), same)
                break
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_void_followup_equals_brute_force(spark, seed):
    import random

    rng = random.Random(seed)
    receipts = []
    for seq in range(1, 60):
        kind = "1" if rng.random() < 0.25 else ("I" if rng.random() < 0.1 else "0")
        items = [(rng.choice("abcd"), float(rng.randrange(1, 3))) for _ in range(rng.randrange(1, 5))]
        receipts.append((seq, rng.randrange(0, 400), kind, float(rng.randrange(3)), items))
    got = {
        r.SequenceNumber: (r.row_num, r.item_match, r.TrnAmtMatch)
        for r in receiptvoid.void_followup(lines_frame(spark, receipts)).collect()
    }
    assert got == brute_force_followup(receipts)


def test_followup_at_the_same_minute_needs_a_higher_sequence(spark):
    basket = [("a", 1.0)]
    receipts = [(5, 0, "1", 1.0, basket), (4, 0, "0", 1.0, basket), (6, 0, "0", 1.0, basket)]
    got = receiptvoid.followup_matches(lines_frame(spark, receipts)).collect()
    assert [(r.row_num, r.item_match, r.TrnAmtMatch) for r in got] == [(1, 1.0, 1)]


def test_followup_of_many_receipts_at_one_time_makes_no_pairs(spark):
    """Receipts of one time are met as counts: a voided receipt has a row for each time, not for each receipt."""
    receipts = [(i, i % 2, "1" if i % 5 == 0 else "0", float(i % 3), [("a", 1.0), ("ab"[i % 2], 2.0)]) for i in range(200)]
    lines = lines_frame(spark, receipts)
    voided = [r for r in receipts if r[2] == "1"]
    candidates = receiptvoid.follow_up_candidates(receiptvoid.item_counts(lines)).count()
    assert candidates <= len(voided) * receiptvoid.FOLLOW_UPS
    got = {
        (r.SequenceNumber, r.row_num): (r.item_match, r.TrnAmtMatch) for r in receiptvoid.followup_matches(lines).collect()
    }
    wanted = {}
    for seq, minute, _, total, items in voided:
        met = [[r for r in receipts if r[1] == m and r[2] == "0" and (m > minute or r[0] > seq)] for m in range(minute, 2)]
        for rank, later in enumerate(filter(None, met), 1):
            hits = sum(a == b for a in items for r in later for b in r[4])
            wanted[seq, rank] = (hits / 2, sum(4 for r in later if r[3] == total))
    assert got == wanted


def test_tender_codes(spark, make):
    matched = make(
        [receipt(s) | {"row_num": r, "TrnAmtMatch": a} for s, r, a in ((1, 1, 0), (2, 9, 0), (3, 8, 2), (4, 3, 0), (5, 2, 1))],
        "row_num int, TrnAmtMatch bigint",
    ).drop("ReceiptNumber")
    tender = make(
        [receipt(s) | {"TenderID": t} for s, t in ((1, "YTCS"), (2, "YTCS"), (3, "YTEC"), (4, "YTEC"), (5, "other"))],
        "TenderID string",
    )
    got = receiptvoid.tender_codes(matched, tender)
    assert rows(got, "SequenceNumber", "Bonstorno_Flag") == [
        (1, "V1"), (2, "V9"), (3, "K8"), (4, None), (5, None),
    ]


def test_unmatched_codes_all_combinations(spark, make):
    void_lines, tenders, headers = [], [], []
    seq = 0
    for change in (None, 1.0):
        for group in (1, 99):
            seq += 1
            at = T0 + timedelta(minutes=seq)
            void_lines.append((1, 1, seq, at, 1, at.date(), "AA1", "1", 1.0, group, "x", 1.0))
            tenders.append(receipt(seq, at) | {"TenderChangeAmount": change})
            headers.append(receipt(seq, at) | {"EmployeeID": seq})
    # employees 1 and 3 go on with a normal receipt later that day
    for emp in (1, 3):
        at = T0 + timedelta(hours=2, minutes=emp)
        void_lines.append((1, 1, 50 + emp, at, 1, at.date(), "AN1", "0", 1.0, 1, "y", 1.0))
        headers.append(receipt(50 + emp, at) | {"EmployeeID": emp})
    lines = spark.createDataFrame(void_lines, lines_frame(spark, [(1, 1, "1", 1.0, [("a", 1.0)])]).schema)
    stores = spark.createDataFrame([(1, False)], "StoreID bigint, IsEBUSStore boolean")
    none = lines.limit(0).selectExpr("RetailStoreID", "WorkstationID", "SequenceNumber", "ReceiptDateTime")
    args = (lines, none, make(tenders, "TenderChangeAmount double"), stores, make(headers, "EmployeeID bigint"))
    as_written = receiptvoid.unmatched_codes(*args)
    assert rows(as_written, "SequenceNumber", "Bonstorno_Flag") == [(1, "WA"), (2, "AA"), (3, "WB"), (4, "AB")]
    intended = receiptvoid.unmatched_codes(*args, intended=True)
    assert rows(intended, "SequenceNumber", "Bonstorno_Flag") == [(1, "WA"), (2, "AC"), (3, "WB"), (4, "AD")]


def redeemed(seq, at, number="5", lane="1", class_id="EN3"):
    return receipt(seq, at) | {
        "EmptiesStoreID": "1", "EmptiesWorkstationID": lane, "EmptiesReceiptNumber": number, "EmptiesTotal": 1.0,
        "EmployeeID": 1, "FLAG": "PF", "Concatenated_Empties_ID": "x", "class_id": class_id,
        "LineItemSequenceNumber": 1, "IsVoided": 0,
    }


SLIP_SCHEMA = (
    "EmptiesStoreID string, EmptiesWorkstationID string, EmptiesReceiptNumber string, EmptiesTotal double, "
    "EmployeeID bigint, FLAG string, Concatenated_Empties_ID string, class_id string, "
    "LineItemSequenceNumber bigint, IsVoided int"
)


def test_timing_flags(make):
    issued = make(
        [receipt(5, T0) | {"x": 1}, receipt(6, T0) | {"x": 1}, receipt(7, T0) | {"x": 1}, receipt(8, T0) | {"x": 1}], "x int"
    )
    uses = make(
        [
            redeemed(20, T0 + timedelta(minutes=20), "5"),
            redeemed(21, T0 + timedelta(minutes=21), "6", class_id="EN9"),
            redeemed(22, T0 + timedelta(minutes=21), "7"),
            redeemed(23, T0 + timedelta(days=1), "8"),
            redeemed(24, T0 + timedelta(minutes=5), "999", lane="100"),
            redeemed(25, T0 + timedelta(minutes=5), "999", lane="99"),
            redeemed(26, T0 + timedelta(minutes=5), "abc", lane="text"),
        ],
        SLIP_SCHEMA,
    )
    got = empties.timing(uses, issued)
    assert rows(got, "SequenceNumber" if "SequenceNumber" in got.columns else "ReceiptNumber", "EmptiesTimingFlag") == [
        (20, 0), (21, 1), (22, 2), (23, 3), (24, 3), (25, None), (26, None),
    ]


def test_timing_uses_one_issue_per_slip(make):
    """The issue before the last redemption counts for all redemptions of the slip."""
    issued = make([receipt(5, T0) | {"x": 1}, receipt(5, T0 + timedelta(minutes=30)) | {"x": 1}], "x int")
    uses = make(
        [redeemed(20, T0 + timedelta(minutes=15), "5"), redeemed(21, T0 + timedelta(minutes=60), "5")], SLIP_SCHEMA
    )
    got = empties.timing(uses, issued)
    assert rows(got, "ReceiptNumber", "EmptiesTimingFlag") == [(20, 0), (21, 2)]


def test_report_carried_on_equals_the_whole_report(spark):
    """Runs in order, data that comes late by days or by many weeks, days without transactions."""
    import datetime
    import random

    from tillsight.plans import reports

    r = random.Random(8)
    start = datetime.datetime(2024, 1, 1, 9)
    types = [*reports.REPORTED_TYPES.values(), "Other"]
    rows = []
    for day in range(200):
        for store in (1, 2, None):
            run = day // 7 if r.random() < 0.95 else r.choice((min(28, day // 7 + 2), 28))
            rows += [(store, start + datetime.timedelta(days=day, minutes=i), r.choice(types), run) for i in range(r.randrange(4))]
    header = spark.createDataFrame(rows, "RetailStoreID bigint, ReceiptDateTime timestamp, TransactionType string, run int").cache()
    names = [(f"f{i}", r.choice((1, 2)), (start + datetime.timedelta(days=r.randrange(210))).date(), r.randrange(29)) for i in range(150)]
    files = spark.createDataFrame(names, "xmlfilename string, RetailStoreID bigint, BusinessDate date, run int").cache()
    past, found = [], {}
    state = spark.createDataFrame([], reports.INCREMENT)
    for runs in ([0], [1, 2], list(range(3, 16)), list(range(16, 22)), list(range(22, 28)), [28]):
        own = [df.where(F.col("run").isin(runs)).drop("run") for df in (header, files)]
        added = spark.createDataFrame(reports.report_increment(*own).collect(), reports.INCREMENT)
        past.append(added)
        history = past[0]
        for more in past[1:]:
            history = history.unionByName(more)
        new, changed = reports.advance_report(state, added, history)
        found |= {x[:2]: tuple(x) for x in changed.collect()}
        state = spark.createDataFrame(new.collect(), reports.INCREMENT)
        assert state.count() <= 2 * 3 * 7 * reports.KEPT_DAYS
    whole = reports.daily_report(header.drop("run"), files.drop("run"))
    want = {x[:2]: tuple(x) for x in whole.select(*changed.columns).collect()}
    assert found == want and len(want) > 300
