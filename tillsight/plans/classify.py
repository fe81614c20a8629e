"""Transaction classification: facts per line, flags per receipt, ordered class rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.keys import LINE, LINE_BY_NUMBER, RECEIPT
from tillsight.functions.rules import Rule, first_match
from tillsight.functions.scalars import embedded_price, flag, is_true, money, outside_tolerance
from tillsight.operators.joins import pivot_values, present

# Item types of returned empties, and the lottery product group.
EMPTIES_TYPES = ("Deposit", "DepositRefund")
LOTTERY_GROUP = 83

#: key of the slip add-ons in the data -> column
SLIP_ADDONS = {
    "RECEIPT_NUMBER": "EmptiesReceiptNumber",
    "STORE_NUMBER": "EmptiesStoreID",
    "WORKSTATION_ID": "EmptiesWorkstationID",
}

HEADER_ROW = [*RECEIPT, "FunctionLogStoreInfoID", "TransactionType"]


def slip_addons(addons: DataFrame) -> DataFrame:
    """Deposit slip a position refers to: one column per add-on key."""
    return pivot_values(
        addons, LINE_BY_NUMBER, "AddonKey", "AddonValue", SLIP_ADDONS, carry=["SequenceNumber"]
    )


def net_modifiers(modifiers: DataFrame, keys: list[str] = LINE_BY_NUMBER) -> DataFrame:
    """Per position: signed sum of surcharges and rebates, replacement price, and whether
    a replacement is present."""
    replace = F.col("AmountAction") == "Replace"
    signed = F.when(F.col("AmountAction") == "Subtract", -F.col("AmountValue")).otherwise(
        F.col("AmountValue")
    )
    total = "decimal(20,2)"
    return (
        modifiers.distinct()
        .groupBy(*keys)
        .agg(
            F.sum(money(F.when(~replace, signed).otherwise(0.0))).cast(total).alias("final_modifier"),
            F.sum(money(F.when(replace, F.col("AmountValue")).otherwise(0.0)))
            .cast(total)
            .alias("Replace_amount"),
            F.when(F.count_if(replace) > 0, "With_Replace")
            .otherwise("Without_Replace")
            .alias("action"),
        )
    )


def price_is_wrong() -> Column:
    """The amount of a position follows neither from its unit price and modifiers nor
    from the price inside its item code."""
    amount, quantity = F.col("ExtendedAmount"), F.col("Quantity")
    units = F.coalesce(F.col("Units"), F.lit(1.0))
    extra = F.coalesce(F.col("final_modifier").cast("double"), F.lit(0.0))

    def off(base: Column) -> Column:
        return outside_tolerance(base + extra, amount)

    replaced = F.col("Replace_amount").cast("double") * quantity * units
    regular = F.col("RegularSalesUnitPrice") * quantity * units
    return F.when(F.col("action") == "With_Replace", off(replaced)).otherwise(
        off(regular) & off(embedded_price("POSItemID"))
    )


ITEM_FACTS = [
    "ItemType", "Quantity", "Units", "ExtendedAmount", "RegularSalesUnitPrice", "POSItemID",
    "MerchandiseStructureItemFlag", "MerchandiseHierarchyLevel",
]


def item_facts(sale: DataFrame, returns: DataFrame) -> DataFrame:
    """Facts of sale and return positions in one table, told apart by ``Side``."""
    return sale.select(*LINE, *ITEM_FACTS, F.lit("sale").alias("Side")).unionByName(
        returns.select(*LINE, *ITEM_FACTS, F.lit("return").alias("Side"))
    )


def with_items(lineitemderived: DataFrame, sale: DataFrame, returns: DataFrame) -> DataFrame:
    """Lines with the facts of their sale or return position and its ``Side``. A position
    is one or the other, so both tables are joined in one go."""
    return lineitemderived.join(item_facts(sale, returns), LINE, "left")


def _product_group() -> Column:
    return (F.col("EntryMethod") == "Keyed") & is_true("MerchandiseStructureItemFlag")


def _ratio(hits: Column, total: Column) -> Column:
    return F.count_if(hits).cast("double") / F.nullif(F.count_if(total), F.lit(0))


def group_ratio_columns() -> list[Column]:
    live, known = ~F.col("VoidFlagDerived"), F.col("VoidFlagDerived").isNotNull()
    return [
        _ratio(_product_group() & live, live).alias("productgroupbookingsratio_Val"),
        _ratio(_product_group() & known, known).alias("productgroupbookingsratio_Val_ALL"),
    ]


def product_group_ratio(
    header: DataFrame, lineitemderived: DataFrame, sale: DataFrame, returns: DataFrame
) -> DataFrame:
    """Share of positions keyed in by product group, per retail receipt: among live
    positions and among all of them."""
    per_receipt = (
        with_items(lineitemderived, sale, returns).groupBy(*RECEIPT).agg(*group_ratio_columns())
    )
    retail = header.where("TransactionType = 'RetailTransaction'")
    return retail.select(*RECEIPT, "TransactionType").distinct().join(per_receipt, RECEIPT, "left")


def price_check(
    lineitemderived: DataFrame, sale: DataFrame, returns: DataFrame, modifiers: DataFrame
) -> DataFrame:
    """Positions with ``PriceError``; null where the inputs are incomplete."""
    lines = with_items(lineitemderived, sale, returns).join(
        net_modifiers(modifiers), LINE_BY_NUMBER, "left"
    )
    return lines.where(F.col("Side").isNotNull()).select(
        *LINE, price_is_wrong().alias("PriceError")
    )


#: lines of one receipt that stay together; a receipt with more spreads over as many tasks as it
#: has blocks
BLOCK_LINES = 1024
#: Columns shared by both line keys, and the block. Lines hashed on these meet children of either
#: key without moving again (see ``session.SQL_SETTINGS``).
BLOCK_SPREAD = ["RetailStoreID", "WorkstationID", "ReceiptDateTime", "_block"]


def in_blocks(lines: DataFrame) -> DataFrame:
    """Adds the block of lines within the receipt."""
    return lines.withColumn("_block", F.floor(F.col("LineItemSequenceNumber") / F.lit(BLOCK_LINES)))


def has_all_addons(addons: DataFrame) -> DataFrame:
    """Keys, with their block, of the positions that ``slip_addons`` finds, without their values."""
    named = [F.bool_or(F.col("AddonKey") == name).alias(f"_{i}") for i, name in enumerate(SLIP_ADDONS)]
    keys = [*LINE_BY_NUMBER, "_block"]
    found = addons.dropna(subset=LINE_BY_NUMBER).groupBy(*keys).agg(*named)
    return found.where(" and ".join(f"_{i}" for i in range(len(named)))).select(*keys)


def line_summary(
    lineitemderived: DataFrame,
    sale: DataFrame,
    returns: DataFrame,
    loyalty: DataFrame,
    addons: DataFrame,
    modifiers: DataFrame,
    items: DataFrame | None = None,
) -> DataFrame:
    """Everything the receipt flags need to know about the lines, one row per receipt.

    Children are reduced to one row per line before they are joined, so nothing is
    counted twice and the joined rows never outnumber the lines. Lines and children move by blocks
    of lines; a block becomes a row or, with returned empties, one for each amount, and only these
    move to the receipt. Give ``items``, the item facts of both sides, where all line tables
    lie in equal buckets by ``BLOCK_SPREAD``: then none of them is moved.
    """
    line, by_number = [*LINE, "_block"], [*LINE_BY_NUMBER, "_block"]
    if items is None:
        items = in_blocks(item_facts(sale, returns))
        lineitemderived = in_blocks(lineitemderived).repartition(*BLOCK_SPREAD)
        loyalty, addons = in_blocks(loyalty), in_blocks(addons)
        modifiers = in_blocks(modifiers).repartition(*BLOCK_SPREAD)
    rewarded = loyalty.where(F.col("PointsAwarded").isNotNull())
    lines = (
        lineitemderived.join(items, line, "left")
        .join(present(rewarded, line, "rewarded"), line, "left")
        .join(net_modifiers(modifiers, by_number), by_number, "left")
        .join(has_all_addons(addons).withColumn("has_slip", F.lit(True)), by_number, "left")
    )
    live, void = ~F.col("VoidFlagDerived"), F.col("VoidFlagDerived")
    ret, sal = F.col("Side") == "return", F.col("Side") == "sale"
    direct, amount = F.col("DirectVoidFlag"), F.col("ExtendedAmount")
    empties = ret & F.col("ItemType").isin(*EMPTIES_TYPES)
    goods = ret & ~F.col("ItemType").isin(*EMPTIES_TYPES)
    keyed = F.col("EntryMethod") == "Keyed"
    special = empties & live & ((F.col("Quantity") > 1) | (keyed & (amount > 5)))
    by_scan = ~F.col("MerchandiseStructureItemFlag")
    lottery = F.col("MerchandiseHierarchyLevel") == LOTTERY_GROUP
    wrong = F.when(F.col("Side").isNotNull(), price_is_wrong())
    counts = {
        "lines": F.col("LineItemSequenceNumber").isNotNull(),
        "live": live,
        "live_returns": live & ret,
        "live_sales": live & sal,
        "live_empties": live & empties,
        "live_empties_scanned": live & empties & (F.col("EntryMethod") == "Scanned"),
        "live_goods_returned": live & goods,
        "any_empties": empties,
        "special_empties": special,
        "direct": direct,
        "void_direct": void & direct,
        "void_not_direct": void & ~direct,
        "void_by_scan": void & by_scan,
        "lottery_returns": live & ret & lottery,
        "lottery_sales": live & sal & lottery,
        "with_slip": F.col("has_slip"),
        "with_points": F.col("rewarded"),
        "wrong_price": wrong,
    }
    known = F.col("VoidFlagDerived").isNotNull()
    grouped = {"grouped_live": _product_group() & live, "grouped": _product_group() & known, "known": known}
    live_empties_amount = F.when(live & empties, amount)
    totals = {
        "live_return_total": F.when(live & ret, amount),
        "live_sale_total": F.when(live & sal, amount),
        "live_empties_total": live_empties_amount,
    }
    names = [f"n_{n}" for n in (*counts, *grouped)]
    blocks = lines.groupBy(*RECEIPT, "_block", live_empties_amount.alias("_amount")).agg(
        *[F.count_if(c).alias(f"n_{n}") for n, c in (counts | grouped).items()],
        *[F.sum(money(c)).alias(n) for n, c in totals.items()],
    )
    summed = blocks.groupBy(*RECEIPT).agg(
        *[F.sum(n).alias(n) for n in (*names, *totals)],
        F.count_distinct("_amount").alias("n_live_empties_amounts"),
    )
    ratio = {
        "productgroupbookingsratio_Val": ("n_grouped_live", "n_live"),
        "productgroupbookingsratio_Val_ALL": ("n_grouped", "n_known"),
    }
    return summed.select(
        "*", *[(F.col(hits).cast("double") / F.nullif(F.col(of), F.lit(0))).alias(n) for n, (hits, of) in ratio.items()]
    )


def header_rows(header: DataFrame) -> DataFrame:
    """Distinct transactions with their cancel and training marks."""
    return header.groupBy(*HEADER_ROW).agg(
        flag(F.bool_or("CancelFlag")).alias("Cancel_Flag"),
        flag(F.bool_or("TrainingModeFlag")).alias("TrainingMode_Flag"),
    )


def receipt_flags(
    header: DataFrame,
    retailheader: DataFrame,
    lineitemderived: DataFrame,
    sale: DataFrame,
    returns: DataFrame,
    tender: DataFrame,
    loyalty: DataFrame,
    addons: DataFrame,
    modifiers: DataFrame,
    stores: DataFrame,
    items: DataFrame | None = None,
) -> DataFrame:
    """The flags behind the retail classes, one row per transaction."""
    is_post_void = (F.col("TransactionLinkReasonCode") == "Voided") & (
        F.col("TransactionStatus") == "PostVoided"
    )
    totals = retailheader.select(
        *RECEIPT,
        "TransactionStatus",
        "TransactionGrandAmount",
        "NegativeTotalFlag",
        (is_post_void & F.col("TransactionLinkRetailStoreID").isNotNull()).alias("post_void"),
        (
            (F.col("TransactionTaxAmount") == 0) & F.col("NegativeTransactionTaxAmount").isNull()
        ).alias("untaxed"),
    )
    links = retailheader.where(is_post_void).select(
        F.col("TransactionLinkRetailStoreID").alias("RetailStoreID"),
        F.col("TransactionLinkWorkstationID").alias("WorkstationID"),
        F.col("TransactionLinkSequenceNumber").alias("SequenceNumber"),
        F.col("TransactionLinkReceiptDateTime").alias("ReceiptDateTime"),
    )
    change = tender.groupBy(*RECEIPT).agg(
        F.sum("TenderChangeAmount").alias("change"), F.lit(True).alias("tendered")
    )
    store_type = stores.select(F.col("StoreID").alias("RetailStoreID"), "IsEBUSStore").dropDuplicates(
        ["RetailStoreID"]
    )
    facts = (
        header_rows(header.repartition(*RECEIPT))  # meets its facts where it lies
        .join(totals, RECEIPT, "left")
        .join(line_summary(lineitemderived, sale, returns, loyalty, addons, modifiers, items), RECEIPT, "left")
        .join(change, RECEIPT, "left")
        .join(present(links, RECEIPT, "voided_later"), RECEIPT, "left")
        .join(store_type, "RetailStoreID", "left")
    )
    return facts.select(
        *HEADER_ROW, "productgroupbookingsratio_Val", *[c.alias(n) for n, c in flag_rules().items()]
    )


def flag_rules() -> dict[str, Column]:
    """Flag name -> expression over the joined receipt facts."""
    n = {
        c: F.coalesce(F.col(f"n_{c}"), F.lit(0))
        for c in (
            "lines live live_returns live_sales live_empties live_empties_scanned "
            "live_goods_returned any_empties special_empties direct void_direct void_not_direct "
            "void_by_scan lottery_returns lottery_sales with_slip with_points wrong_price "
            "live_empties_amounts"
        ).split()
    }
    status, total = F.col("TransactionStatus"), F.col("TransactionGrandAmount")
    ratio = F.col("productgroupbookingsratio_Val")
    ratio_all = F.col("productgroupbookingsratio_Val_ALL")
    whole, whole_all = ratio.cast("int") == 1, ratio_all.cast("int") == 1
    has_return = n["live_returns"] > 0
    empties_only = has_return & (n["live_empties"] == n["live"])
    some_empties = n["any_empties"] > 0
    some_not_direct = n["void_not_direct"] > 0
    some_direct = n["void_direct"] > 0
    net = F.col("live_sale_total") - F.col("live_return_total")
    regular_store = F.col("IsEBUSStore") == F.lit(False)

    def lottery(side: str) -> Column:
        live, hits = n[f"live_{side}"], n[f"lottery_{side}"]
        return F.when(live == 0, 0).when((hits == live) & regular_store, 1)

    two_of_three = (
        some_empties.cast("int") + some_not_direct.cast("int") + some_direct.cast("int") >= 2
    )
    return {
        "Cancel_Flag": F.col("Cancel_Flag"),
        "TrainingMode_Flag": F.col("TrainingMode_Flag"),
        "Incorrect_receipt_Flag": flag((F.abs(net) != money(total)) | (n["wrong_price"] > 0)),
        "Void_flag": F.when(F.col("post_void"), "Z")
        .when(F.col("voided_later"), "1")
        .otherwise("0"),
        "put_on_hold_Flag": flag(status.isin("Suspended", "SuspendedRetrieved")),
        "empty_receipt_Flag": flag(
            empties_only & F.col("tendered").isNull() & (n["with_slip"] == 0) & F.col("untaxed")
        ),
        "Receipt_withonlyScannedempties_flag": flag(
            has_return & (n["live_empties_scanned"] == n["live"])
        ),
        "With_CashBack_Flag": flag((F.col("change") > 0) | F.col("NegativeTotalFlag")),
        "LoyaltyRewards_Flag": flag(
            (status == "Totaled") & (n["with_points"] > 0) & (n["lines"] == 1)
        ),
        "Positive_total_Flag": flag(~F.col("NegativeTotalFlag") & (total > 0)),
        "only_returns_Flag": flag(has_return & (n["live_goods_returned"] == n["live"])),
        "only_EmptiesPayOut_withAllproductgroup_flag": flag(empties_only & whole),
        "Special_Empties_Flag": flag(
            (n["special_empties"] > 0)
            | (F.col("live_empties_total") > F.lit(20))
            | (n["live_empties"] > n["live_empties_amounts"])
        ),
        "mostlyproductgroupbookingsratio_Flag": flag((ratio > 0.5) & (ratio < 1)),
        "only_EmptiesPayOut_withproductgroup_flag": flag(empties_only & (ratio > 0)),
        "atleastoneemptiesreturn_Flag": flag(some_empties),
        "lineitemcancellation_nodirectvoid_Flag": flag((n["direct"] == 0) & some_not_direct),
        "has_lineitemcancellation_nodirectvoid_Flag": flag(some_not_direct),
        "lineitemcancellation_directvoid_Flag": flag(some_direct),
        "onlyproductgroupbooking_empty_Flag": flag(some_empties & whole),
        "onlyproductgroupbooking_Flag": flag(whole_all),
        "productgroupbooking_Flag": flag((ratio > 0) & (ratio < 0.5)),
        "return_receipt_Flag": flag(n["live_goods_returned"] > 0),
        "Voided_Scanned_Flag": flag(n["void_by_scan"] > 0),
        "lotto_return_flag": lottery("returns"),
        "lotto_sale_flag": lottery("sales"),
        "min2of3are_empties_immediatevoid_void_Flag": flag(two_of_three),
    }


def _on(name: str) -> Column:
    return F.col(name) == 1


def _by_void(normal: str, voided: str) -> Column:
    return F.when(F.col("Void_flag") == "0", normal).otherwise(voided)


def booking_ladder() -> dict[int, Column]:
    """What distinguishes receipts inside the positive-total and goods-return families,
    most conspicuous first."""
    empties = _on("atleastoneemptiesreturn_Flag")
    return {
        0: _on("Special_Empties_Flag"),
        9: _on("mostlyproductgroupbookingsratio_Flag"),
        8: _on("Voided_Scanned_Flag") & _on("productgroupbooking_Flag"),
        7: _on("onlyproductgroupbooking_empty_Flag") & _on("onlyproductgroupbooking_Flag") & empties,
        6: _on("onlyproductgroupbooking_Flag"),
        5: _on("min2of3are_empties_immediatevoid_void_Flag"),
        4: empties,
        3: _on("lineitemcancellation_nodirectvoid_Flag"),
        2: _on("lineitemcancellation_directvoid_Flag"),
        1: F.lit(True),
    }


def payout_ladder() -> dict[int, Column]:
    """Receipts without a positive total: payouts, plain returns, empties, cancellations."""
    empties = _on("atleastoneemptiesreturn_Flag")
    not_direct = _on("lineitemcancellation_nodirectvoid_Flag")
    direct = _on("lineitemcancellation_directvoid_Flag")
    nothing_else = (
        (F.col("has_lineitemcancellation_nodirectvoid_Flag") == 0)
        & (F.col("lineitemcancellation_directvoid_Flag") == 0)
        & (F.col("Positive_total_Flag") == 0)
        & (F.col("atleastoneemptiesreturn_Flag") == 0)
    )
    return {
        0: _on("only_EmptiesPayOut_withAllproductgroup_flag"),
        9: _on("Receipt_withonlyScannedempties_flag"),
        8: _on("only_returns_Flag") & _on("return_receipt_Flag"),
        6: _on("only_EmptiesPayOut_withproductgroup_flag"),
        7: _on("Special_Empties_Flag"),
        5: _on("productgroupbooking_Flag"),
        4: empties & (direct | not_direct),
        3: empties,
        2: direct | not_direct,
        1: nothing_else,
    }


def retail_rules() -> list[Rule]:
    """Classes of retail receipts in order of precedence. A pair of codes tells normal
    receipts from receipts that were voided later."""
    parked = _on("put_on_hold_Flag")
    empties = _on("atleastoneemptiesreturn_Flag")
    voids_other = F.col("Void_flag") == "Z"
    lotto_sale, lotto_return = F.col("lotto_sale_flag"), F.col("lotto_return_flag")
    rules = [
        Rule("JV1", _on("Cancel_Flag")),
        Rule("JVS", _on("TrainingMode_Flag")),
        Rule(_by_void("HNK", "HAK"), _on("Incorrect_receipt_Flag")),
        Rule("ZN1", voids_other & ~_on("With_CashBack_Flag")),
        Rule("ZN2", voids_other & _on("With_CashBack_Flag")),
        Rule(_by_void("HNL", "HAL"), parked & _on("empty_receipt_Flag")),
        Rule("HNT", parked & ~empties),
        Rule("HLT", parked & empties),
        Rule("HND", _on("LoyaltyRewards_Flag")),
        Rule(_by_void("LN1", "LA1"), (lotto_return == 0) & (lotto_sale == 1)),
        Rule(_by_void("LN2", "LA2"), (lotto_sale == 0) & (lotto_return == 1)),
        Rule(_by_void("LN0", "LA0"), (lotto_sale == 1) & (lotto_return == 1)),
    ]
    families = (
        ("A", booking_ladder(), _on("Positive_total_Flag")),
        ("E", payout_ladder(), F.lit(True)),
        ("C", booking_ladder(), _on("return_receipt_Flag")),
    )
    for letter, ladder, member in families:
        for digit, condition in ladder.items():
            rules.append(
                Rule(_by_void(f"{letter}N{digit}", f"{letter}A{digit}"), member & condition)
            )
    return rules


CLASS_COLUMNS = [*RECEIPT, "FunctionLogStoreInfoID", "TransactionType", "class_id"]


def classify_retail(flags: DataFrame) -> DataFrame:
    retail = flags.where("TransactionType = 'RetailTransaction'")
    return retail.withColumn("class_id", first_match(retail_rules())).select(*CLASS_COLUMNS)


def classify_control(marks: DataFrame, control: DataFrame) -> DataFrame:
    kind = F.col("ControlTransactionType")
    rules = [
        Rule("JVN", _on("TrainingMode_Flag")),
        Rule("XN1", kind == "OperatorSignOn"),
        Rule("XN5", kind == "OperatorSignOff"),
        Rule("HNW", F.col("NoSale").isNotNull() & F.col("ReasonCode").isNull()),
        Rule("HNJ", kind == "SessionSettle"),
    ]
    details = control.select(*RECEIPT, "ControlTransactionType", "NoSale", "ReasonCode")
    return (
        marks.where("TransactionType = 'ControlTransaction'")
        .join(details, RECEIPT, "left")
        .withColumn("class_id", first_match(rules, "HNG"))
        .select(*CLASS_COLUMNS)
        .distinct()
    )


# Names in the function log.
PAUSE_FUNCTION_ID, PAUSE = 89, "X_PAUSE"
LOOKUP_FUNCTION_ID, LOOKUP = 12, "X_ARTICLE_INFORMATION"


def classify_function(marks: DataFrame, functionlog: DataFrame) -> DataFrame:
    name, parameter = F.col("FunctionName"), F.col("ParameterName")
    pause = (F.col("FunctionID") == PAUSE_FUNCTION_ID) & (name == PAUSE)
    lookup = name == LOOKUP
    wanted = functionlog.where(
        pause | (lookup & parameter.isin("ITEM_EAN", "BEGIN", "END"))
    ).select(
        *RECEIPT,
        F.col("StoreInfoID").alias("FunctionLogStoreInfoID"),
        "FunctionID", "FunctionName", "ParameterName", "ParameterValue",
    )
    unattached = F.col("SequenceNumber") == 0
    rules = [
        Rule("JVN", _on("TrainingMode_Flag")),
        Rule(
            F.when(F.col("ParameterValue") == "BEGIN", "XN7").otherwise("XN3"),
            pause & (parameter == "FUNCTION_STATE"),
        ),
        Rule("XPL", lookup & unattached & (parameter == "ITEM_EAN")),
        Rule("XNF", unattached & (~lookup | name.isNull())),
    ]
    return (
        marks.where("TransactionType = 'FunctionLog'")
        .join(wanted, [*RECEIPT, "FunctionLogStoreInfoID"], "left")
        .withColumn("class_id", first_match(rules))
        .select(*CLASS_COLUMNS)
        .distinct()
    )


def classify_tender(
    marks: DataFrame,
    pickup: DataFrame,
    deposit: DataFrame,
    loan: DataFrame,
    tillsettle: DataFrame,
    safesettle: DataFrame,
) -> DataFrame:
    """Tender-control transactions by the child table they appear in."""
    pickups = pickup.select(*RECEIPT, "TenderPickUpReason").distinct().withColumn("p", F.lit(True))
    deposits = (
        deposit.select(*RECEIPT, "PaidInAmount", "PaidOutAmount").distinct().withColumn("d", F.lit(True))
    )
    picked, paid = F.col("p").isNotNull(), F.col("d").isNotNull()
    reason = F.col("TenderPickUpReason")
    rules = [
        Rule("JVN", _on("TrainingMode_Flag")),
        Rule("HNM", picked & reason.isNull()),
        Rule("HNO", F.col("till").isNotNull()),
        Rule("HNP", picked & (reason == "AT")),
        Rule("HNP", F.col("safe").isNotNull()),
        Rule("HNR", F.col("loan").isNotNull()),
        Rule("GN1", paid & F.col("PaidInAmount").isNotNull()),
        Rule("GN5", paid & F.col("PaidOutAmount").isNotNull()),
        Rule("GN6", paid),
    ]
    return (
        marks.where("TransactionType = 'TenderControlTransaction'")
        .join(pickups, RECEIPT, "left")
        .join(deposits, RECEIPT, "left")
        .join(present(loan, RECEIPT, "loan"), RECEIPT, "left")
        .join(present(tillsettle, RECEIPT, "till"), RECEIPT, "left")
        .join(present(safesettle, RECEIPT, "safe"), RECEIPT, "left")
        .withColumn("class_id", first_match(rules, "TDF"))
        .select(*CLASS_COLUMNS)
        .distinct()
    )


def classify_all(tables) -> DataFrame:
    """Class of every transaction. ``tables`` maps model table names to DataFrames and
    must hold ``lineitemderived``. Retail rows are already distinct, the other branches
    deduplicate their own rows, so the union needs no further shuffle."""
    t = tables
    retail_header = t["header"].where("TransactionType = 'RetailTransaction'")
    marks = header_rows(t["header"].where("TransactionType <> 'RetailTransaction'"))
    retail = classify_retail(
        receipt_flags(
            retail_header, t["retailheader"], t["lineitemderived"], t["sale"], t["return"],
            t["tender"], t["loyalty"], t["addon"], t["modifier"], t["stores"],
        )
    )
    return (
        retail.unionByName(classify_control(marks, t["control"]))
        .unionByName(classify_function(marks, t["functionlog"]))
        .unionByName(
            classify_tender(
                marks, t["pickup"], t["deposit"], t["loan"], t["tillsettle"], t["safesettle"]
            )
        )
    )


def class_catalog() -> list[str]:
    """All class codes the rules can give, in order of precedence."""
    retail = "JV1 JVS HNK HAK ZN1 ZN2 HNL HAL HNT HLT HND LN1 LA1 LN2 LA2 LN0 LA0".split()
    ladders = {"A": booking_ladder(), "E": payout_ladder(), "C": booking_ladder()}
    retail += [f"{f}{v}{d}" for f, ladder in ladders.items() for d in ladder for v in "NA"]
    return retail + "JVN XN1 XN5 HNW HNJ HNG XN7 XN3 XPL XNF HNM HNO HNP HNR GN1 GN5 GN6 TDF".split()
