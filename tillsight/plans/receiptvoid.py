"""Voided receipts: was the same basket booked again afterwards, and how was it paid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.keys import LINE, RECEIPT
from tillsight.functions.scalars import business_day
from tillsight.operators.dedup import first_per_key
from tillsight.operators.joins import present
from tillsight.sources.session import kept, scratch_path

LANE_DAY = ["RetailStoreID", "WorkstationID", "ReceiptDate"]

# How many later receipts are compared, which share of positions must
# reappear, and the highest rank written out in a code.
FOLLOW_UPS = 10
MATCH_RATIO = 0.5
LAST_RANK, CAPPED_RANK = 8, "9"

# Tender ids of cash and of cards.
CASH_TENDER = "YTCS"
CARD_TENDERS = (
    "YOAM YOMA YOMC YOV0 YOVI YOVO YTAC YTAM YTDC YTDD YTDI YTDK YTDP YTEA YTEC YTEK YTGG YTGK "
    "YTKR YTKT YTLV YTMA YTMB YTMC YTNG YTOF YTSO YTVB YTVC YTVE YTVG YTVI YTVO YTVP YTVQ"
).split()
# Product groups worth a second look, by store type.
SUSPICIOUS_GROUPS_EBUS = (1, 2, 3, 15, 21, 22)
SUSPICIOUS_GROUPS_OTHER = (1, 4, 6, 12, 17)


def void_kind(class_id):
    """'1' voided receipt, '0' normal receipt, 'I' neither, by class prefix."""
    c = F.col(class_id) if isinstance(class_id, str) else class_id
    return (
        F.when(c.rlike("^[AEC]A"), "1").when(c.rlike("^[AEC]N"), "0").otherwise("I")
    )


def booked_lines(
    lineitemderived: DataFrame,
    sale: DataFrame,
    returns: DataFrame,
    retailheader: DataFrame,
    classification: DataFrame,
) -> DataFrame:
    """Live positions other than deposits, with what identifies item and price."""
    facts = [*LINE, "RegularSalesUnitPrice", "ExtendedAmount", "MerchandiseHierarchyLevel", "POSItemID"]
    items = (
        sale.where("ItemType <> 'Deposit'").select(*facts)
        .unionByName(returns.where("ItemType <> 'Deposit'").select(*facts))
    )
    live = lineitemderived.where("not VoidFlagDerived").select(*LINE)
    classes = classification.where("TransactionType = 'RetailTransaction'").select(*RECEIPT, "class_id")
    unit = F.col("RegularSalesUnitPrice")
    return (
        live.join(items, LINE)
        .join(retailheader.select(*RECEIPT, "TransactionGrandAmount"), RECEIPT)
        .join(classes, RECEIPT)
        .select(
            *LINE,
            business_day("ReceiptDateTime").alias("ReceiptDate"),
            "class_id",
            void_kind("class_id").alias("void_class_flag"),
            "TransactionGrandAmount",
            "MerchandiseHierarchyLevel",
            F.coalesce(
                F.col("POSItemID").cast("string"), F.col("MerchandiseHierarchyLevel").cast("string")
            ).alias("item_key"),
            F.when(unit != 0, unit).otherwise(F.col("ExtendedAmount")).alias("price_key"),
        )
    )


def _baskets(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*RECEIPT, "ReceiptDate", "TransactionGrandAmount").agg(
        F.count(F.lit(1)).alias("n")
    )


def item_counts(lines: DataFrame) -> DataFrame:
    """Number of positions of each item and price in every voided or normal receipt. Written
    to the scratch folder: it is read from both sides of the match, and far smaller than the
    lines."""
    counts = (
        lines.where("void_class_flag in ('0', '1')")
        .groupBy(*RECEIPT, "ReceiptDate", "TransactionGrandAmount", "void_class_flag", "item_key", "price_key")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    path = scratch_path(lines.sparkSession, "item_counts")
    counts.write.parquet(path)
    return lines.sparkSession.read.schema(counts.schema).parquet(path)


def follow_up_candidates(counts: DataFrame) -> DataFrame:
    """For every voided receipt the next times of its lane and day that hold a later normal
    receipt, numbered in ``row_num``.

    The order is by time; receipts of one time count as one follow-up. One running count of
    the times with a normal receipt places normal and voided receipts alike. It runs over one
    row per time, of which a lane has no more than a day has seconds, so no key is hot. A
    voided receipt then joins the few numbers that follow, so a lane with many receipts is
    never joined to itself, nor are the receipts of one time. The time of the voided receipt
    itself counts if it holds a normal receipt of a higher sequence number.
    """
    is_normal, sequence = F.col("void_class_flag") == "0", F.col("SequenceNumber")
    times = counts.groupBy(*LANE_DAY, "ReceiptDateTime").agg(
        F.max(is_normal.cast("int")).alias("normal"),
        F.max(F.when(is_normal, sequence)).alias("last_normal"),
    )
    upto = F.sum("normal").over(Window.partitionBy(*LANE_DAY).orderBy("ReceiptDateTime"))
    placed = times.withColumn("upto", upto)
    voided = counts.where("void_class_flag = '1'").groupBy(*RECEIPT, "ReceiptDate").agg(F.sum("c").alias("n"))
    # a normal receipt has the number of its time; a voided one the number before the first it may meet
    here = F.coalesce(F.col("last_normal") > sequence, F.lit(False))
    base = F.col("upto") - F.when(here, 1).otherwise(0)
    wanted = voided.join(placed, [*LANE_DAY, "ReceiptDateTime"]).select(
        *RECEIPT, "ReceiptDate", "n", F.posexplode(F.sequence(base + 1, base + FOLLOW_UPS)).alias("row_num", "pos")
    )
    follow = placed.where("normal = 1").select(
        *LANE_DAY, F.col("upto").alias("pos"), F.col("ReceiptDateTime").alias("FollowTime")
    )
    return wanted.join(follow, [*LANE_DAY, "pos"]).select(
        *RECEIPT, "n", (F.col("row_num") + 1).alias("row_num"), "FollowTime"
    )


#: what follow-ups are compared by: items with their price, and totals of receipts
_WHAT = ["kind", "what", "price"]


def _compared(counts: DataFrame) -> DataFrame:
    """Positions of each receipt by what they are compared by: item and price, and total."""
    receipt = [*RECEIPT, "ReceiptDate", "void_class_flag"]
    items = counts.select(
        *receipt, F.lit("item").alias("kind"), F.col("item_key").alias("what"), F.col("price_key").alias("price"), "c"
    )
    totals = counts.select(
        *receipt, F.lit("total").alias("kind"), F.lit("").alias("what"), F.col("TransactionGrandAmount").alias("price"), "c"
    )
    known = items.unionByName(totals).dropna(subset=_WHAT)
    return known.groupBy(*receipt, *_WHAT).agg(F.sum("c").alias("c"))


def followup_matches(lines: DataFrame) -> DataFrame:
    """Match of every voided receipt with each of its next follow-ups.

    Pairs of equal item and price, and of equal totals, are counted from counts per receipt
    and counts per time (count times count): no receipt is joined with the receipts of a time,
    however many of them there are. Within the time of the voided receipt, a running sum gives
    the count of the higher sequence numbers.
    """
    counts = item_counts(lines)
    lane_time = ["RetailStoreID", "WorkstationID", "ReceiptDateTime"]
    normal, voided = F.col("void_class_flag") == "0", F.col("void_class_flag") == "1"
    compared = _compared(counts)
    mixed = (
        counts.groupBy(*lane_time)
        .agg(
            F.max(F.when(normal, F.col("SequenceNumber"))).alias("last_normal"),
            F.min(F.when(voided, F.col("SequenceNumber"))).alias("first_voided"),
        )
        .where("last_normal > first_voided")
    )
    higher = Window.partitionBy(*lane_time, *_WHAT).orderBy(F.col("SequenceNumber").desc()).rangeBetween(
        Window.unboundedPreceding, -1
    )
    own = (
        compared.join(mixed.select(*lane_time), lane_time, "left_semi")
        .withColumn("follow_c", F.sum(F.when(normal, F.col("c"))).over(higher))
        .where(voided)
        .select(*RECEIPT, *_WHAT, F.col("ReceiptDateTime").alias("FollowTime"), F.col("c") * F.col("follow_c"))
        .toDF(*RECEIPT, *_WHAT, "FollowTime", "pairs")
    )
    of_time = (
        compared.where(normal)
        .groupBy("RetailStoreID", "WorkstationID", F.col("ReceiptDateTime").alias("FollowTime"), *_WHAT)
        .agg(F.sum("c").alias("follow_c"))
    )
    candidates = kept(follow_up_candidates(counts), "follow_ups")
    later = (
        candidates.where(F.col("FollowTime") > F.col("ReceiptDateTime")).select(*RECEIPT, "FollowTime")
        .join(compared.where(voided).select(*RECEIPT, *_WHAT, "c"), RECEIPT)
        .join(of_time, ["RetailStoreID", "WorkstationID", "FollowTime", *_WHAT])
        .select(*RECEIPT, *_WHAT, "FollowTime", (F.col("c") * F.col("follow_c")).alias("pairs"))
    )

    def pairs(kind: str):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("pairs"))), F.lit(0))

    found = later.unionByName(own).groupBy(*RECEIPT, "FollowTime").agg(
        pairs("item").alias("matches"), pairs("total").alias("TrnAmtMatch")
    )
    return candidates.join(found, [*RECEIPT, "FollowTime"], "left").select(
        *RECEIPT, "FollowTime", "row_num",
        (F.coalesce("matches", F.lit(0)) / F.col("n")).alias("item_match"),
        F.coalesce("TrnAmtMatch", F.lit(0)).alias("TrnAmtMatch"),
    )


def void_followup(lines: DataFrame) -> DataFrame:
    """First follow-up that repeats enough of the voided receipt."""
    good = followup_matches(lines).where(F.col("item_match") >= MATCH_RATIO)
    return first_per_key(good, RECEIPT, ["row_num"]).select(
        *RECEIPT, "row_num", "item_match", "TrnAmtMatch"
    )


def tender_codes(matched: DataFrame, tender: DataFrame) -> DataFrame:
    """V + rank for cash, K + rank for a card payment of the same total, else null."""
    paid = tender.groupBy(*RECEIPT).agg(
        F.count_if(F.col("TenderID") == CASH_TENDER).alias("cash"),
        F.count_if(F.col("TenderID").isin(*CARD_TENDERS)).alias("card"),
    )
    rank = F.when(F.col("row_num") > LAST_RANK, CAPPED_RANK).otherwise(
        F.col("row_num").cast("string")
    )
    code = F.when(F.col("cash") > 0, F.concat(F.lit("V"), rank)).when(
        (F.col("TrnAmtMatch") > 0) & (F.col("card") > 0), F.concat(F.lit("K"), rank)
    )
    return matched.join(paid, RECEIPT, "left").select(*RECEIPT, code.alias("Bonstorno_Flag"))


def unmatched_codes(
    lines: DataFrame,
    matched: DataFrame,
    tender: DataFrame,
    stores: DataFrame,
    header: DataFrame,
    intended: bool = False,
) -> DataFrame:
    """Code of voided receipts without a repeat: change given x suspicious product group x
    no follow-up sale, as AA .. AD and WA .. WD.

    As specified, the follow-up mark looks for the last normal receipt *of the voided
    receipt itself* and so never fires. ``intended`` asks instead whether the employee
    booked no later normal receipt on that lane and day.
    """
    voided = lines.where("void_class_flag = '1'")
    special = stores.where("IsEBUSStore").select(F.col("StoreID").alias("RetailStoreID"))
    group = F.col("MerchandiseHierarchyLevel")
    suspicious = F.when(F.col("ebus"), group.isin(*SUSPICIOUS_GROUPS_EBUS)).otherwise(
        group.isin(*SUSPICIOUS_GROUPS_OTHER)
    )
    per_receipt = (
        voided.join(present(special, ["RetailStoreID"], "ebus"), "RetailStoreID", "left")
        .groupBy(*RECEIPT, "ReceiptDate")
        .agg(F.max(F.when(suspicious, 1).otherwise(0)).alias("group_flag"))
    )
    change = tender.groupBy(*RECEIPT).agg(F.max("TenderChangeAmount").alias("change"))
    employee = header.select(*RECEIPT, "EmployeeID")
    normal = _baskets(lines.where("void_class_flag = '0'")).join(employee, RECEIPT)
    lane_employee = [*LANE_DAY, "EmployeeID"]
    if intended:
        last = normal.groupBy(*lane_employee).agg(F.max("ReceiptDateTime").alias("last_time"))
        marks = (
            per_receipt.select(*RECEIPT, "ReceiptDate").join(employee, RECEIPT)
            .join(last, lane_employee, "left")
            .where(F.coalesce(F.col("last_time") <= F.col("ReceiptDateTime"), F.lit(True)))
        )
    else:
        marks = first_per_key(
            normal, lane_employee, [F.col("ReceiptDateTime").desc(), F.col("SequenceNumber").desc()]
        )
    without_next = F.coalesce(F.col("alone"), F.lit(False))
    first = F.when(F.col("group_flag") == 1, "W").otherwise("A")
    second = (
        F.when(F.col("change").isNull(), F.when(without_next, "C").otherwise("A"))
        .otherwise(F.when(without_next, "D").otherwise("B"))
    )
    return (
        per_receipt.join(change, RECEIPT, "left")
        .join(present(marks, RECEIPT, "alone"), RECEIPT, "left")
        .join(matched.select(*RECEIPT), RECEIPT, "left_anti")
        .select(*RECEIPT, F.concat(first, second).alias("Bonstorno_Flag"))
    )


def void_report(
    codes: DataFrame,
    retailheader: DataFrame,
    classification: DataFrame,
    header: DataFrame,
    class_texts: DataFrame,
) -> DataFrame:
    """Original receipt and the receipt that voided it, side by side."""
    classes = classification.where("TransactionType = 'RetailTransaction'").select(
        *RECEIPT, "class_id"
    ).join(class_texts.select("class_id", "class_desc_en"), "class_id", "left")

    def renamed(df: DataFrame, suffix: str, extra: dict[str, str]) -> DataFrame:
        return df.select(*[F.col(c).alias(c + suffix) for c in RECEIPT],
                         *[F.col(c).alias(a) for c, a in extra.items()])

    key1 = [c + "_1" for c in RECEIPT]
    key2 = [c + "_2" for c in RECEIPT]
    original = renamed(
        retailheader, "_1",
        {"ReceiptNumber": "ReceiptNumber_1", "TransactionGrandAmount": "TransactionGrandAmount",
         "NegativeTotalFlag": "NegativeTotalFlag"},
    )
    voiding = renamed(
        retailheader, "_2",
        {"ReceiptNumber": "ReceiptNumber_2", "TransactionLinkRetailStoreID": "RetailStoreID_1",
         "TransactionLinkWorkstationID": "WorkstationID_1",
         "TransactionLinkSequenceNumber": "SequenceNumber_1",
         "TransactionLinkReceiptDateTime": "ReceiptDateTime_1"},
    )
    approver = renamed(header, "_2", {"ApproverEmployeeID": "Approver"})
    return (
        renamed(codes, "_1", {"Bonstorno_Flag": "BonStornoFlag"})
        .join(original, key1)
        .join(voiding, key1)
        .join(renamed(classes, "_1", {"class_id": "TransactionClassID_1",
                                      "class_desc_en": "TransactionClassDescr_1"}), key1)
        .join(renamed(classes, "_2", {"class_id": "TransactionClassID_2",
                                      "class_desc_en": "TransactionClassDescr_2"}), key2)
        .join(approver, key2)
        .select(
            *key1, "ReceiptNumber_1", *key2, "ReceiptNumber_2", "BonStornoFlag",
            "TransactionClassID_1", "TransactionClassDescr_1", "TransactionClassID_2",
            "TransactionClassDescr_2", "TransactionGrandAmount", "NegativeTotalFlag", "Approver",
        )
    )
