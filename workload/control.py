"""Load control, logs and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillsight.plans import control, daily, reports
from tillsight.sources import writers
from tillsight.sources.runs import Runs
from tillsight.sources.session import scratch_path
from tillsight.sources.widedata import wide_transactions
from workload import publish, rules  # noqa: F401 - their queries state the rows of published tables
from workload.ingest import KEYS
from workload.registry import ENTRIES, query
from workload.rules import class_texts
from workload.stages import stage

RUN_DATE, STARTED, ENDED = "2024-01-16", "2024-01-16 04:00:00", "2024-01-16 05:00:00"
LOAD_DAY = "2024-01-15"
#: typed tables of a run
TYPED = (
    "header retailheader lineitem sale return tender loyalty addon modifier stores control functionlog "
    "pickup deposit loan tillsettle safesettle articles hierarchy headeraddon customer"
).split()


def received(t):
    """Store days that sent data, with the expected status of the store."""
    days = t["receipt"].where("RetailStoreID <> 2").select("RetailStoreID", "Date").distinct()
    status = control.store_status(t["stores"], RUN_DATE).select("RetailStoreID", "Status")
    return days.join(status, "RetailStoreID")


_STATUS = "case Status when 'Aktiv' then 'A' when 'Inaktiv' then 'I' when 'Inaktiv (temp.)' then 'T' end"
_HISTORY = "(select coalesce(max(o_custkey), 0) + 1 from orders)"


def history(t):
    return t.base("orders").select(F.col("o_custkey").alias("LoadID"))


@query(
    "store_status",
    f"select StoreID as RetailStoreID, cast('{LOAD_DAY}' as date) as Date, {_STATUS} as Status, cast(null as bigint) as LoadID, Reason from {{stores}}",
)
def _(t):
    return control.store_status(t["stores"], RUN_DATE)


@query(
    "load_status_merge",
    f"select s.StoreID as RetailStoreID, case when d.x is not null then {_HISTORY} end as LoadID, "
    f"case when d.x is not null then 'L' else {_STATUS} end as Status, cast('{LOAD_DAY}' as date) as Date, Reason from {{stores}} s "
    f"left join (select distinct RetailStoreID, 1 as x from {{receipt}} where Date = date '{LOAD_DAY}' and RetailStoreID <> 2) d on d.RetailStoreID = s.StoreID",
)
def _(t):
    expected = control.store_status(t["stores"], RUN_DATE)
    days = control.store_days(t["receipt"].where("RetailStoreID <> 2"))
    log = control.store_load_log(days, "L", STARTED, ENDED, 0, 0, history(t))
    return control.merge_load_status(expected, log, history(t))


@query(
    "stores_missing_data",
    f"select '{ENDED}' as EventDateTime, StoreID as RetailStoreID, 'E' as Level, 'Active store but no data' as EventType, "
    "'Store is active but did not receive the data' as EventMessage, 0 as LoadID from {stores} where Status = 'Aktiv' "
    "and not exists (select 1 from {receipt} r where r.RetailStoreID = StoreID and r.RetailStoreID <> 2)",
)
def _(t):
    return control.stores_missing_data(t["stores"], received(t), ENDED)


@query(
    "stores_unexpected_data",
    f"select '{ENDED}' as EventDateTime, StoreID as RetailStoreID, 'W' as Level, 'Inactive store but received the data' as EventType, "
    "'Store ' || StoreID || ' is temporarily inactive but still received the data for ' || cast(d.Date as varchar) as EventMessage, 0 as LoadID "
    "from {stores} join (select distinct RetailStoreID, Date from {receipt}) d on d.RetailStoreID = StoreID where Status = 'Inaktiv (temp.)' and StoreID <> 2",
)
def _(t):
    return control.stores_unexpected_data(received(t), ENDED)


@query("store_days", "select distinct RetailStoreID, cast(ReceiptDateTime as date) as BusinessDate from {header}")
def _(t):
    return control.store_days(t["header"])


_LOG = f"'{STARTED}' as StartDateTime, '{ENDED}' as EndDateTime"


@query(
    "store_load_log",
    f"select distinct RetailStoreID, 'L' as Status, Date as BusinessDate, {_LOG}, 1 as WarningsCount, 0 as ErrorsCount, {_HISTORY} as LoadID from {{receipt}}",
)
def _(t):
    return control.store_load_log(control.store_days(t["receipt"]), "L", STARTED, ENDED, 1, 0, history(t))


@query(
    "run_load_log",
    f"select 'in/a,in/b' as SourceFolder, count(distinct RetailStoreID) as StoreCount, 1 as WarningsCount, 2 as ErrorsCount, {_LOG}, {_HISTORY} as LoadID from {{receipt}}",
)
def _(t):
    days = control.store_days(t["receipt"])
    return control.run_load_log(days, ["in/a", "in/b"], STARTED, ENDED, 1, 2, history(t))


_NAME = (
    "lpad(cast(RetailStoreID as string), 4, '0') || '.t_log.' || cast(20240101 + (k // 60) % 30 as string) "
    "|| '083000.' || lpad(cast(k // 7 as string), 5, '0') || '.xml.gz'"
)


def files(t):
    return control.file_register(
        t["receipt"].select(F.expr(_NAME.replace("//", "div")).alias("xmlfilename"))
    ).withColumn("RetailStoreID", F.col("RetailStoreID").cast("bigint"))


_FILES = (
    "select xmlfilename, cast(substring(xmlfilename, 1, 4) as bigint) as RetailStoreID, "
    "strptime(substring(xmlfilename, 12, 8), '%Y%m%d')::date as BusinessDate, "
    "strptime(substring(xmlfilename, 12, 14), '%Y%m%d%H%M%S') as CreationDateTime, "
    "substring(xmlfilename, 27, 5) as ConsecutiveNumber, 0 as IsDeleted from (select distinct " + _NAME + " as xmlfilename from {receipt}) q"
)


@query("file_register", _FILES)
def _(t):
    return files(t)


@query(
    "daily_report",
    "select h.*, f.XMLFilesCount, avg(retail_transactions) over (partition by h.RetailStoreID, dayofweek(h.BusinessDay) order by h.BusinessDay "
    "rows between 7 preceding and current row) as Average_Retail_trn from (select RetailStoreID, cast(ReceiptDateTime as date) as BusinessDay, "
    "count(case when TransactionType = 'ControlTransaction' then 1 end) as control_transactions, "
    "count(case when TransactionType = 'FunctionLog' then 1 end) as functionlog_transactions, "
    "count(case when TransactionType = 'RetailTransaction' then 1 end) as retail_transactions, "
    "count(case when TransactionType = 'TenderControlTransaction' then 1 end) as tender_transactions from {header} group by 1, 2) h "
    "left join (select RetailStoreID, BusinessDate, count(*) as XMLFilesCount from (" + _FILES + ") x group by 1, 2) f "
    "on f.RetailStoreID = h.RetailStoreID and f.BusinessDate = h.BusinessDay",
)
def _(t):
    return reports.daily_report(t["header"], files(t))


@query("daily_report_state", ENTRIES["daily_report"].sql)
def _(t):
    """The report carried on over four runs: three weeks in order, then what came late. Each run
    reads the state the one before left, not the transactions before it."""
    runs = Runs(t.spark, scratch_path(t.spark, "report"))
    header = t["header"].select("RetailStoreID", "ReceiptDateTime", "TransactionType")
    every = files(t)
    late = F.crc32(F.col("TransactionType")) % 2 == 0
    week = lambda day: F.floor(F.datediff(day, F.lit("2024-01-01")) / 10)
    for part in range(4):
        own = ((week(F.to_date("ReceiptDateTime")) == part) & ~late) if part < 3 else late | ~week(F.to_date("ReceiptDateTime")).isin(0, 1, 2)
        came = week(F.col("BusinessDate")) == part if part < 3 else ~week(F.col("BusinessDate")).isin(0, 1, 2)
        load, paths, schemas = runs.start(), {}, {}

        def write(name, df, load=load, paths=paths, schemas=schemas):
            paths[name], schemas[name] = [writers.write_table(df, runs.root, f"{name}/run={load}")], df.schema
            return t.spark.read.schema(df.schema).parquet(*paths[name])

        daily.carry_report(runs, write, header.where(own), every.where(came))
        runs.publish(load, paths, schemas)
    return daily.full_report(runs)


@query(
    "day_summary",
    f"select cast(ReceiptDateTime as date) as BusinessDay, count(case when TransactionType = 'RetailTransaction' then 1 end) as retail_transactions, "
    f"count(*) as Total_transactions, (select count(*) from (" + _FILES + f") x where BusinessDate = date '{LOAD_DAY}') as XMLFilesCount "
    f"from {{header}} where cast(ReceiptDateTime as date) = date '{LOAD_DAY}' group by 1",
)
def _(t):
    return reports.day_summary(t["header"], files(t), LOAD_DAY)


@query("files_per_day", "select count(*) as XMLFilesCount from (" + _FILES + f") x where BusinessDate = date '{LOAD_DAY}'")
def _(t):
    return reports.files_per_day(files(t), LOAD_DAY)


@query(
    "classification_checks",
    "select count(distinct coalesce(class_id, '')) as classes, count(case when class_id = 'HNK' then 1 end) as incorrect_receipts, count(*) as transactions, "
    "count(distinct coalesce(class_id, '')) < 2 as low_entropy from {classification}",
)
def _(t):
    return reports.classification_checks(stage(t, "classification"))


@query(
    "incorrect_receipt_keys",
    "select distinct RetailStoreID || ':' || WorkstationID || ':' || SequenceNumber as incorrectreceiptkey, ReceiptDateTime from {classification} where class_id = 'HNK'",
)
def _(t):
    return reports.incorrect_receipts(stage(t, "classification"))


_BATCH = "(select RetailStoreID, ceil(row_number() over (order by RetailStoreID) / 5.0) as batch from (select distinct RetailStoreID from {header}) q)"
#: runs of this session: the outcome of a run over one directory serves all queries on it
_runs: dict[tuple[str, str], daily.DailyRun] = {}


def finished_run(t) -> tuple[str, daily.DailyRun]:
    """Whole run over all stores, five a batch, two batches at a time. The second batch fails
    while it publishes. A run over the same root before it shows that only the last is read."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key in _runs:
        return _runs[key]

    def check(known):
        return known["header"].select("RetailStoreID").distinct().withColumn(
            "checked", F.when(F.col("RetailStoreID") == 7, F.raise_error(F.lit("store 7 is broken")).cast("int")).otherwise(1)
        )

    root = scratch_path(t.spark, "daily")
    # the modifiers of the benchmark model carry the rebate rules as well
    tables = {n: t[n] for n in TYPED} | {"class_texts": class_texts(t), "rebate": t["modifier"]}
    steps = [*daily.RULE_STEPS, *daily.PUBLISH_STEPS, ("published_check", check)]
    parts = t["receipt"].select(F.concat(F.lit("part-"), (F.col("k") % 50).cast("string")).alias("part_filename"))
    run = daily.daily_run(
        tables, root, RUN_DATE, STARTED, ENDED, history(t), files(t), 5, steps,
        parts=parts, folders=["in/a", "in/b"], parallel=2,
    )
    _runs[key] = root, run
    return _runs[key]


@query(
    "daily_run",
    f"select s.StoreID as RetailStoreID, case when d.x is not null then {_HISTORY} end as LoadID, "
    f"case when d.x is null then {_STATUS} when d.batch = 2 then 'E' else 'L' end as Status, cast('{LOAD_DAY}' as date) as Date, Reason, "
    "coalesce(c.n, 0) as transactions, coalesce(p.n, 0) as points, coalesce(v.n, 0) as report_days from {stores} s "
    f"left join (select distinct h.RetailStoreID, batch, 1 as x from {{header}} h join {_BATCH} b using (RetailStoreID) where cast(ReceiptDateTime as date) = date '{LOAD_DAY}') d on d.RetailStoreID = s.StoreID "
    f"left join (select RetailStoreID, count(*) as n from {{employee}} join {_BATCH} b using (RetailStoreID) where batch <> 2 group by 1) c on c.RetailStoreID = s.StoreID "
    "left join (select RetailStoreID, count(*) as n from (select distinct RetailStoreID, WorkstationID, ReceiptDateTime, ReceiptNumber, coalesce(ReferenceID, 0) as a, coalesce(RuleDescription, '0') as b "
    f"from {{loyalty}}) y join {_BATCH} b using (RetailStoreID) where batch <> 2 group by 1) p on p.RetailStoreID = s.StoreID "
    f"left join (select RetailStoreID, count(distinct cast(ReceiptDateTime as date)) as n from {{header}} join {_BATCH} b using (RetailStoreID) where batch <> 2 group by 1) v on v.RetailStoreID = s.StoreID",
)
def _(t):
    root, run = finished_run(t)
    out = run.load_status
    counted = {
        "transactions": daily.published(t.spark, root, "published_header"),
        "points": daily.published(t.spark, root, "published_loyalty"),
        "report_days": run.report,
    }
    for name, df in counted.items():
        out = out.join(df.groupBy("RetailStoreID").agg(F.count(F.lit(1)).alias(name)), "RetailStoreID", "left").fillna(0, [name])
    return out


#: published table -> registered query of its rows, store column, and a whole number of each row
_PUBLISHED = {
    "published_header": ("publish_header", "RetailStoreID", "TransactionType"),
    "published_loyalty": ("publish_loyalty", "RetailStoreID", "PointsAwarded"),
    "published_modifiers": ("publish_modifiers", "RetailStoreID", "PriceModifierSequenceNumber"),
    "published_empties": ("publish_empties", "RetailStoreID", "LineItemSequenceNumber"),
    "published_pricelookup": ("publish_pricelookup", "RetailStoreID", "ReceiptNumberFL"),
    "published_receiptvoid": ("publish_receiptvoid", "RetailStoreID_1", "SequenceNumber_1"),
    "published_suspended": ("publish_suspended", "RetailStoreID_suspended", "ReceiptNumber_suspended"),
    "published_retailheader": ("publish_retailheader", "RetailStoreID", "TransactionStatus"),
    "published_lineitem": ("publish_lineitem", "RetailStoreID", "EntryMethod"),
    "published_salereturn": ("publish_salereturn", "RetailStoreID", "ItemType"),
    "published_tender": ("publish_tender", "RetailStoreID", "1000000 * TypeCode + 1000 * TenderID + CardType"),
}


def _published_sql() -> str:
    parts = [
        f"select '{name}' as table_name, x.{store} as RetailStoreID, count(*) as n, cast(sum({number}) as bigint) as total "
        f"from ({ENTRIES[of].sql}) x join {_BATCH} b on b.RetailStoreID = x.{store} where batch <> 2 group by x.{store}"
        for name, (of, store, number) in _PUBLISHED.items()
    ]
    parts += [
        f"select '{name}', cast(null as bigint), count(*), cast(null as bigint) from ({ENTRIES[of].sql}) x"
        for name, of in (("published_articles", "publish_masterdata"), ("published_hierarchy", "publish_hierarchy"))
    ]
    return " union all ".join(parts)


@query("daily_run_tables", _published_sql())
def _(t):
    """Rows of every published table by store, and the sum of its encoded or numeric column."""
    root, run = finished_run(t)
    out = None
    for name, (_, store, number) in _PUBLISHED.items():
        df = daily.published(t.spark, root, name, run.load).groupBy(F.col(store).alias("RetailStoreID"))
        part = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr(number)).cast("bigint").alias("total"))
        part = part.select(F.lit(name).alias("table_name"), "RetailStoreID", "n", "total")
        out = part if out is None else out.unionByName(part)
    none = F.lit(None).cast("bigint")
    for name, _ in daily.MASTER_STEPS:
        df = daily.published(t.spark, root, name, run.load)
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), none.alias("RetailStoreID"), "n", none.alias("total")))
    return out


_DAYS = f"(select distinct h.RetailStoreID, batch, cast(ReceiptDateTime as date) as BusinessDate from {{header}} h join {_BATCH} b using (RetailStoreID))"


@query(
    "daily_run_logs",
    f"select 'store_load_log' as log, RetailStoreID, cast(BusinessDate as varchar) as day, case when batch = 2 then 'E' else 'L' end as state, {_HISTORY} as LoadID, 1 as n from {_DAYS} d "
    f"union all select 'run_load_log', null, '{STARTED}', 'in/a,in/b', {_HISTORY}, count(distinct RetailStoreID) from {_DAYS} d "
    f"union all select 'event_log', StoreID, '{ENDED}', 'E', {_HISTORY}, 1 from {{stores}} where Status = 'Aktiv' and StoreID not in (select RetailStoreID from {_DAYS} d) "
    f"union all select 'event_log', StoreID, '{ENDED}', 'W', {_HISTORY}, count(*) from {{stores}} join {_DAYS} d on d.RetailStoreID = StoreID where Status = 'Inaktiv (temp.)' group by StoreID "
    f"union all select 'file_register', RetailStoreID, cast(BusinessDate as varchar), '0', null, count(*) from ({_FILES}) x group by all "
    "union all select 'consumed_parts', null, 'part-' || cast(k % 50 as varchar), '1', null, 1 from {receipt} group by k % 50",
)
def _(t):
    """Logs, events, file register and consumed part files of the run, as they are written."""
    root, run = finished_run(t)
    runs = Runs(t.spark, root)
    none = F.lit(None).cast("bigint")
    one = F.lit(1).cast("bigint").alias("n")
    rows = {
        "store_load_log": lambda d: d.select("RetailStoreID", F.col("BusinessDate").cast("string").alias("day"), F.col("Status").alias("state"), "LoadID", one),
        "run_load_log": lambda d: d.select(none.alias("RetailStoreID"), F.col("StartDateTime").alias("day"), F.col("SourceFolder").alias("state"), "LoadID", F.col("StoreCount").alias("n")),
        "event_log": lambda d: d.groupBy("RetailStoreID", F.col("EventDateTime").alias("day"), F.col("Level").alias("state"), "LoadID").agg(F.count(F.lit(1)).alias("n")),
        "file_register": lambda d: d.groupBy("RetailStoreID", F.col("BusinessDate").cast("string").alias("day"), F.col("IsDeleted").cast("string").alias("state")).agg(F.count(F.lit(1)).alias("n")).withColumn("LoadID", none),
    }
    parts = [f(runs.table(name, run.load)).withColumn("log", F.lit(name)) for name, f in rows.items()]
    parts.append(runs.consumed().select(none.alias("RetailStoreID"), F.col("part_filename").alias("day"), F.col("status").cast("string").alias("state"), none.alias("LoadID"), one, F.lit("consumed_parts").alias("log")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out



def _ingested_sql() -> str:
    """Rows of each typed table by store, as the queries of its builders state them, and of the
    tenders that are published from there."""
    built = {f"typed_{name}": ENTRIES[KEYS[builder]].sql for name, builder in daily.INGESTED.items()}
    built["published_tender"] = built["typed_tender"]
    return " union all ".join(
        f"select '{name}' as table_name, RetailStoreID, count(*) as n from ({sql}) x group by RetailStoreID" for name, sql in built.items()
    )


@query("daily_run_ingested", _ingested_sql())
def _(t):
    """A run that starts from wide transactions: typed tables, voids and classes, and what is
    published with dictionaries."""
    wide = t.keep("wide_transactions", lambda: wide_transactions(t))
    lookups = {n: t[n] for n in ("stores", "articles", "hierarchy")}
    root = scratch_path(t.spark, "ingested")
    steps = [s for s in daily.RULE_STEPS if s[0] in ("lineitemderived", "classification")]
    run = daily.daily_run(daily.ingest(wide) | lookups, root, RUN_DATE, STARTED, ENDED, history(t), files(t), 10, steps)
    if not all(s.ok for s in run.statuses):
        raise RuntimeError(run.statuses)
    runs = Runs(t.spark, root)
    parts = {f"typed_{n}": t.spark.read.parquet(runs.folder(f"typed_{n}", run.load)) for n in daily.INGESTED}
    parts["published_tender"] = runs.table("published_tender")
    out = None
    for name, df in parts.items():
        part = df.groupBy(F.col("RetailStoreID").cast("bigint").alias("RetailStoreID")).agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out
