"""The daily run, end to end: typed tables stored by store, dictionaries extended, every audit and
published table batch by batch, master data, load logs, load status and report; then one commit
that makes all of it visible, and marks the part files it came from as consumed.

Steps have the shape ``run_batch`` takes. A step sees the typed tables and the results of
the steps before it under their names.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.operators.dictionaries import DictionaryStore, dictionary_values
from tillsight.operators.encode import Dictionaries
from tillsight.plans import classify, control, empties, pricelookup, publish, receiptvoid, reports, suspended, void
from tillsight.plans.ingest import BUILDERS
from tillsight.sources.lookups import SEEDS
from tillsight.sources.runs import Runs
from tillsight.sources.writers import write_snapshot
from tillsight.streaming.batches import BatchStatus, Step, batch_by_store, run_batch

Tables = dict[str, DataFrame]


def lineitemderived(t: Tables) -> DataFrame:
    return void.propagate_voids(t["lineitem"], t["sale"], t["return"])


def booked(t: Tables) -> DataFrame:
    return receiptvoid.booked_lines(
        t["lineitemderived"], t["sale"], t["return"], t["retailheader"], t["classification"]
    )


def void_followup(t: Tables) -> DataFrame:
    return receiptvoid.void_followup(t["booked"])


def void_codes(t: Tables, intended: bool = False) -> DataFrame:
    """Code of every voided receipt, repeated or not."""
    return receiptvoid.tender_codes(t["void_followup"], t["tender"]).unionByName(
        receiptvoid.unmatched_codes(
            t["booked"], t["void_followup"], t["tender"], t["stores"], t["header"], intended
        )
    )


def receiptvoiding(t: Tables) -> DataFrame:
    return receiptvoid.void_report(
        void_codes(t), t["retailheader"], t["classification"], t["header"], t["class_texts"]
    )


def suspendedfraud(t: Tables) -> DataFrame:
    return suspended.suspended_receipts(
        t["headeraddon"], t["retailheader"], t["header"], t["classification"], t["empties"]
    )


#: name of the written table -> step, in order
RULE_STEPS = [
    ("lineitemderived", lineitemderived),
    ("classification", classify.classify_all),
    ("lookups", pricelookup.enriched_lookups),
    ("pricelookup", pricelookup.price_lookups),
    ("booked", booked),
    ("void_followup", void_followup),
    ("receiptvoiding", receiptvoiding),
    ("empties", empties.empties_report),
    ("suspendedfraud", suspendedfraud),
]

#: partition column of tables that do not carry the plain store column
PARTITION_COLUMNS = {"receiptvoiding": "RetailStoreID_1", "suspendedfraud": "RetailStoreID_suspended"}


#: published tables without a dictionary, in order; they read the rule results before them
PUBLISH_STEPS = [
    ("published_header", lambda t: publish.publish_header(t["header"], t["classification"], t["retailheader"])),
    ("published_loyalty", lambda t: publish.publish_loyalty(t["loyalty"])),
    ("published_modifiers", lambda t: publish.publish_modifiers(t["modifier"])),
    ("published_empties", lambda t: publish.publish_empties(t["empties"])),
    ("published_pricelookup", lambda t: publish.publish_pricelookup(t["pricelookup"])),
    ("published_receiptvoid", lambda t: publish.publish_receiptvoid(t["receiptvoiding"])),
    ("published_suspended", lambda t: publish.publish_suspended(t["suspendedfraud"])),
    (
        "published_retailheader",
        lambda t: publish.publish_retailheader(
            t["retailheader"], t["lineitemderived"], t["sale"], t["return"], t["rebate"], t["customer"]
        ),
    ),
]
PUBLISH_PARTITIONS = {"published_receiptvoid": "RetailStoreID_1", "published_suspended": "RetailStoreID_suspended"}


def encoded_steps(known: Dictionaries) -> list[Step]:
    """Published tables with dictionary columns; ``known`` has every text of the run."""
    return [
        (
            "published_lineitem",
            lambda t: publish.publish_lineitem(t["lineitem"], t["sale"], t["return"], known, known=True)[0],
        ),
        (
            "published_salereturn",
            lambda t: publish.publish_salereturn(t["sale"], t["return"], t["articles"], t["stores"], known, known=True)[0],
        ),
        ("published_tender", lambda t: publish.publish_tender(t["tender"], known, known=True)[0]),
    ]


#: master data, published once a run
MASTER_STEPS = [
    ("published_articles", lambda t: publish.publish_articles(t["articles"])),
    ("published_hierarchy", lambda t: publish.publish_hierarchy(t["hierarchy"])),
]

#: table of the rules -> builder that makes it of wide transactions
INGESTED = {
    "header": "transactionheader", "control": "controltransaction", "functionlog": "functionlog",
    "lineitem": "lineitem", "loyalty": "loyaltyreward", "headeraddon": "receiptheaderaddonlist",
    "addon": "receiptpositionaddonlist", "customer": "customer", "modifier": "retailpricemodifier",
    "return": "return", "sale": "sale", "retailheader": "retailtransactionheader", "tender": "tender",
    "loan": "tendercontrolloan", "pickup": "tendercontrolpickup", "safesettle": "tendercontrolsafesettle",
    "tillsettle": "tendercontroltillsettle", "deposit": "tendercontrolpaymentdeposit", "rebate": "salereturn_rebate",
}


def ingest(transactions: DataFrame) -> Tables:
    """Typed tables of wide transactions, under the names the steps use."""
    return {name: BUILDERS[builder](transactions) for name, builder in INGESTED.items()}


#: tables written side by side: most of them are small, and one alone leaves cores idle
AT_ONCE = 4


class DailyRun(NamedTuple):
    """Outcome of a run: its load id, the ids of the batches that finished, how each batch ended,
    and its logs and report as they are written."""

    load: int
    finished: list[int]
    statuses: list[BatchStatus]
    store_log: DataFrame
    load_status: DataFrame
    report: DataFrame


def by_store(runs: Runs, tables: Mapping[str, DataFrame], load: int) -> Tables:
    """Typed tables written once, a folder for each store, and read back; those without a store
    column are left as they are. Batches then read the folders of their own stores alone."""

    def stored(name: str, df: DataFrame) -> DataFrame:
        if "RetailStoreID" not in df.columns:
            return df
        path = write_snapshot(df, runs.root, name, load, path=runs.folder(f"typed_{name}", load))
        return runs.spark.read.schema(df.schema).parquet(path)

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return dict(zip(tables, pool.map(stored, tables, tables.values()), strict=True))


def of_stores(tables: Mapping[str, DataFrame], stores: Sequence[int]) -> Tables:
    """The tables cut to some stores by a filter that prunes folders; lookups stay whole."""
    own = F.col("RetailStoreID").isin(list(stores))
    return {n: df.where(own) if "RetailStoreID" in df.columns else df for n, df in tables.items()}


def published(spark: SparkSession, root: str, table: str, load: int | None = None) -> DataFrame:
    """A table as the last run (or the one given) has published it, all its batches."""
    return Runs(spark, root).table(table, load)


def carry_report(runs: Runs, write: Callable[[str, DataFrame], DataFrame], header: DataFrame, files: DataFrame) -> DataFrame:
    """The daily report carried on from the state that the last run left: writes what this run
    adds, the state after it, and the rows of the report it changed, which are returned."""
    spark = runs.spark
    added = write("report_increment", reports.report_increment(header, files))
    past = [e["load"] for e in runs.log.entries() if "report_increment" in e["tables"]]
    history = added
    for load in past:
        history = history.unionByName(runs.table("report_increment", load))
    state = runs.table("report_state") if past else spark.createDataFrame([], reports.INCREMENT)
    state, rows = reports.advance_report(state, added, history)
    write("report_state", state)
    return write("daily_report", rows)


def full_report(runs: Runs) -> DataFrame:
    """The report over all published runs: each row as the last run that changed it wrote it."""
    loads = [e["load"] for e in runs.log.entries() if "daily_report" in e["tables"]]
    rows = None
    for load in loads:
        part = runs.table("daily_report", load).withColumn("_load", F.lit(load))
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        raise FileNotFoundError(f"{runs.root} has no report")
    key = ["RetailStoreID", "BusinessDay"]
    value = F.max_by(F.struct(*[c for c in rows.columns if c not in (*key, "_load")]), "_load").alias("row")
    return rows.groupBy(*key).agg(value).select(*key, "row.*")


def daily_run(
    tables: Mapping[str, DataFrame],
    root: str,
    run_date: str,
    started: str,
    ended: str,
    history: DataFrame,
    files: DataFrame,
    stores_per_batch: int,
    steps: Sequence[Step] = (*RULE_STEPS, *PUBLISH_STEPS),
    parts: DataFrame | None = None,
    folders: Sequence[str] = (),
    parallel: int = 1,
    database: str | None = None,
) -> DailyRun:
    """Audit and publish the typed tables in batches of stores.

    The run takes a load id above those of ``history`` and of all other runs. Tables with a
    store column are stored by store once; dictionaries get the texts of the whole run in one
    scan of each encoded column; then ``parallel`` batches at a time run all ``steps`` and the
    encoded tables, ``AT_ONCE`` steps of a batch side by side. A batch that fails publishes nothing; its store days are logged with
    status E, those of the others with L, and both override the status expected from the list
    of stores. Tables, logs and the consumed ``parts`` (part_filename) become visible in one
    step at the end; with ``database``, catalog tables are then moved to this run. A run that
    breaks off before leaves everything as it was, but for dictionary ids, which stay.

    The driver holds the list of stores, not of their days or rows.
    """
    spark = tables["header"].sparkSession
    runs = Runs(spark, root)
    top = history.agg(F.coalesce(F.max("LoadID").cast("bigint"), F.lit(0))).first()[0]
    load = runs.start(top, started=started)
    stored = by_store(runs, tables, load)

    dictionaries = DictionaryStore(spark, f"{runs.root}/dictionaries", SEEDS)
    known = dictionaries.extend_all(dictionary_values(stored, publish.ENCODED))
    steps = [*steps, *encoded_steps(known)]

    stores = stored["header"].select("RetailStoreID").where("RetailStoreID is not null").distinct()
    batches: dict[int, list[int]] = {}
    for row in batch_by_store(stores, stores_per_batch).orderBy("batch", "RetailStoreID").collect():
        batches.setdefault(row["batch"], []).append(row["RetailStoreID"])

    def run(batch: int) -> BatchStatus:
        place = lambda name, b: runs.folder(name, load, b)
        return run_batch(of_stores(stored, batches[batch]), batch, root, steps, PARTITION_COLUMNS | PUBLISH_PARTITIONS, place, AT_ONCE)

    with ThreadPoolExecutor(parallel) as pool:
        statuses = list(pool.map(run, batches))
    good = [s for s in statuses if s.ok]
    paths = {name: [s.paths[name] for s in good] for name in (good[0].written if good else ())}
    schemas = dict(good[0].schemas) if good else {}

    def write(name: str, df: DataFrame) -> DataFrame:
        """A table of the run as a whole."""
        path = runs.folder(name, load)
        df.write.parquet(path)
        paths[name], schemas[name] = [path], df.schema
        return spark.read.schema(df.schema).parquet(path)

    before = spark.createDataFrame([(load - 1,)], "LoadID bigint")
    ends = [(s, b.ok) for b in statuses for s in batches[b.batch_id]]
    ended_as = spark.createDataFrame(ends, "RetailStoreID bigint, _ok boolean")
    days = control.store_days(stored["header"]).join(ended_as, "RetailStoreID")
    logs = [
        control.store_load_log(days.where(which), status, started, ended, 0, errors, before)
        for which, status, errors in (("_ok", "L", 0), ("not _ok", "E", 1))
    ]
    failed = len(statuses) - len(good)
    expected = control.store_status(tables["stores"], run_date)
    received = days.join(expected.select("RetailStoreID", "Status"), "RetailStoreID")
    received = received.select("RetailStoreID", F.col("BusinessDate").alias("Date"), "Status")
    events = control.stores_missing_data(tables["stores"], days, ended).unionByName(control.stores_unexpected_data(received, ended))
    done = spark.createDataFrame([(s,) for s, ok in ends if ok], "RetailStoreID bigint")
    reported = stored["header"].join(done, "RetailStoreID", "left_semi")
    whole = {name: step(stored) for name, step in MASTER_STEPS} | {
        "run_load_log": control.run_load_log(days, folders, started, ended, 0, failed, before),
        "event_log": control.stamp_load_id(events, before),
        "file_register": files,
    }
    with ThreadPoolExecutor(AT_ONCE) as pool:
        reporting = pool.submit(carry_report, runs, write, reported, files)
        writing = [pool.submit(write, name, df) for name, df in whole.items()]
        store_log = write("store_load_log", logs[0].unionByName(logs[1]))
        load_status = write("load_status", control.merge_load_status(expected, store_log, before))
        report = reporting.result()
        for written in writing:
            written.result()

    consumed = None
    if parts is not None:
        consumed = runs.folder("consumed_parts", load)
        parts.select("part_filename").distinct().withColumn("status", F.lit(1)).write.parquet(consumed)
    runs.publish(load, paths, schemas, consumed)
    if database:
        runs.register(database, list(paths))
    return DailyRun(load, [s.batch_id for s in good], statuses, store_log, load_status, report)
