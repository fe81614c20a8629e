"""Sources and sinks."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tillsight.operators.dictionaries import DictionaryStore
from tillsight.operators.encode import encode
from tillsight.plans import masterdata, publish, reports
from tillsight.sources import readers, writers
from tillsight.sources.lookups import SEEDS, seed
from tillsight.sources.runs import Runs, unconsumed_parts
from tillsight.sources.session import scratch_path
from tillsight.sources.widedata import wide_table
from tillsight.streaming.batches import batch_by_store, run_batch
from tillsight.streaming.quarantine import all_batches, quarantine_table, stream_with_quarantine
from workload.ingest import ARTICLES_SQL, raw_articles
from workload.registry import query


@query(
    "scan_transactions",
    "select k as SequenceNumber, cast(l as bigint) as lines from {receipt} left join "
    "(select k as lk, count(distinct n) as l from {position} group by k) p on k = lk",
)
def _(t):
    path = scratch_path(t.spark, "wide")
    wide_table(t, "lineitem").write.parquet(path)
    lines = F.when(F.col("RetailTransaction_LineItem_SequenceNumber").isNotNull(),
                   F.size("RetailTransaction_LineItem_SequenceNumber"))
    return readers.read_transactions(t.spark, path).select(
        F.col("SequenceNumber").cast("bigint"), lines.alias("lines")
    )


@query("scan_csv_masterdata", ARTICLES_SQL)
def _(t):
    path = scratch_path(t.spark, "csv")
    raw_articles(t).write.csv(path, header=True, sep=";")
    raw = readers.read_csv_strict(t.spark, path, list(masterdata.ARTICLE_FILE))
    return masterdata.articles(raw)


@query(
    "scan_tsv_lookup",
    "select cast(p_partkey as varchar) as class_id, p_name as class_desc_en, 'DE ' || p_brand as class_desc_gr from part",
)
def _(t):
    path = scratch_path(t.spark, "tsv")
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", F.concat(F.lit("DE "), "p_brand"))
    t.base("part").select(line.alias("value")).write.text(path)
    return readers.read_tab_lookup(t.spark, path, ["class_id", "class_desc_en", "class_desc_gr"])


_USES = {
    "CardType": ("tender", "CardType"), "EntryMethod": ("lineitem", "EntryMethod"),
    "ItemType": ("sale", "ItemType"), "TenderID": ("tender", "TenderID"),
    "TransactionStatus": ("retailheader", "TransactionStatus"),
    "TransactionType": ("header", "TransactionType"), "TypeCode": ("tender", "TypeCode"),
}


@query(
    "seed_lookups",
    " union all ".join(
        f"select '{name}' as dictionary, v.id, v.text_, (select count(*) from {{{_USES[name][0]}}} x "
        f"where x.{_USES[name][1]} = v.text_) as uses from (values "
        + ", ".join(f"({i}, '{s}')" for s, i in SEEDS[name].items())
        + ") v(id, text_)"
        for name in SEEDS
    ),
)
def _(t):
    out = None
    for name, (table, column) in _USES.items():
        uses = t[table].groupBy(F.col(column).alias("text_")).agg(F.count(F.lit(1)).alias("uses"))
        part = seed(t.spark, name).select(
            F.lit(name).alias("dictionary"), F.col(name).alias("id"), F.col(f"{name}Desc").alias("text_")
        ).join(uses, "text_", "left").select("dictionary", "id", "text_", F.coalesce("uses", F.lit(0)).alias("uses"))
        out = part if out is None else out.unionByName(part)
    return out


_BY_TENDER = "select TenderID, count(*) as n, sum(Amount) as total from {tender} group by TenderID"


def _by_tender(df):
    return df.groupBy("TenderID").agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("total"))


@query("scan_published", _BY_TENDER)
def _(t):
    root = scratch_path(t.spark, "published")
    writers.write_table(t["tender"], root, "tender")
    return _by_tender(readers.read_published(t.spark, root, "tender"))


@query("scan_catalog", _BY_TENDER)
def _(t):
    """A catalog table that is moved from an earlier run, of half the stores, to the last one."""
    runs = Runs(t.spark, scratch_path(t.spark, "catalog"))
    database = f"tillsight_{uuid.uuid4().hex[:12]}"
    tender = t["tender"]
    try:
        for rows in (tender.where("RetailStoreID % 2 = 0"), tender):
            load = runs.start()
            path = writers.write_snapshot(rows, runs.root, "tender", load, path=runs.folder("tender", load, 1))
            runs.publish(load, {"tender": [path]}, {"tender": tender.schema})
            runs.register(database)
        return _by_tender(readers.read_catalog(t.spark, database, "tender"))
    finally:  # the query has its files already
        t.spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@query(
    "run_snapshot",
    "select RetailStoreID, TransactionType, count(*) as n, 1 as loads from {header} group by all",
)
def _(t):
    """All store batches of the last complete run, while the next run has begun to write."""
    runs = Runs(t.spark, scratch_path(t.spark, "runs"))
    cols = t["header"].select("RetailStoreID", "SequenceNumber", "TransactionType")
    for number, kind in enumerate(("earlier", None, "unfinished")):
        load, rows = runs.start(), cols if kind is None else cols.withColumn("TransactionType", F.lit(kind))
        paths = [
            writers.write_snapshot(rows.where(cut), runs.root, "header", load, path=runs.folder("header", load, batch))
            for batch, cut in enumerate(("RetailStoreID < 4", "RetailStoreID >= 4"))
        ]
        if number < 2:
            runs.publish(load, {"header": paths}, {"header": cols.schema})
    seen = runs.table("header")
    return seen.groupBy("RetailStoreID", "TransactionType").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("loads"))


@query(
    "run_parts",
    "select cast(k % 40 as bigint) as part, count(*) as n, case when k % 40 < 20 then 2 else 3 end as LoadID from {receipt} group by all",
)
def _(t):
    """Part files consumed once: the first run breaks off after its output, the second reads the
    same files, the third only what has come since."""
    runs, source = Runs(t.spark, scratch_path(t.spark, "part-runs")), scratch_path(t.spark, "parts")
    rows = t["receipt"].select("RetailStoreID", "SequenceNumber", (F.col("k") % 40).alias("part"))

    def arrive(cut: str) -> None:
        rows.where(cut).repartition("part").write.mode("append").partitionBy("part").parquet(source)

    def run(breaks_off: bool = False) -> int:
        load, new = runs.start(), unconsumed_parts(runs, source)
        read = t.spark.read.option("basePath", source).parquet(*[r[0] for r in new.collect()])
        path = writers.write_snapshot(read, runs.root, "receipt", load, path=runs.folder("receipt", load, 1))
        if not breaks_off:
            consumed = runs.folder("consumed_parts", load)
            new.withColumn("status", F.lit(1)).write.parquet(consumed)
            runs.publish(load, {"receipt": [path]}, {"receipt": read.schema}, consumed)
        return load

    arrive("part < 20")
    run(breaks_off=True)
    loads = [run()]
    arrive("part >= 20")
    loads.append(run())
    first, second = (runs.table("receipt", x).withColumn("LoadID", F.lit(x)) for x in loads)
    return first.unionByName(second).groupBy(F.col("part").cast("bigint").alias("part"), "LoadID").agg(F.count(F.lit(1)).alias("n"))


@query(
    "dictionary_store",
    "select CardType as text_, count(*) as uses, 1 as ids, 0 as added_by_repetition from {tender} where CardType is not null group by CardType",
)
def _(t):
    """Five batches of stores extend one dictionary at once, and again. Each text has one id; the
    rows encoded by it are read back through it."""
    store = DictionaryStore(t.spark, scratch_path(t.spark, "dictionaries"), SEEDS)
    rows = t["tender"].select("RetailStoreID", "CardType")

    def extend(batch: int) -> None:
        store.extend("CardType", rows.where(F.col("RetailStoreID") % 5 == batch).select("CardType"))

    versions = []
    for _ in range(2):
        with ThreadPoolExecutor(5) as pool:
            list(pool.map(extend, range(5)))
        versions.append(store.versions("CardType"))
    known = store.read("CardType")
    coded = encode(rows, known, "CardType", "CardType", "CardTypeDesc").groupBy("CardType").agg(F.count(F.lit(1)).alias("uses"))
    ids = known.groupBy("CardTypeDesc").agg(F.count_distinct("CardType").alias("ids"))
    decoded = coded.join(known, "CardType").join(ids, "CardTypeDesc")
    return decoded.select(F.col("CardTypeDesc").alias("text_"), "uses", "ids", F.lit(versions[1] - versions[0]).alias("added_by_repetition"))


@query(
    "stream_quarantine",
    "select cast(k % 8 as bigint) as part, case when k % 8 = 3 then 0 else count(*) end as published, "
    "case when k % 8 = 3 then 2 else 0 end as attempts from {receipt} group by k % 8",
)
def _(t):
    """One of eight files fails: it is held after two attempts, the others are published."""
    root, source, marks = (scratch_path(t.spark, x) for x in ("stream", "arrived", "marks"))
    rows = t["receipt"].select("RetailStoreID", "SequenceNumber", (F.col("k") % 8).alias("part"))
    rows.withColumn("file", F.col("part")).repartition("file").write.partitionBy("file").parquet(source)

    def checked(known):
        broken = F.when(F.col("part") == 3, F.raise_error(F.lit("part 3 is broken")).cast("string"))
        return known["transactions"].withColumn("state", broken.otherwise("ok"))

    for _ in range(3):
        stream_with_quarantine(t.spark, source, rows.schema, root, marks, [("checked", checked)], attempts=2).awaitTermination()
    schema = rows.withColumn("state", F.lit("ok")).schema
    done = all_batches(t.spark, root, "checked", schema).groupBy("part").agg(F.count(F.lit(1)).alias("published"))
    held = quarantine_table(t.spark, root).select(F.regexp_extract("file", r"file=(\d+)", 1).cast("bigint").alias("part"), "attempts")
    both = done.join(held, "part", "full")
    return both.select("part", F.coalesce("published", F.lit(0)).alias("published"), F.coalesce("attempts", F.lit(0)).alias("attempts"))


@query(
    "unprocessed_files",
    "select distinct 'part-' || cast(k % 5000 as varchar) as part_filename from {receipt} where (k % 5000) % 3 <> 0",
)
def _(t):
    name = F.concat(F.lit("part-"), (F.col("k") % 5000).cast("string")).alias("part_filename")
    files = t["receipt"].select("k", name)
    root = scratch_path(t.spark, "register")
    done = readers.file_register_rows(files.where("(k % 5000) % 3 = 0"))
    writers.append_register(done.where("part_filename < 'part-3'"), root, "files")
    writers.append_register(done.where("part_filename >= 'part-3'"), root, "files")
    register = t.spark.read.parquet(f"{root}/files")
    return readers.unprocessed_files(files.select("part_filename").distinct(), register)


_LINE_COLS = "RetailStoreID, WorkstationID, SequenceNumber, LineItemSequenceNumber, EntryMethod, Amount"


@query("write_snapshot_roundtrip", f"select {_LINE_COLS} from {{lineitem}}")
def _(t):
    root = scratch_path(t.spark, "snapshot")
    rows = t["lineitem"].select(*_LINE_COLS.split(", "))
    writers.write_snapshot(rows, root, "lineitem", 1704067200)
    writers.finish_batch(t.spark, root, 1704067200)
    return readers.latest_snapshot(t.spark, root, "lineitem")


@query(
    "latest_snapshot",
    "select RetailStoreID, TransactionType, count(*) as n from {header} group by all",
)
def _(t):
    root = scratch_path(t.spark, "snapshot")
    cols = t["header"].select("RetailStoreID", "SequenceNumber", "TransactionType")
    earlier, unfinished = (cols.withColumn("TransactionType", F.lit(x)) for x in ("earlier", "unfinished"))
    for batch, rows in ((1704067200, earlier), (1704153600, cols), (1704240000, unfinished)):
        writers.write_snapshot(rows, root, "header", batch)
        if rows is not unfinished:
            writers.finish_batch(t.spark, root, batch)
    newest = readers.latest_snapshot(t.spark, root, "header")
    return newest.groupBy("RetailStoreID", "TransactionType").agg(F.count(F.lit(1)).alias("n"))


@query("write_masterdata_roundtrip", ARTICLES_SQL)
def _(t):
    root = scratch_path(t.spark, "masterdata")
    path = writers.write_table(t["articles"], root, "articles")
    return t.spark.read.parquet(path)


_MOD_COLS = ", ".join(publish.MODIFIER_COLUMNS)


@query("write_staging_roundtrip", f"select {_MOD_COLS} from {{modifier}}")
def _(t):
    root = scratch_path(t.spark, "staging")
    rows = publish.publish_modifiers(t["modifier"])
    writers.write_table(rows.where("AmountAction = 'Add'"), root, "modifiers")
    writers.write_table(rows, root, "modifiers")
    return readers.read_published(t.spark, root, "modifiers")


@query(
    "write_csv_report",
    "select strftime(cast(ReceiptDateTime as date), '%Y-%m-%d') as BusinessDay, cast(count(*) as varchar) as transactions "
    "from {header} group by 1",
)
def _(t):
    per_day = t["header"].groupBy(F.to_date("ReceiptDateTime").alias("BusinessDay")).agg(
        F.count(F.lit(1)).alias("transactions")
    )
    path = writers.write_csv_report(per_day, scratch_path(t.spark, "report"), [F.desc("transactions"), "BusinessDay"])
    return t.spark.read.csv(path, header=True, schema="BusinessDay string, transactions string")


@query(
    "batch_by_store",
    "select RetailStoreID, SequenceNumber, cast(ceil(r / 3.0) as bigint) as batch from (select *, dense_rank() over (order by RetailStoreID) as r from {receipt}) q",
)
def _(t):
    return batch_by_store(t["receipt"].select("RetailStoreID", "SequenceNumber"), 3)


@query(
    "batch_epoch_run",
    "select 1 as batch, RetailStoreID, count(*) as lines, count(case when VoidFlagDerived then 1 end) as voids from {lineitemderived} where RetailStoreID < 5 group by RetailStoreID "
    "union all select 2, RetailStoreID, count(*), count(case when VoidFlagDerived then 1 end) from {lineitemderived} where RetailStoreID >= 5 group by RetailStoreID",
)
def _(t):
    from tillsight.plans.void import propagate_voids

    root = scratch_path(t.spark, "batches")
    steps = [("lineitemderived", lambda x: propagate_voids(x["lineitem"], x["sale"], x["return"]))]

    def broken(x):
        return x["lineitemderived"].withColumn("VoidFlagDerived", F.raise_error(F.lit("broken")).cast("boolean"))

    # the last batch fails in its second step; what its first step wrote must not be read
    plan = [(1, "RetailStoreID < 5", []), (2, "RetailStoreID >= 5", []), (3, "true", [("broken", broken)])]
    for batch, where, more in plan:
        tables = {n: t[n].where(where) for n in ("lineitem", "sale", "return")}
        status = run_batch(tables, batch, root, steps + more)
        if status.ok == bool(more):
            raise RuntimeError(status.error or "the broken batch counts as finished")
    out = None
    for batch in readers.snapshot_batches(t.spark, root, "lineitemderived"):
        part = t.spark.read.parquet(f"{root}/lineitemderived/{batch}").groupBy("RetailStoreID").agg(
            F.lit(batch).alias("batch"), F.count(F.lit(1)).alias("lines"),
            F.count_if("VoidFlagDerived").alias("voids"),
        )
        out = part if out is None else out.unionByName(part)
    return out
