"""Audit of how the sources of a language differ in their words.

Every source of a language is a group, and so is the language itself. A group gives each kept
term a share p, in billionths, by its smoothed count; two groups diverge at a term by
``(p - q)^2 / q``. The audit ranks for each source the other sources by their summed divergence,
and the terms that the source has more of than its language.

Terms are ranked by a dominance skyband. A term that has a higher or equal count in the group, a
lower or equal count in the language and comes earlier in UTF-8 ranks before another whatever
the totals are. So terms dominated by k others cannot be among the first k, and partitions drop
them by counts alone; the skybands of partitions are merged in salted tasks, and what is left is
ranked by exact shares.

Sources are compared in cells: of a block of sources with a block of sources over a bucket of
terms. A cell sums divergences over the terms that occur in it; terms that occur in neither
source are added by their number. All sums are of whole numbers and exact.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import quoted, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: documents that must have a term, ranks of terms that are returned, billionths of a share
LEAST_DOCUMENTS, RANKS, SCALE = 3, 200, 10**9
#: A-Z in lower case; what is no letter and below 128 parts terms
WORDS = bytes(b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: bytes cut into terms at once, terms a task counts before it passes them on
SLICE, COUNTED = 4 << 20, 1_000_000
#: rows of a task that are thinned at once, and levels of a count that are told apart there
BLOCK, LEVELS = 500_000, 512
#: tasks that merge the skybands of one group
SALTS = 8
#: sources of a block, and terms of a bucket
SOURCES, TERMS = 64, 16_384

COUNTS = "lang string, source string, term string, n long, docs long"


def counted_part(texts: pa.StringArray, groups: pa.Array) -> pa.Table:
    """(group, term, n, docs) of some texts; terms are parted by single spaces or several."""
    lists = pc.ascii_split_whitespace(texts)
    each = pa.table({"doc": pc.list_parent_indices(lists), "term": pc.list_flatten(lists)})
    each = each.filter(pc.not_equal(each["term"], ""))
    by_doc = each.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    by_doc = pa.table({"group": groups.take(by_doc["doc"].combine_chunks()), "term": by_doc["term"], "n": by_doc["count_all"]})
    out = by_doc.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    return pa.table({"group": out["group"], "term": out["term"], "n": out["n_sum"], "docs": out["n_count"]})


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each term, and documents that have it, by language and source. A group
    gives one row without a term besides, so that it is there even if it has none."""
    ids: dict[tuple, int] = {}
    held: list[pa.Table] = []

    def named(rows: pa.Table) -> pa.Table:
        lang, source = (pa.array([g[k] for g in ids], pa.string()) for k in (0, 1))
        group = rows["group"].combine_chunks()
        return pa.table([lang.take(group), source.take(group), *(rows[c] for c in ("term", "n", "docs"))], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        texts = batch["text"].cast(pa.string())
        valid, ends, data = texts.buffers()
        clean = (data.to_pybytes() if data else b"").translate(WORDS)
        texts = pa.StringArray.from_buffers(len(texts), ends, pa.py_buffer(clean), valid, texts.null_count, texts.offset)
        pairs = zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True)
        groups = pa.array([ids.setdefault(g, len(ids)) for g in pairs], pa.int32())
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE, "right")))
            held.append(counted_part(texts.slice(at, end - at), groups.slice(at, end - at)))
            at = end
            if sum(map(len, held)) >= COUNTED:
                whole = pa.concat_tables(held).group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
                held = [whole.rename_columns(["group", "term", "n", "docs"])]
                if len(whole) >= COUNTED // 2:
                    yield from named(held.pop()).to_batches()
    if ids:
        none = pa.array(range(len(ids)), pa.int32())
        zero = pa.array([0] * len(ids), pa.int64())
        held.append(pa.table({"group": none, "term": pa.nulls(len(ids), pa.string()), "n": zero, "docs": zero}))
        yield from named(pa.concat_tables(held)).to_batches()
        held.clear()
    pa.default_memory_pool().release_unused()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs), and a row without a term for each group. Each task counts
    before anything is moved; nulls count as empty texts."""
    empty = F.lit("")
    rows = docs.select(
        F.coalesce(quoted(lang_col).cast("string"), empty).alias("lang"),
        F.coalesce(quoted(source_col).cast("string"), empty).alias("source"),
        F.coalesce(quoted(text_col).cast("string"), empty).alias("text"),
    )
    parts = rows.mapInArrow(counted, COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exact for any counts. Without terms there
    is no share, and what is returned is not used."""
    product = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    whole = F.greatest(total + terms, F.lit(1)).cast("decimal(19,0)")
    return 1 + F.call_function("div", product, whole)


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def levels(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Each value's place among at most ``most`` of the values, rounded down and rounded up.
    If one value rounded down is not below another rounded up, it is not less."""
    steps = np.unique(values)
    if len(steps) > most:
        steps = steps[np.linspace(0, len(steps) - 1, most).astype(int)]
    return np.searchsorted(steps, values, "right") - 1, np.searchsorted(steps, values, "left")


def skyband(n: np.ndarray, lang_n: np.ndarray, k: int, most: int = LEVELS) -> np.ndarray:
    """Places of the terms, given in the order of their UTF-8, that fewer than ``k`` others are
    known to dominate. With more than ``most`` different counts some more terms stay."""
    down_n, up_n = levels(n, most)
    # a lower count in the language is better, so the order is turned round
    down_l, up_l = levels(-lang_n, most)
    dominated = np.zeros((up_n.max() + 1, up_l.max() + 1), np.int32)  # by level: terms kept so far that are as good
    kept = []
    for at in range(0, len(n), 1024):
        part = np.arange(at, min(at + 1024, len(n)))
        for i in part[dominated[up_n[part], up_l[part]] < k].tolist():
            if dominated[up_n[i], up_l[i]] < k:
                kept.append(i)
                dominated[: down_n[i] + 1, : down_l[i] + 1] += 1
    return np.array(kept, np.int64)


def thinned(k: int, block: int = BLOCK):
    """Drops rows that cannot be among the first ``k`` of their group, block by block; rows come
    in the order of their terms' UTF-8."""

    def thin(rows: pa.Table) -> pa.Table:
        lang, source = (rows[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        order = np.argsort(group, kind="stable")
        n, lang_n = (rows[c].to_numpy() for c in ("n", "lang_n"))
        ends = np.flatnonzero(np.diff(group[order])) + 1
        keep = [at[skyband(n[at], lang_n[at], k)] for at in np.split(order, ends)]
        return rows.take(np.sort(np.concatenate(keep)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= block:
                yield from thin(pa.Table.from_batches(held)).to_batches()
                held = []
        if sum(map(len, held)):
            yield from thin(pa.Table.from_batches(held)).to_batches()
        pa.default_memory_pool().release_unused()

    return run


SKYBAND = "lang string, source string, term string, n long, lang_n long"


def leading_terms(rows: DataFrame, groups: DataFrame, k: int = RANKS) -> DataFrame:
    """First ``k`` terms of each group with a higher share there than in the language: (lang,
    source, part, item, value, rank). ``rows``: SKYBAND, without rows of count 0."""
    thin = thinned(k)
    few = rows.sortWithinPartitions("term").mapInArrow(thin, SKYBAND)
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS))
    few = few.repartition("lang", "source", salt).sortWithinPartitions("term").mapInArrow(thin, SKYBAND)
    known = few.join(groups, ["lang", "source"])
    known = known.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    known = known.withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))).where("p > q")
    known = known.withColumn("value", divergence(F.col("p"), F.col("q")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    ranked = known.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


PAIRS = "lang string, source string, item string, value long, seen long"
#: terms whose shares a cell holds as a matrix at once
CHUNK = 4096


def compared(key: tuple, rows: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Divergence of each source of one block from each of the other, both ways, summed over
    the terms of a cell, and their number. Numbers are whole, squares stay below 2^63."""
    sources = sources.sort_values("source", ignore_index=True)
    names, base = sources["source"].to_numpy(), sources["base"].to_numpy()
    block = sources["block"].to_numpy()
    term, known = pd.factorize(rows["term"])
    place = {name: i for i, name in enumerate(names)}
    of, p = np.fromiter((place[s] for s in rows["source"]), np.int64, len(rows)), rows["p"].to_numpy()
    order = np.argsort(term, kind="stable")
    term, of, p = term[order], of[order], p[order]
    total = np.zeros((len(names), len(names)), np.int64)
    for at in range(0, len(known), CHUNK):
        here = slice(*np.searchsorted(term, (at, at + CHUNK)))
        shares = np.tile(base, (min(CHUNK, len(known) - at), 1))
        shares[term[here] - at, of[here]] = p[here]
        for g in range(len(names)):
            apart = shares[:, g : g + 1] - shares
            total[g] += (apart * apart // shares).sum(axis=0)
    i, j = key[1:3]
    a, b = np.meshgrid(block, block, indexing="ij")
    wanted = ((a == i) & (b == j)) | ((a == j) & (b == i))
    np.fill_diagonal(wanted, False)
    g, h = np.nonzero(wanted)
    return pd.DataFrame({"lang": key[0], "source": names[g], "item": names[h], "value": total[g, h], "seen": len(known)})


def diverging_sources(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of the language, ranked: (lang, source, part, item, value, rank)."""
    blocks = F.ceil(F.col("sources") / SOURCES)
    placed = groups.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")))
    placed = placed.withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("terms") / TERMS)))
    placed = placed.withColumn("base", share(F.lit(0), F.col("total"), F.col("terms"))).where("sources > 1")
    placed = placed.select("lang", "source", "total", "terms", "blocks", "block", "buckets", "base")
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    cell = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    bucket = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("buckets") - 1)).alias("bucket")
    sources = placed.select("lang", "source", "block", "base", "blocks", bucket).select("*", other)
    sources = sources.select("lang", *cell, "bucket", "source", "block", "base")
    shares = rows.join(placed, ["lang", "source"])
    own = F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket")
    shares = shares.select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "block", own, other)
    shares = shares.select("lang", *cell, "bucket", "source", "term", "p")
    keys = ["lang", "i", "j", "bucket"]
    parts = shares.groupBy(keys).cogroup(sources.groupBy(keys)).applyInPandas(compared, PAIRS)
    summed = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    summed = summed.join(placed.select("lang", "source", "terms", F.col("base").alias("p")), ["lang", "source"])
    summed = summed.join(placed.select("lang", F.col("source").alias("item"), F.col("base").alias("q")), ["lang", "item"])
    # without a kept term shares are not defined, and nothing diverges
    rest = F.when(F.col("terms") > 0, (F.col("terms") - F.col("seen")) * divergence(F.col("p"), F.col("q"))).otherwise(F.lit(0))
    summed = summed.withColumn("value", F.col("value") + rest)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST_DOCUMENTS, k: int = RANKS) -> DataFrame:
    """Divergence of sources within their languages: (lang, source, part, item, value, rank).

    Terms are runs of letters and of what is not ASCII, A-Z in lower case; a language keeps
    those in at least ``least`` of its rows. Part ``pair`` ranks the other sources of the
    language, 0 where it keeps no term; part ``term`` the first ``k`` terms that the source has
    and has more of than the language. Equal values are ranked by the UTF-8 of the item. Null
    text, language and source count as empty; an empty source is one, a source alone in its
    language has no pairs. Repeated rows count as often as they are there. An empty table gives
    an empty result; further columns are left out.
    """
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "counts")
    some = counts.where("term is not null")
    kept = some.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = stored(kept.where(F.col("docs") >= least).select("lang", "term", "lang_n"), "kept")
    rows = stored(some.drop("docs").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "terms")
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    every = counts.where("term is null").select("lang", "source")
    sizes = every.groupBy("lang").agg(F.count("*").alias("sources"))
    zero = F.lit(0).cast("bigint")
    groups = every.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang")
    groups = stored(groups.select("lang", "source", "sources", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")]), "groups")
    return diverging_sources(rows, groups).unionByName(leading_terms(rows, groups, k))
