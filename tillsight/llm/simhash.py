"""Near-duplicate documents by SimHash with deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Of two fingerprints that differ in
at most 3 bits, one segment differs in at most one. So each segment is indexed as it is and
with each of its bits wild (33 keys a segment, 66 a fingerprint); fingerprints that share a
key are candidates, and their full distance is verified.

Keys are joined by equality. A key that many fingerprints share is cut into blocks of bounded
size, and pairs of blocks are worked on apart. A block is not expanded into pairs: a search
over it returns a spanning forest of its links, fewer rows than members, which keeps exactly
the reachability. Equal texts collapse to one fingerprint before.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tillsight.llm.common import content_order, hot_join, quoted, row_key, spread, stored, whole_row
from tillsight.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, SEED, DISTANCE = 3, 42, 3
SEGMENT = 32
#: fingerprints of one block; a search holds two of them
BLOCK = 2048
#: shingles whose bits are counted at once
CHUNK = 1 << 15


def fingerprint(text: bytes | None) -> int:
    """SimHash of a text in UTF-8 as a signed 64-bit number. No words: 0."""
    import xxhash

    words = (text or b"").lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(SHINGLE, len(words)) - 1 :].tolist()
    del words
    digest, bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK], strict=True)]
        h = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(h, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > n, bitorder="little").view("<i8")[0])


@pandas_udf(T.LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([fingerprint(t) for t in batch], dtype="int64")


def simhash(text: Column) -> Column:
    """Fingerprint column of a text column. Null counts as empty."""
    return _fingerprints(F.coalesce(text, F.lit("")).cast("binary"))


def hex16(fp: Column) -> Column:
    """16 lower-case hex digits of a signed 64-bit number."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def forest(members: np.ndarray, blocks: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the links among ``members``; of two blocks, only links across."""
    across = blocks.min() != blocks.max()
    left, side, edges = members.view(np.uint64), blocks, []
    while len(left):
        queue, left, side = [(left[0], side[0])], left[1:], side[1:]
        while queue and len(left):
            at, block = queue.pop()
            near = np.bitwise_count(left ^ at) <= DISTANCE
            if across:
                near &= side != block
            if near.any():
                edges += [(int(at.view(np.int64)), int(x.view(np.int64))) for x in left[near]]
                queue += list(zip(left[near], side[near], strict=True))
                left, side = left[~near], side[~near]
    return edges


@pandas_udf(T.ArrayType(T.StructType().add("a", T.LongType()).add("b", T.LongType())))
def _forests(members: pd.Series) -> pd.Series:
    out = []
    for group in members:
        fp = np.fromiter((m["fp"] for m in group), np.int64, len(group))
        out.append([{"a": a, "b": b} for a, b in forest(fp, np.fromiter((m["block"] for m in group), np.int64, len(group)))])
    return pd.Series(out)


def variants(fps: DataFrame) -> DataFrame:
    """Each fingerprint (``fp``) under its 66 keys: (key, segment, fp). Slot 0 of a segment is
    the segment itself, slot i + 1 has bit i wild."""
    slot = F.col("slot") % (SEGMENT + 1)
    rows = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(2 * SEGMENT + 1))).alias("slot"))
    upper = F.shiftrightunsigned("fp", SEGMENT)
    lower = F.col("fp").bitwiseAND(F.lit((1 << SEGMENT) - 1))
    rows = rows.withColumn("segment", F.when(F.col("slot") <= SEGMENT, lower).otherwise(upper))
    wild = F.when(slot == 0, F.lit(0).cast("bigint")).otherwise(F.expr(f"shiftleft(1L, cast((slot % {SEGMENT + 1}) - 1 as int))"))
    key = F.col("segment").bitwiseAND(F.bitwise_not(wild)) + F.col("slot") * F.lit(1 << SEGMENT)
    return rows.select(key.alias("key"), "segment", "fp")


def links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) among distinct fingerprints that differ in 3 bits or fewer, enough to
    connect whatever is connected. A key counts only if it has two fingerprints, and with a
    wild bit only if both values of the bit occur (else the plain key has the same pairs)."""
    # dealt by another hash than that of the aggregation before, which would be kept, a few rows a task
    index = variants(spread(fps.withColumn("__deal", F.xxhash64("fp")), "__deal"))
    sizes = index.groupBy("key").agg(F.count("*").alias("n"), F.min("segment").alias("lo"), F.max("segment").alias("hi"))
    plain = (F.shiftrightunsigned("key", SEGMENT) % (SEGMENT + 1)) == 0
    shared = sizes.where((F.col("n") > 1) & (plain | (F.col("lo") != F.col("hi")))).select("key", "n")
    blocks = F.ceil(F.col("n") / block).cast("int")
    # Spark sizes both sides by the fingerprints, not by their 66 keys each, and would broadcast them
    rows = index.join(shared.hint("merge"), "key").select("key", "fp", blocks.alias("blocks"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    # block i meets every block j: the cell (least, greatest)
    cells = rows.select("key", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.struct("fp", "block").alias("member")
    )
    groups = cells.groupBy("key", "i", "j").agg(F.collect_list("member").alias("members")).where(F.size("members") > 1)
    return groups.select(F.explode(_forests("members")).alias("e")).select("e.a", "e.b").distinct()


def _rooted(prints: DataFrame, best: Column, block: int) -> DataFrame:
    """(fp, root, best) of each fingerprint of ``prints``: the least fingerprint of its component,
    and ``best`` of its rows."""
    fps = prints.groupBy("fp").agg(best.alias("best"))
    roots = components(links(fps.select("fp"), block)).select(F.col("node").alias("fp"), "root")
    return stored(fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "best"), "roots")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: (``id_col``, fp, fingerprint, component_id).

    ``component_id`` is the smallest id reachable over links of at most 3 differing bits. Null
    or blank texts have fingerprint zero and link like any other. A null id is no candidate
    for the smallest: the component of such rows alone has a null id. Repeated rows get one
    row each. An empty table gives an empty result; further columns are left out.
    """
    prints = stored(docs.select(quoted(id_col).alias("id"), simhash(quoted(text_col)).alias("fp")), "fingerprints")
    rooted = _rooted(prints, F.min("id"), block)
    least = rooted.groupBy("root").agg(F.min("best").alias("component_id"))
    named = stored(hot_join(rooted, least, "root").select("fp", "component_id"), "named")
    return hot_join(prints, named, "fp").select(F.col("id").alias(id_col), "fp", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Rows of ``docs`` that stay: one of each component, all columns. It is the row with the
    smallest id, rows without an id last; of texts that share that id the one with the smallest
    fingerprint. Components stay apart even where their rows share an id; of rows that repeat
    id and text, one stays, chosen by a hash of all its columns, whatever their types."""
    key = row_key(quoted(id_col), quoted(text_col))
    prints = docs.select(quoted(id_col).alias("id"), key.alias("key"), simhash(quoted(text_col)).alias("fp"))
    best = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    rooted = _rooted(stored(prints, "fingerprints"), F.min(best), block)
    best = F.struct("best.none", "best.id", "fp", "best.key")
    stay = rooted.groupBy("root").agg(F.min(best).alias("best")).select("best.key")
    rows = docs.select(whole_row(docs), key.alias("key")).join(stay, "key", "left_semi")
    first = F.row_number().over(Window.partitionBy("key").orderBy(content_order(F.col("row"))))
    return rows.withColumn("n", first).where("n = 1").select("row.*")
