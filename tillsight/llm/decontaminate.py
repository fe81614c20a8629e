"""Benchmark passages in training documents, by n-gram windows, in DataFrame functions alone.

The windows of all benchmark items form a hash set. Every word of a document is hashed once, and
the combined hash of every word window is looked up in a table of slots that the windows of the
benchmark fill, two each; only windows whose two slots are filled form their text, and a hit is a match of
the whole window text. Documents are scanned once: what is kept of one is its number of words and
its few candidates. The window table is broadcast if its bytes, which are measured, are within
``BROADCAST_BYTES``; a larger one is joined by shuffling, each window dealt to ``SALTS`` tasks, so
that a passage that very many documents share is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import lower_az, quoted, row_key, stored, whole_row

WINDOW = 10
#: window starts of a document that are looked up at a time
CHUNK = 1024
#: slots for each window of the benchmark, and the largest number of slots; with more windows than
#: that gives room for, more candidates form their text, and results are the same
SLOTS_EACH, MOST_SLOTS = 32, 1 << 22
#: tasks that share one window where the table of windows is not broadcast
SALTS = 16
#: largest window table that is broadcast, in bytes of text and ids
BROADCAST_BYTES = 64 << 20
#: what separates words, in a text whose A-Z are in lower case
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), BETWEEN), "")


def hashes_of(words: Column) -> Column:
    """64-bit hash of each word."""
    return F.transform(words, lambda w: F.xxhash64(w))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(window, len, items): each distinct window and the ids of the items that have it, as
    text. An item of fewer than ``window`` words is one window, one without words has none;
    an item without an id has windows, but adds no id."""
    items = benchmark.select(quoted(id_col).cast("string").alias("item"), words_of(quoted(text_col)).alias("words"))
    items = items.where(F.size("words") > 0)
    long = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1))),
        lambda i: F.slice("words", i, window),
    )
    rows = items.select("item", F.explode(long).alias("w"))
    return rows.groupBy(F.array_join("w", " ").alias("window"), F.size("w").alias("len")).agg(F.collect_set("item").alias("items"))


def slot_of(hashes: Column, number: int, half: int) -> Column:
    """Slot, counted from 1, of a window by the lower or the upper half of its hash."""
    return F.shiftright(F.xxhash64(hashes), 32 * half).bitwiseAND(F.lit(number - 1)) + 1


def slots(known: DataFrame) -> bytes:
    """One byte a slot, 1 where half a hash of a window of ``known`` falls. The number of slots is
    a power of two; what reaches the driver is one bit for each."""
    number = 1 << min(max(known.count() * SLOTS_EACH, 2) - 1, MOST_SLOTS - 1).bit_length()
    both = [slot_of(hashes_of(F.split("window", " ")), number, half) for half in (0, 1)]
    bits = known.select(F.explode(F.array(*both)).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
    bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    filled = {r["bucket"]: r["bits"] for r in bits}
    width = max((len(b) for b in filled.values()), default=0)
    every = [bytes(x >> i & 1 for i in range(8)) for x in range(256)]
    table = b"".join(every[x] for k in range(1, number // max(8 * width, 1) + 2) for x in filled.get(k, bytes(width)))
    return table[:number].ljust(number, b"\0")


def hits(rows: DataFrame, known: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``rows`` with ``n_words`` and ``near`` in place of ``text``: the windows (pos, len, window)
    of the text whose hash falls into filled slots of ``known``, as that of every window does
    that is in ``known``."""
    lengths = sorted(r["len"] for r in known.select("len").distinct().collect())  # at most WINDOW values
    table = slots(known)
    kept = [c for c in rows.columns if c != "text"]
    # both arrays are used more than once below, so each is computed once a row
    hashed = rows.select(*kept, words_of(F.col("text")).alias("words")).select("*", hashes_of(F.col("words")).alias("hashes"))

    def near(n: int) -> Column:
        last = F.size("hashes") - n

        def some(start: Column) -> Column:
            def filled(i: Column) -> Column:
                both = [slot_of(F.slice("hashes", i + 1, n), len(table), half).cast("int") for half in (0, 1)]
                lower, upper = (F.substring(F.lit(table), slot, 1) == F.lit(b"\x01") for slot in both)
                return lower & upper

            return F.filter(F.sequence(start, F.least(start + (chunk - 1), last)), filled)

        at = F.flatten(F.transform(F.sequence(F.lit(0), last, F.lit(chunk)), some))
        found = F.transform(
            at, lambda i: F.struct(i.alias("pos"), F.lit(n).alias("len"), F.array_join(F.slice("words", i + 1, n), " ").alias("window"))
        )
        return F.when(last >= 0, found).otherwise(F.array().cast(NEAR))

    of_all = F.concat(*[near(n) for n in lengths]) if lengths else F.array().cast(NEAR)
    return hashed.select(*kept, F.size("words").cast("bigint").alias("n_words"), of_all.alias("near"))


#: type of the candidates of a row
NEAR = "array<struct<pos:int,len:int,window:string>>"


def verified(near: DataFrame, known: DataFrame) -> DataFrame:
    """(key, pos, len, items) of the candidates of ``near`` (key, near) that ``known`` has."""
    size = known.agg(F.sum(F.octet_length("window") + F.octet_length(F.array_join("items", ",")) + 40)).first()[0]
    windows = near.select("key", F.explode("near").alias("w")).select("key", "w.pos", "w.window")
    if (size or 0) <= BROADCAST_BYTES:
        return windows.join(F.broadcast(known), "window").select("key", "pos", "len", "items")
    dealt = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    windows = windows.withColumn("salt", F.pmod(F.xxhash64("key", "pos"), F.lit(SALTS)).cast("int"))
    return windows.join(dealt, ["window", "salt"]).select("key", "pos", "len", "items")


def _covered(spans: Column) -> Column:
    """Number of words in the union of sorted spans (pos, len)."""
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))

    def step(acc: Column, s: Column) -> Column:
        end = (s["pos"] + s["len"]).cast("bigint")
        new = F.greatest(F.lit(0).cast("bigint"), end - F.greatest(acc["end"], s["pos"].cast("bigint")))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + new).alias("n"))

    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["n"])


def _found(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """(id, key, n_words) of every row, and (key, spans, items) of the rows with hits; the key is
    that of id and text."""
    known = stored(benchmark_windows(benchmark, item_col, item_text), "windows")
    text = quoted(text_col)
    rows = docs.select(quoted(id_col).alias("id"), row_key(quoted(id_col), text).alias("key"), text.alias("text"))
    scanned = stored(hits(rows, known), "scanned")
    found = verified(scanned.select("key", "near"), known).groupBy("key")
    found = found.agg(F.collect_set(F.struct("pos", "len")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return scanned.select("id", "key", "n_words"), found


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: (``id_col``, n_words, n_hit, n_items, items_sha256, contaminated).

    A word is hit if it lies inside any occurrence of a benchmark window. Null and blank texts
    have no words. Rows that repeat an id and a text get the same values each; null ids are
    kept. An empty table on either side gives no hits. Further columns are left out.
    """
    rows, found = _found(docs, benchmark, id_col, text_col, item_col, item_text)
    n_hit = F.coalesce(_covered(F.col("spans")), F.lit(0).cast("bigint"))
    items = F.array_join(F.array_sort("items"), ",")
    sums = found.select("key", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(items, 256).alias("items_sha256"))
    return rows.join(sums, "key", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", spans: bool = False
) -> DataFrame:
    """``docs`` without benchmark passages, all columns: documents with a hit go, or with
    ``spans`` they stay without the words that are hit; the rest of their words is then joined
    by single spaces, in lower case. Documents without a hit are returned as they are, those with
    null and blank texts and every repeated row among them; an empty table on either side removes
    nothing."""
    _, found = _found(docs, benchmark, id_col, text_col, item_col, item_text)
    rows = docs.select(whole_row(docs), row_key(quoted(id_col), quoted(text_col)).alias("key"))
    if not spans:
        return rows.join(found.select("key"), "key", "left_anti").select("row.*")
    left = F.filter(
        words_of(F.col(f"row.`{text_col}`")),
        lambda w, i: ~F.exists("spans", lambda s: (i >= s["pos"]) & (i < s["pos"] + s["len"])),
    )
    clean = F.when(F.col("spans").isNull(), F.col(f"row.`{text_col}`")).otherwise(F.array_join(left, " "))
    return rows.join(found, "key", "left").select(F.col("row").withField(f"`{text_col}`", clean).alias("row")).select("row.*")
