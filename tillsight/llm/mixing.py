"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws a key -ln(u) / w, u being uniform by a hash of its id and w its quality
weight; a source's documents in the order of their keys are a weighted sample without
replacement of any size. Whole epochs of a source come first, then the documents with the
least keys until the source's word budget is met.

No source is sorted as a whole. Keys fall into ``BUCKETS`` ranges; word sums per source and
range show in which range the budget ends. While that range has more than ``EDGE`` rows of a
source it is cut into as many again, at first by key and then by the hash of the text, which
decides between equal keys; only the rows of the last range are sorted. The outcome is one cut
(key, tie) a source, against which every row is compared where it lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import SPACE, quoted, stored, whole_row

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: ranges of a cut, hexadecimal digits that number them, and rows of a source that a task sorts
BUCKETS, DIGITS, EDGE = 4096, 3, 100_000
#: cuts by key, which use up its bits, and by the 32 digits of the tie
KEY_CUTS, TIE_CUTS = 6, 10
SEED = "mix"


def size_of(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def quality_weight(text: Column) -> Column:
    """Share of letters (A-Z, a-z and all that is not ASCII) among the characters that are not
    white space, each count one higher, so that it is above 0 for any text."""
    text = F.coalesce(text, F.lit(""))
    letters = F.length(F.regexp_replace(text, r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", ""))
    shown = F.length(F.regexp_replace(text, f"[{SPACE}]+", ""))
    return (1 + letters) / (1 + shown)


def uniform(id_col: Column, seed: str = SEED) -> Column:
    """Number between 0 and 1 by a hash of an id."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(seed), id_col.cast("string"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def _light(rows: DataFrame, id_col: Column, text: Column, source: Column, weight: Column | None, seed: str) -> DataFrame:
    key = -F.log(uniform(id_col, seed)) / (quality_weight(text) if weight is None else weight)
    tie = F.md5(F.coalesce(text, F.lit("")))
    return rows.withColumns(
        {"src": F.coalesce(source.cast("string"), F.lit("")), "none": source.isNull(), "size": size_of(text), "key": key, "tie": tie}
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds ``target`` to (src, none, source_size), one row per source. Sources in the order of
    their names, null last, weigh ``weights`` in turn; a source stops at ``most`` times its
    size and the excess is shared again. With sources ordered by cap / weight, all that stop
    come first, so running sums give the common level of the others."""
    rank = F.row_number().over(Window.orderBy("none", "src")) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    rows = sizes.withColumn("weight", F.element_at(cycle, (rank % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "none", "src")
    every = Window.partitionBy(F.lit(1))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", rest / F.sum("weight").over(onward))
    reach = F.col("cap") / F.col("weight")
    first = F.min(F.when(F.col("level") <= reach, F.struct(reach.alias("reach"), "none", "src", "level"))).over(every)
    rows = rows.withColumn("level", first["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return rows.select("src", "none", "source_size", target.alias("target"))


def _range(level: int) -> Column:
    """Number of a row's range in the cut ``level``. Ranges are in the order of (key, tie): the
    digits to the base ``BUCKETS`` of key / (1 + key), one a cut, then those of the tie."""
    if level >= KEY_CUTS:
        return F.conv(F.substring("tie", DIGITS * (level - KEY_CUTS) + 1, DIGITS), 16, 10).cast("bigint")
    part = F.col("key") / (1 + F.col("key"))
    for _ in range(level):  # exact: a power of two, and a difference of near numbers
        part = part * BUCKETS - F.floor(part * BUCKETS)
    return F.floor(part * BUCKETS)


def cuts(light: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, edge_rows: int = EDGE) -> DataFrame:
    """Per source: (src, none, source_size, target, epochs, cut_key, cut_tie, each). Rows below
    the cut are taken once more, rows at the cut ``each`` words of them; no cut: none is."""
    names = ["src", "none"]
    upto = F.sum("words").over(Window.partitionBy(names).orderBy("bucket"))
    rows, goal, budget = light, None, None
    last = KEY_CUTS + TIE_CUTS - 1
    for level in range(last + 1):
        rows = rows.withColumn("bucket", _range(level))
        sums = stored(rows.groupBy(*names, "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("n")), "sums")
        if goal is None:
            goal = targets(sums.groupBy(names).agg(F.sum("words").alias("source_size")), weights, share, most)
            epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0).cast("bigint"))
            goal = goal.withColumn("epochs", epochs)
            goal = stored(goal.withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size")), "targets")
            budget = goal.select(*names, "rest", F.lit(0).cast("bigint").alias("before"))
        # a row or a few thousand rows for each source, not for each document
        found = sums.select(*names, "bucket", "words", "n", upto.alias("upto")).join(budget, names)
        found = found.where("before + upto >= rest and before + upto - words < rest and rest > 0")
        budget = stored(found.select(*names, "bucket", "rest", (F.col("before") + F.col("upto") - F.col("words")).alias("before"), "n"), "edges")
        rows = rows.join(budget.select(*names, "bucket", "rest", "before"), [*names, "bucket"])
        if level == last or (budget.agg(F.max("n")).first()[0] or 0) <= edge_rows:
            break
        rows = stored(rows.drop("bucket", "rest", "before"), "edge")
        budget = budget.drop("bucket", "n")
    near = rows.groupBy(*names, "rest", "before", "key", "tie").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    upto = F.col("before") + F.sum("words").over(Window.partitionBy(names).orderBy("key", "tie"))
    cut = near.withColumn("upto", upto).where("upto >= rest and upto - words < rest")
    cut = cut.select(*names, F.col("key").alias("cut_key"), F.col("tie").alias("cut_tie"), F.floor((F.col("rest") - F.col("upto") + F.col("words")) / F.col("rows")).alias("each"))
    return stored(goal.join(cut, names, "left").drop("rest"), "cuts")


def _taken() -> Column:
    more = (
        F.when(F.struct("key", "tie") < F.struct("cut_key", "cut_tie"), F.col("size"))
        .when((F.col("key") == F.col("cut_key")) & (F.col("tie") == F.col("cut_tie")), F.col("each"))
        .otherwise(F.lit(0).cast("bigint"))
    )
    return (F.col("epochs") * F.col("size") + F.when(F.col("cut_key").isNull(), F.lit(0).cast("bigint")).otherwise(more)).alias("taken")


def mixture(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: (``id_col``, size, source_size, target, taken).

    ``taken`` counts the words the mix takes of the row, repeats included. A source's taken
    words equal its target, rounded down, but for words that rows equal in id and text at the
    cut cannot share evenly. The last document taken gives only the words that are left in the
    budget. Null texts have size 0, a null source is a source, null ids draw one key. An empty
    table gives an empty result. Further columns are left out.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), quoted(source_col).alias("source"), *([] if weight is None else [weight.alias("w")]))
    light = _light(rows, F.col("id"), F.col("text"), F.col("source"), None if weight is None else F.col("w"), seed)
    light = stored(light.select("id", "src", "none", "size", "key", "tie"), "sizes")
    cut = cuts(light, weights, share, most)
    return light.join(cut, ["src", "none"]).select(F.col("id").alias(id_col), "size", "source_size", "target", _taken())


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs`` of which the mix takes words, with all their columns and
    ``mix_size``, ``mix_target`` and ``mix_taken`` after them."""
    rows = docs.select(whole_row(docs))
    field = lambda name: F.col(f"row.`{name}`")
    light = _light(rows, field(id_col), field(text_col), field(source_col), None, seed)
    cut = cuts(stored(light.select("src", "none", "size", "key", "tie"), "sizes"), weights, share, most)
    taken = light.join(cut, ["src", "none"]).withColumn("taken", _taken()).where("taken > 0")
    return taken.select("row.*", F.col("size").alias("mix_size"), F.col("target").alias("mix_target"), F.col("taken").alias("mix_taken"))
