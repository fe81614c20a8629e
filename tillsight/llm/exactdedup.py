"""Exact deduplication that stays balanced when one text fills a third of all rows.

Three combining stages, each comparing whole texts, not digests alone:

1. local: rows of one task that have the same digest and text become one row (the map-side
   half of the aggregation), so a text leaves a task once however often it is there;
2. salted: these rows meet by (digest, salt, text), the salt being that of their task;
3. global: the winners of all salts, at most ``SALTS`` a text, meet by digest and are merged
   where their texts are equal.

Rows find their group by digest again, without their texts; only if texts with one digest
differ are those compared once more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import content_order, lower_az, quoted, stored, whole_row

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def groups(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: (digest, keep_id, n, variants, text); ``variants``
    counts the texts of that digest, ``text`` is set only where there are several."""
    text = F.coalesce(lower_az(quoted(text_col)), F.lit(""))
    rows = docs.select(quoted(id_col).alias("id"), text.alias("text")).withColumn("digest", digest(F.col("text")))
    rows = rows.withColumn("salt", F.spark_partition_id() % salts)
    merged = rows.groupBy("digest", "salt", "text").agg(F.max("id").alias("id"), F.count("*").alias("n"))
    whole = merged.repartition("digest").groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.sum("n").alias("n"))
    variants = F.count("*").over(Window.partitionBy("digest"))
    whole = whole.select("digest", "keep_id", "n", variants.alias("variants"), "text")
    return whole.withColumn("text", F.when(F.col("variants") > 1, F.col("text")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``, dropped ones too: (``id_col``, keep_id, group_size, kept,
    text_sha256).

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty. The
    row with the largest id stays. Null ids are smaller than all others: ``keep_id`` is null
    where a group has no other. Rows that repeat the largest id within a group are counted one
    by one and exactly one of them is kept. An empty table gives an empty result; further
    columns are left out. ``digest`` may be any function of the text, colliding ones too.
    """
    text = F.coalesce(lower_az(quoted(text_col)), F.lit(""))
    found = stored(groups(docs, id_col, text_col, digest, salts), "groups")
    rows = docs.select(quoted(id_col).alias("id"), text.alias("text"))
    rows = rows.select("id", digest(F.col("text")).alias("digest"), F.sha2("text", 256).alias("text_sha256"), "text")
    sums = ["id", "digest", "text_sha256"]
    # rows that repeat an id and a text are counted first, so no id can make a group of rows large
    light = rows.select(sums).groupBy(sums).agg(F.count("*").alias("times"))
    joined = light.join(found.where("variants = 1").drop("text"), "digest")
    several = found.where("variants > 1")
    if not several.isEmpty():
        shared = several.select("digest").distinct()
        full = rows.join(shared, "digest", "left_semi").groupBy(*sums, "text").agg(F.count("*").alias("times"))
        joined = joined.unionByName(full.join(several, ["digest", "text"]).drop("text"))
    each = joined.withColumn("i", F.explode(F.expr("sequence(1L, times)")))
    return each.select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that stay, with all their columns; one of each group of equal texts, that
    of ``exact_groups``. Of rows that repeat the id and text that stay, one is chosen by a hash of
    all its columns, so reruns agree. Null texts are empty ones; an empty table stays empty."""
    text = F.coalesce(lower_az(quoted(text_col)), F.lit(""))
    stay = exact_groups(docs, id_col, text_col).where("kept").select(quoted(id_col).alias("id"), "text_sha256")
    rows = docs.select(whole_row(docs), quoted(id_col).alias("id"), F.sha2(text, 256).alias("text_sha256"))
    same = rows["id"].eqNullSafe(stay["id"]) & (rows["text_sha256"] == stay["text_sha256"])
    kept = rows.join(stay, same, "left_semi")
    one = F.row_number().over(Window.partitionBy("id", "text_sha256").orderBy(content_order(F.col("row"))))
    return kept.select("row", one.alias("n")).where("n = 1").select("row.*")
