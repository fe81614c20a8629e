"""Ordered per-key operators that stay balanced when one key is hot.

A plain window sends all rows of a key to one task. The operators here cut every key
into consecutive buckets of its order column, work inside a bucket, and carry the
little that crosses a bucket edge (one row per key and bucket) over in a second step.
Results are the same as with the plain window, whatever the buckets. Buckets are hours, or,
where an hour of one key holds too many rows (a wrong clock, a bulk import), ranges of equal
depth between sampled quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

#: width of a time bucket: an hour of one lane is a few hundred rows even in a very busy store;
#: callers with more rows per key and hour pass a smaller width
BUCKET_SECONDS = 3600


def time_bucket(ts, seconds: int = BUCKET_SECONDS) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_seconds(c) / F.lit(seconds))


#: most rows of one key and time bucket; beyond it ``balanced_bucket`` cuts by depth
DEPTH = 1 << 20
#: ranges of equal depth for each shuffle partition, and the most of them in all
RANGES, MOST_RANGES = 16, 4096
#: sampled rows for each range
SAMPLED = 16


def equal_depth(rows: DataFrame, order: Sequence[str | Column], ranges: int | None = None) -> Column:
    """Number of the range of ``order`` that a row lies in. The ranges hold about equally many
    of all ``rows``, so no key has more rows in one than that, whatever its times.

    The edges are quantiles of a sample of bounded size, which Spark draws and sorts; rows that
    are equal in all of ``order`` share a range. Nulls come first. Any edges give the same
    results in the operators below, so it does not matter which rows are drawn.
    """
    if ranges is None:
        ranges = min(MOST_RANGES, RANGES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    kinds = [f.dataType for f in rows.select(*columns).schema]
    # instants as numbers: as local times of the driver, edges could lose their order where clocks change
    columns = [F.unix_micros(c) if isinstance(t, TimestampType) else c for c, t in zip(columns, kinds, strict=True)]
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(columns)])
    places = rows.select(place.alias("place"))
    share = ranges * SAMPLED / max(places.count(), 1)
    drawn = places.sample(share, seed=1) if share < 1 else places
    edge = F.when(F.col("n") % F.greatest(F.floor(F.col("size") / ranges), F.lit(1)) == 0, F.col("place"))
    sorted_places = drawn.agg(F.sort_array(F.collect_list("place")).alias("all")).select(
        F.size("all").alias("size"), F.posexplode("all").alias("n", "place")
    )
    edges = sorted_places.where("n > 0").select(edge.alias("edge")).where("edge is not null").distinct()
    found = edges.orderBy("edge").collect()  # at most two for each range
    if not found:
        return F.lit(0)
    types = edges.schema["edge"].dataType
    literals = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r["edge"], types, strict=True)]) for r in found
    ]
    steps = [1 << k for k in reversed(range(len(found).bit_length()))]
    # binary search: each step goes on if the edge it would reach is not beyond the row
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(F.array(*literals), at + step - 1) <= place, at + step).otherwise(at),
    )


def balanced_bucket(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    seconds: int = BUCKET_SECONDS,
    depth: int = DEPTH,
) -> Column:
    """Bucket for ``rows``: that of the time ``order[0]`` if no key has more than ``depth`` rows in
    one, which a count by key and bucket tells, else ranges of ``order`` of equal depth."""
    sizes = rows.groupBy(*keys, time_bucket(order[0], seconds).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    most = sizes.agg(F.max("_n")).first()[0] or 0
    return time_bucket(order[0], seconds) if most <= depth else equal_depth(rows, order)


def _tie(rows: DataFrame, columns: Sequence[str]) -> Column:
    """Hash of a row's content, as far as it can be hashed: what tells rows of one time apart."""
    plain = [c for c in columns if not any(t in rows.schema[c].dataType.simpleString() for t in ("map<", "variant"))]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("bigint")


def _cut(rows: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """Adds the cell of each row, its keys and bucket as one struct. A struct is never null
    and structs with equal nulls are equal, so windows and joins by it agree on null keys and
    need one and the same partitioning."""
    return rows.withColumn("_cell", F.struct(*keys, bucket.alias("_bucket")))


def _of(keys: Sequence[str]) -> list[Column]:
    """The keys within the cell."""
    return [F.col("_cell")[k] for k in keys]


def _attach(rows: DataFrame, per_cell: DataFrame, extra: str) -> DataFrame:
    """Left join a column that has one row per cell onto the rows, which stay where they are."""
    return rows.join(per_cell.select("_cell", extra), "_cell", "left")


def running_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    out: str,
    dense: bool = False,
) -> DataFrame:
    """``row_number`` (or ``dense_rank``) of the rows of each key by ``order``.

    ``bucket`` must be a non-decreasing function of the order columns.
    """
    keys = list(keys)
    cut = _cut(df, keys, bucket)
    local = Window.partitionBy("_cell").orderBy(*order)
    position = F.dense_rank() if dense else F.row_number()
    ranked = cut.withColumn("_local", position.over(local))
    if dense:
        distinct = cut.select("_cell", *[c for c in order if c not in keys]).distinct()
        sizes = distinct.groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"))
    else:
        sizes = cut.groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*_of(keys)).orderBy(F.col("_cell")["_bucket"]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    return (
        _attach(ranked, offsets, "_offset")
        .withColumn(out, F.col("_local") + F.col("_offset"))
        .drop("_cell", "_local", "_offset")
    )


def next_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    payload: Sequence[str],
    out: str,
) -> DataFrame:
    """Struct of ``payload`` taken from the following row of the same key, else null.

    Same as ``lead(struct(...))``; the last row of a bucket takes the first row of the
    next bucket that has any.
    """
    keys = list(keys)
    cut = _cut(df, keys, bucket).withColumn("_payload", F.struct(*payload))
    local = Window.partitionBy("_cell").orderBy(*order)
    here = cut.withColumn("_lead", F.lead("_payload").over(local))
    firsts = cut.groupBy("_cell").agg(
        F.min(F.struct(*order, F.col("_payload").alias("_payload")))["_payload"].alias("_first")
    )
    by_bucket = Window.partitionBy(*_of(keys)).orderBy(F.col("_cell")["_bucket"])
    carry = firsts.withColumn("_carry", F.lead("_first").over(by_bucket))
    return (
        _attach(here, carry, "_carry")
        .withColumn(out, F.coalesce("_lead", "_carry"))
        .drop("_cell", "_payload", "_lead", "_carry")
    )


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    payload: Sequence[str],
    direction: str = "next",
    bucket_seconds: int = BUCKET_SECONDS,
    depth: int | None = None,
) -> DataFrame:
    """Attach to each left row the nearest right row strictly after (``next``) or
    strictly before (``prev``) it, within equal ``keys``.

    Left columns are kept; ``right_time`` and ``payload`` are added, null where no
    right row qualifies. Among right rows of one time the one with the smallest
    payload wins for ``next``, the largest for ``prev``. With ``depth``, time buckets of a key
    with more rows than that give way to ranges of equal depth.
    """
    if direction not in ("next", "prev"):
        raise ValueError(direction)
    keys = list(keys)
    forward = direction == "next"
    own = [c for c in left.columns if c not in keys]
    picked = F.struct(F.col(right_time).alias("_rt"), *[F.col(c) for c in payload])
    rights = right.dropna(subset=[*keys, right_time]).select(
        *keys, F.col(right_time).alias("_t"), picked.alias("_right")
    )
    left_rows = left.select(
        *keys, F.col(left_time).alias("_t"), F.struct(*own).alias("_left"),
        F.lit(None).cast(rights.schema["_right"].dataType).alias("_right"),
    )
    right_rows = rights.select(
        *keys, "_t", F.lit(None).cast(left_rows.schema["_left"].dataType).alias("_left"), "_right"
    )
    merged = left_rows.unionByName(right_rows)
    # walking away from the wanted side, a left row must come before right rows of its time
    side = F.col("_right").isNotNull().cast("int")
    if depth is None:
        bucket = time_bucket("_t", bucket_seconds)
    else:  # no right row of a left row's time may lie in a later bucket of the walk
        bucket = balanced_bucket(
            merged, keys, ["_t", 1 - side if forward else side, _tie(merged, ["_left", "_right"])], bucket_seconds, depth
        )
    rows = _cut(merged, keys, bucket)
    if forward:
        order = [F.col("_t").desc(), side, F.col("_right").desc()]
    else:
        order = [F.col("_t").asc(), side, F.col("_right").asc()]
    local = Window.partitionBy("_cell").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    here = (
        rows.withColumn("_near", F.last("_right", ignorenulls=True).over(local))
        .where(F.col("_right").isNull())
    )
    edge = (F.min if forward else F.max)("_right").alias("_edge")
    per_bucket = (
        rows.select("_cell", "_right").groupBy("_cell").agg(edge)
    )
    of = F.col("_cell")["_bucket"]
    seen = Window.partitionBy(*_of(keys)).orderBy(of.desc() if forward else of.asc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # right rows of one time may lie on both sides of an edge
    carry = per_bucket.withColumn("_carry", (F.min if forward else F.max)("_edge").over(seen))
    nearest = (F.least if forward else F.greatest)("_near", "_carry")
    found = _attach(here, carry, "_carry").withColumn("_hit", F.when(F.col("_t").isNotNull(), nearest))
    return found.select(
        *keys,
        *[F.col("_left")[c].alias(c) for c in own],
        F.col("_hit")["_rt"].alias(right_time),
        *[F.col("_hit")[c].alias(c) for c in payload],
    )


def min_after(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    value: str,
    out: str,
    bucket_seconds: int = BUCKET_SECONDS,
    depth: int | None = None,
) -> DataFrame:
    """Smallest ``value`` among all right rows strictly after each left row, within equal
    ``keys``; null if there is none. A running minimum over the merged rows, so that left
    and right rows of a key are never paired up. ``depth`` as in ``as_of``."""
    keys = list(keys)
    own = [c for c in left.columns if c not in keys]
    values = right.dropna(subset=[*keys, right_time]).select(
        *keys, F.col(right_time).alias("_t"), F.col(value).alias("_value")
    )
    left_rows = left.select(*keys, F.col(left_time).alias("_t"), F.struct(*own).alias("_left"))
    merged = left_rows.unionByName(values, allowMissingColumns=True)
    bucket = time_bucket("_t", bucket_seconds)
    if depth is not None:
        of_left = F.col("_left").isNotNull().cast("int")
        bucket = balanced_bucket(merged, keys, ["_t", of_left, _tie(merged, ["_left", "_value"])], bucket_seconds, depth)
    rows = _cut(merged, keys, bucket)
    from_end = [F.col("_t").desc(), F.col("_left").isNull().cast("int")]
    local = Window.partitionBy("_cell").orderBy(*from_end).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    here = rows.withColumn("_near", F.min("_value").over(local)).where(F.col("_left").isNotNull())
    per_bucket = rows.groupBy("_cell").agg(F.min("_value").alias("_least"))
    later = Window.partitionBy(*_of(keys)).orderBy(F.col("_cell")["_bucket"].desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carry = per_bucket.withColumn("_carry", F.min("_least").over(later))
    least = F.when(F.col("_t").isNotNull(), F.least("_near", "_carry"))
    return _attach(here, carry, "_carry").select(
        *keys, *[F.col("_left")[c].alias(c) for c in own], least.alias(out)
    )


#: hexadecimal digits of a text's hash that number its bucket: 4,096 buckets whatever the texts
HASH_DIGITS = 3


def global_row_number(df: DataFrame, order: str, out: str) -> DataFrame:
    """Number all rows 1, 2, ... by (hash bucket, text) without sending them through one task.

    The buckets are ranges of the text's md5, so texts that begin alike spread as evenly as
    any; only one count per bucket is totalled up. Nulls come first, as a bucket of their own.
    """
    hashed = df.withColumns({"_all": F.lit(0), "_hash": F.substring(F.md5(order), 1, HASH_DIGITS)})
    return running_position(hashed, ["_all"], ["_hash", order], F.col("_hash"), out).drop("_all", "_hash")
