"""Scalar expressions. Everything here is a plain ``Column`` expression, so it
stays inside whole-stage code generation; there are no UDFs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_timestamp(ts) -> Column:
    """Timestamp rendered the way the source system writes it."""
    return F.date_format(col(ts), ISO_FORMAT)


def business_day(ts) -> Column:
    """Calendar day of an ISO text or timestamp value."""
    return F.to_date(col(ts))


def zero_to_null(value) -> Column:
    return F.nullif(col(value), F.lit(0.0))


def xor_mask(value, key: int) -> Column:
    """Reversible masking: applying it twice with one key is the identity."""
    return col(value).bitwiseXOR(F.lit(key).cast("bigint"))


def is_true(flag) -> Column:
    """Three-valued flag collapsed to true / not true."""
    return F.coalesce(col(flag), F.lit(False))


def differs(value, other) -> Column:
    """``value`` is null or not equal to ``other``."""
    return ~col(value).eqNullSafe(F.lit(other) if not isinstance(other, Column) else other)


def equals_ignore_case(value, text: str) -> Column:
    return F.lower(col(value)) == text.lower()


def flag(condition: Column) -> Column:
    """Condition as 1 / 0, with unknown counted as 0."""
    return F.when(condition, 1).otherwise(0)


def embedded_price(item_code) -> Column:
    """Price in currency units carried inside a weighed-goods item code: five
    digits of cents in front of the check digit."""
    text = col(item_code).cast("string")
    cents = F.left(F.right(text, F.lit(6)), F.lit(5))
    return cents.try_cast("int") / F.lit(100.0)


def money(amount) -> Column:
    """An amount in exact cents: sums of it do not depend on the order of rows."""
    return F.round(col(amount), 2).cast("decimal(20,2)")


def outside_tolerance(expected, actual, tolerance: str = "0.02") -> Column:
    """Money comparison on cents, so that binary fractions cannot tip the result."""
    gap = F.abs(money(expected) - money(actual))
    return gap > F.lit(tolerance).cast("decimal(20,2)")


def signed_amount(amount, negative_flag) -> Column:
    return F.when(col(negative_flag), -col(amount)).when(~col(negative_flag), col(amount))


def amount_text(amount) -> Column:
    """Amounts below 100 with two decimals, zero-padded to five characters."""
    value = col(amount)
    padded = F.lpad(F.round(value, 2).cast("decimal(20,2)").cast("string"), 5, "0")
    return F.when(value < 100, padded).otherwise(value.cast("string"))


def number_text(number) -> Column:
    """Receipt number as text, zero-padded to three characters."""
    text = col(number).cast("string")
    return F.when(text.try_cast("bigint") < 100, F.lpad(text, 3, "0")).otherwise(text)


def slip_id(store, workstation, number, amount) -> Column:
    """Readable id of a deposit slip: store, lane, receipt number and amount."""
    parts = [
        F.lpad(col(store).cast("string"), 6, "0"),
        col(workstation).cast("string"),
        number_text(number),
        amount_text(amount),
    ]
    dash = F.lit("-")
    return F.concat(parts[0], dash, parts[1], dash, parts[2], dash, parts[3])


def receipt_key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws(":", *[col(c).cast("string") for c in columns])


def minutes_between(a, b) -> Column:
    """Absolute distance of two timestamps in minutes, at second resolution."""
    return F.abs(F.unix_seconds(col(a)) - F.unix_seconds(col(b))) / F.lit(60.0)


def literal_map(value, mapping: Mapping[str, int]) -> Column:
    """Constant dictionary lookup for a handful of entries; unknown values give null."""
    if len(mapping) > 100:
        raise ValueError("use a join for large dictionaries")
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), col(value))


# The layout of source file names, as regular expressions.
FILE_NAME = r"[0-9]{4}\.(\w+)\.[a-zA-Z0-9]+\.+[0-9]{5}.[a-zA-Z].+"
FILE_STORE = "[0-9]{4}"
FILE_DAY = "[0-9]{8}"
FILE_STAMP = "[0-9]{14}"
FILE_COUNTER_AREA = r"[0-9]\.[a-zA-Z0-9]+\."
FILE_COUNTER = "[0-9]{5}"


def file_base_name(path) -> Column:
    """File name without its directory: the part the log tables key on."""
    return F.regexp_extract(col(path), FILE_NAME, 0)


def file_name_parts(name, store_prefix: str = "") -> dict[str, Column]:
    """Store, business day, creation time and running number carried in a file name."""
    c = col(name)
    counter_area = F.regexp_extract(c, FILE_COUNTER_AREA, 0)
    return {
        "RetailStoreID": F.concat(F.lit(store_prefix), F.regexp_extract(c, FILE_STORE, 0)),
        "BusinessDate": F.try_to_date(F.regexp_extract(c, FILE_DAY, 0), "yyyyMMdd"),
        "CreationDateTime": F.try_to_timestamp(
            F.regexp_extract(c, FILE_STAMP, 0), F.lit("yyyyMMddHHmmss")
        ),
        "ConsecutiveNumber": F.regexp_extract(counter_area, FILE_COUNTER, 0),
    }
