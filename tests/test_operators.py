from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tillsight.functions.rules import Rule, first_match
from tillsight.functions.scalars import (
    amount_text, embedded_price, literal_map, number_text, outside_tolerance, signed_amount, slip_id,
    xor_mask, zero_to_null,
)
from tillsight.operators.dedup import dedup_by_key
from tillsight.operators.encode import encode, extend_dictionary
from tillsight.operators.flatten import named_totals, zip_explode, zip_explode_nested
from tillsight.operators.joins import lookup_chain, pivot_values


@pytest.fixture(scope="module")
def ragged(spark):
    return spark.createDataFrame(
        [(1, ["a", "b"], ["x"]), (2, [], []), (3, None, None), (4, ["c"], [None])],
        "id int, p array<string>, q array<string>",
    )


def test_zip_explode_pads_and_drops(ragged):
    assert rows(zip_explode(ragged, ["p", "q"], ["id"])) == [(1, "a", "x"), (1, "b", None), (4, "c", None)]


def test_zip_explode_outer_keeps(ragged):
    got = rows(zip_explode(ragged, ["p", "q"], ["id"], outer=True))
    assert got == [(1, "a", "x"), (1, "b", None), (2, None, None), (3, None, None), (4, "c", None)]


def test_nested_repeats_first_level_leaf(spark):
    df = spark.createDataFrame(
        [(1, ["l1", "l2"], [["m1", "m2"], None])], "id int, leaf array<string>, deep array<array<string>>"
    )
    inner = rows(zip_explode_nested(df, ["leaf", "deep"], ["deep"], ["id"]))
    assert inner == [(1, "l1", "m1"), (1, "l1", "m2")]
    outer = rows(zip_explode_nested(df, ["leaf", "deep"], ["deep"], ["id"], inner_outer=True))
    assert outer == [(1, "l1", "m1"), (1, "l1", "m2"), (1, "l2", None)]


def test_named_totals_missing_and_repeated(spark):
    df = spark.createDataFrame(
        [(1, ["A", "B", "A"], ["1", "2", "3"]), (2, ["B"], ["5"]), (3, None, None)],
        "id int, n array<string>, v array<string>",
    )
    assert rows(named_totals(df, "n", "v", {"a": "A", "b": "B"}), "id", "a", "b") == [
        (1, "3", "2"), (2, None, "5"), (3, None, None),
    ]


@given(st.permutations([(1, "b", None), (1, "a", 2), (1, "a", 1), (2, None, 5), (2, "z", 0)]))
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_dedup_does_not_depend_on_row_order(spark, shuffled):
    df = spark.createDataFrame(shuffled, "k int, a string, b int")
    assert rows(dedup_by_key(df, ["k"])) == [(1, "a", 1), (2, None, 5)]


def test_pivot_needs_all_names_and_combines(spark):
    data = [(1, "A", "a1"), (1, "A", "a2"), (1, "B", "b"), (2, "A", "only"), (1, "C", "other")]
    df = spark.createDataFrame(data, "k int, name string, value string")
    assert rows(pivot_values(df, ["k"], "name", "value", {"A": "va", "B": "vb"})) == [
        (1, "a1", "b"), (1, "a2", "b"),
    ]


def test_lookup_chain_takes_first_hit(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "a int, b int")
    one = spark.createDataFrame([(1, "first")], "k int, v string")
    two = spark.createDataFrame([(10, "second"), (20, "second")], "k int, v string")
    got = lookup_chain(df, [("a", one, "k", "v"), ("b", two, "k", "v")], "out")
    assert rows(got, "a", "out") == [(1, "first"), (2, "second"), (3, None)]


def test_dictionary_is_append_only(spark):
    known = spark.createDataFrame([(0, "Credit"), (7, "Debit")], "id bigint, text string")
    values = spark.createDataFrame([("Zebra",), ("Debit",), (None,), ("Apple",), ("Apple",)], "text string")
    first = extend_dictionary(known, values, "id", "text")
    # new values are numbered by (hash bucket, text)
    assert rows(first, "id", "text") == [(0, "Credit"), (7, "Debit"), (8, "Zebra"), (9, "Apple")]
    again = extend_dictionary(first, values, "id", "text")
    assert rows(again, "id", "text") == rows(first, "id", "text")
    empty = extend_dictionary(known.limit(0), values, "id", "text")
    assert sorted(t for _, t in rows(empty, "id", "text")) == ["Apple", "Debit", "Zebra"]
    assert [i for i, _ in rows(empty, "id", "text")] == [1, 2, 3]
    coded = encode(spark.createDataFrame([("Apple",), ("new",), (None,)], "c string"), first, "c", "id", "text")
    assert rows(coded) == [(None,), (None,), (9,)]


def test_first_match_order_and_nulls(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    rules = [Rule("big", F.col("x") > 3), Rule("any", F.col("x") > 0)]
    assert rows(df.select("x", first_match(rules).alias("r"))) == [(None, None), (1, "any"), (5, "big")]
    assert rows(df.select(first_match(rules, "none"))) == [("any",), ("big",), ("none",)]


@pytest.mark.parametrize("key", [1, 987654321, 2**40])
def test_masking_twice_is_identity(spark, key):
    df = spark.range(50).select(xor_mask(xor_mask("id", key), key).alias("a"), "id")
    assert df.where("a <> id").count() == 0


def test_scalars(spark):
    df = spark.createDataFrame(
        [(7, 1.5, 2000000006507, 0.0, True), (1234, 120.25, 12, 2.0, False), (99, 99.999, None, None, None)],
        "n bigint, amount double, code bigint, units double, neg boolean",
    )
    got = rows(
        df.select(
            "n", number_text("n"), amount_text("amount"), embedded_price("code"), zero_to_null("units"),
            signed_amount("amount", "neg"), slip_id(F.lit("12"), F.lit(3), "n", "amount"),
        )
    )
    assert got == [
        (1234, "1234", "120.25", 0.12, 2.0, 120.25, "000012-3-1234-120.25"),
        (7, "007", "01.50", 6.5, None, -1.5, "000012-3-007-01.50"),
        (99, "099", "100.0", None, None, None, "000012-3-099-100.0"),
    ]


def test_tolerance_is_exact_on_cents(spark):
    df = spark.createDataFrame([(1.00, 1.02), (1.00, 1.03), (0.1 + 0.2, 0.32)], "a double, b double")
    assert [r[0] for r in df.select(outside_tolerance("a", "b")).collect()] == [False, True, False]


def test_literal_map_refuses_large_dictionaries(spark):
    with pytest.raises(ValueError):
        literal_map("x", {str(i): i for i in range(101)})
