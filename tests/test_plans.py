"""What the physical plans must look like."""

from __future__ import annotations

import re

import pytest

from tillsight.plans import classify
from tillsight.sources.testdata import TestTables
from workload.stages import with_stages


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_move_once_through_all_line_joins(spark, sf_dir, no_broadcast):
    t = with_stages(TestTables(spark, sf_dir), "lineitemderived")
    lines = classify.line_summary(
        t["lineitemderived"], t["sale"], t["return"], t["loyalty"], t["addon"], t["modifier"]
    )
    text = plan(lines)
    start = text.index("REPARTITION_BY_COL")
    # from the outermost join down to the repartitioned lines there is no other exchange
    spine = text[text.index("SortMergeJoin"):start].splitlines()
    indent = [len(re.match(r"[\s:+\-*|]*", x).group()) for x in spine]
    assert sum("Exchange" in x for x in spine) == 1, list(zip(indent, spine))


def test_bucketed_lines_are_not_moved(spark, sf_dir, no_broadcast, tmp_path):
    """Joins and reductions of the line tables need no exchange; only sums by receipt move."""
    from tillsight.sources.bucketed import bucketed_lines

    t = with_stages(TestTables(spark, sf_dir), "lineitemderived")
    tables = {n: t[n] for n in ("lineitemderived", "sale", "return", "loyalty", "modifier", "addon")}
    try:
        b = bucketed_lines(spark, tables, "till_buckets", str(tmp_path), 5)
        lines = classify.line_summary(b["lineitemderived"], b["sale"], b["return"], b["loyalty"], b["addon"], b["modifier"], b["items"])
        text = plan(lines)
        assert text.count("till_buckets.") == 5 and text.count("SortMergeJoin") == 4
        assert "Exchange" not in text[text.index("SortMergeJoin"):]
        assert len(re.findall(r"Exchange hashpartitioning\(RetailStoreID#\d+L?, WorkstationID#\d+L?, SequenceNumber", text)) == text.count("Exchange ") == 2
        plain = classify.line_summary(*[t[n] for n in ("lineitemderived", "sale", "return", "loyalty", "addon", "modifier")])
        assert sorted(map(str, lines.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.sql("DROP DATABASE IF EXISTS till_buckets CASCADE")


def test_lines_become_blocks_before_they_move_to_receipts(spark, sf_dir, no_broadcast):
    """A receipt sends a row for its block of lines, not one for each line; modifiers and headers
    move once."""
    t = with_stages(TestTables(spark, sf_dir), "lineitemderived")
    tables = [t[n] for n in ("lineitemderived", "sale", "return", "loyalty", "addon", "modifier")]
    text = plan(classify.line_summary(*tables))
    above = text[: text.index("SortMergeJoin")]
    below = above[above.rindex("Exchange ") :]
    assert len(re.findall(r"HashAggregate\(keys=\[RetailStoreID[^]]*, _block#", below)) == 2
    assert text.count("Exchange ") == 9  # 11 before
    flags = classify.receipt_flags(t["header"], t["retailheader"], *tables[:3], t["tender"], *tables[3:], t["stores"])
    assert plan(flags).count("FunctionLogStoreInfoID#") and not re.search(
        r"Exchange hashpartitioning\([^)]*TransactionType#", plan(flags)
    )


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    text = plan(t["sale"].select("RetailStoreID", "ExtendedAmount"))
    assert "PushedFilters" in text and "IsReturn" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert len(schema.split(",")) <= 3


def test_dedup_limits_groups_before_the_shuffle(spark, sf_dir):
    from tillsight.operators.dedup import dedup_by_key

    df = TestTables(spark, sf_dir).base("lineitem").select("l_orderkey", "l_partkey")
    text = plan(dedup_by_key(df, ["l_orderkey"]))
    partial = [x for x in text.splitlines() if "WindowGroupLimit" in x]
    assert any("Partial" in x for x in partial) and any("Final" in x for x in partial)


def test_no_python_in_any_rule_plan(spark, sf_dir):
    from workload.all import all_queries

    for name in ("classify_all", "price_check", "pricelookup_attach", "empties_totals"):
        text = plan(all_queries()[name](spark, sf_dir))
        assert "Python" not in text and "CartesianProduct" not in text


def test_builder_rules_are_those_of_the_checking_sql():
    """The rules stated in the checking SQL and those of the builders cannot drift apart."""
    from oracle.ingest import ALL, RULES
    from tillsight.plans.ingest import BUILDERS, WHOLE_ROW
    from tillsight.sources.widedata import parts

    assert set(RULES) == set(BUILDERS)
    for name, rules in RULES.items():
        one = (WHOLE_ROW if rules.one == ALL else tuple(rules.one)) if rules.one else None
        for spec, _ in parts(name):
            got = (spec.marker, spec.required, spec.dedup, spec.dedup_first, spec.keep_empty, spec.keep_empty_nested)
            assert got == (rules.marker, rules.required, one, rules.late, rules.keep, rules.keep_nested), name


def test_receipt_void_matching_is_one_pass(spark, sf_dir, no_broadcast):
    from workload.all import all_queries

    text = plan(all_queries()["void_followup_match"](spark, sf_dir))
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 20, text


def test_redemptions_are_found_once(spark, sf_dir):
    """The report reads the redemptions several times; the lines are joined for them but once each."""
    from tillsight.plans import empties

    t = with_stages(TestTables(spark, sf_dir), "lineitemderived", "classification")
    found = empties.redemptions(t["classification"], t["header"], t["lineitemderived"], t["return"], t["addon"])
    totalled = empties.slip_totals(found, t["lineitemderived"])
    assert found.count() == totalled.count() > 0
    for df in (found, totalled):
        assert "Join" not in plan(df) and "Exchange" not in plan(df)


def test_articles_are_cut_to_booked_codes(spark):
    """A long list of articles is cut to what was booked before lines are joined with it."""
    from tillsight.plans.masterdata import resolve_item_codes

    items = spark.createDataFrame(
        [(1, 5, 9, "ST"), (2, 6, 105, "ST"), (3, 6, 9, "ST"), (4, None, None, None)],
        "n int, POSItemID bigint, ItemID bigint, UnitOfMeasureCode string",
    )
    articles = spark.createDataFrame(
        [(100 + i, i, "KG" if i == 6 else "ST") for i in range(50)], "SAP_ID bigint, EAN bigint, Unit string"
    )
    out = resolve_item_codes(items, articles)
    assert sorted((r.n, r.EAN_Lookup) for r in out.collect()) == [(1, "5"), (2, "5"), (3, " "), (4, None)]
    assert "LeftSemi" in plan(out)


def test_wide_rows_have_several_tasks_a_core(spark, sf_dir, tmp_path):
    from tillsight.sources.testdata import TestTables
    from tillsight.sources.widedata import wide_table

    wide_table(TestTables(spark, sf_dir), "lineitem").write.parquet(f"{tmp_path}/wide")
    assert len(list((tmp_path / "wide").glob("part-*.parquet"))) >= 4 * spark.sparkContext.defaultParallelism


def test_wide_texts_follow_the_rule_of_the_leaf(spark):
    from tillsight.sources.widedata import _looked_up, _places, for_spark, leaf

    receipts = spark.range(0, 1200).selectExpr("id as k", "sequence(1L, id % 18) as ns").where("k % 18 > 0")
    df = receipts.selectExpr("*", *[f"{for_spark(e)} as {c}" for c, e in _places("ns").items()])
    entries = "case when (k + n) % 3 = 0 then cast(array() as array<bigint>) else sequence(1L, (k + n) % 3) end"
    for kind in ("long", "double", "boolean", "string"):
        once, twice = (for_spark(leaf("Amount", kind, "tender", "Sale", level)) for level in (1, 2))
        found = _looked_up("Amount", kind, "Sale")
        bad = df.where(
            f"not (transform(ns_{kind}, i -> {found}) <=> transform(ns, n -> cast({once} as string)) and "
            f"transform(ns_m_{kind}, e -> transform(e, i -> {found})) <=> "
            f"transform(ns, n -> transform({entries}, m -> cast({twice} as string))))"
        )
        assert bad.count() == 0, kind


def test_lines_are_not_sorted_before_they_move(spark, sf_dir, no_broadcast):
    from tillsight.plans.ingest import BUILDERS
    from tillsight.sources.testdata import TestTables
    from tillsight.sources.widedata import stored_wide_table

    lines = plan(BUILDERS["tender"](stored_wide_table(TestTables(spark, sf_dir), "tender"))).splitlines()
    moves = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    assert len(moves) == 1, lines
    assert not any(w in x for x in lines[moves[0] :] for w in ("Sort ", "WindowGroupLimit"))
