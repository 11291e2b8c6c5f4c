"""Type inference, rules kept as a table, and sales of unknown products."""

import datetime as dt
from decimal import Decimal as D

import pytest

from helpers import formatted_plan, rows
from sample import write_raw
from weirline.operators import rules
from weirline.operators.collation import collated
from weirline.operators.inference import against, inferred_kinds
from weirline.plans import drift
from weirline.plans.pipeline import read_extracts, run
from weirline.settings import DEFAULT_RULE, Settings
from weirline.sources.warehouse import Warehouse

DAY = dt.date(2024, 1, 1)


def _kinds(df, formats=None):
    return {r.column_name: (r.kind, r.n_missing) for r in inferred_kinds(df, formats).collect()}


@pytest.mark.parametrize("values,kind", [
    (["1", " -2 ", "+3", "007"], "integer"),
    (["1", "NA", "3"], "float"),  # a gap has no whole number
    (["1", "2.5", ".5", "1e9", "5."], "float"),
    (["1" * 18], "integer"),
    (["1" * 19], "float"),
    (["2024-02-29", "null"], "date"),
    (["2024-02-30"], "text"),
    (["2024-01-01", "17"], "text"),
    (["1", "x"], "text"),
    (["", "NaN", None, "None"], "empty"),
    ([" NA "], "text"),  # stands for a missing value without its spaces only
    (["1d", "1"], "text"),
    (["1_000"], "text"),
    ([], "empty"),
])
def test_kinds_of_texts(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert _kinds(df)["v"][0] == kind


def test_formats_and_typed_columns(spark):
    df = spark.createDataFrame(
        [("2024/01/31", "2024-01-31", 1, float("nan"), D("1"), DAY, True),
         ("2024-01-30", "2024/01/31", 2, 2.0, None, DAY, None)],
        "mixed string, strict string, `a.b` bigint, real double, exact decimal(9,2), day date, flag boolean",
    )
    assert _kinds(df, {"mixed": ("yyyy-MM-dd", "yyyy/MM/dd")}) == {
        "mixed": ("date", 0), "strict": ("text", 0), "a.b": ("integer", 0), "real": ("float", 1),
        "exact": ("float", 1), "day": ("date", 0), "flag": ("text", 1),
    }


def test_drift_follows_the_lattice(spark):
    kinds = spark.createDataFrame(
        [(f"{have}-{want}", have, 1, 0) for have in ("empty", "integer", "float", "date", "text")
         for want in ("integer", "float", "date", "text")],
        "column_name string, kind string, n_rows bigint, n_missing bigint",
    )
    declared = {r.column_name: r.column_name.split("-")[1] for r in kinds.collect()}
    fine = {r.column_name for r in against(kinds, declared).where("not drifted").collect()}
    assert fine == {
        "empty-integer", "empty-float", "empty-date", "empty-text", "integer-integer",
        "integer-float", "integer-text", "float-float", "float-text", "date-date", "date-text",
        "text-text",
    }


def test_one_aggregate_an_extract(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    plan = formatted_plan(inferred_kinds(df))
    assert plan.count("Exchange") == 1 and "partial_count" in plan and "Python" not in plan


def test_a_drifted_extract_stops_the_run(spark, tmp_path):
    raw_dir = write_raw(tmp_path)
    found = {(r.table_name, r.column_name): r.kind for r in drift.inferred_types(
        read_extracts(spark, raw_dir)).collect()}
    assert found["orders", "order_value"] == "float" and found["targets", "month"] == "date"
    assert found["customers", "signup_date"] == "date"
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert run(spark, raw_dir, wh, check_types=True).tables
    before = wh.complete_versions()
    path = tmp_path / "products_raw.csv"
    path.write_text(path.read_text() + "P7,Home,cheap,0.1\n")
    with pytest.raises(drift.DriftedExtract, match="products.base_price is text, declared integer"):
        run(spark, raw_dir, wh, check_types=True)
    assert wh.complete_versions() == before


def test_orphans_of_a_run(spark, tmp_path):
    built = run(spark, write_raw(tmp_path), Warehouse(spark, str(tmp_path / "wh")))
    (row,) = built.checks["orphan_order_lines"].collect()
    day = dt.date(2024, 2, 11)
    assert tuple(row) == ("P9", 1, D("70"), day, day)
    lines = built.tables["stg_orders"].count()
    assert lines == built.tables["fact_revenue_enriched"].count() + row.lines


def test_orphans_by_collation_and_without_a_product(spark):
    orders = spark.createDataFrame(
        [("p1", D("1"), DAY), ("P2", D("2"), DAY), ("p2", D("3"), DAY), (None, D("4"), DAY)],
        "product_id string, order_value decimal(18,4), order_date date",
    )
    products = spark.createDataFrame([("P1",), (None,)], "product_id string")
    orders, products = (collated(x, ["product_id"], "UNICODE_CI_AI") for x in (orders, products))
    got = drift.orphan_order_lines(orders, products).select("product_id", "lines", "revenue")
    assert {tuple(r) for r in got.collect()} == {("P2", 2, D("5")), (None, 1, D("4"))}
    assert rows(drift.orphan_order_lines(orders.limit(0), products)) == []


def test_rules_as_a_table_equal_the_case_form(spark):
    named = [(r,) for r in ("South", "East", "West", "North", "south", "Süd", "WEST", None, "")]
    for collation in ("UNICODE_CI_AI", None):
        df = collated(spark.createDataFrame(named, "region string"), ["region"], collation)
        by_table = rules.classify_by_table(df, rules.rule_rows(spark, Settings()))
        assert by_table.columns == ["region", "leakage_type", "risk_level"]
        assert rows(by_table) == rows(rules.classify(df, Settings()))


def test_rule_priorities_and_defaults(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("z",)], "region string")
    table = spark.createDataFrame(
        [(2, "a", "late", "x"), (1, "a", "early", "y"), (1, "b", "tie-2", "x"), (1, "b", "tie-1", "x"),
         (9, None, "other", "o")], rules.RULE_TABLE,
    )
    got = [r.leakage_type for r in rules.classify_by_table(df, table).orderBy("region").collect()]
    assert got == ["early", "tie-1", "tie-1", "other"]  # no row is repeated
    without = rules.classify_by_table(df, table.where("region is not null"))
    assert [r.leakage_type for r in without.where("region = 'z'").collect()] == [None]
    only_default = rules.rule_rows(spark, Settings(region_rules={}))
    assert {(r.leakage_type, r.risk_level) for r in rules.classify_by_table(df, only_default).collect()} == {DEFAULT_RULE}
