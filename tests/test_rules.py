"""Cases, labels, rounding, order keys and the order of results."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from helpers import one, rows
from sample import write_raw
from weirline.functions import numbers
from weirline.operators import collation
from weirline.plans import gold, marts, measures, silver
from weirline.plans.pipeline import run
from weirline.settings import Settings
from weirline.sources.warehouse import Warehouse, conform, jdbc_options

DAY = dt.date(2024, 1, 1)


def test_order_lines_are_told_apart_by_the_pair(spark):
    lines = spark.createDataFrame(
        [("1", 10, 5.0, 0.1), ("2", 0, 6.0, 0.1), ("1", 10, 5.0, 0.1), ("1", 1, 7.0, None)],
        "order_id string, line_number int, order_value double, discount_pct double",
    )
    got = rows(silver.clean_order_lines(lines).select("order_id", "line_number"))
    assert got == [("1", 1), ("1", 10), ("2", 0)]


def _star(spark, settings):
    orders = spark.createDataFrame(
        [("O1", DAY, "C", "P1", "West", D("10"), D("0")), ("O2", DAY, "C", "p1", "west", D("20"), D("0")),
         ("O3", DAY, "C", "P1", "WEST", D("30"), D("0"))],
        "order_id string, order_date date, customer_id string, product_id string, region string, "
        "order_value decimal(18,4), discount_pct decimal(9,6)",
    )
    products = spark.createDataFrame([("P1", "c", D("0.5"))], "product_id string, category string, margin_pct decimal(9,6)")
    targets = spark.createDataFrame(
        [(DAY, "West", D("50")), (DAY, "wEST", D("40"))], "month date, region string, target_revenue decimal(18,4)"
    )
    orders, products, targets = (gold.keyed(x, settings) for x in (orders, products, targets))
    sales = gold.region_month(gold.revenue_grain(orders, products))
    return gold.fact_leakage(sales, gold.fact_targets(targets, settings), settings)


def test_spellings_are_one_from_gold_on(spark):
    got = one(_star(spark, Settings()))
    # The smallest of the spellings that occur, not a new one.
    assert (got["region"], got["actual_revenue"]) == ("WEST", D("60.00"))
    # (50 + 40) uplifted by 5 % and scaled by 1.4
    assert (got["target_revenue"], got["leakage_type"]) == (D("132.30"), "Operational Gap")
    apart = _star(spark, Settings(collation=None)).collect()
    assert sorted(r.region for r in apart) == ["WEST", "West"]  # no product is spelled p1


def test_accents_and_kept_spellings(spark, tmp_path):
    orders = spark.createDataFrame(
        [("O1", DAY, "C", "ABC-1", "Süd", D("10"), D("0")), ("O2", DAY, "C", "abc-1", "SUD", D("5"), D("0"))],
        "order_id string, order_date date, customer_id string, product_id string, region string, "
        "order_value decimal(18,4), discount_pct decimal(9,6)",
    )
    products = spark.createDataFrame([("ABC-1", "c", D("0.5"))], "product_id string, category string, margin_pct decimal(9,6)")
    warehouse = Warehouse(spark, str(tmp_path))
    dim = warehouse.write(products, "dim_product")
    orders, products = (gold.keyed(x, Settings()) for x in (orders, products))
    fact = warehouse.write(gold.fact_revenue(orders, products), "fact_revenue")
    row = one(fact)
    assert (row["region"], row["product_id"], row["orders"]) == ("SUD", "ABC-1", 2)
    # The written fact finds its dimension row, byte for byte and by its own comparison.
    assert collation.plain(fact).join(dim, "product_id").count() == 1
    assert fact.where("region = 'süd' and product_id = 'aBc-1'").count() == 1
    assert one(gold.dim_region(orders))["region"] == "SUD"
    assert rows(gold.fact_revenue_enriched(orders, products).select("product_id")) == [("ABC-1",), ("ABC-1",)]
    assert "COLLATE" not in str(conform(fact, fact.schema).schema.simpleString()).upper()


def test_funnel_uses_the_labels_of_the_settings(spark):
    labels = {"visit": "View", "add_to_cart": "Cart", "purchase": "Sale"}
    settings = Settings(event_labels=labels)
    events = spark.createDataFrame(
        [(DAY, "West", t, n) for t, n in (("View", 5), ("Cart", 2), ("Sale", 1), ("Visit", 9))],
        "event_date date, region string, event_type string, count bigint",
    )
    got = one(gold.fact_funnel(events, settings))
    assert (got["visits"], got["add_to_cart"], got["purchases"]) == (5, 2, 1)
    with pytest.raises(ValueError):
        Settings(event_labels={"visit": "View"})
    with pytest.raises(ValueError):
        Settings(scenarios={"hopeful": D("1")})


@pytest.mark.parametrize(
    "a,b,places,want",
    [
        (1234499999999999, 10**16, 4, "0.1234"), (12345, 10**5, 4, "0.1235"), (1, 0, 4, None),
        (-12345, 10**5, 4, "-0.1235"), (2, -3, 2, "-0.67"), (0, 7, 4, "0.0000"), (None, 7, 4, None),
        (10**17, 1, 2, "100000000000000000.00"),
    ],
)
def test_ratios_are_rounded_once(spark, a, b, places, want):
    df = spark.createDataFrame([(a, b)], "a bigint, b bigint")
    got = df.select(numbers.round_ratio(F.col("a"), F.col("b"), places)).first()[0]
    assert got == (None if want is None else D(want))
    if want and abs(int(a or 0)) < 10**15:
        percent = df.select(numbers.percent(F.col("a"), F.col("b"), 2)).first()[0]
        assert abs(percent - 100 * D(want)) <= D("0.01") * 10 ** (4 - places)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    raw = write_raw(tmp_path_factory.mktemp("raw"))
    return run(spark, raw, Warehouse(spark, str(tmp_path_factory.mktemp("wh"))))


def test_results_come_in_order(built):
    checks, results = built.checks, built.measures
    revenue = [r.actual_revenue for r in checks["leakage_sign"].collect()]
    assert revenue == sorted(revenue, reverse=True) and len(revenue) > 2
    for name in ("funnel", "margin"):
        regions = [r.region or "" for r in checks[name].collect()]
        assert regions == sorted(regions) and len(regions) > 2
    monthly = built.tables["fact_revenue_monthly"]
    actual = [r.actual_revenue for r in measures.region_actual_vs_target(monthly).collect()]
    assert actual == sorted(actual, reverse=True)
    quarters = [r.quarter for r in measures.achievement_by_quarter(monthly).collect()]
    assert quarters == sorted(quarters)
    assert results["kpi_measures"].count() == 1


def test_a_run_from_extracts_to_measures(built):
    """The small extracts end to end, against figures worked out by hand."""
    totals = one(built.measures["kpi_measures"])
    sold = [D("100.10"), D("200.20"), D("300.30"), D("50000"), D("80.005"), D("10")]
    assert totals["total_revenue"] == sum(sold)
    audit = {r.table_name: r for r in built.checks["etl_audit"].collect()}
    assert (audit["orders"].raw_rows, audit["orders"].final_rows) == (11, 7)
    assert (audit["products"].raw_rows, audit["products"].duplicates_removed) == (5, 1)
    funnel = {r.region: r for r in built.checks["funnel"].collect()}
    assert (funnel["North"].total_visits, funnel["North"].total_purchases) == (150, 6)
    assert funnel["North"].conversion_pct == D("4.00")
    assert set(built.measures) >= {"kpi_by_region", "kpi_by_region_month", "leakage_rate", "funnel_totals"}


def test_views_outlive_the_session(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS weirline_v")
    try:
        run(spark, write_raw(tmp_path), Warehouse(spark, database="weirline_v"))
        other = spark.newSession()
        assert other.table("weirline_v.vw_leakage_radar").count() > 2
        assert other.sql("SELECT * FROM weirline_v.vw_executive_summary").count() > 2
        # A new session's view shows the fact as it is now.
        w, leakage = Warehouse(spark, database="weirline_v"), other.table("weirline_v.fact_leakage")
        changed = leakage.withColumn("leakage_amount", F.lit(D("7.25"))).where("region = 'North'").toPandas()
        w.write(spark.createDataFrame(changed, leakage.schema), "fact_leakage")
        radar = spark.newSession().sql("SELECT * FROM weirline_v.vw_leakage_radar").collect()
        assert [r.leakage_amount for r in radar] == [D("7.25")]
        assert spark.newSession().sql(
            "SELECT * FROM weirline_v.vw_executive_summary WHERE leakage_amount = 7.25"
        ).count() >= 1
    finally:
        spark.sql("DROP DATABASE weirline_v CASCADE")


def test_database_options(spark):
    schema = spark.createDataFrame([("a", 1)], "k string, n int").schema
    assert jdbc_options(schema, {"batchsize": "9"}) == {
        "createTableColumnTypes": "`n` BIGINT", "batchsize": "9",
    }
    assert "VARCHAR(80)" in jdbc_options(schema, {}, 80)["createTableColumnTypes"]


def test_margin_and_funnel_checks_use_every_region(built):
    assert {r.region for r in marts.funnel_analysis(built.tables["fact_funnel"]).collect()} == {
        "North", "South", "West",
    }
