"""Report views and validation queries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirline.functions.dates import month_start
from weirline.functions.numbers import percent, round_ratio
from weirline.operators.collation import group_agg
from weirline.operators.rules import classify
from weirline.plans import gold
from weirline.settings import Settings

# -- views ------------------------------------------------------------------


def executive_summary(monthly: DataFrame, leakage: DataFrame) -> DataFrame:
    """Month rows with their region's shortfall repeated on each.

    Sum ``leakage_amount`` over the radar view, never over this one.
    """
    per_region = leakage.select("region", "leakage_amount", "leakage_type", "risk_level")
    return monthly.join(per_region, "region", "left").select(
        *gold.MONTHLY_COLUMNS, "leakage_amount", "leakage_type", "risk_level"
    )


def executive_summary_from_sales(
    sales: DataFrame, targets: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """The same view straight from the month x region rollup, in one pass over orders."""
    rows = classify(gold.sales_with_targets(sales, targets), settings)
    known = F.col("region").isNotNull()
    leakage = gold.leakage_amount(F.col("region_revenue"), F.col("region_target"))
    return rows.select(
        *gold.MONTHLY_COLUMNS,
        leakage.alias("leakage_amount"),
        F.when(known, F.col("leakage_type")).alias("leakage_type"),
        F.when(known, F.col("risk_level")).alias("risk_level"),
    )


def leakage_radar(leakage: DataFrame) -> DataFrame:
    return leakage.select(
        "region",
        "actual_revenue",
        "target_revenue",
        "revenue_gap",
        "leakage_amount",
        "leakage_type",
        "risk_level",
        "avg_conversion_rate",
        "avg_discount",
    )


def funnel_analysis(funnel: DataFrame) -> DataFrame:
    return funnel.select(
        "date",
        "region",
        "visits",
        "add_to_cart",
        "purchases",
        "conversion_rate",
        round_ratio(F.col("add_to_cart"), F.col("visits"), 4).alias("cart_rate"),
        round_ratio(F.col("purchases"), F.col("add_to_cart"), 4).alias("checkout_rate"),
    )


def recovery_scenarios(recovery: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return recovery.select(
        "region",
        "leakage_amount",
        *[f"{name}_recovery" for name in settings.scenarios],
        "leakage_type",
        "risk_level",
    )


def _ratio_text(a: str, b: str, places: int) -> str:
    """``round_ratio`` of two whole numbers as SQL text."""
    whole = f"CAST(abs({a}) div abs({b}) AS DECIMAL(19,0))"
    part = f"CAST(abs({a}) % abs({b}) AS DECIMAL(20,0)) * {2 * 10**places} + abs({b})"
    digits = f"CAST(({part}) div (CAST(abs({b}) AS DECIMAL(20,0)) * 2) AS DECIMAL({places + 2},0))"
    step = f"{Decimal(1).scaleb(-places):f}"
    return (
        f"CASE WHEN {b} = 0 THEN NULL WHEN ({a} < 0) != ({b} < 0) "
        f"THEN -({whole} + {digits} * {step}) ELSE {whole} + {digits} * {step} END"
    )


def view_queries(settings: Settings = Settings()) -> dict[str, str]:
    """The report views as SQL over the facts, whose names are in braces."""
    monthly = ", ".join(f"m.{c}" for c in gold.MONTHLY_COLUMNS)
    scenarios = ", ".join(f"{name}_recovery" for name in settings.scenarios)
    return {
        "vw_executive_summary": f"SELECT {monthly}, l.leakage_amount, l.leakage_type, l.risk_level "
        "FROM {fact_revenue_monthly} m LEFT JOIN {fact_leakage} l ON m.region = l.region",
        "vw_leakage_radar": "SELECT region, actual_revenue, target_revenue, revenue_gap, "
        "leakage_amount, leakage_type, risk_level, avg_conversion_rate, avg_discount "
        "FROM {fact_leakage}",
        "vw_funnel_analysis": "SELECT date, region, visits, add_to_cart, purchases, conversion_rate, "
        f"{_ratio_text('add_to_cart', 'visits', 4)} AS cart_rate, "
        f"{_ratio_text('purchases', 'add_to_cart', 4)} AS checkout_rate FROM {{fact_funnel}}",
        "vw_recovery_scenarios": f"SELECT region, leakage_amount, {scenarios}, leakage_type, "
        "risk_level FROM {fact_recovery}",
    }


# -- validation -------------------------------------------------------------


def validate_leakage_sign(leakage: DataFrame) -> DataFrame:
    """CORRECT where the shortfall is positive; a missing one is WRONG too."""
    positive = F.col("leakage_amount") > 0
    return leakage.select(
        "region",
        "actual_revenue",
        "target_revenue",
        "leakage_amount",
        "leakage_type",
        "risk_level",
        F.when(positive, "CORRECT").otherwise("WRONG").alias("status"),
    ).orderBy(F.desc("actual_revenue"))


def validate_funnel(funnel: DataFrame) -> DataFrame:
    visits, purchases = F.sum("visits"), F.sum("purchases")
    return (
        group_agg(
            funnel,
            ["region"],
            visits.alias("total_visits"),
            F.sum("add_to_cart").alias("total_cart"),
            purchases.alias("total_purchases"),
            percent(purchases, visits).alias("conversion_pct"),
        )
        .orderBy("region")
    )


def margin_and_discount(sales: DataFrame, by: str) -> DataFrame:
    """Mean margin and discount per order line, from ``sales_by`` sums."""
    margin, lines = F.col("margin_pct"), F.col("lines")
    return (
        group_agg(
            sales,
            [by],
            percent(
                F.sum(margin * lines), F.sum(F.when(margin.isNotNull(), lines))
            ).alias("avg_margin_pct"),
            percent(F.sum("discount_sum"), F.sum("lines")).alias("avg_discount_pct"),
        )
        .orderBy(by)
    )


def margin_from_rollup(sales: DataFrame, by: str) -> DataFrame:
    """``margin_and_discount`` from rows with additive line sums (``region_month``)."""
    return group_agg(
        sales,
        [by],
        percent(F.sum("margin_sum"), F.sum("margin_lines")).alias("avg_margin_pct"),
        percent(F.sum("discount_sum"), F.sum("lines")).alias("avg_discount_pct"),
    ).orderBy(by)


def warehouse_row_counts(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    events: DataFrame,
    targets: DataFrame,
) -> DataFrame:
    """Rows of the eleven warehouse tables without building them.

    The orders are aggregated once to day x region rows; all order-based tables
    are counted from those. Written tables are counted by ``audit.row_counts``.
    """
    known = products.select("product_id", F.lit(True).alias("_known"))
    grain = (
        orders.groupBy("order_date", "region", "customer_id", "product_id")
        .agg(F.count(F.lit(1)).alias("_lines"))
        .join(known, "product_id", "left")
    )
    days = grain.groupBy("order_date", "region").agg(
        F.count("_known").alias("_groups"),
        F.sum(F.when(F.col("_known"), F.col("_lines"))).alias("_lines"),
    )
    sold = F.col("_groups") > 0
    month_region = F.struct(month_start(F.col("order_date")), F.col("region"))
    region = F.struct("region")
    sold_regions = F.count_distinct(F.when(sold, region))
    zero = F.lit(0).cast("bigint")
    from_orders = days.agg(
        F.count_distinct(F.struct("order_date")).alias("dim_date"),
        F.count_distinct(region).alias("dim_region"),
        F.coalesce(F.sum("_groups"), zero).alias("fact_revenue"),
        F.count_distinct(F.when(sold, month_region)).alias("fact_revenue_monthly"),
        F.coalesce(F.sum("_lines"), zero).alias("fact_revenue_enriched"),
        sold_regions.alias("fact_leakage"),
        sold_regions.alias("fact_recovery"),
    ).unpivot([], [
        "dim_date",
        "dim_region",
        "fact_revenue",
        "fact_revenue_monthly",
        "fact_revenue_enriched",
        "fact_leakage",
        "fact_recovery",
    ], "table_name", "row_count")

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("table_name"), F.col("n").alias("row_count"))

    n = F.count(F.lit(1)).alias("n")
    cells = F.count_distinct(F.struct("event_date", "region")).alias("n")
    target_cells = F.count_distinct(F.struct("month", "region")).alias("n")
    return (
        from_orders.unionByName(counted(customers.agg(n), "dim_customer"))
        .unionByName(counted(products.agg(n), "dim_product"))
        .unionByName(counted(events.agg(cells), "fact_funnel"))
        .unionByName(counted(targets.agg(target_cells), "fact_targets"))
    )
