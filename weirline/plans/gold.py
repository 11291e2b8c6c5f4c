"""Star schema: dimensions and facts, each a function of silver or gold frames.

Facts about one order line are never joined before they are small. Orders are
aggregated to the fact's grain first (map-side combined, so a hot region,
product or customer shrinks before it is shuffled) and only the aggregate meets
the product table; which side is broadcast is left to measured sizes, and a hot
product in a sort-merge join is split by AQE because nothing downstream depends
on that join's partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirline.functions.dates import date_parts, month_start
from weirline.functions.numbers import round_ratio
from weirline.operators.collation import collated, group_agg
from weirline.operators.rows import distinct_rows
from weirline.operators.rules import classify, sum_where, uplift_where
from weirline.settings import Settings


def keyed(df: DataFrame, settings: Settings) -> DataFrame:
    """A silver table as the star schema sees it. Cleaning tells spellings apart; facts,
    joins and rules compare by the collation of the settings."""
    return collated(df, ("region", "product_id"), settings.collation)


def dim_date(orders: DataFrame) -> DataFrame:
    """Days that have an order (not a calendar)."""
    days = distinct_rows(orders.select(F.col("order_date").alias("date")))
    return days.select("date", *date_parts(F.col("date")))


def dim_region(orders: DataFrame) -> DataFrame:
    return group_agg(orders, ["region"])


# -- revenue ----------------------------------------------------------------


def sales_by(orders: DataFrame, products: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Order lines summed per ``keys`` and product, with the product's attributes.

    The margin is one value per product, so it can be applied to sums: the
    result equals summing over joined order lines. Orders of unknown products
    drop out here. Products are spelled as in the product table.
    """
    sums = group_agg(
        orders,
        [*keys, F.col("product_id").alias("_sold")],
        F.count("order_id").alias("orders"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("order_value").alias("revenue"),
        F.sum("discount_pct").alias("discount_sum"),
        F.avg("discount_pct").alias("avg_discount"),
    )
    known = products.select("product_id", "category", "margin_pct")
    return sums.join(known, F.col("_sold") == F.col("product_id")).drop("_sold")


def revenue_grain(orders: DataFrame, products: DataFrame) -> DataFrame:
    return sales_by(
        orders, products, [F.col("order_date").alias("date"), "region", "customer_id"]
    )


def fact_revenue(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Day x region x customer x product."""
    return revenue_facts(revenue_grain(orders, products))


def revenue_facts(grain: DataFrame) -> DataFrame:
    """The columns of the revenue fact, from ``revenue_grain`` rows."""
    return grain.select(
        "date",
        "region",
        "customer_id",
        "product_id",
        "orders",
        "revenue",
        (F.col("revenue") * F.col("margin_pct")).alias("gross_margin"),
        "avg_discount",
    )


def fact_revenue_enriched(orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order, with rounded margin and discount amounts."""
    value = F.col("order_value")
    known = products.select("product_id", "category", "margin_pct")
    sold = orders.withColumnRenamed("product_id", "_sold")
    return sold.join(known, F.col("_sold") == F.col("product_id")).select(
        "order_date",
        "region",
        "product_id",
        "customer_id",
        "order_value",
        "discount_pct",
        "margin_pct",
        "category",
        F.round(value * F.col("margin_pct"), 2).alias("gross_margin"),
        F.round(value * F.col("discount_pct"), 2).alias("discount_amount"),
    )


def region_month(grain: DataFrame) -> DataFrame:
    """Additive month x region sums of the revenue grain.

    Every sales report rolls up from these few rows, so one pass over the
    orders serves them all. ``avg_discount_sum`` over ``grains`` is the
    average of the per-grain averages, which is not weighted by orders.
    """
    margin = F.col("margin_pct")
    return group_agg(
        grain,
        [month_start(F.col("date")).alias("month"), "region"],
        F.sum("revenue").alias("revenue"),
        F.count("avg_discount").alias("grains"),
        F.sum("avg_discount").alias("avg_discount_sum"),
        F.sum("lines").alias("lines"),
        F.sum("discount_sum").alias("discount_sum"),
        F.sum(margin * F.col("lines")).alias("margin_sum"),
        F.sum(F.when(margin.isNotNull(), F.col("lines"))).alias("margin_lines"),
    )


def product_month(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Month x region x product sums, for reports that need no customer grain."""
    return sales_by(
        orders, products, [month_start(F.col("order_date")).alias("month"), "region"]
    )


# -- funnel and targets -----------------------------------------------------


def fact_funnel(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Day x region; a stage without events counts 0, without visits no rate."""
    stage, n, label = F.col("event_type"), F.col("count"), settings.event_labels
    days = group_agg(
        events,
        [F.col("event_date").alias("date"), "region"],
        sum_where(stage == label["visit"], n).alias("visits"),
        sum_where(stage == label["add_to_cart"], n).alias("add_to_cart"),
        sum_where(stage == label["purchase"], n).alias("purchases"),
    )
    return days.withColumn("conversion_rate", round_ratio(F.col("purchases"), F.col("visits"), 4))


def target_uplift(targets: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return uplift_where(
        targets,
        "target_revenue",
        F.col("region") == settings.uplift_region,
        settings.uplift_factor,
    )


def fact_targets(targets: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Month x region, uplifted per row and scaled per group."""
    scaled = F.sum("target_revenue") * F.lit(settings.target_scale)
    return group_agg(
        target_uplift(targets, settings),
        ["month", "region"],
        F.round(scaled, 2).alias("target_revenue"),
    )


# -- actual against target --------------------------------------------------


def _with_achievement(rows: DataFrame) -> DataFrame:
    actual, target = F.col("actual_revenue"), F.col("target_revenue")
    return rows.withColumns(
        {"variance": actual - target, "achievement_pct": round_ratio(actual, target, 2)}
    )


def against_target(monthly_sales: DataFrame, targets: DataFrame) -> DataFrame:
    """Add target, variance and achievement to month x region rows with ``revenue``.

    A month without a target is kept, with NULL target, variance and ratio.
    """
    return _with_achievement(
        monthly_sales.withColumnRenamed("revenue", "actual_revenue").join(
            targets.select("month", "region", "target_revenue"), ["month", "region"], "left"
        )
    )


MONTHLY_COLUMNS = (
    "month",
    "region",
    "actual_revenue",
    "target_revenue",
    "variance",
    "achievement_pct",
)


def fact_revenue_monthly(sales: DataFrame, targets: DataFrame) -> DataFrame:
    """``sales``: any rows with month, region and revenue (a table or a rollup)."""
    totals = group_agg(sales, ["month", "region"], F.sum("revenue").alias("revenue"))
    return against_target(totals, targets).select(*MONTHLY_COLUMNS)


SALES_SUMS = (
    "revenue",
    "grains",
    "avg_discount_sum",
    "lines",
    "discount_sum",
    "margin_sum",
    "margin_lines",
)


def sales_with_targets(sales: DataFrame, targets: DataFrame) -> DataFrame:
    """``against_target`` rows that also carry their region's revenue and target.

    Sales and targets are stacked and regrouped instead of joined twice (by
    month and by region), so each side is computed once. The windows run over a
    region's months. As in a join, a NULL key matches nothing.
    """
    sums = [c for c in SALES_SUMS if c in sales.columns]
    stacked = sales.select("month", "region", *sums, F.lit(1).alias("_sold")).unionByName(
        targets.select("month", "region", "target_revenue"), allowMissingColumns=True
    )
    region = Window.partitionBy("region")
    has_region = F.col("region").isNotNull()
    has_both = has_region & F.col("month").isNotNull()
    cells = group_agg(
        stacked,
        ["month", "region"],
        *[F.sum(c).alias(c) for c in sums],
        F.max("target_revenue").alias("target_revenue"),
        F.max("_sold").alias("_sold"),
    )
    rows = (
        cells.withColumns(
            {
                "region_revenue": F.sum("revenue").over(region),
                "region_target": F.when(has_region, F.sum("target_revenue").over(region)),
            }
        )
        .where("_sold = 1")
        .drop("_sold")
        .withColumnRenamed("revenue", "actual_revenue")
        .withColumn("target_revenue", F.when(has_both, F.col("target_revenue")))
    )
    return _with_achievement(rows)


def leakage_amount(actual: Column, target: Column) -> Column:
    """Target minus actual: negative where the region beat its target."""
    return F.round(target - actual, 2)


def region_targets(targets: DataFrame) -> DataFrame:
    return group_agg(targets, ["region"], F.sum("target_revenue").alias("target_total"))


def fact_leakage(
    sales: DataFrame, targets: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Region shortfall, from the ``region_month`` rollup."""
    regions = group_agg(
        sales,
        ["region"],
        F.sum("revenue").alias("revenue"),
        F.sum("avg_discount_sum").alias("avg_discount_sum"),
        F.sum("grains").alias("grains"),
    )
    gap = leakage_amount(F.col("revenue"), F.col("target_total"))
    joined = regions.join(region_targets(targets), "region", "left")
    return classify(joined, settings).select(
        "region",
        F.round("revenue", 2).alias("actual_revenue"),
        F.round("target_total", 2).alias("target_revenue"),
        gap.alias("revenue_gap"),
        gap.alias("leakage_amount"),
        "leakage_type",
        "risk_level",
        round_ratio(F.col("avg_discount_sum"), F.col("grains"), 2).alias("avg_discount"),
        F.lit(settings.assumed_conversion_rate).alias("avg_conversion_rate"),
    )


def recovery_columns(settings: Settings) -> list[Column]:
    return [
        F.round(F.col("leakage_amount") * F.lit(share), 2).alias(f"{name}_recovery")
        for name, share in settings.scenarios.items()
    ]


def fact_recovery(leakage: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return leakage.select(
        "region",
        "leakage_amount",
        *recovery_columns(settings),
        "leakage_type",
        "risk_level",
    )
