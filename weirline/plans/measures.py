"""KPI measures and dashboard page queries.

A measure is an aggregate expression; the grouping columns are its filter
context, so the same list serves totals, regions, months and their products.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirline.functions.numbers import mean, percent, round_ratio
from weirline.operators.collation import BINARY, collation_of, group_agg
from weirline.plans import gold
from weirline.settings import RECOVERY_SCENARIO, Settings


def gap_percent(variance: Column, target: Column) -> Column:
    """Variance as % of target; 0, not NULL, when there is no target."""
    return F.coalesce(percent(variance, target, 4), F.lit(0).cast("decimal(38,4)"))


def executive_measures() -> list[Column]:
    """Over executive-summary rows (month x region)."""
    return [
        F.sum("actual_revenue").alias("total_revenue"),
        F.sum("target_revenue").alias("total_target"),
        F.sum("variance").alias("revenue_variance"),
        mean("achievement_pct", 4).alias("avg_achievement_pct"),
        gap_percent(F.sum("variance"), F.sum("target_revenue")).alias("revenue_gap_pct"),
    ]


def rate_measures() -> list[Column]:
    """Over rows with additive line sums (``region_month``)."""
    return [
        percent(F.sum("margin_sum"), F.sum("margin_lines"), 4).alias("avg_margin_pct"),
        percent(F.sum("discount_sum"), F.sum("lines"), 4).alias("avg_discount_pct"),
    ]


def funnel_measures() -> list[Column]:
    """Over funnel rows (day x region): mean of the rates, not rate of the totals."""
    return [mean("conversion_rate", 4).alias("avg_conversion_rate")]


def recovery_measures() -> list[Column]:
    """Over region rows of the recovery view."""
    return [
        F.sum("leakage_amount").alias("total_leakage"),
        F.sum(f"{RECOVERY_SCENARIO}_recovery").alias("recovery_potential"),
    ]


def measure(df: DataFrame, measures: Sequence[Column], context: Sequence[Column | str] = ()):
    """Evaluate measures under a context; no context gives the grand total."""
    return group_agg(df, context, *measures)


KPI_COLUMNS = (
    "total_revenue",
    "total_target",
    "revenue_variance",
    "total_leakage",
    "avg_achievement_pct",
    "revenue_gap_pct",
    "recovery_potential",
    "avg_conversion_rate",
    "avg_margin_pct",
    "avg_discount_pct",
)


def _region_sums(
    sales: DataFrame, targets: DataFrame, settings: Settings
) -> DataFrame:
    """Region rows with every additive part of the sales measures, and the
    shortfall and recovery that are defined per region. Orders are read once."""
    additive = ("actual_revenue", "target_revenue", "variance")
    additive += ("margin_sum", "margin_lines", "discount_sum", "lines")
    regions = group_agg(
        gold.sales_with_targets(sales, targets),
        ["region", "region_revenue", "region_target"],
        *[F.sum(c).alias(c) for c in additive],
        F.sum("achievement_pct").alias("achievement_sum"),
        F.count("achievement_pct").alias("achievement_rows"),
    )
    gap = gold.leakage_amount(F.col("region_revenue"), F.col("region_target"))
    regions = regions.withColumn("leakage_amount", gap)
    return regions.select("*", *gold.recovery_columns(settings))


def _sales_measures() -> list[Column]:
    """The sales measures over ``_region_sums`` rows."""
    return [
        F.sum("actual_revenue").alias("total_revenue"),
        F.sum("target_revenue").alias("total_target"),
        F.sum("variance").alias("revenue_variance"),
        round_ratio(F.sum("achievement_sum"), F.sum("achievement_rows"), 4).alias(
            "avg_achievement_pct"
        ),
        gap_percent(F.sum("variance"), F.sum("target_revenue")).alias("revenue_gap_pct"),
        *rate_measures(),
        *recovery_measures(),
    ]


def kpi_measures(
    sales: DataFrame, targets: DataFrame, funnel: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """All ten measures over everything, one row."""
    totals = _region_sums(sales, targets, settings).agg(*_sales_measures())
    conversion = measure(funnel, funnel_measures()).scalar()
    return totals.withColumn("avg_conversion_rate", conversion).select(*KPI_COLUMNS)


def kpi_by_region(
    sales: DataFrame, targets: DataFrame, funnel: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """All ten measures per region, for every region with sales or web events."""
    sold = measure(_region_sums(sales, targets, settings), _sales_measures(), ["region"])
    visited = measure(funnel, funnel_measures(), ["region"])
    return sold.join(visited, "region", "full").select("region", *KPI_COLUMNS)


def kpi_by_region_month(sales: DataFrame, targets: DataFrame, funnel: DataFrame) -> DataFrame:
    """Measures per month and region, for every cell with sales or web events.

    Shortfall and recovery have no month, so they are not shown at this grain.
    """
    months = gold.against_target(sales, targets)
    sales_kpis = measure(months, [*executive_measures(), *rate_measures()], ["month", "region"])
    visits = funnel.withColumn("month", F.trunc("date", "MM"))
    web_kpis = measure(visits, funnel_measures(), ["month", "region"])
    return sales_kpis.join(web_kpis, ["month", "region"], "full")


CONTEXTS = ("total", "region", "month", "category", "quarter")


def _context_rows(
    sales: DataFrame, targets: DataFrame, funnel: DataFrame, settings: Settings
) -> DataFrame:
    """Rows whose plain sums are the measures of any context.

    Sums per month, region and category; what is defined per cell (target, variance,
    achievement) or per region (shortfall, recovery) stands in the first row of its cell
    or region only, and web rates are rows of their own."""
    margin = F.col("margin_pct")
    parts = group_agg(
        sales,
        ["month", "region", "category"],
        F.sum("revenue").alias("actual_revenue"),
        F.sum("lines").alias("lines"),
        F.sum("discount_sum").alias("discount_sum"),
        F.sum(margin * F.col("lines")).alias("margin_sum"),
        F.sum(F.when(margin.isNotNull(), F.col("lines"))).alias("margin_lines"),
    )
    cell, region = Window.partitionBy("month", "region"), Window.partitionBy("region")
    parts = parts.withColumns(
        {
            "_cell_revenue": F.sum("actual_revenue").over(cell),
            "_in_cell": F.row_number().over(cell.orderBy("category")),
            "_region_revenue": F.sum("actual_revenue").over(region),
            "_in_region": F.row_number().over(region.orderBy("month", "category")),
        }
    )
    known = targets.select("month", "region", F.col("target_revenue").alias("_target"))
    parts = parts.join(known, ["month", "region"], "left").join(
        gold.region_targets(targets), "region", "left"
    )
    first = F.col("_in_cell") == 1
    revenue, target = F.col("_cell_revenue"), F.when(first, F.col("_target"))
    gap = gold.leakage_amount(F.col("_region_revenue"), F.col("target_total"))
    parts = parts.withColumns(
        {
            "target_revenue": target,
            "variance": revenue - target,
            "achievement_pct": round_ratio(revenue, target, 2),
            "leakage_amount": F.when(F.col("_in_region") == 1, gap),
        }
    )
    parts = parts.select("*", *gold.recovery_columns(settings))
    visits = funnel.select(F.trunc("date", "MM").alias("month"), "region", "conversion_rate")
    return parts.unionByName(visits, allowMissingColumns=True).withColumn(
        "quarter", F.quarter("month").cast("string")
    )


def kpi_contexts(
    sales: DataFrame, targets: DataFrame, funnel: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """All measures in all of ``CONTEXTS``, in one aggregation over grouping sets.

    ``sales`` are sums with month, region, category and ``margin_pct`` (``product_month``);
    they are computed once, whatever the number of contexts. Shortfall and recovery have
    no month, targets and web rates no category: there these measures are NULL."""
    rows = _context_rows(sales, targets, funnel, settings)
    keys = list(CONTEXTS[1:])
    named = rows.select(*keys).schema
    spelled = [f.name for f in named if collation_of(f.dataType)]
    sets = [[], *[[F.col(k)] for k in keys]]
    grouped = rows.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("_set"),
        *executive_measures(),
        *rate_measures(),
        *recovery_measures(),
        *funnel_measures(),
        F.count("lines").alias("_parts"),
        *[F.min(F.collate(k, BINARY)).alias(f"_spelling_{k}") for k in spelled],
    )
    # The id has a bit per key, the first key's the highest, set where the key is not in use.
    every = (1 << len(keys)) - 1
    context = F.lit(CONTEXTS[0])
    for place, key in enumerate(keys):
        one = every ^ (1 << (len(keys) - 1 - place))
        context = F.when(F.col("_set") == one, key).otherwise(context)
    by_category, total = context == "category", F.col("_set") == every
    hidden = {c: ~by_category for c in ("total_target", "revenue_variance", "avg_achievement_pct")}
    hidden |= {c: ~by_category for c in ("revenue_gap_pct", "avg_conversion_rate")}
    hidden |= {c: total | (context == "region") for c in ("total_leakage", "recovery_potential")}
    shown = [
        F.when(hidden[c], F.col(c)).alias(c) if c in hidden else F.col(c) for c in KPI_COLUMNS
    ]
    chosen = [
        F.when(context == k, F.col(f"_spelling_{k}")).alias(k) if k in spelled else F.col(k)
        for k in keys
    ]
    return grouped.where(~by_category | (F.col("_parts") > 0)).select(
        context.alias("context"), *chosen, *shown
    )


# -- page queries -----------------------------------------------------------


def achievement_by_quarter(monthly: DataFrame) -> DataFrame:
    return measure(
        monthly,
        [mean("achievement_pct", 4).alias("avg_achievement_pct")],
        [F.quarter("month").alias("quarter")],
    ).orderBy("quarter")


def region_actual_vs_target(monthly: DataFrame) -> DataFrame:
    return measure(
        monthly,
        [
            F.sum("actual_revenue").alias("actual_revenue"),
            F.sum("target_revenue").alias("target_revenue"),
            F.sum("variance").alias("variance"),
        ],
        ["region"],
    ).orderBy(F.desc("actual_revenue"))


def leakage_share_by_type(leakage: DataFrame) -> DataFrame:
    """Share of each shortfall type; the window runs over one row per type."""
    by_type = measure(
        leakage, [F.sum("leakage_amount").alias("leakage_amount")], ["leakage_type"]
    )
    total = F.sum("leakage_amount").over(Window.partitionBy())
    return by_type.withColumn("share_pct", percent(F.col("leakage_amount"), total))


def leakage_rate(leakage: DataFrame) -> DataFrame:
    lost, earned = F.sum("leakage_amount"), F.sum("actual_revenue")
    return leakage.agg(
        lost.alias("total_leakage"),
        earned.alias("total_revenue"),
        percent(lost, earned, 4).alias("leakage_pct"),
    )


def funnel_totals(funnel: DataFrame) -> DataFrame:
    visits, cart, purchases = (
        F.sum("visits"),
        F.sum("add_to_cart"),
        F.sum("purchases"),
    )
    return funnel.agg(
        visits.alias("visits"),
        cart.alias("add_to_cart"),
        purchases.alias("purchases"),
        round_ratio(cart, visits, 4).alias("cart_rate"),
        round_ratio(purchases, cart, 4).alias("checkout_rate"),
        round_ratio(purchases, visits, 4).alias("conversion_rate"),
        round_ratio(visits - cart, visits, 4).alias("cart_drop_off"),
        round_ratio(cart - purchases, cart, 4).alias("checkout_drop_off"),
    )


def recovery_by_scenario(recovery: DataFrame, settings: Settings = Settings()) -> DataFrame:
    names = list(settings.scenarios)
    sums = recovery.agg(*[F.sum(f"{n}_recovery").alias(n) for n in names])
    return sums.unpivot([], names, "scenario", "recovery_amount")


def leakage_fixed_rate(leakage: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The other definition in use: a fixed share of revenue, whatever the target."""
    lost = F.round(F.col("actual_revenue") * F.lit(settings.fixed_leakage_rate), 2)
    return leakage.select(
        "region", "actual_revenue", lost.alias("leakage_amount"), "leakage_type", "risk_level"
    )
