"""Every query of the workload, by name: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirline.functions import dates, numbers, text
from weirline.operators import audit, median, rows, rules
from weirline.plans import drift, gold, marts, measures, silver
from weirline.settings import Settings
from weirline.sources import files
from weirline.sources.schemas import LINE, POSITION
from weirline.workload import bindings as b

Query = Callable[[SparkSession, str], DataFrame]


class Frames:
    """Lazy frames over one data folder; each property only declares a plan."""

    def __init__(
        self, spark: SparkSession, sf_dir: str, settings: Settings = b.SETTINGS,
        mixed_case: bool = False,
    ):
        self.tables, self.settings = b.Tables(spark, sf_dir, mixed_case), settings

    def with_settings(self, settings: Settings, mixed_case: bool = False) -> Frames:
        return Frames(self.tables.spark, self.tables.sf_dir, settings, mixed_case)

    def keyed(self, name: str) -> DataFrame:
        return gold.keyed(self.clean(name), self.settings)

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def raw(self, name: str) -> DataFrame:
        return b.RAW[name](self.tables)

    def clean(self, name: str) -> DataFrame:
        return silver.CLEANERS[name](self.raw(name), self.settings)

    @cached_property
    def orders(self) -> DataFrame:
        return gold.keyed(b.clean_orders(self.tables), self.settings)

    @cached_property
    def products(self) -> DataFrame:
        return self.keyed("products")

    @cached_property
    def targets(self) -> DataFrame:
        return gold.fact_targets(self.keyed("targets"), self.settings)

    @cached_property
    def funnel(self) -> DataFrame:
        return gold.fact_funnel(self.keyed("web_events"), self.settings)

    @cached_property
    def sales(self) -> DataFrame:
        return gold.region_month(gold.revenue_grain(self.orders, self.products))

    @cached_property
    def product_sales(self) -> DataFrame:
        return gold.product_month(self.orders, self.products)

    @cached_property
    def region_sales(self) -> DataFrame:
        return gold.sales_by(self.orders, self.products, ["region"])

    @cached_property
    def monthly(self) -> DataFrame:
        return gold.fact_revenue_monthly(self.product_sales, self.targets)

    @cached_property
    def leakage(self) -> DataFrame:
        return gold.fact_leakage(self.sales, self.targets, self.settings)

    @cached_property
    def recovery(self) -> DataFrame:
        return gold.fact_recovery(self.leakage, self.settings)


# -- row and column operators -----------------------------------------------


def _dedup_keep_first(f: Frames) -> DataFrame:
    return rows.keep_first(f.table("lineitem"), ["l_orderkey", "l_linenumber"])


def _dedup_composite_key(f: Frames) -> DataFrame:
    raw = f.raw("targets")
    month = dates.parse_mixed(F.col("month"), f.settings.target_date_formats)
    return rows.keep_first(raw.withColumn("month", month), ["month", "region"])


def _dedup_full_row(f: Frames) -> DataFrame:
    return rows.distinct_rows(f.raw("customers"))


def _drop_null_rows(f: Frames) -> DataFrame:
    return rows.drop_null_rows(f.raw("orders").drop(POSITION), ["order_value"])


def _outlier_filter(f: Frames) -> DataFrame:
    lines = f.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rows.keep_at_most(lines, "l_extendedprice", float(f.settings.order_value_cap))


def _fill_constant(f: Frames) -> DataFrame:
    return rows.fill_constant(
        f.raw("orders").select("order_id", LINE, "discount_pct"), {"discount_pct": 0}
    )


def _fill_median(f: Frames) -> DataFrame:
    products = f.raw("products").select("product_id", "margin_pct")
    return median.fill_median(rows.keep_first(products, ["product_id"]), "margin_pct")


def _na_tokens_to_null(f: Frames) -> DataFrame:
    return f.table("events").select(
        "event_id", text.na_to_null(b.count_text()).alias("count_text")
    )


def _text_upper(f: Frames) -> DataFrame:
    segment = text.strip_upper(F.col("segment")).alias("segment")
    return f.raw("customers").select("customer_id", segment)


def _text_title(f: Frames) -> DataFrame:
    category = text.strip_title(F.col("category")).alias("category")
    return f.raw("products").select("product_id", category)


def _event_type_canonical(f: Frames) -> DataFrame:
    events = f.table("events").select("event_id", b.event_label().alias("event_type"))
    return text.canonical_label(events, "event_type", f.settings.event_labels)


def _parse_strict_date(f: Frames) -> DataFrame:
    written = F.date_format("o_orderdate", "yyyy-MM-dd")
    return f.table("orders").select(
        "o_orderkey", dates.parse_strict(written).alias("order_date")
    )


def _parse_mixed_dates(f: Frames) -> DataFrame:
    slashed = F.date_format("o_orderdate", "yyyy/MM/dd")
    dashed = F.date_format("o_orderdate", "yyyy-MM-dd")
    written = F.when(F.col("o_orderkey") % 5 == 0, slashed).otherwise(dashed)
    parsed = dates.parse_mixed(written, f.settings.target_date_formats)
    return f.table("orders").select("o_orderkey", parsed.alias("order_date"))


def _cohort_month(f: Frames) -> DataFrame:
    day = F.to_date("o_orderdate")
    return f.table("orders").select("o_orderkey", dates.cohort_month(day).alias("cohort_month"))


def _nan_to_missing(f: Frames) -> DataFrame:
    """Every tenth value is a real NaN before it is cleaned and totalled."""
    value = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    dirty = f.table("events").select("event_id", value.alias("value"))
    return dirty.select("event_id", numbers.nan_to_null(dirty, "value").alias("value"))


def _median_order_value(f: Frames) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
    return median.exact_median(f.table("lineitem").select(price), "price")


def _median_double(f: Frames) -> DataFrame:
    """Net prices as they come, in doubles; those of every tenth order are NaN."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    price = F.when(F.col("l_orderkey") % 10 == 0, F.lit(float("nan"))).otherwise(net)
    return median.exact_median(f.table("lineitem").select(price.alias("price")), "price")


def _csv_text_round_trip(f: Frames) -> DataFrame:
    """Texts with quotes, edge spaces, line breaks and more, to CSV records and back."""
    schema = "c_custkey bigint, text string"
    customers = f.table("customer").select("c_custkey", b.awkward_text().alias("text"))
    line = files.csv_line(["c_custkey", "text"])
    back = customers.select(files.parse_csv_line(line, schema).alias("row")).select("row.*")
    return back.withColumn("text", files.real_text(F.col("text")))


def _count_to_int(f: Frames) -> DataFrame:
    written = f.table("events").select("event_id", F.col("value").cast("string").alias("count"))
    return written.withColumn("count", numbers.to_count(written, "count"))


def _leakage_classify(f: Frames) -> DataFrame:
    buyers = f.tables.customer_region
    counted = buyers.groupBy("region").agg(F.count(F.lit(1)).alias("customers"))
    return rules.classify(counted, f.settings)


def _leakage_classify_rules(f: Frames) -> DataFrame:
    buyers = f.tables.customer_region
    counted = buyers.groupBy("region").agg(F.count(F.lit(1)).alias("customers"))
    return rules.classify_by_table(counted, rules.rule_rows(f.tables.spark, f.settings))


def _inferred_types(f: Frames) -> DataFrame:
    """The five extracts, and events whose counts are texts that no cleaning expects."""
    events = f.table("events").select("event_id", b.count_text().alias("count"))
    declared = drift.declared_kinds(f.settings)
    declared["drifted_events"] = {"event_id": "integer", "count": "float"}
    raw = {**b.raw_tables(f.tables), "drifted_events": events}
    return drift.inferred_types(raw, f.settings, declared)


def _orphan_order_lines(f: Frames) -> DataFrame:
    """Sales of products that are on every eleventh number, missing in the product table."""
    return drift.orphan_order_lines(f.orders, f.products.where("product_id % 11 <> 0"))


def _collation_group(f: Frames) -> DataFrame:
    segment = text.strip(F.col("segment")).alias("segment")
    return rules.count_ignoring_case(f.raw("customers").select(segment), "segment")


# -- jobs, reports and measures ---------------------------------------------


def _validate_row_counts(f: Frames) -> DataFrame:
    return marts.warehouse_row_counts(
        f.clean("customers"),
        f.products,
        f.orders,
        f.clean("web_events"),
        f.clean("targets"),
    )


def _quality_report(f: Frames) -> DataFrame:
    return audit.quality_report(
        {
            "customers": f.clean("customers"),
            "products": f.products,
            "orders": f.orders,
            "web_events": f.clean("web_events"),
            "targets": f.clean("targets"),
        }
    )


PLANS: dict[str, Callable[[Frames], DataFrame]] = {
    "dedup_keep_first": _dedup_keep_first,
    "dedup_composite_key": _dedup_composite_key,
    "dedup_full_row": _dedup_full_row,
    "drop_null_rows": _drop_null_rows,
    "outlier_filter": _outlier_filter,
    "fill_constant": _fill_constant,
    "fill_median": _fill_median,
    "na_tokens_to_null": _na_tokens_to_null,
    "text_upper": _text_upper,
    "text_title": _text_title,
    "event_type_canonical": _event_type_canonical,
    "parse_strict_date": _parse_strict_date,
    "parse_mixed_dates": _parse_mixed_dates,
    "cohort_month": _cohort_month,
    "count_to_int": _count_to_int,
    "nan_to_missing": _nan_to_missing,
    "median_order_value": _median_order_value,
    "median_double": _median_double,
    "csv_text_round_trip": _csv_text_round_trip,
    "leakage_classify": _leakage_classify,
    "leakage_classify_rules": _leakage_classify_rules,
    "collation_group": _collation_group,
    "inferred_types": _inferred_types,
    "orphan_order_lines": _orphan_order_lines,
    "target_uplift": lambda f: gold.target_uplift(f.clean("targets"), f.settings),
    "etl_audit": lambda f: silver.etl_audit(b.raw_tables(f.tables), f.settings),
    "quality_report": _quality_report,
    "clean_customers": lambda f: f.clean("customers"),
    "clean_products": lambda f: f.clean("products"),
    "clean_orders": lambda f: f.orders,
    "clean_web_events": lambda f: f.clean("web_events"),
    "clean_targets": lambda f: f.clean("targets"),
    "dim_date": lambda f: gold.dim_date(f.orders),
    "dim_region": lambda f: gold.dim_region(f.orders),
    "fact_revenue": lambda f: gold.fact_revenue(f.orders, f.products),
    "fact_revenue_enriched": lambda f: gold.fact_revenue_enriched(f.orders, f.products),
    "fact_funnel": lambda f: f.funnel,
    "fact_funnel_relabelled": lambda f: f.with_settings(b.RELABELLED).funnel,
    "fact_funnel_mixed_case": lambda f: f.with_settings(b.MIXED_CASE, mixed_case=True).funnel,
    "fact_leakage_mixed_case": lambda f: f.with_settings(b.MIXED_CASE, mixed_case=True).leakage,
    "fact_revenue_mixed_case": lambda f: gold.fact_revenue(
        f.with_settings(b.MIXED_CASE, mixed_case=True).orders,
        f.with_settings(b.MIXED_CASE, mixed_case=True).products,
    ),
    "fact_targets": lambda f: f.targets,
    "fact_revenue_monthly": lambda f: f.monthly,
    "fact_leakage": lambda f: f.leakage,
    "fact_recovery": lambda f: f.recovery,
    "vw_executive_summary": lambda f: marts.executive_summary_from_sales(
        f.sales, f.targets, f.settings
    ),
    "vw_leakage_radar": lambda f: marts.leakage_radar(f.leakage),
    "vw_funnel_analysis": lambda f: marts.funnel_analysis(f.funnel),
    "vw_recovery_scenarios": lambda f: marts.recovery_scenarios(f.recovery, f.settings),
    "validate_row_counts": _validate_row_counts,
    "validate_leakage_sign": lambda f: marts.validate_leakage_sign(f.leakage),
    "validate_funnel": lambda f: marts.validate_funnel(f.funnel),
    "validate_margin": lambda f: marts.margin_and_discount(f.region_sales, "region"),
    "kpi_measures": lambda f: measures.kpi_measures(f.sales, f.targets, f.funnel, f.settings),
    "kpi_by_region": lambda f: measures.kpi_by_region(
        f.sales, f.targets, f.funnel, f.settings
    ),
    "kpi_by_region_month": lambda f: measures.kpi_by_region_month(f.sales, f.targets, f.funnel),
    "kpi_contexts": lambda f: measures.kpi_contexts(
        f.product_sales, f.targets, f.funnel, f.settings
    ),
    "achievement_by_quarter": lambda f: measures.achievement_by_quarter(f.monthly),
    "region_actual_vs_target": lambda f: measures.region_actual_vs_target(f.monthly),
    "leakage_share_by_type": lambda f: measures.leakage_share_by_type(f.leakage),
    "leakage_rate": lambda f: measures.leakage_rate(f.leakage),
    "funnel_totals": lambda f: measures.funnel_totals(f.funnel),
    "discount_margin_by_region": lambda f: marts.margin_and_discount(
        f.region_sales, "region"
    ),
    "discount_margin_by_category": lambda f: marts.margin_and_discount(
        f.region_sales, "category"
    ),
    "recovery_by_scenario": lambda f: measures.recovery_by_scenario(f.recovery, f.settings),
    "leakage_fixed_rate": lambda f: measures.leakage_fixed_rate(f.leakage, f.settings),
}


def _query(plan: Callable[[Frames], DataFrame]) -> Query:
    return lambda spark, sf_dir: numbers.for_report(plan(Frames(spark, sf_dir)))


def queries() -> dict[str, Query]:
    return {name: _query(plan) for name, plan in PLANS.items()}
