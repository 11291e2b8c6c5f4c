"""The whole job: raw extracts -> silver -> star schema -> views and reports."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirline.functions.dates import month_start
from weirline.operators.audit import PassingRows, observed_audit, quality_report, row_counts
from weirline.plans import gold, marts, measures, silver
from weirline.plans.drift import inferred_types, orphan_order_lines, refuse_drift
from weirline.settings import Settings
from weirline.sources.files import read_raw, write_csv
from weirline.sources.schemas import RAW_COLUMNS
from weirline.sources.warehouse import JdbcTarget, Warehouse, build_views, write_jdbc

SILVER_TABLES = {
    "customers": "dim_customer",
    "products": "dim_product",
    "orders": "stg_orders",
    "web_events": "stg_web_events",
    "targets": "stg_targets",
}

# Tables of the row-count check, in report order.
COUNTED_TABLES = (
    "dim_date",
    "dim_region",
    "dim_customer",
    "dim_product",
    "fact_revenue",
    "fact_funnel",
    "fact_targets",
    "fact_revenue_monthly",
    "fact_revenue_enriched",
    "fact_leakage",
    "fact_recovery",
)


@dataclass(frozen=True)
class Built:
    tables: Mapping[str, DataFrame]
    views: Mapping[str, DataFrame]
    checks: Mapping[str, DataFrame]
    measures: Mapping[str, DataFrame]


def read_extracts(
    spark: SparkSession, raw_dir: str, multi_line: bool = False
) -> dict[str, DataFrame]:
    return {e: read_raw(spark, f"{raw_dir}/{e}_raw.csv", e, multi_line) for e in RAW_COLUMNS}


def build_silver(
    raw: Mapping[str, DataFrame],
    warehouse: Warehouse,
    settings: Settings = Settings(),
    clean_csv_dir: str | None = None,
) -> tuple[dict[str, DataFrame], list[PassingRows]]:
    """Clean and write the five tables, each in one pass that counts its rows too; the
    CSV copies are made from the tables."""
    tables, passed = {}, []
    for entity, clean in silver.CLEANERS.items():
        name, passing = SILVER_TABLES[entity], PassingRows(entity)
        cleaned = clean(raw[entity], settings, passing)
        tables[name] = warehouse.write(passing.final(cleaned), name)
        passed.append(passing)
        if clean_csv_dir is not None:
            write_csv(tables[name], f"{clean_csv_dir}/{entity}_clean.csv")
    return tables, passed


def build_gold(
    tables: Mapping[str, DataFrame], warehouse: Warehouse, settings: Settings = Settings()
) -> dict[str, DataFrame]:
    """Facts and dimensions. Order lines are grouped once, into ``agg_revenue``; the revenue
    fact is a part of its columns, and all reports by month and region, KPIs and checks
    included, read the small ``agg_sales`` that is rolled up from it."""
    out = dict(tables)

    def write(name: str, df: DataFrame) -> DataFrame:
        out[name] = warehouse.write(df, name)
        return out[name]

    orders = gold.keyed(tables["stg_orders"], settings)
    products = gold.keyed(tables["dim_product"], settings)
    events = gold.keyed(tables["stg_web_events"], settings)
    planned = gold.keyed(tables["stg_targets"], settings)
    write("dim_date", gold.dim_date(orders))
    write("dim_region", gold.dim_region(orders))
    grain = write("agg_revenue", gold.revenue_grain(orders, products))
    write("fact_revenue", gold.revenue_facts(grain))
    write("fact_revenue_enriched", gold.fact_revenue_enriched(orders, products))
    write("fact_funnel", gold.fact_funnel(events, settings))
    targets = write("fact_targets", gold.fact_targets(planned, settings))
    sales = write("agg_sales", gold.region_month(grain))
    write("fact_revenue_monthly", gold.fact_revenue_monthly(sales, targets))
    leakage = write("fact_leakage", gold.fact_leakage(sales, targets, settings))
    write("fact_recovery", gold.fact_recovery(leakage, settings))
    return out


def build_measures(
    tables: Mapping[str, DataFrame], settings: Settings = Settings()
) -> dict[str, DataFrame]:
    """The ten measures under their contexts, and the report pages."""
    sales = tables["agg_sales"]
    targets, funnel = tables["fact_targets"], tables["fact_funnel"]
    monthly, leakage = tables["fact_revenue_monthly"], tables["fact_leakage"]
    return {
        "kpi_measures": measures.kpi_measures(sales, targets, funnel, settings),
        "kpi_contexts": measures.kpi_contexts(
            tables["agg_revenue"].withColumn("month", month_start(F.col("date"))),
            targets, funnel, settings,
        ),
        "kpi_by_region": measures.kpi_by_region(sales, targets, funnel, settings),
        "kpi_by_region_month": measures.kpi_by_region_month(sales, targets, funnel),
        "achievement_by_quarter": measures.achievement_by_quarter(monthly),
        "region_actual_vs_target": measures.region_actual_vs_target(monthly),
        "leakage_share_by_type": measures.leakage_share_by_type(leakage),
        "leakage_rate": measures.leakage_rate(leakage),
        "funnel_totals": measures.funnel_totals(funnel),
        "recovery_by_scenario": measures.recovery_by_scenario(tables["fact_recovery"], settings),
        "leakage_fixed_rate": measures.leakage_fixed_rate(leakage, settings),
    }


def build_checks(
    tables: Mapping[str, DataFrame], settings: Settings = Settings()
) -> dict[str, DataFrame]:
    return {
        "row_counts": row_counts({t: tables[t] for t in COUNTED_TABLES}),
        "leakage_sign": marts.validate_leakage_sign(tables["fact_leakage"]),
        "funnel": marts.validate_funnel(tables["fact_funnel"]),
        "margin": marts.margin_from_rollup(tables["agg_sales"], "region"),
    }


def run(
    spark: SparkSession,
    raw_dir: str,
    warehouse: Warehouse,
    settings: Settings = Settings(),
    clean_csv_dir: str | None = None,
    replacement_events: DataFrame | None = None,
    multi_line: bool = False,
    database: JdbcTarget | None = None,
    check_types: bool = False,
) -> Built:
    """Full refresh, all or nothing under a warehouse folder. ``replacement_events`` takes the place of the cleaned events
    before the funnel is built (truncate and reload). ``multi_line`` allows line breaks
    inside quoted fields of the extracts. Every table is copied to ``database``, if given.
    ``check_types`` reads the extracts once more, before anything is built: it infers what
    their columns hold, and refuses the run where that is not what is declared."""
    raw = read_extracts(spark, raw_dir, multi_line)
    if check_types:
        refuse_drift(inferred_types(raw, settings))
    with warehouse.refresh() as fresh:
        tables, passed = build_silver(raw, fresh, settings, clean_csv_dir)
        audit = fresh.write(observed_audit(spark, passed), "etl_audit")
        cleaned = {entity: tables[name] for entity, name in SILVER_TABLES.items()}
        quality = fresh.write(quality_report(cleaned), "quality_report")
        if replacement_events is not None:
            tables["stg_web_events"] = fresh.write(replacement_events, "stg_web_events")
        tables = build_gold(tables, fresh, settings)
        orphans = fresh.write(
            orphan_order_lines(
                gold.keyed(tables["stg_orders"], settings),
                gold.keyed(tables["dim_product"], settings),
            ),
            "orphan_order_lines",
        )
        results = {
            name: fresh.write(df, name) for name, df in build_measures(tables, settings).items()
        }
    views = build_views(marts.view_queries(settings), tables, warehouse)
    checks = {
        **build_checks(tables, settings), "quality_report": quality, "etl_audit": audit,
        "orphan_order_lines": orphans,
    }
    if database is not None:
        for name, df in tables.items():
            write_jdbc(df, database.url, name, database.properties, settings.text_width)
    return Built(tables, views, checks, results)
