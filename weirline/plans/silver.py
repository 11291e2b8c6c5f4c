"""The five cleaning jobs: raw extract -> typed, deduplicated table.

Input columns may be text (CSV bronze) or already typed (Parquet sources); a
typed date is not printed and parsed again. ``passing`` counts the rows of a job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirline.functions.dates import cohort_month, parse_mixed, parse_strict
from weirline.functions.numbers import nan_to_null, to_count
from weirline.functions.text import canonical_label, strip_title, strip_upper
from weirline.operators.audit import PassingRows, audit_keyed, audit_rows, union_all
from weirline.operators.median import fill_median
from weirline.operators.rows import drop_null_rows, fill_constant, keep_at_most, keep_first
from weirline.settings import Settings
from weirline.sources.schemas import LINE, POSITION

KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "targets": ["month", "region"],
}


def order_keys(raw: DataFrame) -> list[str]:
    """Orders are told apart by id, and by line where the source has lines."""
    return KEYS["orders"] + [LINE] * (LINE in raw.columns)


def _order_by(raw: DataFrame) -> list[str]:
    return [POSITION] if POSITION in raw.columns else []


def _first_rows(
    raw: DataFrame, keys: list[str], passing: PassingRows | None = None
) -> DataFrame:
    order = _order_by(raw)
    firsts = passing.first_rows(raw, keys, order) if passing else keep_first(raw, keys, order)
    return firsts.drop(POSITION)


def _date(df: DataFrame, name: str, parse: Callable[[Column], Column]) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse(F.col(name))
    return F.col(name).cast("date")


def _numeric(df: DataFrame, name: str, dtype: T.DataType) -> Column:
    return nan_to_null(df, name).cast(dtype)


def clean_customers(
    raw: DataFrame, settings: Settings = Settings(), passing: PassingRows | None = None
) -> DataFrame:
    df = _first_rows(raw, KEYS["customers"], passing)
    df = df.withColumns(
        {"segment": strip_upper(F.col("segment")), "signup_date": _date(df, "signup_date", parse_strict)}
    )
    df = fill_constant(df, {"signup_date": settings.default_signup_date})
    return df.withColumn("cohort_month", cohort_month(F.col("signup_date")))


def clean_products(
    raw: DataFrame, settings: Settings = Settings(), passing: PassingRows | None = None
) -> DataFrame:
    df = _first_rows(raw, KEYS["products"], passing)
    df = df.withColumns(
        {
            "category": strip_title(F.col("category")),
            "base_price": _numeric(df, "base_price", settings.base_price),
            "margin_pct": _numeric(df, "margin_pct", settings.rate),
        }
    )
    return fill_median(df, "margin_pct")


def clean_order_lines(
    raw: DataFrame, settings: Settings = Settings(), passing: PassingRows | None = None
) -> DataFrame:
    """The order rules that need only key, value and discount.

    Deduplicate before any cut: an order whose first copy has no value goes,
    even if a later copy has one. Sources that keep date, buyer or region in
    other tables clean their lines with this first and join the survivors.
    """
    df = _first_rows(raw, order_keys(raw), passing)
    df = df.withColumn("order_value", nan_to_null(df, "order_value"))
    df = drop_null_rows(df, ["order_value"])
    # The cut sees the value as given; only then is it brought to its scale.
    df = df.withColumn("_given", F.col("order_value").cast("double"))
    df = keep_at_most(df, "_given", settings.order_value_cap).drop("_given")
    df = df.withColumns(
        {
            "order_value": F.col("order_value").cast(settings.money),
            "discount_pct": _numeric(df, "discount_pct", settings.rate),
        }
    )
    return fill_constant(df, {"discount_pct": 0})


def clean_orders(
    raw: DataFrame, settings: Settings = Settings(), passing: PassingRows | None = None
) -> DataFrame:
    df = clean_order_lines(raw, settings, passing)
    return df.withColumn("order_date", _date(df, "order_date", parse_strict))


def clean_web_events(
    raw: DataFrame, settings: Settings = Settings(), passing: PassingRows | None = None
) -> DataFrame:
    """No key, so no deduplication."""
    df = passing.all_rows(raw) if passing else raw
    df = df.drop(POSITION)
    df = df.withColumn("count", nan_to_null(df, "count"))
    df = drop_null_rows(df, ["count"])
    df = df.withColumns(
        {"event_date": _date(df, "event_date", parse_strict), "count": to_count(df, "count")}
    )
    return canonical_label(df, "event_type", settings.event_labels)


def _dated_targets(raw: DataFrame, settings: Settings) -> DataFrame:
    month = _date(raw, "month", lambda c: parse_mixed(c, settings.target_date_formats))
    return raw.withColumn("month", month)


def clean_targets(
    raw: DataFrame, settings: Settings = Settings(), passing: PassingRows | None = None
) -> DataFrame:
    """The month is parsed before deduplication: two spellings are one key."""
    df = _first_rows(_dated_targets(raw, settings), KEYS["targets"], passing)
    return df.withColumn(
        "target_revenue", _numeric(df, "target_revenue", settings.money)
    )


CLEANERS = {
    "customers": clean_customers,
    "products": clean_products,
    "orders": clean_orders,
    "web_events": clean_web_events,
    "targets": clean_targets,
}


def etl_audit(raw: dict[str, DataFrame], settings: Settings = Settings()) -> DataFrame:
    """Per extract: rows read, duplicates removed, rows rejected, rows kept."""
    orders, events = raw["orders"], raw["web_events"]
    value = nan_to_null(orders, "order_value").cast("double")
    return union_all(
        [
            audit_keyed(raw["customers"], "customers", KEYS["customers"]),
            audit_keyed(raw["products"], "products", KEYS["products"]),
            audit_keyed(
                orders,
                "orders",
                order_keys(orders),
                _order_by(orders),
                keep=value <= F.lit(settings.order_value_cap),
            ),
            audit_rows(events, "web_events", nan_to_null(events, "count").isNotNull()),
            audit_keyed(_dated_targets(raw["targets"], settings), "targets", KEYS["targets"]),
        ]
    )
