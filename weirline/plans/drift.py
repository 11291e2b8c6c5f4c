"""Extracts against what cleaning expects of them: types, and products that are sold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirline.operators.audit import union_all
from weirline.operators.collation import group_agg
from weirline.operators.inference import DATE, FLOAT, INTEGER, against, inferred_kinds
from weirline.settings import Settings
from weirline.sources.schemas import POSITION


class DriftedExtract(ValueError):
    """Columns of the extracts do not hold what is declared."""


def declared_kinds(settings: Settings = Settings()) -> dict[str, dict[str, str]]:
    """The kinds that cleaning reads columns as; all others are text."""
    whole = isinstance(settings.base_price, T.IntegralType)
    return {
        "customers": {"signup_date": DATE},
        "products": {"base_price": INTEGER if whole else FLOAT, "margin_pct": FLOAT},
        "orders": {"order_date": DATE, "order_value": FLOAT, "discount_pct": FLOAT},
        "web_events": {"event_date": DATE, "count": FLOAT},
        "targets": {"month": DATE, "target_revenue": FLOAT},
    }


def inferred_types(
    raw: Mapping[str, DataFrame],
    settings: Settings = Settings(),
    declared: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Per column of each extract: the kind of its values, the kind that is declared, rows,
    missing values, and whether the extract has drifted. One aggregate an extract."""
    declared = declared_kinds(settings) if declared is None else declared
    formats = {"month": settings.target_date_formats}
    parts = []
    for name, df in raw.items():
        kinds = inferred_kinds(df.drop(POSITION), formats if name == "targets" else None)
        parts.append(
            against(kinds, declared.get(name, {})).select(F.lit(name).alias("table_name"), "*")
        )
    return union_all(parts)


def refuse_drift(types: DataFrame) -> None:
    """Raise with the drifted columns, if there are any (a row per column at most)."""
    drifted = types.where("drifted").orderBy("table_name", "column_name").collect()
    if drifted:
        raise DriftedExtract(
            "; ".join(
                f"{r.table_name}.{r.column_name} is {r.kind}, declared {r.declared}" for r in drifted
            )
        )


def orphan_order_lines(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sales that no fact has, because their product is not in the product table: per unknown
    product the order lines, their value, and the first and last day.

    Lines are summed per product before they meet the products, so a product with a third of
    the lines is a row per task. A missing product id is unknown too."""
    sold = group_agg(
        orders,
        ["product_id"],
        F.count(F.lit(1)).alias("lines"),
        F.sum("order_value").alias("revenue"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
    )
    return sold.join(products.select("product_id"), "product_id", "left_anti")
