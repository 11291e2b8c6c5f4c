"""The five raw extracts. Bronze is all text: types are set once, in silver."""

from __future__ import annotations

from pyspark.sql import types as T

# Header names of the raw files, in file order.
RAW_COLUMNS = {
    "customers": ("customer_id", "region", "segment", "signup_date"),
    "products": ("product_id", "category", "base_price", "margin_pct"),
    "orders": (
        "order_id",
        "order_date",
        "customer_id",
        "product_id",
        "region",
        "order_value",
        "discount_pct",
    ),
    "web_events": ("event_date", "region", "event_type", "count"),
    "targets": ("month", "region", "target_revenue"),
}

POSITION = "_pos"

# Sources whose orders have numbered lines add this column to the order key.
LINE = "line_number"


def raw_schema(entity: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[entity]])
