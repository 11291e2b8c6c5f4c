"""Deduplication, null handling and row cuts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """One row per key: the first by ``order_by``, then by all other columns.

    The order is total up to identical rows, so the result does not depend on
    partitioning. A minimum over a struct combines on the map side: each task
    ships one row per key, so a key holding a third of the table costs the
    reducer one row per map task. ``copies`` names an optional column with the
    number of rows the key had.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    first = F.min(F.struct(*order_by, *rest)).alias("_first")
    counts = [F.count(F.lit(1)).alias(copies)] if copies else []
    if not order_by and not rest:
        grouped = df.groupBy(*keys).agg(*counts) if counts else df.select(*keys).distinct()
        return grouped
    return (
        df.groupBy(*keys)
        .agg(first, *counts)
        .select(
            *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns],
            *([copies] if copies else []),
        )
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def keep_at_most(df: DataFrame, column: str, cap: Any) -> DataFrame:
    """Rows whose value is at most ``cap`` (inclusive); a missing value is dropped."""
    return df.where(F.col(column) <= F.lit(cap))


def fill_constant(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace NULLs by a constant of the column's own type."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
            for c, v in values.items()
        }
    )
