"""Date expressions. Unreadable text raises (ANSI mode); NULL stays NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_strict(col: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.to_date(col, fmt)


def parse_mixed(col: Column, formats: tuple[str, ...]) -> Column:
    """First format that fits wins; the last one is strict, so junk still fails."""
    *lenient, last = formats
    return F.coalesce(*[F.try_to_date(col, f) for f in lenient], F.to_date(col, last))


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def cohort_month(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def date_parts(col: Column) -> list[Column]:
    """Calendar columns of the date dimension (``MMMM`` is the full month name)."""
    return [
        F.year(col).alias("year"),
        F.quarter(col).alias("quarter"),
        F.month(col).alias("month"),
        F.date_format(col, "MMMM").alias("month_name"),
        month_start(col).alias("month_start"),
    ]
