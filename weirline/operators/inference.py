"""What the values of a table's columns are, found in one aggregate over all rows.

Kinds form a lattice: an empty column may be read as anything, a whole number as a number,
numbers and dates as text. A column's kind is the least that holds all its values; whole
numbers with gaps are numbers, because a gap has no whole number. Every task folds its rows
to a few counts per column, so nothing but those is shuffled, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirline.functions.text import na_to_null, strip

EMPTY, INTEGER, FLOAT, DATE, TEXT = "empty", "integer", "float", "date", "text"

# Kinds that values of a kind may be read as.
READABLE_AS = {
    EMPTY: (EMPTY, INTEGER, FLOAT, DATE, TEXT),
    INTEGER: (INTEGER, FLOAT, TEXT),
    FLOAT: (FLOAT, TEXT),
    DATE: (DATE, TEXT),
    TEXT: (TEXT,),
}

# Up to 18 digits always fit a 64-bit number; longer runs are numbers without a whole type.
_WHOLE = r"^[+-]?[0-9]{1,18}$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _sightings(
    df: DataFrame, column: str, formats: Sequence[str]
) -> tuple[Column, Column, Column, Column]:
    """Whether a row's value is there, a whole number, a number, a date.

    A typed column answers by its type; only text is matched against patterns."""
    value, dtype = F.col(f"`{column}`"), df.schema[column].dataType
    there, yes, no = value.isNotNull(), F.lit(True), F.lit(False)
    if isinstance(dtype, T.StringType):
        value = na_to_null(value)
        bare = strip(value)
        dated = F.coalesce(*[F.try_to_date(bare, f) for f in formats]).isNotNull()
        return value.isNotNull(), bare.rlike(_WHOLE), bare.rlike(_NUMBER), dated
    if isinstance(dtype, T.IntegralType):
        return there, yes, yes, no
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return there & ~F.isnan(value), no, yes, no
    if isinstance(dtype, T.DecimalType):
        return there, no, yes, no
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return there, no, no, yes
    return there, no, no, no


def _kind(rows: Column, there: Column, whole: Column, number: Column, date: Column) -> Column:
    return (
        F.when(there == 0, EMPTY)
        .when((whole == there) & (there == rows), INTEGER)
        .when(number == there, FLOAT)
        .when(date == there, DATE)
        .otherwise(TEXT)
    )


def inferred_kinds(
    df: DataFrame, formats: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """A row per column: ``column_name, kind, n_rows, n_missing``.

    ``formats`` has the date formats of single columns; others take ``yyyy-MM-dd``. Missing
    are NULLs, NaNs and the texts that stand for a missing value. An empty table has empty
    columns; a table without columns has no rows."""
    if not df.columns:
        return df.sparkSession.createDataFrame(
            [], "column_name string, kind string, n_rows bigint, n_missing bigint"
        )
    counts = [F.count(F.lit(1)).alias("n_rows")]
    for i, column in enumerate(df.columns):
        there, *kinds = _sightings(df, column, (formats or {}).get(column, ("yyyy-MM-dd",)))
        counts.append(F.count_if(there).alias(f"there{i}"))
        counts += [
            F.count_if(there & F.coalesce(kind, F.lit(False))).alias(f"{name}{i}")
            for name, kind in zip(("whole", "number", "date"), kinds, strict=True)
        ]
    rows = F.col("n_rows")
    found = [
        F.struct(
            F.lit(column).alias("column_name"),
            _kind(rows, *[F.col(f"{n}{i}") for n in ("there", "whole", "number", "date")]).alias(
                "kind"
            ),
            rows.alias("n_rows"),
            (rows - F.col(f"there{i}")).alias("n_missing"),
        )
        for i, column in enumerate(df.columns)
    ]
    return df.agg(*counts).select(F.inline(F.array(*found)))


def against(kinds: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Add ``declared`` and ``drifted``: whether some value cannot be read as declared.
    Columns that are not declared are text, which anything can be read as."""
    expected: Column = F.lit(TEXT)
    for column, kind in declared.items():
        expected = F.when(F.col("column_name") == column, kind).otherwise(expected)
    readable = F.lit(False)
    for kind, targets in READABLE_AS.items():
        readable = readable | ((F.col("kind") == kind) & F.col("declared").isin(*targets))
    return kinds.withColumn("declared", expected).withColumn("drifted", ~readable)
