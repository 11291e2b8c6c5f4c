"""Number expressions: exact decimals inside, doubles only at the report edge."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RATIO = "decimal(38,10)"
_EXACT = "decimal(28,10)"
_LARGEST = 9e18  # whole parts are 64-bit numbers


def nan_to_null(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing; a no-op for non-floating types."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def to_count(df: DataFrame, name: str) -> Column:
    """A whole number; text such as ``7267.9`` is cut towards zero.

    Text goes through an exact decimal, so neither long digit runs nor a long
    fraction are rounded on the way.
    """
    col = nan_to_null(df, name)
    if isinstance(df.schema[name].dataType, T.StringType):
        col = col.cast("decimal(38,18)")
    return col.cast("bigint")


def round_half_up(col: Column, places: int) -> Column:
    """Round by decimal digits, so 0.285 gives 0.29 whatever its binary form."""
    return F.round(col.cast(_RATIO), places)


def round_ratio(numerator: Column, denominator: Column, places: int, scale: int = 1) -> Column:
    """``scale`` times the quotient, rounded half up once; NULL on a zero denominator.

    Whole part and remainder are found by dividing exact decimals, and the digits kept
    from the remainder: nothing is rounded on the way, however large the sums (below
    10^18 with 10 decimals). A quotient too large for a whole number fails the run.
    """
    a = F.abs(numerator.cast(_EXACT)) * F.lit(scale)
    b = F.abs(denominator.cast(_EXACT))
    whole = F.call_function("div", a, b).cast("decimal(19,0)")
    digits = F.call_function("div", (a % b) * F.lit(2 * 10**places) + b, b * F.lit(2))
    exact = whole + digits.cast(f"decimal({places + 2},0)") * F.lit(Decimal(1).scaleb(-places))
    negative = (numerator < 0) != (denominator < 0)
    too_large = a.cast("double") >= b.cast("double") * F.lit(_LARGEST)
    failure = F.raise_error(F.lit("ratio out of range")).cast(f"decimal({places + 21},{places})")
    signed = F.when(too_large, failure).when(negative, -exact).otherwise(exact)
    return F.when(b != 0, signed)


def percent(numerator: Column, denominator: Column, places: int = 2) -> Column:
    return round_ratio(numerator, denominator, places, scale=100)


def mean(column: str, places: int) -> Column:
    """Mean of the values that are there, rounded once."""
    return round_ratio(F.sum(column), F.count(column), places)


def for_report(df: DataFrame) -> DataFrame:
    """Decimals as doubles, with all their digits, the form a report or CSV file shows."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
