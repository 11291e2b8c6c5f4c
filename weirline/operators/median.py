"""Exact median of a column without gathering its values anywhere."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ACCURACY = 1000  # of the sketches: ranks are off by one in this many values at most
_SLOTS = 128  # parts that the values between the bounds are dealt to
_EXACT_DIGITS = 36  # of a decimal, so that half a sum is exact


def _quantiles(df: DataFrame, column: str, shares: list[float]) -> Column:
    """Approximate quantiles as an array, a scalar subquery. Tasks send small sketches."""
    points = F.percentile_approx(column, shares, _ACCURACY)
    return df.agg(points.alias("points")).scalar()


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row, one column ``median``: interpolated, NULLs and NaNs skipped; NULL if
    nothing is left. Floats give a double, decimals their own type (with 37 digits or
    more the two middle values may not differ, or the query fails).

    ``df`` is read twice. The first pass sketches quantiles whose error has a bound, so
    that two of them bracket both middle ranks. The second counts the values between
    them one by one and all others as one group, combined before the shuffle: some 0.4 %
    of the rows at most travel. Those counts are dealt to slots by quantiles of their
    own, and only the slots that hold the middle ranks, two at most, are put in order. No
    task gets more than a slot, however the values are spread, and the counts decide:
    where the bracket missed a rank the query would fail, not return another value.
    """
    dtype = df.schema[column].dataType
    if not isinstance(dtype, (T.DecimalType, T.DoubleType, T.FloatType)):
        raise TypeError(f"exact_median needs decimals or floats, got {dtype.simpleString()}")

    value = F.col(column)
    known = value.isNotNull()
    if not isinstance(dtype, T.DecimalType):
        value = value.cast("double")
        known = known & ~F.isnan(value)
    # Doubles keep the order of decimals; those that fall together stay together.
    values = df.where(known).select(value.alias("_v"), value.cast("double").alias("_d"))
    margin = 2 / _ACCURACY
    bounds = _quantiles(values, "_d", [0.5 - margin, 0.5 + margin])
    low, high = F.element_at(bounds, 1), F.element_at(bounds, 2)
    counts = (
        values.select(
            F.when(F.col("_d").between(low, high), F.col("_v")).alias("_v"),
            (F.col("_d") < low).alias("_below"),
        )
        .groupBy(F.col("_v").alias("_key"))
        .agg(
            F.max("_v").alias("_v"),  # the key itself; what is asked of it stays above the counts
            F.count(F.lit(1)).alias("_n"),
            F.count_if("_below").alias("_below"),
        )
        .drop("_key")
        .where("_n > 0 and _below >= 0")  # all uses read the same columns, so there is one pass
    )
    between = counts.where("_v is not null").select(F.col("_v").cast("double").alias("_d"))
    points = _quantiles(between, "_d", [i / _SLOTS for i in range(1, _SLOTS)])
    slot = F.size(F.filter("_points", lambda point: point < F.col("_v").cast("double")))
    slots = counts.withColumn("_points", points).select(
        "_v", "_n", "_below", F.when(F.col("_v").isNull(), -1).otherwise(slot).alias("_slot")
    )

    # At most 129 rows, then at most two: the slots that hold the two middle ranks.
    sizes = slots.groupBy("_slot").agg(
        F.sum("_n").alias("_all"),
        F.sum(F.when(F.col("_slot") < 0, F.col("_below")).otherwise(F.col("_n"))).alias("_size"),
    )
    everything = Window.partitionBy(F.lit(0))
    def over_all(n: Column) -> Column:
        return F.sum(n).over(everything)

    size, inside = F.col("_size"), F.when(F.col("_slot") >= 0, F.col("_size"))
    below = over_all(size) - over_all(inside)
    bracketed = (below <= F.col("_lo")) & (over_all(size) > F.col("_hi"))
    missed = F.raise_error(F.lit("exact_median: the bracket missed a middle rank"))
    middle = (
        sizes.withColumn("_total", over_all(F.col("_all")))
        .withColumns({"_lo": F.shiftright(F.col("_total") - 1, 1), "_hi": F.shiftright("_total", 1)})
        .withColumns({"_end": F.sum("_size").over(everything.orderBy("_slot")), "_ok": bracketed})
        .withColumn(
            "_before",
            F.when(F.col("_ok"), F.col("_end") - size).otherwise(missed.cast("bigint")),
        )
        .where("_slot >= 0 and _before <= _hi and _end > _lo")
        .select("_slot", "_before", "_lo", "_hi")
    )
    end = F.col("_before") + F.sum("_n").over(Window.partitionBy("_slot").orderBy("_v"))
    ends = (
        slots.select("_slot", "_v", "_n")
        .join(F.broadcast(middle), "_slot")
        .withColumn("_end", end)
        .where("_end - _n <= _hi and _end > _lo")
        .agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    )
    return ends.select(_midpoint(F.col("_low"), F.col("_high"), dtype).alias("median"))


def _midpoint(low: Column, high: Column, dtype: T.DataType) -> Column:
    if not isinstance(dtype, T.DecimalType):
        return F.when(low == high, low).otherwise(low / 2 + high / 2)
    exact = T.DecimalType(min(dtype.precision, _EXACT_DIGITS), min(dtype.scale, _EXACT_DIGITS))
    half = (low.cast(exact) + high.cast(exact)) * F.lit(Decimal("0.5"))
    return F.when(low == high, low).otherwise(F.round(half, dtype.scale).cast(dtype))


def fill_median(df: DataFrame, column: str) -> DataFrame:
    """Replace NULLs by the column's median; all-NULL columns stay NULL.

    The median reaches the rows as a scalar subquery, so no join is planned.
    """
    median = exact_median(df.select(column), column).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), median))
