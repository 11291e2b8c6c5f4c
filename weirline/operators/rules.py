"""Rule-driven columns: conditional updates and classifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirline.settings import Settings


def uplift_where(
    df: DataFrame, column: str, condition: Column, factor, places: int = 2
) -> DataFrame:
    """Scale and round ``column`` on matching rows.

    A pure expression: running it again on the same input gives the same rows,
    unlike an in-place update, which compounds.
    """
    old = F.col(column)
    new = F.round(old * F.lit(factor), places).cast(df.schema[column].dataType)
    return df.withColumn(column, F.when(condition, new).otherwise(old))


def _rule_column(region: Column, settings: Settings, position: int) -> Column:
    default = F.lit(settings.default_rule[position])
    expr = None
    for name, rule in settings.region_rules.items():
        hit = region == name
        value = rule[position]
        expr = F.when(hit, value) if expr is None else expr.when(hit, value)
    return default if expr is None else expr.otherwise(default)


def leakage_type(region: Column, settings: Settings) -> Column:
    return _rule_column(region, settings, 0)


def risk_level(region: Column, settings: Settings) -> Column:
    return _rule_column(region, settings, 1)


def classify(df: DataFrame, settings: Settings, region: str = "region") -> DataFrame:
    """Add ``leakage_type`` and ``risk_level`` by the region rules."""
    col = F.col(region)
    return df.withColumns(
        {"leakage_type": leakage_type(col, settings), "risk_level": risk_level(col, settings)}
    )


RULE_TABLE = "priority int, region string, leakage_type string, risk_level string"


def rule_rows(spark: SparkSession, settings: Settings) -> DataFrame:
    """The region rules as a table: a priority each, and a last row without a region that
    holds where no other does."""
    rules = [(i, name, *rule) for i, (name, rule) in enumerate(settings.region_rules.items())]
    return spark.createDataFrame([*rules, (len(rules), None, *settings.default_rule)], RULE_TABLE)


def classify_by_table(df: DataFrame, rules: DataFrame, region: str = "region") -> DataFrame:
    """``classify`` with rules that are kept as data.

    Of several rules for a region the one with the least priority holds (of equal priorities
    the least label pair); a rule without a region is the default, and without one there is
    no label. Regions compare as the column's collation has it. The rules are reduced to one a
    region before the join, so no row of ``df`` is repeated; the join is planned by size, and
    the default is one row, read as a scalar."""
    verdict = F.struct("priority", "leakage_type", "risk_level")
    default = rules.where(F.col("region").isNull()).agg(F.min(verdict).alias("rule")).scalar()
    names = rules.where(F.col("region").isNotNull())
    kind = df.schema[region].dataType
    known = names.groupBy(F.col("region").cast(kind).alias("_ruled")).agg(F.min(verdict).alias("_rule"))
    ruled = df.join(known, F.col(region) == F.col("_ruled"), "left")
    ruled = ruled.withColumn("_rule", F.coalesce("_rule", default))
    labels = {label: F.col(f"_rule.{label}") for label in ("leakage_type", "risk_level")}
    return ruled.withColumns(labels).drop("_ruled", "_rule")


def sum_where(condition: Column, value: Column) -> Column:
    """Conditional sum: 0, not NULL, where no row of the group matches."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("bigint")))


def count_ignoring_case(df: DataFrame, column: str) -> DataFrame:
    """Group as a case-insensitive collation does: label and rows per spelling class.

    Exact spellings are counted first, so only one row per spelling reaches the
    case-folding step.
    """
    spellings = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return (
        spellings.groupBy(F.lower(column).alias("_folded"))
        .agg(F.min(column).alias(column), F.sum("row_count").alias("row_count"))
        .drop("_folded")
    )
