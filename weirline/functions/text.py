"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that stand for a missing value in the raw extracts.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Every character Python's str.strip() removes. Spark's trim()
# removes the plain space only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A run of cased letters, or a run of anything else.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"
_CASED_RUNS = f"([{_CASED}]+|[^{_CASED}]+)"


def na_to_null(col: Column) -> Column:
    """NULL where the text is a missing-value token, else the text unchanged."""
    return F.when(~col.isin(*NA_TOKENS), col)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def strip_upper(col: Column) -> Column:
    return F.upper(strip(col))


def strip_title(col: Column) -> Column:
    """Title case that restarts after every non-letter (``home-decor`` -> ``Home-Decor``).

    ``initcap`` restarts after spaces only, so the text is cut into letter runs first.
    """
    runs = F.regexp_extract_all(F.lower(strip(col)), F.lit(_CASED_RUNS), 1)
    return F.array_join(F.transform(runs, F.initcap), "")


def strip_lower(col: Column) -> Column:
    return F.lower(strip(col))


def label_of(key: Column, labels: Mapping[str, str]) -> Column:
    """The label of a strip+lower spelling; an unknown spelling stays as it is."""
    expr = None
    for spelling, label in labels.items():
        hit = key == spelling
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return key if expr is None else expr.otherwise(key)


def canonical_label(df: DataFrame, column: str, labels: Mapping[str, str]) -> DataFrame:
    """Canonicalise a category column.

    Two steps, so that a row is folded once and not once per known label.
    """
    df = df.withColumn(column, strip_lower(F.col(column)))
    return df.withColumn(column, label_of(F.col(column), labels))
