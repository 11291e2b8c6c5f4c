"""Keys that compare as in a case- and accent-insensitive warehouse.

A column gets a collation as its type and keeps its text: grouping, joining and
comparing then hold spellings equal, whoever does it, and the type stays with the column
in written tables. Spark groups such keys by sorting where it would hash plain text, so
sources that are known to spell a key one way are better left without a collation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINARY = "UTF8_BINARY"


def collation_of(kind: T.DataType) -> str | None:
    """The collation of a text type that does not compare bytes."""
    named = isinstance(kind, T.StringType) and kind.collation != BINARY
    return kind.collation if named else None


def collated(df: DataFrame, columns: Sequence[str], collation: str | None) -> DataFrame:
    """Give those of the columns that are text in ``df`` a collation; None changes nothing."""
    texts = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    if collation is None or not texts:
        return df
    return df.withColumns({c: F.collate(F.col(c), collation) for c in texts})


def plain(df: DataFrame) -> DataFrame:
    """All text as bytes again, for targets that know no collations."""
    texts = {f.name: F.collate(f.name, BINARY) for f in df.schema if collation_of(f.dataType)}
    return df.withColumns(texts) if texts else df


def group_agg(df: DataFrame, keys: Sequence[Column | str], *aggs: Column) -> DataFrame:
    """``df.groupBy(keys).agg(aggs)``; a collated key shows the smallest of the spellings
    that its group has, so it is one that occurs and does not depend on the order of rows."""
    named = df.select(*keys).schema
    collations = {f.name: c for f in named if (c := collation_of(f.dataType))}
    spellings = [
        F.min(F.collate(key, BINARY)).alias(f"_spelling_{field.name}")
        for key, field in zip(keys, named, strict=True)
        if field.name in collations
    ]
    grouped = df.groupBy(*keys)
    if not spellings:
        return grouped.agg(*aggs) if aggs else df.select(*keys).distinct()
    found = grouped.agg(*aggs, *spellings)
    chosen = {n: F.collate(f"_spelling_{n}", c) for n, c in collations.items()}
    return found.withColumns(chosen).drop(*[f"_spelling_{n}" for n in collations])
