"""Awkward inputs that every operator has to take."""

from __future__ import annotations

from pathlib import Path

DATA = Path("/root/testdata/sf0.001")
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for their own columns.
CLASHING = ("score", "fp", "key", "node", "row", "words", "n", "rank", "h1", "component", "runs")


def documents(spark, texts, *, langs=None, extra=True):
    """Documents with ids from 0 and, if ``extra``, columns whose names clash."""
    rows = [
        (i, text, langs[i] if langs else "en", None, len(text) if text else None)
        for i, text in enumerate(texts)
    ]
    return clash(spark.createDataFrame(rows, DOCUMENT)) if extra else spark.createDataFrame(rows, DOCUMENT)


def clash(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("mine") for c in CLASHING})


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
