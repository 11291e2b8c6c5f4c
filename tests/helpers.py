"""Small readers used by several tests."""

from __future__ import annotations


def rows(df, *order):
    """All rows as tuples, sorted by every column (or the given ones)."""
    cols = list(order) or df.columns
    return sorted((tuple(r) for r in df.select(*df.columns).collect()), key=lambda r: tuple(
        (r[df.columns.index(c)] is None, str(r[df.columns.index(c)])) for c in cols
    ))


def one(df):
    (row,) = df.collect()
    return row.asDict()


def formatted_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
