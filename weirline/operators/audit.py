"""Row-count audits and quality reports: one aggregation per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weirline.operators.rows import keep_first


def _named(name: str) -> Column:
    return F.lit(name).alias("table_name")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def audit_keyed(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    keep: Column | None = None,
) -> DataFrame:
    """Rows in, duplicates removed, rows rejected by ``keep``, rows out, in one pass."""
    firsts = keep_first(df, keys, order_by, copies="_copies")
    kept = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    unique, final = F.count(F.lit(1)), F.count_if(kept)
    raw = F.coalesce(F.sum("_copies"), F.lit(0))
    return firsts.agg(
        raw.alias("raw_rows"),
        (raw - unique).alias("duplicates_removed"),
        (unique - final).alias("rejected_rows"),
        final.alias("final_rows"),
    ).select(_named(name), "*")


def audit_rows(df: DataFrame, name: str, keep: Column) -> DataFrame:
    """The same audit for a table without a key."""
    raw, final = F.count(F.lit(1)), F.count_if(F.coalesce(keep, F.lit(False)))
    return df.agg(
        raw.alias("raw_rows"),
        F.lit(0).cast("bigint").alias("duplicates_removed"),
        (raw - final).alias("rejected_rows"),
        final.alias("final_rows"),
    ).select(_named(name), "*")


AUDIT = (
    "table_name string, raw_rows bigint, duplicates_removed bigint, rejected_rows bigint, "
    "final_rows bigint"
)


class PassingRows:
    """Counts the rows of one table at steps of its cleaning, in the pass that writes it.

    Spark reports the counts with the write, so nothing is read again. They are taken
    behind the last shuffle, where a task that is repeated counts once: rows as read
    come out of the deduplication as a number of copies per key."""

    def __init__(self, table: str):
        self.table, self._seen = table, {}

    def _watch(self, df: DataFrame, **steps: Column) -> DataFrame:
        seen = Observation()
        self._seen.update(dict.fromkeys(steps, seen))
        return df.observe(seen, *[count.alias(step) for step, count in steps.items()])

    def first_rows(self, df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
        """``keep_first``, counting rows before and after."""
        firsts = keep_first(df, keys, order_by, copies="_copies")
        raw = F.coalesce(F.sum("_copies"), F.lit(0))
        return self._watch(firsts, raw=raw, unique=F.count(F.lit(1))).drop("_copies")

    def all_rows(self, df: DataFrame) -> DataFrame:
        """The rows of a table without a key."""
        n = F.count(F.lit(1))
        return self._watch(df, raw=n, unique=n)

    def final(self, df: DataFrame) -> DataFrame:
        return self._watch(df, final=F.count(F.lit(1)))

    def row(self) -> tuple:
        """A row of the audit. Waits until the table has been written."""
        raw, unique, final = (int(self._seen[s].get[s]) for s in ("raw", "unique", "final"))
        return self.table, raw, raw - unique, unique - final, final


def observed_audit(spark: SparkSession, tables: Sequence[PassingRows]) -> DataFrame:
    """The audit of tables that have been written, a row each."""
    return spark.createDataFrame([t.row() for t in tables], AUDIT)


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and NULL cells left in every table."""
    parts = []
    for name, df in tables.items():
        nulls = reduce(Column.__add__, [F.count_if(F.col(c).isNull()) for c in df.columns])
        parts.append(
            df.agg(F.count(F.lit(1)).alias("row_count"), nulls.alias("null_cells")).select(
                _named(name), "*"
            )
        )
    return union_all(parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table; meant for written tables, whose footers hold the count."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(_named(name), "*")
            for name, df in tables.items()
        ]
    )
