"""Full-refresh tables and replaceable views."""

from __future__ import annotations

import contextlib
import time
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weirline.functions.numbers import nan_to_null
from weirline.operators.collation import plain


VERSIONS, COMPLETE = "versions", "_COMPLETE"


@dataclass(frozen=True)
class Warehouse:
    """Tables as Parquet directories under ``root``, or managed in ``database``.

    Writing a table rebuilds it, as dropping and recreating would. Readers get
    the written files, so every later step starts from data on disk: a lost
    executor costs a re-read, not a recomputation of the whole lineage.

    A ``refresh`` under ``root`` writes a folder per version. The version counts once an
    empty file in it says that it is complete; making that file is the one step by which
    all tables change at once, on stores without a rename too. Managed tables change one
    by one.
    """

    spark: SparkSession
    root: str | None = None
    database: str | None = None
    version: str | None = None  # that is being written

    def __post_init__(self) -> None:
        if (self.root is None) == (self.database is None):
            raise ValueError("give exactly one of root and database")

    @contextlib.contextmanager
    def refresh(self) -> Iterator[Warehouse]:
        """A warehouse to rebuild all tables in. If that fails, the tables of the last
        complete refresh stay the ones that are read."""
        if self.root is None:
            yield self
            return
        fresh = replace(self, version=f"{time.time_ns():020d}")
        yield fresh
        files, path = self._files(f"{VERSIONS}/{fresh.version}/{COMPLETE}")
        files.create(path, True).close()

    def _files(self, name: str):
        """The file system of ``root``, and a path in it."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(context._jsc.hadoopConfiguration()), path

    def complete_versions(self) -> list[str]:
        """Versions that may be read, the current one last."""
        files, path = self._files(VERSIONS)
        if not files.exists(path):
            return []
        names = sorted(f.getPath().getName() for f in files.listStatus(path) if f.isDirectory())
        return [n for n in names if files.exists(self._files(f"{VERSIONS}/{n}/{COMPLETE}")[1])]

    def expire(self, keep: int = 2) -> list[str]:
        """Delete all but the last ``keep`` complete versions, and what failed before them;
        to be called when nobody reads those any more. Returns the deleted versions."""
        kept = self.complete_versions()[-max(keep, 1) :]
        files, path = self._files(VERSIONS)
        if not kept:
            return []
        old = sorted(f.getPath().getName() for f in files.listStatus(path))
        old = [n for n in old if n < kept[0]]
        for name in old:
            files.delete(self._files(f"{VERSIONS}/{name}")[1], True)
        return old

    def _path(self, name: str) -> str:
        versions = [self.version] if self.version else self.complete_versions()
        return f"{self.root}/{VERSIONS}/{versions[-1]}/{name}" if versions else f"{self.root}/{name}"

    def write(
        self, df: DataFrame, name: str, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write and return the written table; outside of a refresh, in the current version.

        With ``partition_by`` rows are first rebalanced on those columns: AQE
        splits a hot value over several tasks and merges small ones, so the
        table gets few, even files.
        """
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.database is not None:
            writer.format("parquet").saveAsTable(f"{self.database}.{name}")
        else:
            writer.parquet(self._path(name))
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        if self.database is not None:
            return self.spark.read.table(f"{self.database}.{name}")
        return self.spark.read.parquet(self._path(name))


def build_views(
    queries: Mapping[str, str], tables: Mapping[str, DataFrame], warehouse: Warehouse
) -> dict[str, DataFrame]:
    """Create or replace report views, given as SQL with the tables' names in braces.

    They are views of the session; with a ``database`` also permanent ones in it, which
    keep the SQL and so show what the tables hold when they are read."""
    spark, views = warehouse.spark, {}
    for name, query in queries.items():
        views[name] = spark.sql(query, **tables)
        views[name].createOrReplaceTempView(name)
        if warehouse.database is not None:
            own = query.format(**{t: f"{warehouse.database}.{t}" for t in tables})
            spark.sql(f"CREATE OR REPLACE VIEW {warehouse.database}.{name} AS {own}")
    return views


@dataclass(frozen=True)
class JdbcTarget:
    """An external database that a run copies its tables to."""

    url: str
    properties: Mapping[str, str]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a target table, in its order and types; NaN becomes NULL, and text
    compares as the target has it."""
    typed = df.select(*[nan_to_null(df, f.name).cast(f.dataType).alias(f.name) for f in schema])
    return plain(typed)


def column_types(schema: T.StructType, text_width: int | None = None) -> str:
    """Column types for a table created in an external database: whole numbers
    BIGINT, text VARCHAR of a given width, everything else as it is. Without a
    width text is left to the database's unbounded type."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    parts = []
    for f in schema:
        if isinstance(f.dataType, T.StringType):
            if text_width is None:
                continue
            kind = f"VARCHAR({text_width})"
        else:
            kind = "BIGINT" if isinstance(f.dataType, whole) else f.dataType.simpleString().upper()
        parts.append(f"`{f.name}` {kind}")
    return ", ".join(parts)


def jdbc_options(
    schema: T.StructType, properties: Mapping[str, str], text_width: int | None = None
) -> dict[str, str]:
    types = column_types(schema, text_width)
    return {**({"createTableColumnTypes": types} if types else {}), **properties}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    text_width: int | None = None,
) -> None:
    """Full refresh of a table in an external database.

    Needs the database's JDBC driver on the class path. Every partition opens
    one connection; ``numPartitions`` and ``batchsize`` in ``properties`` bound
    the load on the server.
    """
    options = jdbc_options(df.schema, properties, text_width)
    conform(df, df.schema).write.jdbc(url, table, mode="overwrite", properties=options)
