"""Helpers shared by the operators: reading tables and cutting lineage."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDS = 5
ROW_GROUP = 16 << 20  # bytes
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 16 << 20  # of rows that travel to Python at a time


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares, from ``spark.checkpoint.dir``.

    Only where that is unset and all tasks run in this process (tests on one machine) a
    temporary folder is made."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named and not context.getCheckpointDir():
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the cluster shares")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="weirline-"))
    return named or context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder: later steps neither
    recompute it nor lose it with an executor. Spark's cleaner deletes the files
    once nothing refers to them, where the cluster asks for that."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Like ``cut``, as a compressed columnar table for wide rows; the files stay
    in the shared folder, which the cluster has to expire."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    # A task holds a row group of whole texts in memory, twice while it grows.
    with small_batches(spark, batch_bytes):
        df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_texts_at_a_time(spark: SparkSession) -> None:
    """From now on the session's jobs hold some megabytes of whole texts at a time where
    they go to Python and where they are written, in place of 10,000 rows and 128 MB."""
    spark.conf.set(ARROW_BYTES, str(BATCH_BYTES // 2))
    spark.conf.set("parquet.block.size", str(ROW_GROUP))


@contextlib.contextmanager
def small_batches(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> Iterator[None]:
    """While whole texts are written, few of them travel to Python at a time."""
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, str(batch_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_BYTES)
        else:
            spark.conf.set(ARROW_BYTES, before)


def bucketed(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Like ``stored``, dealt out by ``keys`` so that joins on them leave it in place.
    There are as many buckets as shuffle partitions. The files stay as those of ``stored``
    do, and nothing stays in the catalog."""
    spark = df.sparkSession
    table_name = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
        .option("compression", "zstd")
        .option("path", f"{shared_dir(spark).rstrip('/')}/{table_name}")
        .saveAsTable(table_name)
    )
    found = spark.table(table_name)
    # The plan has the files and their buckets; the catalog entry is not needed any more.
    spark.sql(f"DROP TABLE {table_name}")
    return found


def freeing(task: Callable) -> Callable:
    """A task function (batches in, batches out) that gives memory back at its end:
    Python workers are used again, and would keep what earlier tasks had at most."""

    @functools.wraps(task)
    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)

    return run


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is in fold 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS


def held_out(id_col: str = "doc_id") -> Column:
    return fold(id_col) == 0
