"""CSV in and out. Paths may be local, HDFS or object-store URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirline.functions.numbers import nan_to_null
from weirline.functions.text import na_to_null
from weirline.sources.schemas import POSITION, RAW_COLUMNS, raw_schema


# Quotes are doubled inside quoted fields, on both sides; spaces belong to the text.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

_TEXT_OPTIONS = {k: str(v).lower() for k, v in _CSV.items() if k != "header"}

_CORRUPT = "_corrupt"

# Stands for a quoted empty text while the reader tells it from a missing one.
_EMPTY = "\ue000empty\ue000"


_QUOTED_FIELD = r'(^|,)"(?:[^"]++|"")*+"(?=,|$)'
_OPEN_QUOTE = r'(^|,)"'


def csv_line(columns: Sequence[str]) -> Column:
    """Columns as one CSV record, as ``write_csv`` writes it."""
    return F.to_csv(F.struct(*columns), {**_TEXT_OPTIONS, "emptyValue": '""'})


def parse_csv_line(line: Column, ddl: str) -> Column:
    """The struct that ``csv_line`` was made from."""
    return F.from_csv(line, ddl, {**_TEXT_OPTIONS, "emptyValue": _EMPTY})


def real_text(col: Column) -> Column:
    """A text read with the sentinel for empty texts."""
    return F.when(col == _EMPTY, "").otherwise(col)


def _checked(df: DataFrame, schema: T.StructType, source: str) -> DataFrame:
    """Fails on a record with surplus fields or an open quote; short records, padded
    with NULLs by the reader, pass."""
    bad, field = F.col(_CORRUPT), F.col(schema[0].name)
    # The reader calls all of them corrupt; see what is left without quoted fields.
    bare = F.regexp_replace(bad, _QUOTED_FIELD, "$1")
    surplus = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= len(schema)
    broken = bad.isNotNull() & (F.rlike(bare, F.lit(_OPEN_QUOTE)) | surplus)
    message = F.concat_ws(" ", F.lit(f"malformed CSV record in {source}:"), bad, field)
    # The first column and the filter both depend on the check, so no pruning loses it.
    first = F.when(broken, F.raise_error(message).cast(schema[0].dataType)).otherwise(field)
    fine = F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    df = df.withColumn(schema[0].name, first).where(fine).drop(_CORRUPT)
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: real_text(F.col(c)) for c in texts})


def _read(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool
) -> DataFrame:
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .options(**_CSV)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("columnPruning", False)  # a pruning parser does not see surplus fields
        .option("emptyValue", _EMPTY)
        .csv(path)
    )


def read_raw(
    spark: SparkSession, path: str, entity: str, multi_line: bool = False
) -> DataFrame:
    """One raw extract as text, missing-value tokens as NULL, with row positions.

    ``_pos`` (file, split offset, row in split) orders rows as they stand in the
    files, whatever the partitioning; "keep the first copy" needs it and it is
    pruned from every plan that does not. A header that differs from the schema
    raises, and so do records with surplus fields or an open quote: without
    ``multi_line``, which allows line breaks inside quotes but makes a file
    unsplittable, a field with a line break is such a record.
    """
    raw = _read(spark, path, raw_schema(entity), multi_line)
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )
    raw = _checked(raw.withColumn(POSITION, position), raw_schema(entity), path)
    return raw.select(
        *[na_to_null(F.col(c)).alias(c) for c in RAW_COLUMNS[entity]],
        POSITION,
    )


def _csv_column(df: DataFrame, name: str) -> Column:
    """Decimals as plain text without trailing zeros, NaN as empty."""
    col, dtype = nan_to_null(df, name), df.schema[name].dataType
    if isinstance(dtype, T.DecimalType) and dtype.scale > 0:
        col = F.rtrim(F.rtrim(col.cast("string"), F.lit("0")), F.lit("."))
    return col.alias(name)


def write_csv(df: DataFrame, path: str) -> None:
    """Full refresh of a CSV directory, one file per task, each with a header.

    Missing values are written as nothing, empty texts as ``""``."""
    df = df.select(*[_csv_column(df, c) for c in df.columns])
    df.write.mode("overwrite").options(**_CSV).option("emptyValue", '""').csv(path)


def read_clean_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """What ``write_csv`` wrote: nothing is missing, ``""`` an empty text. Files are read
    whole, as texts may hold line breaks; say otherwise where they do not."""
    return _checked(_read(spark, path, schema, multi_line), schema, path)
