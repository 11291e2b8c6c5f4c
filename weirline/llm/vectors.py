"""Vectors as packed bytes: what both embedding operators read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def usable(vector: str) -> Column:
    """Not null, with no null or non-finite component, and not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def width(df: DataFrame, vector: str) -> np.dtype:
    """Packed as 32-bit floats if the column holds those, else as doubles."""
    single = isinstance(df.schema[vector].dataType.elementType, T.FloatType)
    return np.dtype("<f4" if single else "<f8")


def packed(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """``id, dim, vec`` of the rows with usable vectors, the components as bytes."""
    dtype = width(df, vector)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
            data, size = flat.tobytes(), dtype.itemsize
            ends = np.cumsum(batch.column(1).to_numpy(zero_copy_only=False)) * size
            starts = np.concatenate([[0], ends[:-1]]).astype(int)
            vecs = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(vecs, pa.binary())],
                names=["id", "dim", "vec"],
            )

    kept = df.where(usable(vector)).select(
        F.col(id_col).cast("long").alias("id"), F.size(vector).alias("dim"), vector
    )
    return kept.mapInArrow(pack, "id long, dim int, vec binary")


def matrix(vecs, dtype: np.dtype, dim: int) -> np.ndarray:
    """Packed vectors as rows of doubles."""
    return np.frombuffer(b"".join(vecs), dtype).reshape(-1, dim).astype(np.float64)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; the largest component is divided out first, so that very
    large and very small vectors keep their direction."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)
