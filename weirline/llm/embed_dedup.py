"""Embedding near-duplicates by p-stable hashing and exact cosine checks.

A table has ``hashes`` random projections of the unit vector, each shifted, divided
by ``width`` and floored; equal codes put vectors into one bucket. For unit vectors
at a distance c one code agrees with probability p(c) (``agreement``). The number of
hashes grows with the logarithm of the number of vectors, so that a bucket holds
about ``crowd`` unrelated ones, and the number of tables is such that a pair right at the
threshold is missed with probability ``miss`` at most, and closer pairs less often.

Equal vectors are one node, whatever their number. Each bucket is compared by matrix
products; buckets of more than ``BLOCK`` vectors are cut into blocks, and each pair of
blocks is a task of its own. A bucket puts out sums of links and spanning edges, never
pairs, so output is in proportion to its members; a link counts in the first table
in which its two vectors meet. All links between equal vectors count without comparing.

Defined results: vectors that are null, empty or zero, or hold null or non-finite
components, have no links and form a component of their own; vectors of different
lengths are never linked; a null id never names a component unless it is alone in
it; repeated rows are vectors of their own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirline.llm.common import cut
from weirline.llm.graph import components
from weirline.llm.vectors import matrix, packed, unit, usable, width

BLOCK = 2048


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.9
    width: float = 2.5
    crowd: float = 40.0
    miss: float = 0.002
    seed: int = 17


def agreement(distance: float, width: float) -> float:
    """Probability that one quantised Gaussian projection agrees."""
    r = width / distance
    normal = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def shape(vectors: int, settings: Settings) -> tuple[int, int]:
    """Hashes per table and number of tables for a number of distinct vectors."""
    far = agreement(math.sqrt(2), settings.width)
    near = agreement(math.sqrt(2 - 2 * settings.cosine), settings.width)
    hashes = max(1, math.ceil(math.log(max(vectors / settings.crowd, 2)) / -math.log(far)))
    tables = math.ceil(math.log(settings.miss) / math.log1p(-(near**hashes)))
    return hashes, tables


class Hashes:
    """Bucket keys of unit vectors; the same everywhere for the same dimension."""

    def __init__(self, hashes: int, tables: int, settings: Settings):
        self.hashes, self.tables, self.settings = hashes, tables, settings
        self.by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rng = np.random.default_rng(settings.seed)
        self.mix = rng.integers(1, 1 << 62, hashes, dtype=np.int64) | 1

    def keys(self, rows: np.ndarray) -> np.ndarray:
        """One 64-bit key per row and table, mixed from the table's codes."""
        dim = rows.shape[1]
        if dim not in self.by_dim:
            rng = np.random.default_rng([self.settings.seed, dim])
            n = self.hashes * self.tables
            self.by_dim[dim] = (rng.normal(size=(dim, n)), rng.uniform(0, 1, n))
        directions, shifts = self.by_dim[dim]
        codes = np.floor(rows @ directions / self.settings.width + shifts).astype(np.int64)
        codes = codes.reshape(len(rows), self.tables, self.hashes)
        with np.errstate(over="ignore"):
            return ((codes * self.mix) ^ (codes * self.mix >> 29)).sum(2) * self.mix[0] + dim


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest member that each member of a bucket is connected to."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(1)
        after = np.minimum(label, near)
        after = np.minimum(after, after[after])
        if (after == label).all():
            return label
        label = after


def _compare(table: int, ids, sizes, sides, rows, hashes: Hashes) -> tuple:
    """Links of one bucket (``sides`` all 0), or between two blocks (0 and 1): per
    member with links its id, the vectors linked in this table first, and a root."""
    none = (np.zeros(0, np.int64),) * 3
    linked = rows @ rows.T >= hashes.settings.cosine
    np.fill_diagonal(linked, False)
    if sides.any():
        linked &= sides[:, None] != sides[None, :]
    if not linked.any():
        return none
    some = np.flatnonzero(linked.any(1))
    linked = linked[np.ix_(some, some)]
    new = linked.copy()
    if table:
        keys = hashes.keys(rows[some])
        for earlier in range(table):
            new &= keys[:, None, earlier] != keys[None, :, earlier]
            if not new.any():
                break
    return ids[some], new @ sizes[some], ids[some][_roots(linked)]


def _bucket_tasks(batches: Iterator[pa.RecordBatch], dtype, hashes) -> Iterator[pa.RecordBatch]:
    """Compares bucket after bucket of a partition sorted by ``task``."""
    held = None
    names = ["node", "links", "root"]

    def results(data: pa.Table) -> Iterator[pa.RecordBatch]:
        table, dim, side, ids, sizes = (
            data.column(c).to_numpy() for c in ("table", "dim", "side", "node", "n")
        )
        vecs = data.column("vec").to_pylist()
        task = np.stack([data.column(c).to_numpy() for c in TASK])
        bounds = np.flatnonzero((task[:, 1:] != task[:, :-1]).any(0)) + 1
        found = []
        for a, b in zip([0, *bounds], [*bounds, len(ids)], strict=True):
            if b - a > 1:
                rows = unit(matrix(vecs[a:b], dtype, int(dim[a])))
                part = slice(a, b)
                found.append(
                    _compare(int(table[a]), ids[part], sizes[part], side[part], rows, hashes)
                )
        if found:
            columns = [np.concatenate(c) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    for batch in batches:
        data = pa.Table.from_batches([batch])
        held = data if held is None else pa.concat_tables([held, data])
        if held.num_rows < 2:
            continue
        task = np.stack([held.column(c).to_numpy() for c in TASK])
        (same,) = np.nonzero((task == task[:, -1:]).all(0))
        if same[0]:
            yield from results(held.slice(0, same[0]))
            held = held.slice(same[0])
    if held is not None and held.num_rows:
        yield from results(held)


TASK = ("table", "key", "dim", "low", "high")


def near_duplicates(
    df: DataFrame, settings: Settings | None = None, *, id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per row of ``df``: ``vec_id, n_links, component_id, kept``."""
    settings, dtype = settings or Settings(), width(df, vector_col)
    rows = packed(df, id_col, vector_col)
    nodes = cut(
        rows.groupBy("dim", "vec")
        .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    hashes = Hashes(*shape(nodes.count(), settings), settings)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                keys = hashes.keys(unit(matrix(part.column("vec").to_pylist(), dtype, int(dim))))
                n, t = keys.shape
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(part.column("node").to_numpy(), t)),
                        pa.array(np.full(n * t, dim, np.int32)),
                        pa.array(np.tile(np.arange(t, dtype=np.int32), n)),
                        pa.array(keys.ravel()),
                    ],
                    ["node", "dim", "table", "key"],
                )

    postings = cut(
        nodes.select("node", "dim", "vec").mapInArrow(
            keyed, "node long, dim int, table int, key long"
        )
    )
    bucket = ["table", "key", "dim"]
    sizes = postings.groupBy(*bucket).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    met = postings.join(sizes, bucket).withColumn("blocks", blocks)
    # A member of block i goes to the tasks (i, j) and (j, i) of all blocks j >= i.
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = met.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    tasks = met.select(
        "node", *bucket,
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
    )
    dealt = (
        tasks.join(nodes.select("node", "n", "vec"), "node")
        .repartition(*(F.col(c) for c in TASK)).sortWithinPartitions(*TASK)
    )
    found = cut(
        dealt.mapInArrow(
            lambda batches: _bucket_tasks(batches, dtype, hashes), "node long, links long, root long"
        )
    )
    links = found.groupBy("node").agg(F.sum("links").alias("others"))
    edges = found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    labels = components(edges.distinct())
    labelled = nodes.join(links, "node", "left").join(labels, "node", "left").select(
        "dim", "vec", "least",
        (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component"),
    )
    named = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    known = labelled.join(named, "component").select("dim", "vec", "n_links", "component_id")
    known = known.toDF("known dim", "known vec", "n_links", "component_id")
    same = (F.col("dim") == F.col("known dim")) & (F.col("vec") == F.col("known vec"))
    linked = rows.join(known, same).select("id", "n_links", "component_id")
    alone = df.where(~usable(vector_col)).select(
        F.col(id_col).cast("long").alias("id"), F.lit(0).cast("long").alias("n_links"),
        F.col(id_col).cast("long").alias("component_id"),
    )
    return linked.union(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
