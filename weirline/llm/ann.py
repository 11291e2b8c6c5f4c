"""Approximate nearest neighbours by inner product in a hierarchical k-means tree.

The tree is fitted on a bounded sample (lengths too rare in it have one leaf); every row goes to the leaf that a walk to the
nearest centre leads to. A query walks the tree best bin first: from the root, a priority
queue always opens the branch whose centre has the largest inner product with the query,
plus the query's length times the branch's spread. That gives an order of leaves. How many of
them are visited is widened until a calibration sample of queries, compared with all rows,
reaches the wanted recall; if it takes all leaves, the search is exact. A query whose leaves
hold fewer rows than it wants neighbours opens further ones until they hold enough.

Leaves meet their queries in blocks of bounded size, so a leaf that holds a third of the
rows is many tasks. Candidates are scored exactly, in doubles, on the original vectors.

Defined results: vectors that are null, empty or zero, or hold null or non-finite
components, take no part, nor do rows without id; vectors are compared with those of their
own length only, each length in a tree of its own; scores beyond a double are infinite; rows
that repeat id and vector count once; of rows that share an id each vector is a candidate
and, if asked, a query with ranks of its own, but no neighbour of the others; ties go to the
smaller id; a query has fewer neighbours if there are fewer candidates; an empty table
gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirline.llm.common import cut
from weirline.llm.vectors import matrix, packed, width


@dataclass(frozen=True)
class Settings:
    neighbours: int = 20
    branch: int = 8
    leaf_rows: int = 96  # sampled rows that a leaf holds at most
    max_sample: int = 20_000  # bound of the rows that the tree is fitted on
    max_calibration: int = 200  # bound of the queries of a length compared with all rows
    recall: float = 0.96
    rounds: int = 8
    block_rows: int = 8192
    block_queries: int = 2048
    seed: int = 5


@dataclass
class Tree:
    """Nodes in an array: children of each, and their centres and spreads."""

    children: list[list[int]] = field(default_factory=list)
    centres: list[np.ndarray] = field(default_factory=list)
    spreads: list[float] = field(default_factory=list)
    leaves: list[int] = field(default_factory=list)  # node of each leaf

    def __post_init__(self):
        self.leaf_of = {node: leaf for leaf, node in enumerate(self.leaves)}

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row: down to the nearest centre at every level."""
        rows = _tame(rows)
        at = np.zeros(len(rows), np.int64)
        waiting = [0]
        while waiting:
            node = waiting.pop()
            if not self.children[node]:
                continue
            here = np.flatnonzero(at == node)
            if len(here):
                kids = np.array(self.children[node])
                centres = np.stack([self.centres[k] for k in kids])
                distance = (centres**2).sum(1)[None, :] - 2 * rows[here] @ centres.T
                at[here] = kids[distance.argmin(1)]
                waiting += kids.tolist()
        return np.array([self.leaf_of[n] for n in at.tolist()], np.int64)

    def visits(
        self, query: np.ndarray, most: int | None = None, held: np.ndarray | None = None,
        least: int = 0,
    ) -> list[int]:
        """Leaves in the order in which a best-bin-first walk opens them: ``most``, and more
        until those opened hold ``least`` rows, of which leaf i has ``held[i]``."""
        query = _tame(query)
        length, found, rows = float(np.linalg.norm(query)), [], 0
        queue = [(0.0, 0)]
        while queue and (most is None or len(found) < most or rows < least):
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                found.append(self.leaf_of[node])
                rows += 0 if held is None else int(held[found[-1]])
            for kid in self.children[node]:
                promise = float(self.centres[kid] @ query) + length * self.spreads[kid]
                heapq.heappush(queue, (-promise, kid))
        return found


SINGLE = Tree([[]], [], [], [0])  # of a length that no sampled row has


def _tame(rows: np.ndarray) -> np.ndarray:
    """For the walk only: components so large that their squares overflow are cut."""
    return np.clip(rows, -1e100, 1e100)


def _kmeans(rows: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    centres = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        nearest = ((centres**2).sum(1)[None, :] - 2 * rows @ centres.T).argmin(1)
        for j in range(k):
            own = rows[nearest == j]
            if len(own):
                centres[j] = own.mean(0)
    return ((centres**2).sum(1)[None, :] - 2 * rows @ centres.T).argmin(1)


def fit(rows: np.ndarray, settings: Settings) -> Tree:
    """Tree over sampled vectors. Its height and size are bounded by the sample."""
    rng, rows = np.random.default_rng(settings.seed), _tame(rows)
    children, centres, spreads, leaves = [[]], [rows.mean(0)], [0.0], []
    waiting = [(0, np.arange(len(rows)))]
    while waiting:
        node, own = waiting.pop()
        if len(own) > settings.leaf_rows:
            part = _kmeans(rows[own], settings.branch, settings.rounds, rng)
            groups = [own[part == j] for j in range(settings.branch)]
            groups = [g for g in groups if len(g)]
            if len(groups) > 1:
                for group in groups:
                    centre = rows[group].mean(0)
                    children[node].append(len(children))
                    waiting.append((len(children), group))
                    children.append([])
                    centres.append(centre)
                    # Deviation along one direction, the query's.
                    spread = ((rows[group] - centre) ** 2).sum(1).mean() / rows.shape[1]
                    spreads.append(float(np.sqrt(spread)))
                continue
        leaves.append(node)
    return Tree(children, centres, spreads, leaves)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def _search(queries: np.ndarray, query_ids, rows: np.ndarray, ids, k: int) -> Iterator[tuple]:
    """Per query its place, and the places and scores of the k best rows but those of its id.
    The products pick a few more than k, which are scored again one by one, so that equal
    vectors have equal scores."""
    with np.errstate(over="ignore", invalid="ignore"):
        products = np.nan_to_num(queries @ rows.T, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        largest = max(np.linalg.norm(rows, axis=1).max(), 1e-300)
        slack = np.nan_to_num(1e-9 * np.linalg.norm(queries, axis=1) * largest, nan=np.inf)
    for i, query in enumerate(query_ids):
        allowed = np.flatnonzero(ids != query)
        if not len(allowed):
            continue
        rough = products[i, allowed]
        near = allowed
        if len(rough) > k and np.isfinite(slack[i]):
            near = allowed[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack[i]]
        with np.errstate(over="ignore", invalid="ignore"):
            scores = (rows[near] * queries[i]).sum(1)
        best = _best(scores, ids[near], k)
        yield i, near[best], scores[best]


def _hits(asked: pd.DataFrame, rows: pd.DataFrame, dtype, dim: int, k: int) -> pd.DataFrame:
    """Best of ``rows`` (``id, leaf, vec``) per query of ``asked`` (``query, query_id, vec``)."""
    found = []
    if len(rows) and len(asked):
        found = list(_search(
            matrix(asked["vec"], dtype, dim), asked["query_id"].to_numpy(),
            matrix(rows["vec"], dtype, dim), rows["id"].to_numpy(), k,
        ))
    if not found:
        return pd.DataFrame({c: [] for c in ("query", "query_id", "vec_id", "score", "leaf")})
    who = np.concatenate([np.full(len(at), i) for i, at, _ in found])
    at = np.concatenate([at for _, at, _ in found])
    return pd.DataFrame(
        {
            "query": asked["query"].to_numpy()[who],
            "query_id": asked["query_id"].to_numpy()[who],
            "vec_id": rows["id"].to_numpy()[at],
            "score": np.concatenate([scores for _, _, scores in found]),
            "leaf": rows["leaf"].to_numpy()[at],
        }
    )


HITS = "query long, query_id long, vec_id long, score double, leaf int"


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _lengths(dims: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each length with its places."""
    for dim in np.unique(dims).tolist():
        yield dim, np.flatnonzero(dims == dim)


def search(
    df: DataFrame, is_query: Column, settings: Settings | None = None, *, id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for each row that ``is_query`` (a condition on
    ``id``, or on nothing else) holds for."""
    settings, dtype = settings or Settings(), width(df, vector_col)
    k, spark = settings.neighbours, df.sparkSession
    usual = packed(df, id_col, vector_col).where("id is not null")
    rows = cut(usual.distinct())

    by_hash = [F.xxhash64(F.lit(settings.seed), "id"), F.col("id"), F.col("dim"), F.col("vec")]
    sample = rows.orderBy(*by_hash).limit(settings.max_sample).toPandas()
    if sample.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    trees = {
        dim: fit(matrix(sample["vec"].iloc[at], dtype, dim), settings)
        for dim, at in _lengths(sample["dim"].to_numpy())
    }

    @F.pandas_udf("int")
    def leaf(dims: pd.Series, vecs: pd.Series) -> pd.Series:
        found = np.zeros(len(vecs), np.int32)
        for dim, at in _lengths(dims.to_numpy()):
            found[at] = trees.get(dim, SINGLE).assign(matrix(vecs.iloc[at], dtype, dim))
        return pd.Series(found)

    placed = cut(
        rows.select(
            "id", "dim", "vec", leaf("dim", "vec").alias("leaf"),
            F.monotonically_increasing_id().alias("query"),
        )
    )
    queries = placed.where(is_query).withColumnRenamed("id", "query_id").drop("leaf")
    # At most as many lengths as the sample has room for, and their leaves.
    split = [dim for dim, tree in trees.items() if len(tree.leaves) > 1]
    visited, held = {}, {dim: np.zeros(len(trees[dim].leaves), np.int64) for dim in split}
    if split:
        several = F.col("dim").isin(split)
        each = min(settings.max_calibration, max(1, settings.max_sample // len(split)))
        order = Window.partitionBy("dim").orderBy(
            F.xxhash64(F.lit(settings.seed), "query_id"), "query_id", "vec"
        )
        asked = queries.where(several).withColumn("n", F.row_number().over(order))
        asked = asked.where(F.col("n") <= each).drop("n").toPandas()
        visited = _calibrate(placed.where(several), asked, trees, dtype, settings)
        for row in placed.where(several).groupBy("dim", "leaf").count().collect():
            held[row["dim"]][row["leaf"]] = row["count"]

    @F.pandas_udf("array<int>")
    def opened(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for dims, vecs, own in batches:
            found = pd.Series([[0]] * len(vecs))
            for dim, at in _lengths(dims.to_numpy()):
                if dim in visited:
                    # A query may meet all rows of its id.
                    vectors, least = matrix(vecs.iloc[at], dtype, dim), k + own.to_numpy()
                    for i, vector in zip(at.tolist(), vectors, strict=True):
                        found[i] = trees[dim].visits(vector, visited[dim], held[dim], least[i])
            yield found

    shared = rows.groupBy("id", "dim").agg(F.count(F.lit(1)).alias("own")).where("own > 1")
    owned = queries.join(shared.withColumnRenamed("id", "query_id"), ["query_id", "dim"], "left")
    leaves = opened("dim", "vec", F.coalesce("own", F.lit(1).cast("long")))
    named = [F.col(c).alias(c) for c in ("query", "query_id", "dim", "vec")]  # apart from placed's
    asked = cut(owned.select(*named, F.explode(leaves).alias("leaf")))
    # One row per leaf: bounded by the sample, but for lengths that it has no row of.
    blocks = (
        placed.groupBy("dim", "leaf").agg(F.ceil(F.count("id") / settings.block_rows).alias("rows"))
        .join(
            asked.groupBy("dim", "leaf")
            .agg(F.ceil(F.count("query") / settings.block_queries).alias("queries")),
            ["dim", "leaf"],
        )
    )

    def dealt(frame, id_col, own, other):
        """Each row to its own block, against all blocks of the other side."""
        here = blocks.select(*(F.col(c).alias(c) for c in ("dim", "leaf", "rows", "queries")))
        return (
            frame.join(F.broadcast(here), ["dim", "leaf"])
            .withColumn(f"{own} block", F.pmod(F.xxhash64(id_col), F.col(own)))
            .withColumn(f"{other} block", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        )

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        dim = 0 if left.empty else int(left["dim"].iloc[0])
        return _hits(right, left, dtype, dim, k).drop(columns="leaf")

    task = ["dim", "leaf", "rows block", "queries block"]
    hits = (
        dealt(placed.drop("query"), "id", "rows", "queries").groupBy(*task)
        .cogroup(dealt(asked, "query", "queries", "rows").groupBy(*task))
        .applyInPandas(compare, HITS.removesuffix(", leaf int"))
    )
    return _ranked(hits, k).select("query_id", "rank", "vec_id", "score")


def _calibrate(
    placed: DataFrame, asked: pd.DataFrame, trees: dict[int, Tree], dtype, settings: Settings
) -> dict[int, int]:
    """Leaves to visit by length, so that the sampled queries find the wanted share of their
    true neighbours; those come from a comparison with all rows."""
    if asked.empty:
        return {}
    k, by_dim = settings.neighbours, dict(list(asked.groupby("dim")))

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, at in _lengths(batch["dim"].to_numpy()):
                if dim in by_dim:
                    yield _hits(by_dim[dim], batch.iloc[at], dtype, dim, k)

    hits = placed.drop("query").mapInPandas(exact, HITS)
    truth = dict(list(_ranked(hits, k).select("query", "leaf").toPandas().groupby("query")["leaf"]))
    visited = {}
    for dim, own in by_dim.items():
        needed = []
        for query, vector in zip(own["query"], matrix(own["vec"], dtype, dim), strict=True):
            order = {leaf: i for i, leaf in enumerate(trees[dim].visits(vector))}
            needed += [order[leaf] for leaf in truth.get(query, ())]
        needed.sort()
        at = min(len(needed) - 1, int(np.ceil(settings.recall * len(needed))) - 1)
        visited[dim] = needed[at] + 1 if needed else 1
    return visited
