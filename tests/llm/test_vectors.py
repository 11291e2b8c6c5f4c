import numpy as np
import pytest
from cases import DATA, clash
from pyspark.sql import functions as F

from weirline.llm import ann, embed_dedup, queries
from weirline.llm.vectors import packed

NAN, INF = float("nan"), float("inf")
ODD = [
    (0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [0.95, 0.3, 0.0]), (3, None), (4, []),
    (5, [0.0, 0.0, 0.0]), (6, [NAN, 1.0, 0.0]), (7, [INF, 1.0, 0.0]), (8, [None, 1.0, 0.0]),
    (9, [1.0, 0.0]), (10, [1e300, 0.0, 0.0]), (11, [0.0, 1.0, 0.0]), (11, [0.0, 1.0, 0.0]),
    (None, [0.0, -1.0, 0.0]), (12, [-0.0, 0.0, 1e-300]), (13, [0.0, 0.0, 5.0]),
]


def frame(spark, rows, kind="double"):
    return clash(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int"))


def odd(spark):
    return frame(spark, [(i, v, 0) for i, v in ODD])


def clusters(seed, n=300, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim))
    rows = centres[rng.integers(0, 20, n)] + rng.normal(size=(n, dim)) * rng.uniform(0.02, 0.5, (n, 1))
    rows[:40] = rows[0]  # a third or so of equal vectors
    return rows


def brute(rows):
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    label = np.arange(len(rows))
    for _ in rows:
        label = np.minimum(label, np.where(linked, label[None], len(rows)).min(1))
    return linked.sum(1), label


def test_dedup_of_awkward_vectors(spark):
    found = embed_dedup.near_duplicates(odd(spark)).collect()
    rows = sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id, r.kept) for r in found)
    assert rows == [
        (-1, 0, None, True), (0, 3, 0, True), (1, 3, 0, False), (2, 3, 0, False), (3, 0, 3, True),
        (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True),
        (9, 0, 9, True), (10, 3, 0, False), (11, 1, 11, True), (11, 1, 11, True), (12, 1, 12, True),
        (13, 1, 12, False),
    ]
    assert embed_dedup.near_duplicates(frame(spark, [])).collect() == []


@pytest.mark.parametrize("block", [2048, 8])
def test_dedup_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    rows = clusters(1)
    found = embed_dedup.near_duplicates(
        frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(rows)]),
        embed_dedup.Settings(miss=1e-9),
    ).collect()
    links, label = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in found}
    assert got == {i: (links[i], label[i]) for i in range(len(rows))}


def test_agreement_is_the_share_of_equal_codes():
    rng = np.random.default_rng(0)
    steps = rng.normal(size=200_000) * 0.5 / 2.5
    shifts = rng.uniform(0, 1, 200_000)
    share = (np.floor(shifts) == np.floor(shifts + steps)).mean()
    assert abs(share - embed_dedup.agreement(0.5, 2.5)) < 0.005


def test_whole_table_dedup(spark):
    found = embed_dedup.near_duplicates(spark.read.parquet(f"{DATA}/embeddings.parquet")).toPandas()
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas().sort_values("vec_id")
    links, label = brute(np.stack(table["embedding"]).astype(float))
    found = found.sort_values("vec_id")
    assert (found.n_links.to_numpy() == links).all()
    assert (found.component_id.to_numpy() == table["vec_id"].to_numpy()[label]).all()


def exact(ids, rows, query, k):
    scores = rows @ rows[query]
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[query]][:k]
    return [(int(ids[i]), scores[i]) for i in order]


def test_search_of_awkward_vectors(spark):
    found = ann.search(odd(spark), F.col("id") % 2 == 0, ann.Settings(neighbours=3)).collect()
    by = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r.vec_id)
    # The double 1e300 is finite and largest; ids 3 to 8 and 9 (other length) take no part.
    assert by[0] == [10, 1, 2] and by[12] == [13, 0, 1] and set(by) == {0, 2, 10, 12}
    assert ann.search(frame(spark, []), F.col("id") % 2 == 0).collect() == []
    one = frame(spark, [(0, [1.0], 0)])
    assert ann.search(one, F.col("id") % 2 == 0).collect() == []


@pytest.mark.parametrize("blocks", [(8192, 2048), (16, 4)])
def test_search_with_all_leaves_is_exact(spark, blocks):
    rows = clusters(2)
    settings = ann.Settings(
        neighbours=7, leaf_rows=20, recall=1.0, max_calibration=1000, block_rows=blocks[0],
        block_queries=blocks[1],
    )
    df = frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(rows)])
    found = ann.search(df, F.col("id") % 10 == 0, settings).toPandas()
    ids = np.arange(len(rows))
    for query, own in found.groupby("query_id"):
        own = own.sort_values("rank")
        want = exact(ids, rows, query, 7)
        assert own["vec_id"].tolist() == [i for i, _ in want]
        assert np.allclose(own["score"], [s for _, s in want], rtol=1e-12)
    assert found["query_id"].nunique() == 30


def test_tree_assigns_and_visits_every_leaf():
    rows = clusters(3)
    tree = ann.fit(rows, ann.Settings(leaf_rows=16))
    leaves = tree.assign(rows)
    assert set(leaves) <= set(range(len(tree.leaves)))
    assert sorted(tree.visits(rows[0])) == list(range(len(tree.leaves)))
    assert tree.visits(rows[5], 3) == tree.visits(rows[5])[:3]


def test_sparse_regions_get_all_their_neighbours(spark):
    rng = np.random.default_rng(6)
    dense = np.repeat(np.eye(60)[:30], 100, axis=0)  # one leaf each, and most queries
    sparse = np.hstack([np.zeros((48, 30)), rng.normal(size=(48, 30)) * 0.3])  # leaves of a few rows
    rows = np.vstack([dense, sparse])
    settings = ann.Settings(leaf_rows=20)
    df = frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(rows)])
    found = ann.search(df, F.col("id") % 3 == 0, settings).toPandas()
    counts = found.groupby("query_id").size()
    assert sorted(counts.index) == list(range(0, len(rows), 3))
    assert set(counts) == {20}
    assert not (found["query_id"] == found["vec_id"]).any()
    few = ann.search(df.where("vec_id % 150 = 0"), F.col("id") % 3 == 0, settings).toPandas()
    assert set(few.groupby("query_id").size()) == {len(range(0, len(rows), 150)) - 1}


@pytest.mark.parametrize("sample", [20_000, 60])
def test_search_of_mixed_lengths_and_repeated_ids(spark, sample):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4 if i % 5 else 3).tolist(), 0) for i in range(300)]
    rows += [(1000, [0.5, 0.5], 0), (1002, [1.0, 0.0], 0)]  # a length of two rows
    rows += [(i, rng.normal(size=4).tolist(), 0) for i in (4, 4, 8, 299)]  # repeated ids
    rows += rows[:3]  # repeated rows
    settings = ann.Settings(
        neighbours=7, leaf_rows=20, recall=1.0, max_sample=sample, max_calibration=1000
    )
    found = ann.search(frame(spark, rows), F.col("id") % 2 == 0, settings).collect()
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in found)
    want, once = [], {(i, tuple(v)) for i, v, _ in rows}
    for query, vector in once:
        if query % 2 == 0:
            near = [(-np.dot(v, vector), i) for i, v in once if len(v) == len(vector) and i != query]
            best = enumerate(sorted(near)[:7], 1)
            want += [(query, rank, i, round(-score, 9)) for rank, (score, i) in best]
    assert {1000, 0, 4} <= {q for q, *_ in got}
    if sample == 20_000:  # all leaves
        assert got == sorted(want)
    else:  # 60 sampled rows, so fewer calibration queries
        assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
        assert len(set(got) & set(want)) >= 0.8 * len(want)


def test_recall_on_a_whole_table(spark):
    sf = str(DATA).replace("0.001", "0.1")
    found = queries.op6_nearest_neighbours(spark, sf).toPandas()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, rows = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    hits = total = 0
    for query, own in found.groupby("query_id"):
        want = {i for i, _ in exact(ids, rows, int(np.searchsorted(ids, query)), 20)}
        hits, total = hits + len(want & set(own["vec_id"])), total + len(want)
    assert found["query_id"].nunique() == (ids % 20 == 0).sum()
    assert hits / total >= 0.9


def test_packed_keeps_the_bytes(spark):
    df = frame(spark, [(1, [0.1, -2.5], 0)], "float")
    (row,) = packed(df, "vec_id", "embedding").collect()
    assert (row.dim, bytes(row.vec)) == (2, np.array([0.1, -2.5], "<f4").tobytes())
