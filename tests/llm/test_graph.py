import random

from weirline.llm import graph
from weirline.llm.graph import components


def expected(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for e in edges for x in e if e[0] != e[1] or root(x) != x}


def check(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {x: c for x, c in expected([e for e in edges if e[0] != e[1]]).items()}


def test_random_graphs(spark):
    rng = random.Random(4)
    check(spark, [(rng.randrange(200), rng.randrange(200)) for _ in range(150)])


def test_path_and_hub(spark):
    check(spark, [(i, i + 1) for i in range(60)])
    check(spark, [(500, i) for i in range(300)] + [(-5, 7)])


def test_no_edges_loops_and_repeats(spark):
    check(spark, [])
    check(spark, [(1, 1)])
    check(spark, [(2, 1), (1, 2), (2, 1)])


def test_a_hub_is_split(spark):
    """A star of a third of the edges: the join of edges and minima is dealt out anew."""
    few = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k, None) for k in few}
    for k, v in few.items():
        spark.conf.set(k, v)
    try:
        star = spark.range(1, 20_001).selectExpr("0L a", "id b")
        pairs = spark.range(20_000).selectExpr("100000 + 2 * id a", "100001 + 2 * id b")
        edges = star.union(pairs).union(pairs.selectExpr("a + 1000000", "b + 1000000"))
        linked = graph._large_star(edges.repartition(8))
        assert len(linked.collect()) == 60_000
        assert "skew=true" in linked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
