"""One key holding a third of all rows: right results and split work."""

import pytest
from pyspark.sql import functions as F

from weirline.operators.rows import keep_first
from weirline.plans import gold, silver
from weirline.workload import bindings

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.files.maxPartitionBytes": "256k",
}


@pytest.fixture
def cluster_like(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _executed(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_sends_one_row_per_task(cluster_like):
    n = 200_000
    df = cluster_like.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.lit(n) - F.col("id")).alias("x"),
    )
    got = keep_first(df, ["k"], copies="n")
    hot = got.where("k = -1").first()
    assert (hot.x, hot.n) == (2, (n + 2) // 3)  # id 199998 is the last multiple of 3
    assert got.count() == n - hot.n + 1


@pytest.fixture(scope="module")
def hot_tables(spark, tmp_path_factory):
    """TPC-H-like tables in which one order, one buyer and one part are hot."""
    out = tmp_path_factory.mktemp("hot")
    n, orders = 300_000, 30_000
    hot = lambda c, value: F.when(F.col("id") % 3 == 0, F.lit(value)).otherwise(c)
    spread = F.pmod(F.xxhash64("id"), F.lit(orders))
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(F.xxhash64("id"), F.lit(400)).cast("int"))
    tables = {
        "region": spark.createDataFrame([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
        "nation": spark.range(4).selectExpr(
            "cast(id as int) n_nationkey", "concat('N', id) n_name", "cast(id % 2 as int) n_regionkey"
        ),
        "customer": spark.range(2000).selectExpr(
            "id c_custkey", "cast(id % 4 as int) c_nationkey", "'A' c_mktsegment"
        ),
        "orders": spark.range(orders).select(
            F.col("id").alias("o_orderkey"),
            hot(F.pmod(F.xxhash64("id"), F.lit(2000)), 7).alias("o_custkey"),
            F.lit(1000.0).alias("o_totalprice"),
            day.cast("timestamp_ntz").alias("o_orderdate"),
        ),
        "part": spark.range(5000).selectExpr(
            "id p_partkey", "'T' p_type", "'B' p_brand", "cast(id % 50 as int) p_size",
            "1.0D p_retailprice",
        ),
        "lineitem": spark.range(0, n, 1, 8).select(
            hot(spread, 11).alias("l_orderkey"),
            hot(F.pmod(F.xxhash64("id"), F.lit(5000)), 13).alias("l_partkey"),
            F.col("id").alias("l_suppkey"),
            (F.pmod(F.xxhash64("id"), F.lit(7)) + 1).cast("int").alias("l_linenumber"),
            (F.pmod(F.xxhash64("id"), F.lit(60000)) + 0.25).cast("double").alias("l_extendedprice"),
            F.lit(0.05).alias("l_discount"),
            F.lit(0.01).alias("l_tax"),
        ),
    }
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}.parquet")
    return str(out)


def test_hot_order_is_split_in_the_join(cluster_like, hot_tables):
    raw = bindings.orders_raw(bindings.Tables(cluster_like, hot_tables))
    rows, plan = _executed(raw.agg(F.count("*").alias("n"), F.sum("order_value").alias("v")))
    assert rows[0].n == 300_000
    assert "skew=true" in plan


def test_hot_product_is_split_in_the_enriched_fact(cluster_like, hot_tables):
    lines = cluster_like.read.parquet(f"{hot_tables}/lineitem.parquet").select(
        F.col("l_suppkey").alias("order_id"),
        F.lit("2024-01-01").cast("date").alias("order_date"),
        F.col("l_orderkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.lit("R").alias("region"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("order_value"),
        F.col("l_discount").cast("decimal(9,6)").alias("discount_pct"),
    )
    products = cluster_like.range(5000).selectExpr(
        "id product_id", "'X' category", "cast(0.2 as decimal(9,6)) margin_pct"
    )
    enriched = gold.fact_revenue_enriched(lines, products)
    rows, plan = _executed(enriched.agg(F.count("*").alias("n"), F.sum("gross_margin").alias("m")))
    assert rows[0].n == 300_000 and "skew=true" in plan
    # The same margin, to the cent per row, from sums that never met a hot join key.
    sums = gold.sales_by(lines, products, ["region"])
    total = sums.agg(F.sum(F.col("revenue") * F.col("margin_pct"))).first()[0]
    assert abs(total - rows[0].m) < 300_000 * 0.005


def test_leakage_on_hot_tables_equals_pandas(cluster_like, hot_tables):
    tables = bindings.Tables(cluster_like, hot_tables)
    orders = bindings.clean_orders(tables)
    late = silver.clean_orders(bindings.orders_raw(tables), bindings.SETTINGS)
    assert orders.exceptAll(late.select(orders.columns)).isEmpty()
    assert orders.count() == late.count()
    products = silver.clean_products(bindings.products_raw(tables), bindings.SETTINGS)
    got = {
        r.region: float(r.v)
        for r in gold.fact_revenue(orders, products)
        .groupBy("region").agg(F.sum("revenue").alias("v")).collect()
    }
    read = lambda t: cluster_like.read.parquet(f"{hot_tables}/{t}.parquet").toPandas()
    lines = read("lineitem").sort_values(["l_partkey", "l_suppkey"], kind="stable")
    lines = lines.drop_duplicates(["l_orderkey", "l_linenumber"])
    lines = lines[lines.l_extendedprice <= 50000]
    regions = read("customer").merge(read("nation"), left_on="c_nationkey", right_on="n_nationkey")
    regions = regions.merge(read("region"), left_on="n_regionkey", right_on="r_regionkey")
    heads = read("orders").merge(regions, left_on="o_custkey", right_on="c_custkey")
    want = lines.merge(heads, left_on="l_orderkey", right_on="o_orderkey")
    want = want.groupby("r_name").l_extendedprice.sum().to_dict()
    assert {k: round(v, 2) for k, v in got.items()} == {k: round(v, 2) for k, v in want.items()}
