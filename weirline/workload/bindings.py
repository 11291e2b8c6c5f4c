"""Raw extracts derived from the TPC-H-like tables, dirt included.

Each function states one extract as lazy expressions over the Parquet files;
``oracle.py`` states the same in SQL.
"""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirline.plans import silver
from weirline.settings import MONEY, Settings
from weirline.sources.schemas import LINE, POSITION

SETTINGS = Settings(
    uplift_region="ASIA",
    region_rules={
        "AFRICA": ("Pricing Erosion", "Medium"),
        "AMERICA": ("Funnel Drop-off", "High"),
        "ASIA": ("Operational Gap", "Medium"),
    },
    base_price=MONEY,
    collation=None,
)

# The same rules over regions in several spellings.
MIXED_CASE = replace(SETTINGS, collation="UNICODE_CI_AI")

# Other report labels for the same event types.
RELABELLED = replace(
    SETTINGS, event_labels={"visit": "View", "add_to_cart": "Cart", "purchase": "Sale"}
)

# Text forms of a count, by event_id % 20; every other event has "1.0".
COUNT_TEXTS = {0: "", 1: "NA", 2: "null", 3: "NaN", 4: " NA "}


# Columns of the tables in use. Given, so that opening a table
# starts no job to read footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


class Tables:
    """The Parquet tables of one folder; each is listed and opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str, mixed_case: bool = False):
        self.spark, self.sf_dir, self._mixed_case = spark, sf_dir, mixed_case
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            reader = self.spark.read.schema(SCHEMAS[name])
            self._open[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._open[name]

    def region(self, key: Column) -> Column:
        """The region, spelled by ``key`` where spellings are mixed."""
        region = F.col("region")
        if not self._mixed_case:
            return region
        accented = F.translate(region, "A", "Á")
        return _spelling(F.when(key % 7 == 3, accented).otherwise(region), key).alias("region")

    def product(self, key: Column, spelled_by: Column | None = None) -> Column:
        """The product's number, or a code in mixed spellings."""
        if not self._mixed_case:
            return key.alias("product_id")
        code = F.concat(F.lit("Prd-"), key.cast("string"))
        return (code if spelled_by is None else _spelling(code, spelled_by)).alias("product_id")

    @cached_property
    def customer_region(self) -> DataFrame:
        return (
            self["customer"]
            .join(self["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self["region"], F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "c_mktsegment", F.col("r_name").alias("region"))
        )

    @cached_property
    def order_region(self) -> DataFrame:
        buyers = self.customer_region.select("c_custkey", "region")
        return (
            self["orders"]
            .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                "o_orderkey",
                F.to_date("o_orderdate").alias("order_date"),
                "o_custkey",
                "region",
                "o_totalprice",
            )
        )


def _copies(df: DataFrame, twice: Column) -> DataFrame:
    """Emit rows matching ``twice`` two times, in the same pass."""
    n = F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_copy", F.explode(n)).drop("_copy")


def _spelling(text: Column, key: Column) -> Column:
    """Upper, lower or unchanged, by key % 3."""
    return (
        F.when(key % 3 == 0, F.upper(text)).when(key % 3 == 1, F.lower(text)).otherwise(text)
    )


def order_lines_raw(tables: Tables) -> DataFrame:
    """Order lines without their headers; copies rank by product, then supplier."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return tables["lineitem"].select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias(LINE),
        tables.product(F.col("l_partkey"), F.col("l_orderkey")),
        F.when(F.col("l_tax") != 0.08, price).alias("order_value"),
        F.when(discount != 0, discount).alias("discount_pct"),
        F.struct("l_partkey", "l_suppkey").alias(POSITION),
    )


def with_headers(tables: Tables, lines: DataFrame) -> DataFrame:
    heads = tables.order_region.select(
        "o_orderkey",
        "order_date",
        F.col("o_custkey").alias("customer_id"),
        tables.region(F.col("o_custkey")),
    )
    return lines.join(heads, F.col("order_id") == F.col("o_orderkey")).drop("o_orderkey")


def orders_raw(tables: Tables) -> DataFrame:
    return with_headers(tables, order_lines_raw(tables))


def clean_orders(tables: Tables) -> DataFrame:
    """Clean the lines, then look up the headers of those that are left.

    A line's header depends on its key alone, so this equals cleaning
    ``orders_raw``; only the survivors are shuffled for the join.
    """
    lines = silver.clean_order_lines(order_lines_raw(tables), SETTINGS)
    return with_headers(tables, lines)


def products_raw(tables: Tables) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    label = F.concat_ws("-", "p_type", "p_brand")
    margin = ((20 + size % 16) / 100).cast("decimal(9,6)")
    return _copies(
        tables["part"].select(
            tables.product(key),
            key.alias("_number"),
            _spelling(label, key).alias("category"),
            F.col("p_retailprice").alias("base_price"),
            F.when(size % 5 != 0, margin).alias("margin_pct"),
        ),
        F.col("_number") % 10 == 0,
    ).drop("_number")


def customers_raw(tables: Tables) -> DataFrame:
    key = F.col("c_custkey")
    since = (
        tables["orders"]
        .groupBy("o_custkey")
        .agg(F.to_date(F.min("o_orderdate")).alias("since"))
    )
    return _copies(
        tables.customer_region
        .join(since, key == F.col("o_custkey"), "left")
        .select(
            key.alias("customer_id"),
            "region",
            F.concat(F.lit(" "), _spelling(F.col("c_mktsegment"), key), F.lit("\t")).alias(
                "segment"
            ),
            F.when(key % 7 != 0, F.date_format("since", "yyyy-MM-dd")).alias("signup_date"),
        ),
        F.col("customer_id") % 15 == 0,
    )


def awkward_text() -> Column:
    """Customer names dressed in what CSV has to keep, by key % 8; every eighth is missing."""
    name, kind = F.col("c_name"), F.col("c_custkey") % 8
    return (
        F.when(kind == 0, F.concat(F.lit('5" disc, big '), name))
        .when(kind == 1, F.concat(F.lit("  "), name, F.lit("  ")))
        .when(kind == 2, F.concat(name, F.lit("\ntwo\r\nlines")))
        .when(kind == 3, F.concat(F.lit("back\\slash\\"), name, F.lit("\\")))
        .when(kind == 4, F.lit(""))
        .when(kind == 5, F.concat(F.lit('"'), name, F.lit('"')))
        .when(kind == 6, name)
    )


def event_label() -> Column:
    """The shop's three stages under the stream's own names; others stay unknown."""
    kind = F.col("event_type")
    stage = (
        F.when(kind == "view", "visit").when(kind == "click", "add_to_cart").otherwise(kind)
    )
    return _spelling(stage, F.col("event_id"))


def count_text() -> Column:
    slot = F.col("event_id") % 20
    expr = None
    for key, text in COUNT_TEXTS.items():
        expr = F.when(slot == key, text) if expr is None else expr.when(slot == key, text)
    return expr.otherwise("1.0")


def web_events_raw(tables: Tables) -> DataFrame:
    users = tables.customer_region.select("c_custkey", "region")
    n = F.when(F.col("event_id") % 20 != 0, F.lit("1.0"))
    return (
        tables["events"]
        .join(users, F.col("user_id") == F.col("c_custkey"))
        .select(
            F.to_date("ts").alias("event_date"),
            tables.region(F.col("user_id")),
            event_label().alias("event_type"),
            n.alias("count"),
        )
    )


def targets_raw(tables: Tables) -> DataFrame:
    month = F.trunc("order_date", "MM")
    planned = F.round(F.sum(F.col("o_totalprice").cast(MONEY)) * F.lit(Decimal("0.0986")), 2)
    sums = (
        tables.order_region
        .groupBy(month.alias("first_day"), "region")
        .agg(planned.alias("target_revenue"))
    )
    day = F.col("first_day")
    # A month whose target nobody has entered yet.
    unknown = (F.col("region") == "EUROPE") & (F.month(day) == 2)
    sums = sums.withColumn("target_revenue", F.when(~unknown, F.col("target_revenue")))
    text = F.when(F.month(day) % 5 == 0, F.date_format(day, "yyyy/MM/dd")).otherwise(
        F.date_format(day, "yyyy-MM-dd")
    )
    return _copies(sums, F.month(day) == 1).select(
        text.alias("month"), tables.region(F.month(day)), "target_revenue"
    )


RAW = {
    "customers": customers_raw,
    "products": products_raw,
    "orders": orders_raw,
    "web_events": web_events_raw,
    "targets": targets_raw,
}


def raw_tables(tables: Tables) -> dict[str, DataFrame]:
    return {name: bind(tables) for name, bind in RAW.items()}
