import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import one, rows
from weirline.operators import audit, rows as ops, rules
from weirline.operators.median import exact_median, fill_median
from weirline.settings import Settings


def test_keep_first_follows_the_given_order(spark):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "early"), ("b", 5, None), (None, 1, "n1"), (None, 2, "n2")],
        "k string, pos int, v string",
    )
    got = ops.keep_first(df, ["k"], ["pos"], copies="n")
    assert got.columns == ["k", "pos", "v", "n"]
    assert rows(got) == [("a", 1, "early", 2), ("b", 5, None, 1), (None, 1, "n1", 2)]


def test_keep_first_ignores_partitioning(spark):
    data = [(i % 50, random.Random(i).randint(0, 9), str(i % 7)) for i in range(1000)]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, x int, y string").repartition(seed + 1)
        got = rows(ops.keep_first(df, ["k"]))
        want = want or got
        assert got == want
    best = {}
    for k, x, y in data:
        best[k] = min(best.get(k, (x, y)), (x, y))
    assert want == sorted(((k, *v) for k, v in best.items()), key=lambda r: tuple(
        (False, str(c)) for c in r))


def test_keep_first_on_keys_alone(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(ops.keep_first(df, ["k"])) == [(1,), (2,)]
    assert rows(ops.keep_first(df, ["k"], copies="n")) == [(1, 2), (2, 1)]


def test_small_row_operators(spark):
    df = spark.createDataFrame(
        [(1, 50000.0), (2, 50000.01), (3, None), (3, None)], "k int, v double"
    )
    assert rows(ops.keep_at_most(df, "v", 50000)) == [(1, 50000.0)]
    assert [r[0] for r in rows(ops.drop_null_rows(df, ["v"]))] == [1, 2]
    assert ops.distinct_rows(df).count() == 3
    assert rows(ops.fill_constant(df, {"v": 0}).where("k = 3")) == [(3, 0.0), (3, 0.0)]


def _decimals(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], f"m {dtype}")


@pytest.mark.parametrize(
    "values",
    [
        ["0.25", "0.30", None, "0.20", "0.35"],
        ["0.2", "0.3"],
        ["-1.5", "0", "0", "2"],
        ["-0.000001", "0.000001", "0.5"],
        ["7"],
        [None, None],
        [],
        ["0.1"] * 99 + ["0.9"] * 100,
    ],
)
def test_median_small(spark, values):
    nums = [None if v is None else Decimal(v) for v in values]
    known = [v for v in nums if v is not None]
    got = one(exact_median(_decimals(spark, nums, "decimal(9,6)"), "m"))["median"]
    assert got == (statistics.median(known) if known else None)


@pytest.mark.parametrize("dtype,scale", [("decimal(9,6)", 6), ("decimal(18,4)", 4), ("decimal(5,0)", 0)])
def test_median_equals_sorting(spark, dtype, scale):
    rng = random.Random(scale)
    digits = {6: 9, 4: 18, 0: 5}[scale]
    for size in (500, 501):
        nums = [
            Decimal(rng.randint(-(10**digits) + 1, 10**digits - 1)).scaleb(-scale)
            for _ in range(size)
        ]
        got = one(exact_median(_decimals(spark, nums, dtype).repartition(7), "m"))["median"]
        exact = statistics.median(nums)
        assert abs(got - exact) <= Decimal(5).scaleb(-scale - 1)


def test_median_wants_numbers(spark):
    with pytest.raises(TypeError):
        exact_median(spark.createDataFrame([("1.0",)], "m string"), "m")


@pytest.mark.parametrize(
    "name,make",
    [
        ("even spread", lambda rng: rng.random()),
        ("powers", lambda rng: 10.0 ** rng.randint(-300, 300) * rng.choice([-1, 1])),
        ("close to one value", lambda rng: 1 + rng.randint(0, 2000) * 2.0**-52),
        ("a hot value", lambda rng: 0.5 if rng.random() < 0.4 else rng.random()),
        ("two values", lambda rng: rng.choice([-0.0, 3.0])),
    ],
)
def test_median_of_doubles_equals_sorting(spark, name, make):
    for size in (30_000, 30_001):
        rng = random.Random(size)
        nums = [make(rng) for _ in range(size)]
        dirty = [(x,) for x in [*nums, float("nan"), None, float("nan")]]
        df = spark.createDataFrame(dirty, "m double").repartition(11)
        a, b = sorted(nums)[(size - 1) // 2], sorted(nums)[size // 2]
        assert one(exact_median(df, "m"))["median"] == (a if a == b else a / 2 + b / 2), name


def test_median_of_doubles_at_the_edges(spark):
    inf = float("inf")
    for nums, want in (
        ([1.7e308, 1.7e308 - 1e293], 1.7e308 / 2 + (1.7e308 - 1e293) / 2),
        ([-inf, 2.0, inf], 2.0),
        ([float("nan"), None], None),
    ):
        df = spark.createDataFrame([(x,) for x in nums], "m double")
        assert one(exact_median(df, "m"))["median"] == want
    small = spark.createDataFrame([(0.5,), (0.25,)], "m float")
    assert one(exact_median(small, "m"))["median"] == 0.375


def test_median_of_long_decimals(spark):
    # Values that are one and the same double, and a sum of 37 digits.
    base = Decimal("123456789012345678901234567890.0000")
    near = [base + Decimal(i).scaleb(-4) for i in range(-900, 1100)]
    random.Random(1).shuffle(near)
    got = one(exact_median(_decimals(spark, near, "decimal(38,4)").repartition(5), "m"))
    assert got["median"] == base + Decimal("0.0100")  # of 99 and 100, half up
    wide = [Decimal("9" * 28 + ".12345678"), Decimal("9" * 28 + ".12345679")]
    assert one(exact_median(_decimals(spark, wide, "decimal(36,8)"), "m"))["median"] == wide[1]
    same = [Decimal("9" * 38)] * 3
    assert one(exact_median(_decimals(spark, same, "decimal(38,0)"), "m"))["median"] == same[0]


def test_fill_median_keeps_all_null_null(spark):
    half = _decimals(spark, [Decimal("0.2"), None, Decimal("0.35")], "decimal(9,6)")
    assert rows(fill_median(half, "m")) == [
        (Decimal("0.200000"),), (Decimal("0.275000"),), (Decimal("0.350000"),)
    ]
    none = _decimals(spark, [None, None], "decimal(9,6)")
    assert rows(fill_median(none, "m")) == [(None,), (None,)]


def test_rules(spark):
    df = spark.createDataFrame(
        [(r, Decimal("100.05")) for r in ("South", "East", "West", "North", None)],
        "region string, t decimal(18,4)",
    )
    got = {r.region: (r.leakage_type, r.risk_level) for r in rules.classify(df, Settings()).collect()}
    assert got == {
        "South": ("Funnel Drop-off", "High"),
        "East": ("Pricing Erosion", "Medium"),
        "West": ("Operational Gap", "Medium"),
        "North": ("Funnel Drop-off", "Low"),
        None: ("Funnel Drop-off", "Low"),
    }
    up = rules.uplift_where(df, "t", F.col("region") == "West", Decimal("1.05"))
    got = {r.region: r.t for r in up.collect()}
    assert got["West"] == Decimal("105.0500") and got["East"] == got[None] == Decimal("100.0500")
    assert up.schema["t"].dataType == df.schema["t"].dataType


def test_count_ignoring_case(spark):
    df = spark.createDataFrame([("West",), ("WEST",), ("west",), ("East",), (None,)], "r string")
    assert rows(rules.count_ignoring_case(df, "r")) == [("East", 1), ("WEST", 3), (None, 1)]


def test_audits(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", 1.0), ("b", 2.0), ("c", 9.0)], "k string, v double"
    )
    got = one(audit.audit_keyed(df, "t", ["k"], keep=F.col("v") <= 5))
    # "a" counts as rejected: its first copy (NULL sorts first) has no value.
    assert got == {
        "table_name": "t", "raw_rows": 4, "duplicates_removed": 1,
        "rejected_rows": 2, "final_rows": 1,
    }
    empty = one(audit.audit_keyed(df.limit(0), "t", ["k"]))
    assert empty["raw_rows"] == empty["duplicates_removed"] == empty["final_rows"] == 0
    got = one(audit.audit_rows(df, "t", F.col("v").isNotNull()))
    assert (got["raw_rows"], got["rejected_rows"], got["final_rows"]) == (4, 1, 3)
    report = audit.quality_report({"one": df, "two": df.na.drop()})
    assert rows(report) == [("one", 4, 1), ("two", 3, 0)]
    assert rows(audit.row_counts({"x": df})) == [("x", 4)]
