import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weirline.functions import dates, numbers, text
from weirline.settings import EVENT_LABELS


def apply(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("c"))).collect()]


def test_missing_value_tokens_are_exact(spark):
    given_ = ["", "NA", "N/A", "null", "NaN", "<NA>", "None", " NA ", "na", "0", "Nan", None]
    got = apply(spark, given_, text.na_to_null)
    assert got == [None] * 7 + [" NA ", "na", "0", "Nan", None]


def test_strip_covers_all_unicode_space(spark):
    every = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert set(every) == set(text.WHITESPACE)
    given_ = ["\t smb ", " x ", "a b", "\n\n", None]
    assert apply(spark, given_, text.strip) == ["smb", "x", "a b", "", None]
    assert apply(spark, ["\tmid-market "], text.strip_upper) == ["MID-MARKET"]


def test_title_restarts_after_every_non_letter(spark):
    words = ["home-decor", "HOME", "ADD_TO_CART", "o'neil", "3rd place", "élan vital", "", None]
    want = [None if w is None else w.strip().title() for w in words]
    assert apply(spark, words, text.strip_title) == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=126, min_codepoint=32), max_size=20),
                min_size=20, max_size=60))
def test_title_equals_python(spark, words):
    assert apply(spark, words, text.strip_title) == [w.strip().title() for w in words]


def test_labels(spark):
    raw = [" VISIT", "Add_To_Cart", "purchase\t", "Refund", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, t string")
    got = text.canonical_label(df, "t", EVENT_LABELS).orderBy("i")
    assert [r.t for r in got.collect()] == ["Visit", "Add_To_Cart", "Purchase", "refund", None]


def test_strict_date(spark):
    assert apply(spark, ["2024-02-29", None], dates.parse_strict) == [dt.date(2024, 2, 29), None]
    for bad in ("2024-13-01", "2023-02-29", "2024/03/01", "soon"):
        with pytest.raises(PySparkException):
            apply(spark, [bad], dates.parse_strict)


def test_mixed_dates(spark):
    parse = lambda c: dates.parse_mixed(c, ("yyyy-MM-dd", "yyyy/MM/dd"))
    got = apply(spark, ["2024-03-01", "2024/03/01", None], parse)
    assert got == [dt.date(2024, 3, 1)] * 2 + [None]
    with pytest.raises(PySparkException):
        apply(spark, ["03.01.2024"], parse)


def test_month_columns(spark):
    day = [dt.date(2024, 3, 31)]
    assert apply(spark, day, dates.month_start, "date") == [dt.date(2024, 3, 1)]
    assert apply(spark, day, dates.cohort_month, "date") == ["2024-03"]
    df = spark.createDataFrame([(day[0],)], "d date").select(*dates.date_parts(F.col("d")))
    assert tuple(df.first()) == (2024, 1, 3, "March", dt.date(2024, 3, 1))


def test_counts_are_cut_not_rounded(spark):
    given_ = ["7267.0", "7267.9", "7267.99999999", "-1.5", "9223372036854775807", None]
    df = spark.createDataFrame([(v,) for v in given_], "n string")
    got = [r[0] for r in df.select(numbers.to_count(df, "n")).collect()]
    assert got == [7267, 7267, 7267, -1, 9223372036854775807, None]
    bad = spark.createDataFrame([("many",)], "n string")
    with pytest.raises(PySparkException):
        bad.select(numbers.to_count(bad, "n")).collect()


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(math.nan,), (1.5,), (None,)], "x double")
    got = [r[0] for r in df.select(numbers.nan_to_null(df, "x")).collect()]
    assert got == [None, 1.5, None]


def test_ratio_and_rounding(spark):
    df = spark.createDataFrame([(1, 0), (7, 2), (1, 3)], "a bigint, b bigint")
    got = df.select(numbers.round_ratio(F.col("a"), F.col("b"), 4)).collect()
    assert [None if r[0] is None else float(r[0]) for r in got] == [None, 3.5, 0.3333]
    tie = spark.createDataFrame([(0.285,), (1.005,), (-0.285,)], "x double")
    got = tie.select(numbers.round_half_up(F.col("x"), 2)).collect()
    assert [float(r[0]) for r in got] == [0.29, 1.01, -0.29]
