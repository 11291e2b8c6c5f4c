"""The whole run: tables, CSV copies, views, checks, and a second run."""

import csv
import os
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import one, rows
from sample import write_raw
from weirline.operators import audit
from weirline.plans import gold, marts, measures, silver
from weirline.plans.pipeline import COUNTED_TABLES, SILVER_TABLES, read_extracts, run
from weirline.session import sizing
from weirline.sources.files import read_clean_csv, write_csv
from weirline.sources.seed import funnel_seed
from weirline.sources.warehouse import Warehouse, column_types, conform


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    raw_dir = write_raw(tmp_path_factory.mktemp("raw"))
    out = tmp_path_factory.mktemp("wh")
    csv_dir = str(tmp_path_factory.mktemp("csv"))
    return raw_dir, out, csv_dir, run(spark, raw_dir, Warehouse(spark, str(out)), clean_csv_dir=csv_dir)


def _counts(df):
    return {r.table_name: r.row_count for r in df.collect()}


def test_checks(built):
    *_, b = built
    counts = _counts(b.checks["row_counts"])
    assert list(counts) == list(COUNTED_TABLES)
    assert counts == {
        "dim_date": 5, "dim_region": 4, "dim_customer": 4, "dim_product": 4,
        "fact_revenue": 4, "fact_funnel": 3, "fact_targets": 4, "fact_revenue_monthly": 4,
        "fact_revenue_enriched": 6, "fact_leakage": 4, "fact_recovery": 4,
    }
    quality = {r.table_name: (r.row_count, r.null_cells) for r in b.checks["quality_report"].collect()}
    assert quality["orders"] == (7, 1) and quality["customers"] == (4, 1)
    assert one(b.checks["margin"].where("region = 'North'"))["avg_margin_pct"] == 25


def test_counts_without_tables_agree(built):
    *_, b = built
    t = {e: b.tables[n] for e, n in SILVER_TABLES.items()}
    fast = marts.warehouse_row_counts(
        t["customers"], t["products"], t["orders"], t["web_events"], t["targets"]
    )
    assert _counts(fast) == _counts(b.checks["row_counts"])


def test_audit_agrees_with_cleaning(spark, built):
    raw_dir, _, _, b = built
    raw = read_extracts(spark, raw_dir)
    counted = {r.table_name: r for r in silver.etl_audit(raw).collect()}
    for entity, table in SILVER_TABLES.items():
        assert counted[entity].final_rows == b.tables[table].count(), entity
        assert counted[entity].raw_rows == raw[entity].count()
    orders = counted["orders"]
    assert (orders.duplicates_removed, orders.rejected_rows) == (2, 2)


def test_one_pass_over_the_extracts(spark, tmp_path, monkeypatch):
    """The audit comes out of the writes; order lines are grouped once."""
    raw_dir = write_raw(tmp_path)
    want = rows(silver.etl_audit(read_extracts(spark, raw_dir)))
    read, grouped = [], []
    first, grain = audit.keep_first, gold.sales_by
    monkeypatch.setattr(audit, "keep_first", lambda df, *a, **k: read.append(df) or first(df, *a, **k))
    monkeypatch.setattr(gold, "sales_by", lambda *a: grouped.append(a) or grain(*a))
    monkeypatch.setattr(silver, "etl_audit", None)
    b = run(spark, raw_dir, Warehouse(spark, str(tmp_path / "wh")))
    assert rows(b.checks["etl_audit"]) == want
    assert len(read) == 4 and len(grouped) == 1


def test_audit_of_empty_extracts(spark):
    passing = audit.PassingRows("orders")
    empty = spark.createDataFrame([], "order_id string, order_value double, discount_pct double")
    assert passing.final(silver.clean_order_lines(empty, passing=passing)).collect() == []
    assert passing.row() == ("orders", 0, 0, 0, 0)


def test_views_are_queryable(spark, built):
    *_, b = built
    for name in b.views:
        assert spark.table(name).count() == b.views[name].count()
    radar = spark.sql("SELECT SUM(leakage_amount) AS s FROM vw_leakage_radar").first().s
    assert radar == b.tables["fact_leakage"].agg(F.sum("leakage_amount")).first()[0]


def test_totals_agree_across_facts(built):
    *_, b = built
    def total(table, column):
        return float(b.tables[table].agg(F.sum(column)).first()[0])
    revenue = total("fact_revenue", "revenue")
    assert revenue == total("fact_revenue_enriched", "order_value")
    assert revenue == total("fact_revenue_monthly", "actual_revenue")


def test_clean_csv_round_trip(spark, built):
    _, _, csv_dir, b = built
    for entity, table in SILVER_TABLES.items():
        want = b.tables[table]
        back = read_clean_csv(spark, f"{csv_dir}/{entity}_clean.csv", want.schema)
        assert rows(back) == rows(want), entity
    text = "".join(p.read_text() for p in Path(csv_dir, "orders_clean.csv").glob("part-*"))
    assert "North,100.1,0.1\n" in text and "South,50000,0.05\n" in text


def test_second_run_gives_the_same_tables(spark, built):
    raw_dir, out, _, b = built
    before = {n: rows(df) for n, df in b.tables.items()}
    again = run(spark, raw_dir, Warehouse(spark, str(out)))
    for name, df in again.tables.items():
        assert rows(df) == before[name], name


def test_replacement_events(spark, built, tmp_path):
    raw_dir = built[0]
    b = run(spark, raw_dir, Warehouse(spark, str(tmp_path)), replacement_events=funnel_seed(spark))
    assert b.tables["stg_web_events"].count() == 144
    totals = {r.region: r for r in b.checks["funnel"].collect()}
    assert {k: (v.total_visits, v.total_cart, v.total_purchases, float(v.conversion_pct))
            for k, v in totals.items()} == {
        "East": (168000, 30240, 6048, 3.6), "North": (156000, 31200, 6240, 4.0),
        "South": (144000, 25920, 4320, 3.0), "West": (180000, 34200, 6840, 3.8),
    }
    # The report on cleaned data is taken before the events are replaced.
    assert b.checks["quality_report"].where("table_name = 'web_events'").first().row_count == 8


def test_a_failed_run_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    (tmp_path / "raw").mkdir()
    raw_dir, w = write_raw(tmp_path / "raw"), Warehouse(spark, str(tmp_path / "wh"))
    run(spark, raw_dir, w)
    before = {n: rows(w.read(n)) for n in ("stg_orders", "dim_region", "fact_leakage")}
    (first,) = w.complete_versions()

    extract = Path(raw_dir, "orders_raw.csv")
    extract.write_text(extract.read_text() + "O9999,2024-01-09,C0001,P101,Nowhere,7,0.1\n")
    with monkeypatch.context() as m:
        m.setattr(gold, "fact_leakage", lambda *a: spark.range(1).selectExpr("raise_error('lost')"))
        with pytest.raises(Exception, match="lost"):
            run(spark, raw_dir, w)
    assert len(os.listdir(tmp_path / "wh" / "versions")) == 2 and w.complete_versions() == [first]
    assert {n: rows(w.read(n)) for n in before} == before

    run(spark, raw_dir, w)
    assert w.complete_versions()[0] == first and len(w.complete_versions()) == 2
    assert "Nowhere" in {r.region for r in w.read("dim_region").collect()}
    assert "O9999" in {r.order_id for r in w.read("stg_orders").collect()}
    assert len(w.expire(keep=1)) == 2 and len(w.complete_versions()) == 1
    assert w.write(w.read("dim_region").limit(1), "dim_region").count() == 1


def test_views_equal_the_frames(built):
    *_, b = built
    t = b.tables
    want = {
        "vw_executive_summary": marts.executive_summary(t["fact_revenue_monthly"], t["fact_leakage"]),
        "vw_leakage_radar": marts.leakage_radar(t["fact_leakage"]),
        "vw_funnel_analysis": marts.funnel_analysis(t["fact_funnel"]),
        "vw_recovery_scenarios": marts.recovery_scenarios(t["fact_recovery"]),
    }
    assert want.keys() == b.views.keys()
    for name, df in want.items():
        assert b.views[name].columns == df.columns
        assert rows(b.views[name]) == rows(df), name


def test_partitioned_table(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("k"))
    back = w.write(df, "t", partition_by=["k"])
    assert rows(back.select("id", "k")) == rows(df)
    assert sorted(p for p in os.listdir(tmp_path / "t") if p.startswith("k=")) == ["k=0", "k=1", "k=2"]


def test_managed_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS weirline_t")
    try:
        w = Warehouse(spark, database="weirline_t")
        for n in (5, 3):
            assert w.write(spark.range(n), "ids").count() == n
    finally:
        spark.sql("DROP DATABASE weirline_t CASCADE")
    with pytest.raises(ValueError):
        Warehouse(spark)


def test_target_types(spark):
    df = spark.createDataFrame(
        [("a", 1, float("nan"), 2.5)], "k string, n int, x double, y double"
    )
    want = T.StructType.fromDDL("y decimal(18,4), x double, n bigint, k string")
    got = conform(df, want)
    assert got.schema.simpleString() == want.simpleString()
    assert tuple(got.first()) == (D("2.5"), None, 1, "a")
    assert "`k`" not in column_types(want)
    assert column_types(want, 40) == (
        "`y` DECIMAL(18,4), `x` DOUBLE, `n` BIGINT, `k` VARCHAR(40)"
    )


def test_nan_is_empty_in_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 0.5)], "k int, x double")
    write_csv(df, str(tmp_path / "out"))
    back = read_clean_csv(spark, str(tmp_path / "out"), df.schema)
    assert rows(back) == [(1, None), (2, 0.5)]


def test_sizing_grows_with_the_input():
    small, large = sizing(1 << 30), sizing(100 << 40)
    split, parts = "spark.sql.files.maxPartitionBytes", (
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    )
    assert (int(small[split]), int(small[parts])) == (128 << 20, 200)
    assert int(large[parts]) == (100 << 40) // (512 << 20) == 204_800
    maps = (100 << 40) // int(large[split])
    assert (100 << 40) // (maps * int(large[parts])) >= 8 << 10
    assert int(sizing(1 << 50)[parts]) == (1 << 50) // (512 << 20)


# -- the published sample, where it is at hand --------------------------------

SAMPLE = os.environ.get("SAMPLE_EXTRACTS")


@pytest.mark.skipif(not SAMPLE, reason="SAMPLE_EXTRACTS not set")
def test_published_sample(spark, tmp_path):
    b = run(spark, f"{SAMPLE}/data_raw", Warehouse(spark, str(tmp_path)),
            replacement_events=funnel_seed(spark))
    assert _counts(b.checks["row_counts"]) == {
        "dim_date": 254, "dim_region": 4, "dim_customer": 140, "dim_product": 8,
        "fact_revenue": 463, "fact_funnel": 48, "fact_targets": 48,
        "fact_revenue_monthly": 48, "fact_revenue_enriched": 463, "fact_leakage": 4,
        "fact_recovery": 4,
    }
    got = {
        r.region: (float(r.actual_revenue), float(r.target_revenue), float(r.leakage_amount),
                   r.leakage_type, r.risk_level, float(r.avg_discount))
        for r in b.tables["fact_leakage"].collect()
    }
    assert got == {
        "East": (449045.31, 390732.66, -58312.65, "Pricing Erosion", "Medium", 0.19),
        "North": (474437.28, 440324.93, -34112.35, "Funnel Drop-off", "Low", 0.14),
        "South": (493781.09, 429446.50, -64334.59, "Funnel Drop-off", "High", 0.17),
        "West": (541208.37, 400874.82, -140333.55, "Operational Gap", "Medium", 0.15),
    }
    recovery = {r.region: tuple(float(r[f"{s}_recovery"]) for s in
                ("conservative", "realistic", "aggressive"))
                for r in b.tables["fact_recovery"].collect()}
    assert recovery == {
        "East": (-43734.49, -49565.75, -55397.02), "North": (-25584.26, -28995.50, -32406.73),
        "South": (-48250.94, -54684.40, -61117.86), "West": (-105250.16, -119283.52, -133316.87),
    }
    margins = {r.region: (float(r.avg_margin_pct), float(r.avg_discount_pct))
               for r in b.checks["margin"].collect()}
    assert margins == {"East": (27.74, 18.83), "North": (27.38, 13.63),
                       "South": (27.26, 17.05), "West": (27.31, 15.35)}
    enriched = {r.region: (float(r.m), float(r.d)) for r in b.tables["fact_revenue_enriched"]
                .groupBy("region").agg(F.sum("gross_margin").alias("m"),
                                       F.sum("discount_amount").alias("d")).collect()}
    assert enriched == {"East": (124950.01, 85650.47), "North": (130263.73, 63880.67),
                        "South": (135713.05, 81056.89), "West": (148698.52, 84567.32)}
    monthly = b.tables["fact_revenue_monthly"]
    assert monthly.where("variance < 0").count() == 17
    quarters = {r.quarter: float(r.avg_achievement_pct)
                for r in measures.achievement_by_quarter(monthly).collect()}
    assert max(quarters, key=quarters.get) == 4
    # The published figures use a fixed rate for the shortfall and unscaled targets.
    fixed = measures.leakage_fixed_rate(b.tables["fact_leakage"])
    shares = {r.leakage_type: float(r.share_pct)
              for r in measures.leakage_share_by_type(fixed).collect()}
    assert shares["Funnel Drop-off"] == 49.44
    recovered = {r.scenario: float(r.recovery_amount)
                 for r in measures.recovery_by_scenario(gold.fact_recovery(fixed)).collect()}
    assert [round(recovered[s] / 1000, 2) for s in
            ("conservative", "realistic", "aggressive")] == [73.44, 83.24, 93.03]
    unscaled = gold.fact_revenue_monthly(b.tables["agg_sales"], b.tables["stg_targets"])
    gap = one(measures.measure(unscaled, measures.executive_measures()))["revenue_gap_pct"]
    assert round(float(gap), 2) == 66.95
    # Cleaned rows equal the published clean files, number by number.
    clean = silver.clean_web_events(read_extracts(spark, f"{SAMPLE}/data_raw")["web_events"])
    frames = {e: b.tables[t] for e, t in SILVER_TABLES.items() if e != "web_events"}
    for entity, df in {**frames, "web_events": clean}.items():
        with open(f"{SAMPLE}/data_clean/{entity}_clean.csv", newline="") as f:
            want = sorted(tuple(_value(r[c]) for c in df.columns) for r in csv.DictReader(f))
        assert sorted(tuple(_value(str(v)) for v in r) for r in df.collect()) == want, entity


def _value(text):
    try:
        return str(float(text))
    except ValueError:
        return text
