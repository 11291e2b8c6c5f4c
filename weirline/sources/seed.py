"""The stock web-event rows that replace an event table by a truncate and reload."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

# Visits per region, January to December 2024.
SEED_VISITS = {
    "North": (12000, 11000, 13000, 12500, 11500, 14000, 13500, 12000, 11000, 15000, 14500, 16000),
    "South": (11000, 10500, 12000, 11500, 10000, 13000, 12500, 11000, 10000, 14000, 13500, 15000),
    "East": (13000, 12000, 14000, 13500, 12500, 15000, 14500, 13000, 12000, 16000, 15500, 17000),
    "West": (14000, 13000, 15000, 14500, 13500, 16000, 15500, 14000, 13000, 17000, 16500, 18000),
}

# Cart adds per region, January to December 2024.
SEED_CART_ADDS = {
    "North": (2400, 2200, 2600, 2500, 2300, 2800, 2700, 2400, 2200, 3000, 2900, 3200),
    "South": (1980, 1890, 2160, 2070, 1800, 2340, 2250, 1980, 1800, 2520, 2430, 2700),
    "East": (2340, 2160, 2520, 2430, 2250, 2700, 2610, 2340, 2160, 2880, 2790, 3060),
    "West": (2660, 2470, 2850, 2755, 2565, 3040, 2945, 2660, 2470, 3230, 3135, 3420),
}

# Purchases per region, January to December 2024.
SEED_PURCHASES = {
    "North": (480, 440, 520, 500, 460, 560, 540, 480, 440, 600, 580, 640),
    "South": (330, 315, 360, 345, 300, 390, 375, 330, 300, 420, 405, 450),
    "East": (468, 432, 504, 486, 450, 540, 522, 468, 432, 576, 558, 612),
    "West": (532, 494, 570, 551, 513, 608, 589, 532, 494, 646, 627, 684),
}

SEED_SERIES = {
    "Visit": SEED_VISITS,
    "Add_To_Cart": SEED_CART_ADDS,
    "Purchase": SEED_PURCHASES,
}


def funnel_seed(spark: SparkSession) -> DataFrame:
    """144 clean event rows: 4 regions x 12 months x 3 event types."""
    rows = [
        (dt.date(2024, month, 1), region, event_type, count)
        for event_type, regions in SEED_SERIES.items()
        for region, counts in regions.items()
        for month, count in enumerate(counts, start=1)
    ]
    return spark.createDataFrame(
        rows, "event_date date, region string, event_type string, count bigint"
    )
