"""Fixed reference tables and the calendar generator.

The exchange rates and the DMA -> region map are small, fixed tables: they are
created on the driver from the literal rows below and are always safe to
broadcast (their size does not grow with the data).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.functions import dates as D

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's reference data).
# Monthly exchange rates to USD for 2026, source "simulation":
#   USD: Jan-Jun 1.0
#   CAD: Jan 0.74, Feb 0.74, Mar 0.73, Apr 0.73, May 0.72, Jun 0.72
#   GBP: Jan 1.27, Feb 1.27, Mar 1.26, Apr 1.26, May 1.25, Jun 1.25
# DMA code -> name -> region (mapping source "manual"):
#   501 New York East; 504 Philadelphia East; 505 Detroit East;
#   506 Boston East; 511 Washington DC East; 524 Atlanta East;
#   528 Miami-Ft. Lauderdale East; 539 Tampa-St. Petersburg East;
#   602 Chicago East; 618 Houston West; 623 Dallas-Ft. Worth West;
#   753 Phoenix West; 803 Los Angeles West;
#   807 San Francisco-Oakland-San Jose West; 819 Seattle-Tacoma West
# Calendar of the source system: 2026-01-01 through 2027-01-01 inclusive.
# ---------------------------------------------------------------------------
FX_RATES_2026 = {
    "USD": [1.0, 1.0, 1.0, 1.0, 1.0, 1.0],
    "CAD": [0.74, 0.74, 0.73, 0.73, 0.72, 0.72],
    "GBP": [1.27, 1.27, 1.26, 1.26, 1.25, 1.25],
}
DMA_REGION_MAP = [
    ("501", "New York", "East"),
    ("504", "Philadelphia", "East"),
    ("505", "Detroit", "East"),
    ("506", "Boston", "East"),
    ("511", "Washington DC", "East"),
    ("524", "Atlanta", "East"),
    ("528", "Miami-Ft. Lauderdale", "East"),
    ("539", "Tampa-St. Petersburg", "East"),
    ("602", "Chicago", "East"),
    ("618", "Houston", "West"),
    ("623", "Dallas-Ft. Worth", "West"),
    ("753", "Phoenix", "West"),
    ("803", "Los Angeles", "West"),
    ("807", "San Francisco-Oakland-San Jose", "West"),
    ("819", "Seattle-Tacoma", "West"),
]
CALENDAR_START = _dt.date(2026, 1, 1)
CALENDAR_END = _dt.date(2027, 1, 1)

FX_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("from_currency", T.StringType()),
    T.StructField("to_currency", T.StringType()),
    T.StructField("rate", T.DoubleType()),
    T.StructField("source", T.StringType()),
])
DMA_MAP_SCHEMA = T.StructType([
    T.StructField("dma_code", T.StringType()),
    T.StructField("dma_name", T.StringType()),
    T.StructField("mapped_region", T.StringType()),
    T.StructField("mapping_source", T.StringType()),
])


def exchange_rates(spark: SparkSession) -> DataFrame:
    """SRC-8: monthly rates, 18 rows."""
    rows = [(2026, m + 1, cur, "USD", rate, "simulation")
            for cur, rates in FX_RATES_2026.items() for m, rate in enumerate(rates)]
    return spark.createDataFrame(rows, FX_SCHEMA)


def dma_region_map(spark: SparkSession) -> DataFrame:
    """SRC-9: 15 DMAs, 9 East and 6 West."""
    return spark.createDataFrame([(c, n, r, "manual") for c, n, r in DMA_REGION_MAP],
                                 DMA_MAP_SCHEMA)


def calendar_columns(date_col: Column) -> list[Column]:
    return [
        date_col.alias("date"),
        F.year(date_col).cast("int").alias("year"),
        F.month(date_col).cast("int").alias("month"),
        D.month_name(date_col).alias("month_name"),
        D.day_of_week_sunday0(date_col).alias("day_of_week"),
        D.is_weekend(date_col).alias("is_weekend"),
    ]


def calendar(spark: SparkSession, start=CALENDAR_START, end=CALENDAR_END) -> DataFrame:
    """SRC-10: one row per day from ``start`` to ``end`` inclusive."""
    one = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias("d"))
    return one.select(*calendar_columns(F.col("d")))


def calendar_spanning(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Calendar whose range comes from a one-row DataFrame of bounds, so the
    range is derived on the executors (no driver round trip).  Its size is the
    number of days in the range, which does not grow with the row count."""
    days = bounds.select(F.explode(F.sequence(F.col(lo).cast("date"), F.col(hi).cast("date"),
                                              F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def exchange_rates_for_years(years: DataFrame, col: str = "year") -> DataFrame:
    """The monthly rate pattern above, repeated for every year in ``years``
    (used when data outside 2026 must be converted).  Built with explode, no
    join: 18 rows per year."""
    cells = [F.struct(F.lit(m + 1).alias("month"), F.lit(cur).alias("from_currency"),
                      F.lit(rate).alias("rate"))
             for cur, rates in FX_RATES_2026.items() for m, rate in enumerate(rates)]
    x = years.select(F.col(col).cast("int").alias("year"), F.explode(F.array(*cells)).alias("r"))
    return x.select("year", F.col("r.month").alias("month"),
                    F.col("r.from_currency").alias("from_currency"),
                    F.lit("USD").alias("to_currency"), F.col("r.rate").alias("rate"),
                    F.lit("simulation").alias("source"))


def fx_rates_values_sql() -> str:
    """The same 18 (month, currency, rate) cells as a SQL VALUES list."""
    rows = [f"({m + 1}, '{cur}', {rate})"
            for cur, rates in FX_RATES_2026.items() for m, rate in enumerate(rates)]
    return "VALUES " + ", ".join(rows)
