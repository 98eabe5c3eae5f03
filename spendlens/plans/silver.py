"""Silver layer builders (TAB-5 .. TAB-13, TAB-19).

Each builder is DataFrame(s) -> DataFrame; persistence, watermarks and
upserts are applied by the pipeline around them.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions import dates as D

from spendlens.functions import money as M
from spendlens.operators.dedup import last_per_key
from spendlens.operators.fill import zero_fill
from spendlens.sources.reference import CALENDAR_END, CALENDAR_START

META_KEY = ["date", "campaign_id", "adset_id", "ad_id", "objective", "placement"]
GOOGLE_KEY = ["date", "campaign_id", "campaign_name", "advertising_channel_type"]
PERF_KEY = ["date", "campaign_id", "platform", "adset_id", "ad_id", "objective", "placement"]
VISITS_KEY = ["date", "dma_code"]

PERF_COLS = ["date", "timestamp_utc", "campaign_id", "campaign_name", "adset_id", "ad_id",
             "objective", "placement", "impressions", "clicks", "spend_usd", "currency_used",
             "currency_conversion_note", "conversions", "conversion_value_usd", "platform",
             "_load_timestamp", "_staged_timestamp"]


def usd_rates(rates: DataFrame) -> DataFrame:
    """Rates into USD only: the source joins on (year, month, currency) and
    ignores the target currency, which would fan rows out as soon as a second
    target appeared."""
    return rates.filter(F.col("to_currency") == "USD").select(
        F.col("year").alias("_fx_year"), F.col("month").alias("_fx_month"),
        F.col("from_currency").alias("_fx_cur"), F.col("rate").alias("_fx_rate"))


def convert_currency(df: DataFrame, rates: DataFrame, *, amount_cols: dict[str, str],
                     currency: str = "original_currency", missing: str = "currency_missing",
                     calendar=(CALENDAR_START, CALENDAR_END)) -> DataFrame:
    """JON-1/2 + PRJ-11/12: monthly rate lookup with USD default.

    The calendar join of the source only supplies year and month, so it is
    replaced by deriving them from the date; dates outside the calendar get no
    rate (factor 1.0), as the source's left join gives.  The rate table is the
    caller's: Spark broadcasts it where its size allows."""
    in_cal = F.col("date").between(F.lit(calendar[0]), F.lit(calendar[1])) if calendar else F.lit(True)
    cur = F.coalesce(F.col(currency), F.lit("USD"))
    keyed = (df.withColumn("_y", F.when(in_cal, F.year("date")))
             .withColumn("_m", F.when(in_cal, F.month("date")))
             .withColumn("_cur", cur))
    r = usd_rates(rates)
    j = keyed.join(r, (F.col("_y") == F.col("_fx_year")) & (F.col("_m") == F.col("_fx_month"))
                   & (F.col("_cur") == F.col("_fx_cur")), "left")
    out = j
    for target, source in amount_cols.items():
        out = out.withColumn(target, M.fx_amount(F.col(source), F.col("_fx_rate")))
    out = (out.withColumn("currency_used", F.col("_cur"))
           .withColumn("currency_conversion_note", M.currency_note(F.col(currency), F.col(missing)))
           .withColumn("_fx_found", F.col("_fx_rate").isNotNull().cast("int")))
    return out.drop("_y", "_m", "_cur", "_fx_year", "_fx_month", "_fx_cur", "_fx_rate")


def build_stg_meta(raw_meta: DataFrame, rates: DataFrame, staged_ts: _dt.datetime,
                   extra: Sequence[str] = (), calendar=(CALENDAR_START, CALENDAR_END)
                   ) -> DataFrame:
    """TAB-10.  ``extra`` columns (e.g. input order) are carried through."""
    conv = convert_currency(raw_meta, rates, amount_cols={
        "spend_usd": "spend_amount", "conversion_value_usd": "conversion_value_amount"},
        calendar=calendar)
    return conv.select(
        "date", "timestamp_utc", "campaign_id", "campaign_name", "adset_id", "ad_id",
        "objective", "placement", "impressions", "clicks", "spend_usd", "currency_used",
        "currency_conversion_note", "conversions", "conversion_value_usd", "platform",
        "_load_timestamp", D.ntz_lit(staged_ts).alias("_staged_timestamp"),
        *extra)


def build_stg_google(raw_google: DataFrame, staged_ts: _dt.datetime,
                     extra: Sequence[str] = ()) -> DataFrame:
    """TAB-11: micros -> dollars; always USD.  The export's text timestamp becomes a
    wall clock here, after the de-duplication that compares it as text; an absent one
    becomes NULL."""
    return raw_google.select(
        "date", D.parse_wall_clock("timestamp_utc").alias("timestamp_utc"), "campaign_id", "campaign_name", "advertising_channel_type",
        "impressions", "clicks",
        M.micros_to_dollars("cost_micros").alias("spend_usd"),
        F.lit("USD").alias("currency_used"),
        F.lit("USD (native, micros converted)").alias("currency_conversion_note"),
        "conversions",
        M.micros_to_dollars("conversions_value_micros").alias("conversion_value_usd"),
        "platform", "duplicate_combined", "duplicate_count", "_load_timestamp",
        D.ntz_lit(staged_ts).alias("_staged_timestamp"), *extra)


def google_as_performance(stg_google: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """PRJ-14: Google rows in the unified shape (no ad-level ids; channel
    type re-used as placement)."""
    return stg_google.select(
        "date", "timestamp_utc", "campaign_id", "campaign_name",
        F.lit("").alias("adset_id"), F.lit("").alias("ad_id"), F.lit("").alias("objective"),
        F.col("advertising_channel_type").alias("placement"),
        "impressions", "clicks", "spend_usd", "currency_used", "currency_conversion_note",
        "conversions", "conversion_value_usd", "platform", "_load_timestamp",
        "_staged_timestamp", *extra)


def build_stg_store_visits(raw_visits: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    """TAB-13: full refresh over the raw date range, gaps filled with zeros.
    Filled rows carry the run timestamp as load time, so facts built
    incrementally from a load-time watermark pick them up (quirk D3 fixed)."""
    filled = zero_fill(raw_visits, carry=("_load_timestamp",), run_ts=run_ts)
    return filled.withColumn("_staged_timestamp", D.ntz_lit(run_ts))


def build_ref_dma_list(raw_visits: DataFrame) -> DataFrame:
    """TAB-7: one name per DMA code (the largest, deterministically).  The
    distinct (code, name) pairs come first (hash aggregate), the choice of name
    runs on those few rows."""
    pairs = raw_visits.groupBy("dma_code", "dma_name").agg(F.count(F.lit(1)).alias("_n"))
    return pairs.groupBy("dma_code").agg(F.max("dma_name").alias("dma_name"))


def build_ref_campaign_list(raw_metadata: DataFrame) -> DataFrame:
    """TAB-8 + PRJ-9: ``brand || '_' || product_line || '_' || region``
    (NULL if any part is NULL, like ``||``).  One row per campaign id: the
    latest load wins (the whole row breaks ties)."""
    order = [c for c in ("_load_timestamp",) if c in raw_metadata.columns]
    out = raw_metadata.select(
        "campaign_id", "brand", "product_line", "region",
        F.concat("brand", F.lit("_"), "product_line", F.lit("_"), "region")
        .alias("campaign_name_standardized"), *order).transform(
            lambda d: last_per_key(d, ["campaign_id"], order) if order else d.dropDuplicates())
    return out.drop(*order)
