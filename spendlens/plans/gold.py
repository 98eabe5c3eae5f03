"""Gold layer builders (TAB-14 .. TAB-18): dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_PERF_KEY = ["date", "campaign_id", "platform", "adset_id", "ad_id", "objective", "placement"]
FACT_PERF_COLS = FACT_PERF_KEY + ["impressions", "clicks", "spend_usd", "conversions",
                                  "conversion_value_usd"]
FACT_VISITS_KEY = ["date", "dma_code"]


def build_fact_store_visits(stg_visits: DataFrame, region_map: DataFrame) -> DataFrame:
    """TAB-18: staged visits joined to the DMA -> region map.  DMAs missing
    from the map drop out here (inner join); the quality rule
    ``unmapped_keys`` reports them.  The map is the caller's: Spark broadcasts it
    where its size allows."""
    m = region_map.select("dma_code", F.col("dma_name").alias("_map_name"), "mapped_region")
    j = stg_visits.join(m, "dma_code")
    return j.select("date", "dma_code", F.col("_map_name").alias("dma_name"), "mapped_region",
                    "attributed_visits", "attribution_window_days", "is_zero_filled")


def build_dim_campaign(campaign_list: DataFrame) -> DataFrame:
    """TAB-14: campaign attributes only."""
    return campaign_list.select("campaign_id", "brand", "product_line", "region",
                                "campaign_name_standardized")


def build_dim_dma(dma_list: DataFrame, raw_visits: DataFrame) -> DataFrame:
    """TAB-15: DMAs that appear in the raw visits."""
    return dma_list.join(raw_visits.select("dma_code").distinct(), "dma_code", "left_semi") \
        .select("dma_code", "dma_name")


def build_fact_daily_performance(stg_perf: DataFrame) -> DataFrame:
    """TAB-17: performance fact at the silver key grain."""
    return stg_perf.select(*FACT_PERF_COLS)
