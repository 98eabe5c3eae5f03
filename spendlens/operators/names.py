"""Campaign name history (TAB-19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def name_change_log(perf: DataFrame) -> DataFrame:
    """One row per (campaign, name, platform) with first/last seen date and
    active days; ``is_current`` marks the rows whose last-seen date is the
    campaign's latest (compared across platforms, so several rows can be
    current).

    The fact is first collapsed to one row per name; the latest date per
    campaign is an aggregate joined back on the key (no per-campaign window
    buffer, so a campaign with very many names is not held in one task's
    memory)."""
    g = (perf.filter(F.col("campaign_name") != "")
         .groupBy("campaign_id", "campaign_name", "platform")
         .agg(F.min("date").alias("first_seen_date"), F.max("date").alias("last_seen_date"),
              F.count_distinct("date").alias("days_active")))
    latest = g.groupBy("campaign_id").agg(F.max("last_seen_date").alias("_latest"))
    return (g.join(latest, "campaign_id")
            .withColumn("is_current", (F.col("last_seen_date") == F.col("_latest")).cast("int"))
            .drop("_latest"))


def multi_name_campaigns(log: DataFrame) -> DataFrame:
    """DQ-8: campaigns with more than one name and how many are current."""
    g = log.groupBy("campaign_id").agg(
        F.count_distinct("campaign_name").alias("name_count"),
        F.count_if(F.col("is_current") == 1).alias("current_names"))
    return g.filter(F.col("name_count") > 1).orderBy(F.desc("name_count"), "campaign_id")


def name_month_summary(perf: DataFrame, month: str = "_month") -> DataFrame:
    """Per (campaign, name, platform, month): first/last date and distinct
    active days.  A date lies in exactly one month, so these combine across
    months exactly (min, max, sum) -- months untouched by a batch never need
    to be re-read."""
    return (perf.filter(F.col("campaign_name") != "")
            .groupBy("campaign_id", "campaign_name", "platform", month)
            .agg(F.min("date").alias("first_seen_date"), F.max("date").alias("last_seen_date"),
                 F.count_distinct("date").alias("days_active")))


def name_log_from_months(summary: DataFrame) -> DataFrame:
    """TAB-19 from the monthly summaries (same result as ``name_change_log``
    over the whole performance table)."""
    g = (summary.groupBy("campaign_id", "campaign_name", "platform")
         .agg(F.min("first_seen_date").alias("first_seen_date"),
              F.max("last_seen_date").alias("last_seen_date"),
              F.sum("days_active").cast("bigint").alias("days_active")))
    latest = g.groupBy("campaign_id").agg(F.max("last_seen_date").alias("_latest"))
    return (g.join(latest, "campaign_id")
            .withColumn("is_current", (F.col("last_seen_date") == F.col("_latest")).cast("int"))
            .drop("_latest"))
