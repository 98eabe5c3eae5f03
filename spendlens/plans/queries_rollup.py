"""Queries over kept aggregates: states of two batches, merged."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators.rollup import (active_days, apply_batch, day_bits, merge_day_bits,
                                        replaced_rows, rollup)
from spendlens.plans import bindings as B
from spendlens.plans.catalog import register

PERIOD = (dt.date(1994, 2, 11), dt.date(1996, 9, 5))


@register("days_active_merged", f"""
SELECT CAST(l_suppkey AS BIGINT) AS campaign_id, l_returnflag AS objective,
       COUNT(DISTINCT CAST(l_shipdate AS DATE)) AS days_active
FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}'
GROUP BY ALL""")
def q_days_active_merged(spark: SparkSession, d: str) -> DataFrame:
    """AGG-3/4, TAB-19: distinct active days of a period from the day bits of two batches that
    share days; the rows are not looked at again."""
    keys = ["campaign_id", "objective"]
    li = B.table(spark, d, "lineitem").select(
        F.col("l_suppkey").cast("bigint").alias("campaign_id"), F.col("l_returnflag").alias("objective"),
        F.col("l_shipdate").cast("date").alias("date"), "l_linenumber")
    states = [day_bits(li.where(c), keys) for c in ("l_linenumber <= 3", "l_linenumber > 2")]
    return active_days(merge_day_bits(states, keys), keys, *PERIOD)


_LATER = "(l_linenumber >= 5 OR (l_linenumber = 2 AND l_partkey % 3 = 0))"


@register("spend_after_two_batches", f"""
WITH rows AS (
  SELECT CAST(l_suppkey AS BIGINT) AS campaign_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         CAST(l_extendedprice AS DECIMAL(14,2)) * if(l_linenumber = 2 AND l_partkey % 3 = 0, 2, 1) AS spend,
         CAST(l_quantity AS DECIMAL(14,2)) AS conversions
  FROM lineitem WHERE NOT (l_linenumber = 3 AND l_partkey % 5 = 0))
SELECT campaign_id, month, COUNT(*) AS n_rows, CAST(SUM(spend) AS DOUBLE) AS spend_usd,
       CAST(SUM(conversions) AS DOUBLE) AS conversions
FROM rows GROUP BY campaign_id, month""")
def q_spend_after_two_batches(spark: SparkSession, d: str) -> DataFrame:
    """QRY-1/5, RPT-1..6: campaign sums by day kept through a batch that brings rows, replaces
    rows by their key (twice the spend) and takes rows away; the report folds the state."""
    measures = {"spend_usd": "decimal(14,2)", "conversions": "decimal(14,2)"}
    keys, row_key = ["campaign_id", "date"], ["l_orderkey", "l_linenumber", "l_partkey"]
    li = B.table(spark, d, "lineitem").select(
        *row_key, F.col("l_suppkey").cast("bigint").alias("campaign_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("spend_usd"),
        F.col("l_quantity").cast("decimal(14,2)").alias("conversions"))
    fact = li.where("l_linenumber < 5")
    batch = li.where(_LATER).withColumn("spend_usd", (F.col("spend_usd") * F.when(
        F.col("l_linenumber") == 2, 2).otherwise(1)).cast("decimal(14,2)"))
    gone = fact.where("l_linenumber = 3 and l_partkey % 5 = 0")
    state = rollup(fact, keys, measures)
    now = apply_batch(state, batch, replaced_rows(fact, batch, row_key).unionByName(gone), keys, measures)
    return now.groupBy("campaign_id", F.trunc("date", "month").alias("month")).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("spend_usd").cast("double").alias("spend_usd"),
        F.sum("conversions").cast("double").alias("conversions"))
