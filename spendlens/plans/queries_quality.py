"""Registered data-quality queries (DQ-*, RPT-10) on the bound tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendlens.plans import bindings as B
from spendlens.plans import quality as Q
from spendlens.plans.catalog import register, with_ctes
from spendlens.plans.queries_ops import (_DEDUP_BEST_CTES, _DEDUP_BEST_SQL, _FX_SQL, _UNIFY_SQL,
                                         dedup_lineitem,
                                         fx_converted, unified)


# ------------------------------------------------------------------ DQ-1 / SRC-7 / SET-3
@register("table_counts", with_ctes(B.ADS_FACT_SQL, B.CAMPAIGN_DIM_SQL, B.FACT_STORE_VISITS_SQL,
                                    B.CAMPAIGN_METADATA_SQL) + """
SELECT 'fact_daily_performance' AS table_name, COUNT(*) AS row_count FROM ads_fact
UNION ALL SELECT 'dim_campaign', COUNT(*) FROM dim_campaign
UNION ALL SELECT 'raw_store_visits', COUNT(*) FROM raw_store_visits
UNION ALL SELECT 'stg_store_visits', COUNT(*) FROM stg_store_visits
UNION ALL SELECT 'fact_store_visits', COUNT(*) FROM fact_store_visits
UNION ALL SELECT 'raw_campaign_metadata', COUNT(*) FROM campaign_metadata""")
def q_table_counts(spark, d):
    return Q.table_counts({
        "fact_daily_performance": B.ads_fact(spark, d),
        "dim_campaign": B.campaign_dim(spark, d),
        "raw_store_visits": B.raw_store_visits(spark, d),
        "stg_store_visits": B.stg_store_visits(spark, d),
        "fact_store_visits": B.fact_store_visits(spark, d),
        "raw_campaign_metadata": B.campaign_metadata(spark, d),
    })


# ------------------------------------------------------------------ DQ-2 / DQ-3
@register("profile_spend", _FX_SQL + """
SELECT COUNT(*) AS total_records,
       COUNT(*) FILTER (WHERE spend_usd IS NULL) AS null_spend,
       COUNT(*) FILTER (WHERE spend_usd < 0) AS negative_spend,
       COUNT(*) FILTER (WHERE currency_used = 'USD') AS usd_records,
       COUNT(*) FILTER (WHERE currency_conversion_note LIKE 'Converted%') AS converted_records,
       COUNT(*) FILTER (WHERE currency_conversion_note LIKE 'Assumed%') AS assumed_records
FROM converted""")
def q_profile_spend(spark, d):
    return Q.meta_profile(fx_converted(spark, d))


# ------------------------------------------------------------------ DQ-4 / DQ-5
@register("unified_totals", _UNIFY_SQL + """
SELECT platform, COUNT(*) AS record_count,
       CAST(ROUND(SUM(CAST(spend_usd AS DECIMAL(20,4))), 2) AS DOUBLE) AS total_spend,
       CAST(ROUND(SUM(CAST(conversions AS DECIMAL(20,4))), 2) AS DOUBLE) AS total_conversions
FROM unified GROUP BY platform""")
def q_unified_totals(spark, d):
    return Q.platform_totals(unified(spark, d))


@register("google_profile", _UNIFY_SQL + """
SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE spend_usd IS NULL) AS null_spend,
       CAST(ROUND(SUM(CAST(spend_usd AS DECIMAL(20,4))), 2) AS DOUBLE) AS total_spend_usd
FROM unified WHERE platform = 'google'""")
def q_google_profile(spark, d):
    return Q.google_profile(unified(spark, d).filter(F.col("platform") == "google"))


# ------------------------------------------------------------------ DQ-6
@register("visit_fill_profile", with_ctes(B.STG_STORE_VISITS_SQL) + """
SELECT COUNT(*) AS total_records,
       COUNT(*) FILTER (WHERE is_zero_filled = 1) AS zero_filled,
       COUNT(*) FILTER (WHERE is_zero_filled = 0) AS actual_records,
       MIN(date) AS min_date, MAX(date) AS max_date
FROM stg_store_visits""")
def q_visit_fill_profile(spark, d):
    return Q.visit_fill_profile(B.stg_store_visits(spark, d))


# ------------------------------------------------------------------ DQ-7 / AGG-13
_LAST_SEEN_SQL = """last_seen AS (
  SELECT 'lineitem' AS source, CAST(MAX(l_shipdate) AS DATE) AS last_date FROM lineitem
  UNION ALL SELECT 'orders', CAST(MAX(o_orderdate) AS DATE) FROM orders
  UNION ALL SELECT 'events', CAST(MAX(ts) AS DATE) FROM events)"""


def _last_seen(spark, d):
    parts = [B.table(spark, d, t).agg(F.max(c).cast("date").alias("last_date"))
             .select(F.lit(t).alias("source"), "last_date")
             for t, c in (("lineitem", "l_shipdate"), ("orders", "o_orderdate"), ("events", "ts"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("watermark_summary", with_ctes(_LAST_SEEN_SQL) + """
SELECT COUNT(*) AS tracked_tables, MIN(last_date) AS oldest_timestamp,
       MAX(last_date) AS newest_timestamp FROM last_seen""")
def q_watermark_summary(spark, d):
    tracking = _last_seen(spark, d).select(
        F.col("source").alias("table_name"),
        F.col("last_date").alias("last_processed_load_timestamp"))
    return Q.watermark_summary(tracking)


# ------------------------------------------------------------------ DQ-17
@register("source_freshness", with_ctes(_LAST_SEEN_SQL) + """
SELECT source, last_date,
       CAST(datediff('day', last_date, (SELECT MAX(last_date) FROM last_seen)) AS INTEGER) AS lag_days,
       CASE WHEN datediff('day', last_date, (SELECT MAX(last_date) FROM last_seen)) > 1
            THEN 1 ELSE 0 END AS stale
FROM last_seen""")
def q_source_freshness(spark, d):
    return Q.source_freshness(_last_seen(spark, d))


# ------------------------------------------------------------------ DQ-9
@register("rowcount_vs_7day", """
WITH days AS (
  SELECT source, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT event_type AS source, MIN(CAST(ts AS DATE)) AS a, MAX(CAST(ts AS DATE)) AS b
        FROM events GROUP BY 1)),
daily AS (
  SELECT source, date, COUNT(ts) AS row_count
  FROM days LEFT JOIN events ON event_type = source AND CAST(ts AS DATE) = date GROUP BY 1, 2),
a AS (
  SELECT *, AVG(row_count) OVER (PARTITION BY source ORDER BY date
    RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING) AS avg7 FROM daily),
b AS (SELECT *, DROUND((row_count - avg7) / NULLIF(avg7, 0) * 100, 1) AS deviation_pct FROM a)
SELECT source, date, row_count, DROUND(avg7, 2) AS avg_prev_7d, deviation_pct,
       CASE WHEN avg7 IS NULL THEN 'no_history'
            WHEN avg7 = 0 THEN if(row_count = 0, 'ok', 'critical')
            WHEN abs(deviation_pct) > 50 THEN 'critical'
            WHEN abs(deviation_pct) > 20 THEN 'warning' ELSE 'ok' END AS severity
FROM b""")
def q_rowcount_vs_7day(spark, d):
    e = B.table(spark, d, "events")
    daily = e.groupBy(F.col("event_type").alias("source"), F.col("ts").cast("date").alias("date")) \
        .agg(F.count(F.lit(1)).alias("row_count"))
    return Q.rowcount_vs_average(daily)


# ------------------------------------------------------------------ DQ-10
@register("duplicate_share", _DEDUP_BEST_SQL + """,
ds AS (SELECT ship_date, CAST(SUM(duplicate_count) AS BIGINT) AS records,
              CAST(SUM(duplicate_count - 1) AS BIGINT) AS duplicates
       FROM deduped GROUP BY ship_date)
SELECT ship_date, records, duplicates,
       DROUND(CAST(duplicates AS DOUBLE) / NULLIF(CAST(records AS DOUBLE), 0) * 100, 2) AS share_pct,
       CASE WHEN DROUND(CAST(duplicates AS DOUBLE) / NULLIF(CAST(records AS DOUBLE), 0) * 100, 2) > 5
            THEN 1 ELSE 0 END AS alert
FROM ds""")
def q_duplicate_share(spark, d):
    return Q.duplicate_share(dedup_lineitem(spark, d), date="ship_date")


# ------------------------------------------------------------------ DQ-11
@register("non_usd_share", _FX_SQL + """,
g AS (SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
             COUNT(*) AS records, COUNT(*) FILTER (WHERE currency_used != 'USD') AS non_usd_records
      FROM converted GROUP BY 1, 2)
SELECT year, month, records, non_usd_records,
       DROUND(CAST(non_usd_records AS DOUBLE) / CAST(records AS DOUBLE) * 100, 2) AS share_pct,
       CASE WHEN DROUND(CAST(non_usd_records AS DOUBLE) / CAST(records AS DOUBLE) * 100, 2) > 10
            THEN 1 ELSE 0 END AS alert
FROM g""")
def q_non_usd_share(spark, d):
    return Q.non_usd_share(fx_converted(spark, d))


# ------------------------------------------------------------------ DQ-12
@register("missing_fx_rates", _FX_SQL + """
SELECT currency_used, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       COUNT(*) AS rows
FROM converted WHERE currency_used != 'USD' AND fx_found = 0 GROUP BY 1, 2, 3""")
def q_missing_fx_rates(spark, d):
    return Q.missing_fx_rates(fx_converted(spark, d))


@register("duplicate_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def q_duplicate_keys(spark, d):
    return Q.duplicate_keys(B.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("unmapped_keys", with_ctes(B.RAW_STORE_VISITS_SQL, B.DMA_REGION_MAP_SQL) + """
SELECT v.dma_code, max(v.dma_name) AS dma_name, COUNT(*) AS rows,
       CAST(SUM(v.attributed_visits) AS BIGINT) AS attributed_visits
FROM raw_store_visits v
WHERE NOT EXISTS (SELECT 1 FROM dma_region_map m WHERE m.dma_code = v.dma_code)
GROUP BY v.dma_code""")
def q_unmapped_keys(spark, d):
    return Q.unmapped_keys(B.raw_store_visits(spark, d), B.dma_region_map(spark, d))


@register("unacceptable_conditions", _FX_SQL + ",\n" + B.RAW_STORE_VISITS_SQL + ",\n"
          + B.DMA_REGION_MAP_SQL + ",\n" + B.ADS_FACT_SQL + """
SELECT 'missing_fx_rate' AS rule,
       CAST((SELECT COUNT(*) FROM converted WHERE currency_used != 'USD' AND fx_found = 0) AS BIGINT)
         AS violations
UNION ALL SELECT 'duplicate_primary_key',
       (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
                              HAVING COUNT(*) > 1))
UNION ALL SELECT 'negative_spend', (SELECT COUNT(*) FROM ads_fact WHERE spend_usd < 0)
UNION ALL SELECT 'unmapped_dma',
       (SELECT COUNT(DISTINCT dma_code) FROM raw_store_visits v
        WHERE NOT EXISTS (SELECT 1 FROM dma_region_map m WHERE m.dma_code = v.dma_code))""")
def q_unacceptable_conditions(spark, d):
    return Q.unacceptable_conditions(
        converted=fx_converted(spark, d), keyed=B.table(spark, d, "lineitem"),
        keys=["l_orderkey", "l_linenumber"], spend=B.ads_fact(spark, d),
        visits=B.raw_store_visits(spark, d), mapping=B.dma_region_map(spark, d))


# ------------------------------------------------------------------ DQ-13
@register("cpa_alerts", with_ctes(B.ADS_FACT_SQL) + """,
g AS (SELECT date, SUM(spend_usd) AS s, SUM(conversions) AS c FROM ads_fact GROUP BY date)
SELECT date, CAST(ROUND(s, 2) AS DOUBLE) AS spend_usd, CAST(ROUND(c, 2) AS DOUBLE) AS conversions,
       DROUND(CAST(s AS DOUBLE) / NULLIF(CAST(c AS DOUBLE), 0), 2) AS cpa
FROM g WHERE DROUND(CAST(s AS DOUBLE) / NULLIF(CAST(c AS DOUBLE), 0), 2) > 60""")
def q_cpa_alerts(spark, d):
    return Q.cpa_alerts(B.ads_fact(spark, d))


@register("visit_drop_alerts", with_ctes(B.FACT_STORE_VISITS_SQL) + """,
weekly AS (SELECT mapped_region, strftime(date, '%Y-W%W') AS week,
                  CAST(SUM(attributed_visits) AS BIGINT) AS visits
           FROM fact_store_visits GROUP BY 1, 2),
l AS (SELECT *, LAG(visits) OVER (PARTITION BY mapped_region ORDER BY week) AS prev_visits
      FROM weekly),
x AS (SELECT *, CASE WHEN prev_visits > 0 THEN
                  DROUND(CAST(prev_visits - visits AS DOUBLE) / prev_visits * 100, 1) END AS drop_pct
      FROM l)
SELECT mapped_region, week, visits, prev_visits, drop_pct FROM x WHERE drop_pct > 30""")
def q_visit_drop_alerts(spark, d):
    return Q.visit_drop_alerts(B.fact_store_visits(spark, d))


@register("conversion_rate_alerts", """
WITH g AS (
  SELECT CAST(ts AS DATE) AS date,
         SUM(CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS DECIMAL(20,4))) AS c,
         SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS clicks
  FROM events GROUP BY 1)
SELECT date, CAST(ROUND(c, 2) AS DOUBLE) AS conversions, CAST(clicks AS BIGINT) AS clicks,
       DROUND(CAST(c AS DOUBLE) / NULLIF(CAST(clicks AS DOUBLE), 0) * 100, 2) AS conversion_rate_pct,
       CASE WHEN DROUND(CAST(c AS DOUBLE) / NULLIF(CAST(clicks AS DOUBLE), 0) * 100, 2) < 1
            THEN 1 ELSE 0 END AS alert
FROM g""")
def q_conversion_rate_alerts(spark, d):
    e = B.table(spark, d, "events")
    rows = e.select(F.col("ts").cast("date").alias("date"),
                    (F.col("event_type") == "purchase").cast("int").alias("conversions"),
                    (F.col("event_type") == "click").cast("int").alias("clicks"))
    return Q.conversion_rate_alerts(rows)


# ------------------------------------------------------------------ DQ-14
@register("spend_vs_forecast", with_ctes(B.ADS_FACT_SQL) + """,
daily AS (SELECT platform, date, SUM(spend_usd) AS s FROM ads_fact GROUP BY platform, date),
f AS (SELECT *, CAST(COALESCE(SUM(s) OVER w, 0) AS DOUBLE)
             / NULLIF(least(7, date - MIN(date) OVER (PARTITION BY platform)), 0) AS fc FROM daily
      WINDOW w AS (PARTITION BY platform ORDER BY date
                   RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING))
SELECT platform, date, CAST(ROUND(s, 2) AS DOUBLE) AS spend_usd,
       FLOOR(fc * 100.0 + 0.5) / 100.0 AS forecast_spend,
       FLOOR((CAST(s AS DOUBLE) - fc) * 100.0 + 0.5) / 100.0 AS deviation,
       CASE WHEN abs(CAST(s AS DOUBLE) - fc) > 100000 THEN 1 ELSE 0 END AS alert
FROM f""")
def q_spend_vs_forecast(spark, d):
    return Q.spend_vs_forecast(B.ads_fact(spark, d))


# ------------------------------------------------------------------ DQ-15 / DQ-16
@register("reconcile_loss", _UNIFY_SQL + ",\n" + B.ADS_FACT_SQL + """,
b AS (SELECT platform, SUM(spend_usd) AS bs, SUM(conversions) AS bc FROM ads_fact GROUP BY platform),
g AS (SELECT objective AS platform, SUM(CAST(spend_usd AS DECIMAL(20,4))) AS gs,
             SUM(CAST(conversions AS DECIMAL(20,4))) AS gc
      FROM unified WHERE platform = 'meta' GROUP BY objective),
j AS (SELECT b.platform, bs, gs, bc, gc,
             DROUND(CAST(bs - COALESCE(gs, 0) AS DOUBLE) / NULLIF(CAST(bs AS DOUBLE), 0) * 100, 3) + 0.0
               AS sl,
             DROUND(CAST(bc - COALESCE(gc, 0) AS DOUBLE) / NULLIF(CAST(bc AS DOUBLE), 0) * 100, 3) + 0.0
               AS cl
      FROM b LEFT JOIN g ON b.platform = g.platform)
SELECT platform, CAST(ROUND(bs, 2) AS DOUBLE) AS bronze_spend, CAST(ROUND(gs, 2) AS DOUBLE) AS gold_spend,
       sl AS spend_loss_pct, CAST(ROUND(bc, 2) AS DOUBLE) AS bronze_conversions,
       CAST(ROUND(gc, 2) AS DOUBLE) AS gold_conversions, cl AS conversion_loss_pct,
       CASE WHEN sl > 0.5 THEN 1 ELSE 0 END AS spend_loss_alert,
       CASE WHEN cl > 1.0 THEN 1 ELSE 0 END AS conversion_loss_alert,
       CASE WHEN abs(sl) > 5 THEN 1 ELSE 0 END AS spend_mismatch_alert
FROM j""")
def q_reconcile_loss(spark, d):
    gold = unified(spark, d).filter(F.col("platform") == "meta") \
        .drop("platform").withColumnRenamed("objective", "platform")
    return Q.reconcile(B.ads_fact(spark, d), gold)


@register("visit_loss", with_ctes(B.FACT_STORE_VISITS_SQL) + """,
t AS (SELECT (SELECT SUM(attributed_visits) FROM raw_store_visits) AS raw_visits,
             (SELECT SUM(attributed_visits) FROM fact_store_visits WHERE is_zero_filled = 0)
               AS fact_visits)
SELECT CAST(raw_visits AS BIGINT) AS raw_visits, CAST(fact_visits AS BIGINT) AS fact_visits,
       DROUND(CAST(raw_visits - fact_visits AS DOUBLE) / NULLIF(CAST(raw_visits AS DOUBLE), 0) * 100, 3)
         AS visit_loss_pct,
       CASE WHEN DROUND(CAST(raw_visits - fact_visits AS DOUBLE)
                        / NULLIF(CAST(raw_visits AS DOUBLE), 0) * 100, 3) > 5 THEN 1 ELSE 0 END AS alert
FROM t""")
def q_visit_loss(spark, d):
    return Q.reconcile_visits(B.raw_store_visits(spark, d), B.fact_store_visits(spark, d))


@register("silver_key_collisions", """
SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS campaign_id, COUNT(*) AS rows,
       COUNT(DISTINCT l_partkey) AS names
FROM lineitem
GROUP BY 1, 2 HAVING COUNT(DISTINCT l_partkey) > 1""")
def q_silver_key_collisions(spark, d):
    """DQ-12 / quirk D2: rows whose narrower key (which leaves out a column
    of the wider key -- here the part, as the silver key leaves out the
    campaign name) collides although the wider key differs."""
    li = B.table(spark, d, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_suppkey").alias("campaign_id"),
        F.col("l_partkey").alias("name"))
    return Q.key_collisions(li, ["date", "campaign_id"], "name")


# ------------------------------------------------------------------ RPT-10
@register("quality_issue_summary", _FX_SQL + ",\n" + _DEDUP_BEST_CTES + ",\n"
          + B.STG_STORE_VISITS_SQL + ",\n" + B.CAMPAIGN_METADATA_SQL + """,
issues AS (
  SELECT 'currency conversion' AS issue,
         COUNT(*) FILTER (WHERE currency_conversion_note LIKE 'Converted%') AS records_affected,
         COUNT(*) AS total_records FROM converted
  UNION ALL SELECT 'missing currency', COUNT(*) FILTER (WHERE currency_missing = 1), COUNT(*)
    FROM converted
  UNION ALL SELECT 'duplicate records', CAST(SUM(duplicate_count - 1) AS BIGINT),
    CAST(SUM(duplicate_count) AS BIGINT) FROM deduped
  UNION ALL SELECT 'zero-filled store visits', COUNT(*) FILTER (WHERE is_zero_filled = 1), COUNT(*)
    FROM stg_store_visits
  UNION ALL SELECT 'missing budgets', COUNT(*) FILTER (WHERE budget_usd IS NULL), COUNT(*)
    FROM campaign_metadata)
SELECT *, DROUND(CAST(records_affected AS DOUBLE) / NULLIF(CAST(total_records AS DOUBLE), 0) * 100, 1)
  AS pct FROM issues""")
def q_quality_issue_summary(spark, d):
    conv = fx_converted(spark, d)
    dd = dedup_lineitem(spark, d)
    sv = B.stg_store_visits(spark, d)
    md = B.campaign_metadata(spark, d)
    s = Q.issue_summary({
        "currency conversion": (conv, F.count_if(F.col("currency_conversion_note")
                                                 .startswith("Converted")), F.count(F.lit(1))),
        "missing currency": (conv, F.count_if(F.col("currency_missing") == 1), F.count(F.lit(1))),
        "duplicate records": (dd, F.sum(F.col("duplicate_count") - 1), F.sum("duplicate_count")),
        "zero-filled store visits": (sv, F.count_if(F.col("is_zero_filled") == 1), F.count(F.lit(1))),
        "missing budgets": (md, F.count_if(F.col("budget_usd").isNull()), F.count(F.lit(1))),
    })
    return s
