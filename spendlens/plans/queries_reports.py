"""Registered report queries (QRY-*, RPT-*) on the bound tables."""

from __future__ import annotations

import datetime as dt

from spendlens.plans import bindings as B
from spendlens.plans import reports as R
from spendlens.plans.catalog import register, with_ctes
from spendlens.sources import reference as REF

_STAR = with_ctes(B.ADS_FACT_SQL, B.CAMPAIGN_DIM_SQL, B.date_dim_sql("ads_fact"))


def _star(spark, d):
    """The fact, its dimension, and a fixed calendar that holds all test dates."""
    days = REF.calendar(spark, dt.date(1990, 1, 1), dt.date(2029, 12, 31))
    return B.ads_fact(spark, d), B.campaign_dim(spark, d), days


def _sum2(expr: str) -> str:
    return f"CAST(ROUND(SUM({expr}), 2) AS DOUBLE)"


def _ratio(num: str, den: str, digits: int = 2) -> str:
    return f"DROUND(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), {digits})"


# ------------------------------------------------------------------ QRY-1
@register("blended_cpa", _STAR + f"""
SELECT dc.brand, dd.year, dd.month, dd.month_name,
       {_ratio('SUM(f.spend_usd)', 'SUM(f.conversions)')} AS blended_cpa,
       {_sum2('f.spend_usd')} AS total_spend,
       {_sum2('f.conversions')} AS total_conversions
FROM ads_fact f
JOIN dim_campaign dc ON f.campaign_id = dc.campaign_id
JOIN dim_date dd ON f.date = dd.date
GROUP BY dc.brand, dd.year, dd.month, dd.month_name
ORDER BY dd.year, dd.month, dc.brand""")
def q_blended_cpa(spark, d):
    return R.blended_cpa(*_star(spark, d))


# ------------------------------------------------------------------ RPT-1/2/5
@register("cpa_by_month", _STAR + f"""
SELECT dd.month, dd.month_name,
       {_ratio('SUM(f.spend_usd)', 'SUM(f.conversions)')} AS blended_cpa
FROM ads_fact f
JOIN dim_campaign dc ON f.campaign_id = dc.campaign_id
JOIN dim_date dd ON f.date = dd.date
GROUP BY dd.month, dd.month_name
ORDER BY dd.month""")
def q_cpa_by_month(spark, d):
    return R.cpa_by_month(*_star(spark, d))


@register("spend_by_month", _STAR + """
SELECT dd.month, dd.month_name, CAST(ROUND(SUM(f.spend_usd), 0) AS DOUBLE) AS total_spend
FROM ads_fact f JOIN dim_date dd ON f.date = dd.date
GROUP BY dd.month, dd.month_name
ORDER BY dd.month""")
def q_spend_by_month(spark, d):
    fact, _, cal = _star(spark, d)
    return R.spend_by_month(fact, cal)


@register("spend_cpa_by_year_month", _STAR + f"""
SELECT dd.year, dd.month, dd.month_name, {_sum2('f.spend_usd')} AS total_spend,
       {_ratio('SUM(f.spend_usd)', 'SUM(f.conversions)')} AS cpa
FROM ads_fact f JOIN dim_date dd ON f.date = dd.date
GROUP BY dd.year, dd.month, dd.month_name
ORDER BY dd.year, dd.month""")
def q_spend_cpa_by_year_month(spark, d):
    fact, _, cal = _star(spark, d)
    return R.spend_cpa_by_year_month(fact, cal)


# ------------------------------------------------------------------ QRY-2
_EVENTS = with_ctes(B.EVENTS_FACT_SQL, B.CUSTOMER_CAMPAIGN_DIM_SQL)


# a week is compared with the campaign's one before it, found by its rank
@register("wow_growth_top10", _EVENTS + """,
ranked AS (
  SELECT campaign_id, strftime(date, '%Y-W%W') AS week, MIN(date) AS a, MAX(date) AS b,
         CAST(SUM(spend_usd) AS DOUBLE) AS s,
         row_number() OVER (PARTITION BY campaign_id ORDER BY strftime(date, '%Y-W%W')) AS k
  FROM events_fact, (SELECT MAX(date) AS newest FROM events_fact)
  WHERE datediff('day', date, newest) <= 28
  GROUP BY campaign_id, strftime(date, '%Y-W%W'))
SELECT campaign_id, campaign_name_standardized, now.week,
       concat(now.a, ' to ', now.b) AS week_range, DROUND(now.s, 2) AS weekly_spend_usd,
       DROUND(old.s, 2) AS prev_week_spend_usd,
       DROUND((now.s - old.s) / old.s * 100, 2) AS week_over_week_growth_pct
FROM ranked now JOIN ranked old USING (campaign_id) JOIN cust_dim USING (campaign_id)
WHERE old.k + 1 = now.k AND old.s <> 0
ORDER BY week_over_week_growth_pct DESC, campaign_id, now.week
LIMIT 10""")
def q_wow_growth_top10(spark, d):
    return R.wow_growth(B.events_fact(spark, d), B.customer_campaign_dim(spark, d))


@register("weekly_spend", with_ctes(B.ADS_FACT_SQL) + """
SELECT campaign_id, strftime(date, '%Y-W%W') AS week,
       CAST(date_trunc('week', date) AS DATE) AS week_start,
       MIN(date) AS first_day, MAX(date) AS last_day,
       CAST(ROUND(SUM(spend_usd), 2) AS DOUBLE) AS weekly_spend_usd
FROM ads_fact
GROUP BY campaign_id, strftime(date, '%Y-W%W'), CAST(date_trunc('week', date) AS DATE)""")
def q_weekly_spend(spark, d):
    return R.weekly_spend(B.ads_fact(spark, d))


# ------------------------------------------------------------------ QRY-3
_VISITS = with_ctes(B.ADS_FACT_SQL, B.CAMPAIGN_DIM_SQL, B.FACT_STORE_VISITS_SQL)

# visits are looked up for each (week, region) of the spend: all of the week's for
# National, else the region's own
_SPEND_VS_VISITS_CTES = _VISITS + """,
counted AS (
  SELECT strftime(date, '%Y-W%W') AS in_week, mapped_region, attributed_visits AS n
  FROM fact_store_visits WHERE is_zero_filled = 0),
spent AS (
  SELECT strftime(date, '%Y-W%W') AS week, CAST(date_trunc('week', date) AS DATE) AS week_start,
         region AS campaign_region, SUM(spend_usd) AS s
  FROM ads_fact JOIN dim_campaign USING (campaign_id) GROUP BY ALL),
weekly AS (
  SELECT *, DROUND(CAST(s AS DOUBLE) / NULLIF(CAST(total_store_visits AS DOUBLE), 0), 2) AS cost_per_visit
  FROM (SELECT *, CAST((SELECT SUM(n) FROM counted WHERE in_week = week
                        AND campaign_region IN ('National', mapped_region)) AS BIGINT)
               AS total_store_visits
        FROM spent))
"""


@register("spend_vs_visits", _SPEND_VS_VISITS_CTES + """
SELECT week, week_start, campaign_region, CAST(ROUND(s, 2) AS DOUBLE) AS total_spend_usd,
       total_store_visits, cost_per_visit
FROM weekly ORDER BY week, campaign_region""")
def q_spend_vs_visits(spark, d):
    return R.spend_vs_visits(B.ads_fact(spark, d), B.campaign_dim(spark, d),
                             B.fact_store_visits(spark, d))


# Every spend row with the visit rows of its day: how many, and their visits; of all regions,
# and of the campaign's own.
_SEEN = _VISITS.rstrip() + """,
seen AS (
  SELECT (SELECT region FROM dim_campaign WHERE campaign_id = a.campaign_id) AS area,
         strftime(date, '%Y-%W') AS week, spend_usd AS spend, date AS day FROM ads_fact a),
counted AS (
  SELECT area, week, spend,
         (SELECT COUNT(*) FROM fact_store_visits WHERE date = day) AS times,
         (SELECT SUM(attributed_visits) FROM fact_store_visits WHERE date = day) AS visits,
         (SELECT COUNT(*) FROM fact_store_visits WHERE date = day AND mapped_region = area) AS own_times,
         (SELECT SUM(attributed_visits) FROM fact_store_visits WHERE date = day AND mapped_region = area)
           AS own_visits
  FROM seen)
"""


@register("spend_vs_visits_fanout", _SEEN + f"""
SELECT week, {_sum2('spend * times')} AS total_spend_usd, CAST(SUM(visits) AS BIGINT) AS total_store_visits,
       {_ratio('SUM(spend * times)', 'SUM(visits)')} AS cost_per_visit
FROM counted WHERE area != 'National' AND times > 0 GROUP BY week ORDER BY week""")
def q_spend_vs_visits_fanout(spark, d):
    return R.spend_vs_visits_fanout(B.ads_fact(spark, d), B.campaign_dim(spark, d),
                                    B.fact_store_visits(spark, d))


@register("spend_vs_visits_region_fanout", _SEEN + f""",
placed AS (
  SELECT area, week, spend, if(area = 'National', times, own_times) AS times,
         if(area = 'National', visits, own_visits) AS visits FROM counted)
SELECT week, area AS campaign_region, {_sum2('spend * times')} AS total_spend_usd,
       CAST(SUM(visits) AS BIGINT) AS total_store_visits,
       {_ratio('SUM(spend * times)', 'SUM(visits)')} AS cost_per_visit
FROM placed WHERE times > 0 AND area IS NOT NULL GROUP BY week, area ORDER BY week, area""")
def q_spend_vs_visits_region_fanout(spark, d):
    return R.spend_vs_visits_region_fanout(B.ads_fact(spark, d), B.campaign_dim(spark, d),
                                           B.fact_store_visits(spark, d))


@register("visit_summary", _SPEND_VS_VISITS_CTES + """,
ranked AS (
  SELECT campaign_region, week, cost_per_visit,
         row_number() OVER (PARTITION BY campaign_region ORDER BY cost_per_visit ASC, week ASC) AS rb,
         row_number() OVER (PARTITION BY campaign_region ORDER BY cost_per_visit DESC, week DESC) AS rw
  FROM weekly WHERE cost_per_visit IS NOT NULL),
tot AS (
  SELECT campaign_region, SUM(s) AS s, SUM(total_store_visits) AS v
  FROM weekly GROUP BY campaign_region)
SELECT t.campaign_region, CAST(ROUND(t.s, 2) AS DOUBLE) AS total_spend_usd,
       CAST(t.v AS BIGINT) AS total_store_visits,
       DROUND(CAST(t.s AS DOUBLE) / NULLIF(CAST(t.v AS DOUBLE), 0), 2) AS spend_per_visit,
       b.week AS best_week, b.cost_per_visit AS best_cost_per_visit,
       w.week AS worst_week, w.cost_per_visit AS worst_cost_per_visit
FROM tot t
LEFT JOIN ranked b ON b.campaign_region = t.campaign_region AND b.rb = 1
LEFT JOIN ranked w ON w.campaign_region = t.campaign_region AND w.rw = 1
ORDER BY t.campaign_region""")
def q_visit_summary(spark, d):
    return R.visit_summary(B.ads_fact(spark, d), B.campaign_dim(spark, d),
                           B.fact_store_visits(spark, d))


# ------------------------------------------------------------------ QRY-4
_BUDGET = with_ctes(B.BUDGET_FACT_SQL, B.CAMPAIGN_METADATA_SQL, B.CUSTOMER_CAMPAIGN_DIM_SQL)

# one pass over the metadata: each campaign with its totals, and beside it the mean daily
# rate of the campaigns of its product line and region that have a budget
_BUDGET_COMPLIANCE_CTES = _BUDGET + """,
totals AS (SELECT campaign_id, SUM(spend_usd) AS total, COUNT(DISTINCT date) AS days_active
           FROM budget_fact GROUP BY campaign_id),
rated AS (
  SELECT m.*, total, days_active, DROUND(AVG(CAST(total AS DOUBLE) / days_active)
           FILTER (m.budget_usd IS NOT NULL) OVER (PARTITION BY product_line, region), 2) AS peers
  FROM campaign_metadata m LEFT JOIN totals USING (campaign_id)),
compliance AS (
  SELECT *, CASE WHEN spent > budget_usd THEN 'OVER BUDGET' ELSE 'WITHIN BUDGET' END AS budget_status,
         DROUND(spent - budget_usd, 2) AS over_budget_amount,
         DROUND(spent / NULLIF(budget_usd, 0) * 100, 1) AS pct_of_budget
  FROM (SELECT campaign_id, campaign_name_standardized, d.brand, r.product_line, r.region,
               CAST(ROUND(total, 2) AS DOUBLE) AS total_spend_usd, CAST(total AS DOUBLE) AS spent,
               CASE WHEN r.budget_usd IS NOT NULL THEN CAST(r.budget_usd AS DOUBLE)
                    ELSE DROUND(peers * CAST(campaign_end_date - campaign_start_date AS INTEGER), 2)
               END AS budget_usd,
               if(r.budget_usd IS NULL, 'ESTIMATED', 'ACTUAL') AS budget_source, days_active
        FROM rated r JOIN cust_dim d USING (campaign_id)
        WHERE total IS NOT NULL AND (r.budget_usd IS NOT NULL OR peers IS NOT NULL)))
"""


def _budget_inputs(spark, d):
    return (B.budget_fact(spark, d), B.customer_campaign_dim(spark, d),
            B.campaign_metadata(spark, d))


@register("budget_compliance", _BUDGET_COMPLIANCE_CTES + """
SELECT * EXCLUDE (spent) FROM compliance ORDER BY over_budget_amount DESC, campaign_id""")
def q_budget_compliance(spark, d):
    return R.budget_compliance(*_budget_inputs(spark, d))


@register("budget_status_counts", _BUDGET_COMPLIANCE_CTES + """,
counts AS (SELECT budget_status, COUNT(*) AS campaigns FROM compliance GROUP BY budget_status)
SELECT budget_status, campaigns,
       DROUND(CAST(campaigns AS DOUBLE) / CAST(SUM(campaigns) OVER () AS DOUBLE) * 100, 1) AS pct
FROM counts ORDER BY budget_status""")
def q_budget_status_counts(spark, d):
    return R.budget_status_counts(*_budget_inputs(spark, d))


_TOTALS = """,
totals AS (SELECT campaign_id, SUM(spend_usd) AS total, COUNT(DISTINCT date) AS days_active
           FROM budget_fact GROUP BY campaign_id),
known AS (
  SELECT campaign_id, campaign_name_standardized, d.brand, total, days_active,
         CAST(ROUND(total, 2) AS DOUBLE) AS total_spend_usd, CAST(m.budget_usd AS DOUBLE) AS budget_usd
  FROM totals JOIN cust_dim d USING (campaign_id) JOIN campaign_metadata m USING (campaign_id)
  WHERE m.budget_usd IS NOT NULL)
"""


@register("over_budget_only", _BUDGET + _TOTALS + """
SELECT campaign_id, campaign_name_standardized, brand, total_spend_usd, budget_usd,
       'OVER BUDGET' AS budget_status,
       DROUND(CAST(total AS DOUBLE) - budget_usd, 2) AS over_budget_amount
FROM known WHERE CAST(total AS DOUBLE) > budget_usd""")
def q_over_budget_only(spark, d):
    return R.over_budget_only(*_budget_inputs(spark, d))


@register("budget_known_only", _BUDGET + _TOTALS + """
SELECT campaign_id, campaign_name_standardized, brand, total_spend_usd, budget_usd, days_active,
       if(total_spend_usd > budget_usd, 'OVER BUDGET', 'WITHIN BUDGET') AS budget_status,
       DROUND(total_spend_usd - budget_usd, 2) AS over_budget_amount,
       DROUND(total_spend_usd / NULLIF(budget_usd, 0) * 100, 1) AS pct_of_budget
FROM known""")
def q_budget_known_only(spark, d):
    return R.budget_known_only(*_budget_inputs(spark, d))


@register("budget_peer_average", _BUDGET + """,
filled AS (
  SELECT campaign_id, d.brand, m.product_line, m.region, m.budget_usd IS NULL AS guessed,
         COALESCE(CAST(m.budget_usd AS DOUBLE),
                  DROUND(CAST(SUM(m.budget_usd) OVER p AS DOUBLE) / NULLIF(COUNT(m.budget_usd) OVER p, 0), 2))
           AS budget
  FROM campaign_metadata m JOIN cust_dim d USING (campaign_id)
  WINDOW p AS (PARTITION BY m.product_line, m.region))
SELECT campaign_id, brand, product_line, region, CAST(ROUND(total, 2) AS DOUBLE) AS total_spend_usd,
       budget AS budget_usd, if(guessed, 'ESTIMATED', 'ACTUAL') AS budget_source,
       if(CAST(total AS DOUBLE) > budget, 'OVER BUDGET', 'WITHIN BUDGET') AS budget_status,
       DROUND(CAST(total AS DOUBLE) - budget, 2) AS over_budget_amount
FROM filled LEFT JOIN (SELECT campaign_id, SUM(spend_usd) AS total FROM budget_fact GROUP BY 1)
  USING (campaign_id)""")
def q_budget_peer_average(spark, d):
    brands = B.customer_campaign_dim(spark, d).select("campaign_id", "brand")
    return R.budget_peer_average(B.budget_fact(spark, d),
                                 B.campaign_metadata(spark, d).join(brands, "campaign_id"))


# ------------------------------------------------------------------ QRY-5
_ROI_SELECT = f"""{_sum2('f.spend_usd')} AS total_spend,
       {_sum2('f.conversion_value_usd')} AS total_conversion_value,
       {_ratio('SUM(f.conversion_value_usd)', 'SUM(f.spend_usd)')} AS roi"""


@register("roi_by_product_line", _STAR + f"""
SELECT dc.product_line, {_ROI_SELECT},
       {_sum2('f.conversions')} AS total_conversions,
       {_ratio('SUM(f.spend_usd)', 'SUM(f.conversions)')} AS cpa
FROM ads_fact f JOIN dim_campaign dc ON f.campaign_id = dc.campaign_id
GROUP BY dc.product_line
ORDER BY roi DESC, dc.product_line""")
def q_roi_by_product_line(spark, d):
    fact, dim, _ = _star(spark, d)
    return R.roi_by_product_line(fact, dim)


@register("roi_by_platform", with_ctes(B.ADS_FACT_SQL) + f"""
SELECT f.platform, {_ROI_SELECT}
FROM ads_fact f GROUP BY f.platform ORDER BY f.platform""")
def q_roi_by_platform(spark, d):
    return R.roi_by_platform(B.ads_fact(spark, d))


@register("roi_by_campaign", _STAR + f"""
SELECT f.campaign_id, dc.campaign_name_standardized, dc.product_line, {_ROI_SELECT},
       {_ratio('SUM(f.spend_usd)', 'SUM(f.conversions)')} AS cpa
FROM ads_fact f JOIN dim_campaign dc ON f.campaign_id = dc.campaign_id
GROUP BY f.campaign_id, dc.campaign_name_standardized, dc.product_line
ORDER BY roi DESC, f.campaign_id""")
def q_roi_by_campaign(spark, d):
    fact, dim, _ = _star(spark, d)
    return R.roi_by_campaign(fact, dim)


# ------------------------------------------------------------------ RPT-3/4/6/9
@register("kpi_overview", _STAR + f"""
SELECT {_sum2('f.spend_usd')} AS total_spend, {_sum2('f.conversions')} AS total_conversions,
       {_ratio('SUM(f.spend_usd)', 'SUM(f.conversions)')} AS average_cpa,
       COUNT(DISTINCT f.campaign_id) AS active_campaigns, COUNT(DISTINCT dc.brand) AS brands
FROM ads_fact f JOIN dim_campaign dc ON f.campaign_id = dc.campaign_id""")
def q_kpi_overview(spark, d):
    fact, dim, _ = _star(spark, d)
    return R.kpi_overview(fact, dim)


@register("platform_share", with_ctes(B.ADS_FACT_SQL) + """
SELECT platform, CAST(ROUND(SUM(spend_usd), 2) AS DOUBLE) AS spend_usd,
       DROUND(CAST(SUM(spend_usd) AS DOUBLE) / CAST(SUM(SUM(spend_usd)) OVER () AS DOUBLE) * 100, 1)
         AS share_pct
FROM ads_fact GROUP BY platform ORDER BY spend_usd DESC, platform""")
def q_platform_share(spark, d):
    return R.platform_share(B.ads_fact(spark, d))


@register("top_campaigns", _STAR + f"""
SELECT f.campaign_id, dc.campaign_name_standardized, {_sum2('f.spend_usd')} AS spend,
       {_sum2('f.conversions')} AS conversions,
       {_ratio('SUM(f.spend_usd)', 'SUM(f.conversions)')} AS cpa
FROM ads_fact f JOIN dim_campaign dc ON f.campaign_id = dc.campaign_id
GROUP BY f.campaign_id, dc.campaign_name_standardized
ORDER BY conversions DESC, f.campaign_id LIMIT 3""")
def q_top_campaigns(spark, d):
    fact, dim, _ = _star(spark, d)
    return R.top_campaigns(fact, dim, 3)


@register("product_line_share", _STAR + f"""
SELECT dc.product_line, {_sum2('f.spend_usd')} AS total_spend,
       {_ratio('SUM(f.conversion_value_usd)', 'SUM(f.spend_usd)')} AS roi,
       DROUND(CAST(SUM(f.spend_usd) AS DOUBLE) / CAST(SUM(SUM(f.spend_usd)) OVER () AS DOUBLE) * 100, 1)
         AS spend_share_pct
FROM ads_fact f JOIN dim_campaign dc ON f.campaign_id = dc.campaign_id
GROUP BY dc.product_line ORDER BY roi DESC, dc.product_line""")
def q_product_line_share(spark, d):
    fact, dim, _ = _star(spark, d)
    return R.product_line_share(fact, dim)


@register("campaign_cpa_vs_average", _STAR + """,
per AS (
  SELECT f.campaign_id, dc.campaign_name_standardized, SUM(f.spend_usd) AS s,
         SUM(f.conversions) AS c
  FROM ads_fact f JOIN dim_campaign dc ON f.campaign_id = dc.campaign_id
  GROUP BY f.campaign_id, dc.campaign_name_standardized),
avg_cpa AS (SELECT CAST(SUM(s) AS DOUBLE) / NULLIF(CAST(SUM(c) AS DOUBLE), 0) AS a FROM per)
SELECT campaign_id, campaign_name_standardized,
       DROUND(CAST(s AS DOUBLE) / NULLIF(CAST(c AS DOUBLE), 0), 2) AS cpa,
       DROUND(a, 2) AS average_cpa,
       DROUND(CAST(s AS DOUBLE) / NULLIF(CAST(c AS DOUBLE), 0) - a, 2) AS cpa_gap
FROM per, avg_cpa ORDER BY cpa_gap, campaign_id""")
def q_campaign_cpa_vs_average(spark, d):
    fact, dim, _ = _star(spark, d)
    return R.campaign_cpa_vs_average(fact, dim)
