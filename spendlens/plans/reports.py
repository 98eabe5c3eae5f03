"""Reporting queries (QRY-*, RPT-*) over the media star schema.

Inputs are media-shaped DataFrames:

fact      date, campaign_id, platform, spend_usd, conversions,
          conversion_value_usd  (+ anything else)
dim       campaign_id, brand, product_line, region, campaign_name_standardized
dim_date  date, year, month, month_name, ...
visits    fact_store_visits: date, dma_code, mapped_region, attributed_visits,
          is_zero_filled
metadata  campaign_id, product_line, region, campaign_start_date,
          campaign_end_date, budget_usd

Plan shape used throughout: the fact is aggregated to the campaign grain (or
campaign x period) *before* it meets a dimension.  Dimension attributes depend
only on the campaign key, so the result is the same as joining first, but the
join and every later shuffle see one partially aggregated row per campaign and
period instead of the raw fact rows.  Partial aggregation runs map-side, so a
campaign holding a large share of the rows does not concentrate raw rows in
one task.  Dimensions derived from data are not force-broadcast: Spark's
size-based broadcast threshold (checked again at run time by AQE) decides, and
falls back to a shuffle join beyond it.

"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions import dates as D
from spendlens.functions import money as M
from spendlens.operators.regional import NATIONAL, match_regions


def _sums(fact: DataFrame, *names: str):
    return [M.exact_sum(fact, n).alias(n) for n in names]


def _with_calendar(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The fact with the calendar's year, month and month name in place of its own."""
    names = ("year", "month", "month_name")
    cal = dim_date.select("date", *names)
    return fact.drop(*names).join(cal, "date")


# ---------------------------------------------------------------- QRY-1
def blended_cpa(fact: DataFrame, dim: DataFrame, dim_date: DataFrame) -> DataFrame:
    f = _with_calendar(fact, dim_date)
    pre = f.groupBy("campaign_id", "year", "month", "month_name").agg(
        *_sums(fact, "spend_usd", "conversions"))
    j = pre.join(dim.select("campaign_id", "brand"), "campaign_id")
    g = j.groupBy("brand", "year", "month", "month_name").agg(
        F.sum("spend_usd").alias("s"), F.sum("conversions").alias("c"))
    return g.select("brand", "year", "month", "month_name",
                    M.round_ratio("s", "c").alias("blended_cpa"),
                    M.round_money("s").alias("total_spend"),
                    M.round_money("c").alias("total_conversions")
                    ).orderBy("year", "month", "brand")


# ---------------------------------------------------------------- RPT-1/2/5
def cpa_by_month(fact: DataFrame, dim: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Blended CPA per calendar month (all years together, like the chart)."""
    pre = _with_calendar(fact, dim_date).groupBy("campaign_id", "month", "month_name").agg(
        *_sums(fact, "spend_usd", "conversions"))
    g = (pre.join(dim.select("campaign_id"), "campaign_id", "left_semi")
         .groupBy("month", "month_name").agg(F.sum("spend_usd").alias("spend_usd"),
                                             F.sum("conversions").alias("conversions")))
    return g.select("month", "month_name",
                    M.round_ratio("spend_usd", "conversions").alias("blended_cpa")
                    ).orderBy("month")


def spend_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    f = _with_calendar(fact, dim_date)
    g = f.groupBy("month", "month_name").agg(*_sums(fact, "spend_usd"))
    return g.select("month", "month_name", M.round_money("spend_usd", 0).alias("total_spend")
                    ).orderBy("month")


def spend_cpa_by_year_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """RPT-5: spend and CPA per (year, month)."""
    f = _with_calendar(fact, dim_date)
    g = f.groupBy("year", "month", "month_name").agg(*_sums(fact, "spend_usd", "conversions"))
    return g.select("year", "month", "month_name",
                    M.round_money("spend_usd").alias("total_spend"),
                    M.round_ratio("spend_usd", "conversions").alias("cpa")
                    ).orderBy("year", "month")


# ---------------------------------------------------------------- QRY-2
def weekly_spend(fact: DataFrame) -> DataFrame:
    """Weekly spend per campaign with the Monday-week label and week start."""
    g = fact.groupBy("campaign_id", D.week_label("date").alias("week"),
                     D.week_start("date").alias("week_start")).agg(
        F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        *_sums(fact, "spend_usd"))
    return g.select("campaign_id", "week", "week_start", "first_day", "last_day",
                    M.round_money("spend_usd").alias("weekly_spend_usd"))


def wow_growth(fact: DataFrame, dim: DataFrame, *, days: int = 28, top: int | None = 10,
               sep: str = "-W") -> DataFrame:
    """Week-over-week spend growth over the last ``days`` days of data."""
    # one value, as a literal: the scan is pruned by date and, on stored tables, by month
    last = fact.agg(F.max("date")).first()[0]
    since = last - datetime.timedelta(days=days) if last else datetime.date.max
    recent = fact.filter(F.col("date") >= F.lit(since))
    if "_month" in fact.columns:
        recent = recent.filter(F.col("_month") >= F.lit(since.replace(day=1)))
    pre = recent.groupBy("campaign_id", D.week_label("date", sep).alias("week")).agg(
        F.min("date").alias("week_start"), F.max("date").alias("week_end"),
        M.exact_sum(recent, "spend_usd").cast("double").alias("weekly_spend"))
    j = pre.join(dim.select("campaign_id", "campaign_name_standardized"), "campaign_id")
    w = Window.partitionBy("campaign_id").orderBy("week")
    g = (j.withColumn("prev_week_spend", F.lag("weekly_spend").over(w))
         .withColumn("week_over_week_growth_pct",
                     M.growth_pct("weekly_spend", "prev_week_spend"))
         .filter(F.col("week_over_week_growth_pct").isNotNull()))
    out = g.select("campaign_id", "campaign_name_standardized", "week",
                   F.concat(F.col("week_start").cast("string"), F.lit(" to "),
                            F.col("week_end").cast("string")).alias("week_range"),
                   F.round("weekly_spend", 2).alias("weekly_spend_usd"),
                   F.round("prev_week_spend", 2).alias("prev_week_spend_usd"),
                   "week_over_week_growth_pct")
    out = out.orderBy(F.desc("week_over_week_growth_pct"), "campaign_id", "week")
    return out.limit(top) if top else out


# ---------------------------------------------------------------- QRY-3
def _campaign_period_spend(fact: DataFrame, dim: DataFrame, period_cols, extra=()):
    pre = fact.groupBy("campaign_id", *period_cols).agg(
        *_sums(fact, "spend_usd"), *[e for e in extra])
    return pre.join(dim.select("campaign_id", "region"), "campaign_id")


def spend_vs_visits(fact: DataFrame, dim: DataFrame, visits: DataFrame,
                    rounded: bool = True) -> DataFrame:
    """Weekly spend, actual visits and cost per visit by campaign region."""
    totals = (visits.filter(F.col("is_zero_filled") == 0)
              .groupBy(D.week_label("date").alias("week"), "mapped_region")
              .agg(F.sum("attributed_visits").alias("total_store_visits")))
    by_region = match_regions(dim, totals, keys=["week"], value="total_store_visits")
    spend = (_campaign_period_spend(fact, dim, [D.week_label("date").alias("week"),
                                                D.week_start("date").alias("week_start")])
             .groupBy("week", "week_start", F.col("region").alias("campaign_region"))
             .agg(F.sum("spend_usd").alias("s")))
    j = spend.join(by_region, ["week", "campaign_region"], "left")
    return j.select("week", "week_start", "campaign_region",
                    (M.round_money("s") if rounded else F.col("s")).alias(
                        "total_spend_usd" if rounded else "s"),
                    F.col("total_store_visits").cast("bigint").alias("total_store_visits"),
                    M.round_ratio("s", "total_store_visits").alias("cost_per_visit")
                    ).orderBy("week", "campaign_region", "week_start")


def spend_vs_visits_fanout(fact: DataFrame, dim: DataFrame, visits: DataFrame) -> DataFrame:
    """Draft QRY-3a: regional campaigns joined to visits on date only.  The
    many-to-many totals are computed from per-date (sum, count) pairs."""
    spend = (_campaign_period_spend(fact, dim, ["date"], [F.count(F.lit(1)).alias("m")])
             .filter(F.col("region") != NATIONAL)
             .groupBy("date").agg(F.sum("spend_usd").alias("S"), F.sum("m").alias("m")))
    vis = visits.groupBy("date").agg(F.sum("attributed_visits").alias("V"),
                                     F.count(F.lit(1)).alias("n"))
    j = spend.join(vis, "date")
    g = j.groupBy(D.week_label("date", "-").alias("week")).agg(
        F.sum(F.col("S") * F.col("n")).alias("s"), F.sum(F.col("V") * F.col("m")).alias("v"))
    return g.select("week", M.round_money("s").alias("total_spend_usd"),
                    F.col("v").cast("bigint").alias("total_store_visits"),
                    M.round_ratio("s", "v").alias("cost_per_visit")).orderBy("week")


def spend_vs_visits_region_fanout(fact: DataFrame, dim: DataFrame,
                                  visits: DataFrame) -> DataFrame:
    """Draft QRY-3b: join on date AND (National OR region = mapped_region),
    summed per (week, campaign region); zero-filled rows count as rows."""
    spend = (_campaign_period_spend(fact, dim, ["date"], [F.count(F.lit(1)).alias("m")])
             .groupBy("date", "region").agg(F.sum("spend_usd").alias("S"),
                                            F.sum("m").alias("m")))
    vis_r = visits.groupBy("date", "mapped_region").agg(
        F.sum("attributed_visits").alias("V"), F.count(F.lit(1)).alias("n"))
    # per-date totals folded from the per-region sums (the visits input is
    # aggregated once, not twice)
    vis_t = vis_r.groupBy("date").agg(F.sum("V").alias("V"), F.sum("n").alias("n"))
    regional = (spend.filter(F.col("region") != NATIONAL)
                .join(vis_r, (spend.date == vis_r.date) & (spend.region == vis_r.mapped_region))
                .select(spend.date, spend.region, "S", "m", "V", "n"))
    national = spend.filter(F.col("region") == NATIONAL).join(vis_t, "date").select(
        "date", "region", "S", "m", "V", "n")
    u = regional.unionByName(national)
    g = u.groupBy(D.week_label("date", "-").alias("week"),
                  F.col("region").alias("campaign_region")).agg(
        F.sum(F.col("S") * F.col("n")).alias("s"), F.sum(F.col("V") * F.col("m")).alias("v"))
    return g.select("week", "campaign_region", M.round_money("s").alias("total_spend_usd"),
                    F.col("v").cast("bigint").alias("total_store_visits"),
                    M.round_ratio("s", "v").alias("cost_per_visit")
                    ).orderBy("week", "campaign_region")


# ---------------------------------------------------------------- QRY-4
def campaign_spend(fact: DataFrame) -> DataFrame:
    """Total spend (exact) and active days per campaign."""
    return fact.groupBy("campaign_id").agg(
        M.exact_sum(fact, "spend_usd").alias("total_spend"),
        F.count_distinct("date").alias("days_active"))


def estimated_budgets(metadata: DataFrame, spend: DataFrame) -> DataFrame:
    """Actual budgets plus budgets estimated as (average daily spend rate of
    budgeted peers with the same product line and region) x duration."""
    has_budget = F.col("budget_usd").isNotNull()
    rate = (metadata.filter(has_budget).join(spend, "campaign_id")
            .select("product_line", "region",
                    (F.col("total_spend").cast("double") / F.col("days_active"))
                    .alias("daily_avg_spend"))
            .groupBy("product_line", "region")
            .agg(F.round(F.avg("daily_avg_spend"), 2).alias("avg_daily_rate"),
                 F.count(F.lit(1)).alias("campaign_count")))
    actual = metadata.filter(has_budget).select(
        "campaign_id", "product_line", "region",
        F.col("budget_usd").cast("double").alias("budget_usd"),
        F.lit("ACTUAL").alias("budget_source"))
    duration = F.datediff("campaign_end_date", "campaign_start_date")
    estimated = (metadata.filter(~has_budget).join(rate, ["product_line", "region"])
                 .select("campaign_id", "product_line", "region",
                         F.round(F.col("avg_daily_rate") * duration, 2).alias("budget_usd"),
                         F.lit("ESTIMATED").alias("budget_source")))
    return actual.unionByName(estimated)


def budget_compliance(fact: DataFrame, dim: DataFrame, metadata: DataFrame) -> DataFrame:
    spend = campaign_spend(fact)
    budgets = estimated_budgets(metadata, spend)
    j = (budgets.join(dim.select("campaign_id", "campaign_name_standardized", "brand"),
                      "campaign_id")
         .join(spend, "campaign_id"))
    total = F.col("total_spend").cast("double")
    return j.select(
        "campaign_id", "campaign_name_standardized", "brand", "product_line", "region",
        M.round_money("total_spend").alias("total_spend_usd"),
        "budget_usd", "budget_source", "days_active",
        M.budget_status(total, F.col("budget_usd")).alias("budget_status"),
        F.round(total - F.col("budget_usd"), 2).alias("over_budget_amount"),
        F.round(F.try_divide(total, F.col("budget_usd")) * 100, 1).alias("pct_of_budget"),
    ).orderBy(F.desc("over_budget_amount"), "campaign_id")


def over_budget_only(fact: DataFrame, dim: DataFrame, metadata: DataFrame) -> DataFrame:
    """Draft QRY-4a: only campaigns whose spend exceeds a known budget."""
    spend = fact.groupBy("campaign_id").agg(M.exact_sum(fact, "spend_usd").alias("total_spend"))
    j = (spend.join(dim.select("campaign_id", "campaign_name_standardized", "brand"),
                    "campaign_id")
         .join(metadata.select("campaign_id", "budget_usd"), "campaign_id", "left"))
    total = F.col("total_spend").cast("double")
    budget = F.col("budget_usd").cast("double")
    out = j.select("campaign_id", "campaign_name_standardized", "brand",
                   M.round_money("total_spend").alias("total_spend_usd"),
                   budget.alias("budget_usd"),
                   M.budget_status(total, budget, with_missing="NO BUDGET").alias("budget_status"),
                   F.round(total - budget, 2).alias("over_budget_amount"))
    return out.filter(F.col("budget_status") == "OVER BUDGET").orderBy(
        F.desc("over_budget_amount"), "campaign_id")


def budget_known_only(fact: DataFrame, dim: DataFrame, metadata: DataFrame) -> DataFrame:
    """Commented QRY-4b: campaigns that have a budget; the rounded total is
    compared with it."""
    spend = campaign_spend(fact)
    j = (spend.join(dim.select("campaign_id", "campaign_name_standardized", "brand"),
                    "campaign_id")
         .join(metadata.select("campaign_id", "budget_usd"), "campaign_id", "left")
         .filter(F.col("budget_usd").isNotNull()))
    total = M.round_money("total_spend")
    budget = F.col("budget_usd").cast("double")
    return j.select("campaign_id", "campaign_name_standardized", "brand",
                    total.alias("total_spend_usd"), budget.alias("budget_usd"), "days_active",
                    M.budget_status(total, budget, with_missing="NO BUDGET AVAILABLE")
                    .alias("budget_status"),
                    F.round(total - budget, 2).alias("over_budget_amount"),
                    F.round(F.try_divide(total, budget) * 100, 1).alias("pct_of_budget")
                    ).orderBy(F.desc("over_budget_amount"), "campaign_id")


def budget_peer_average(fact: DataFrame, metadata: DataFrame) -> DataFrame:
    """Commented QRY-4c: a missing budget is the average budget of the
    campaigns with the same product line and region."""
    has_budget = F.col("budget_usd").isNotNull()
    avgs = (metadata.filter(has_budget).groupBy("product_line", "region")
            .agg(F.round(F.sum("budget_usd").cast("double") / F.count("budget_usd"), 2)
                 .alias("avg_budget")))
    cb = (metadata.join(avgs, ["product_line", "region"], "left")
          .select("campaign_id", "brand", "product_line", "region",
                  F.coalesce(F.col("budget_usd").cast("double"), F.col("avg_budget"))
                  .alias("budget_usd"),
                  F.when(has_budget, F.lit("ACTUAL")).otherwise(F.lit("ESTIMATED"))
                  .alias("budget_source")))
    spend = fact.groupBy("campaign_id").agg(M.exact_sum(fact, "spend_usd").alias("total_spend"))
    j = cb.join(spend, "campaign_id", "left")
    total = F.col("total_spend").cast("double")
    return j.select("campaign_id", "brand", "product_line", "region",
                    M.round_money("total_spend").alias("total_spend_usd"),
                    "budget_usd", "budget_source",
                    M.budget_status(total, F.col("budget_usd")).alias("budget_status"),
                    F.round(total - F.col("budget_usd"), 2).alias("over_budget_amount")
                    ).orderBy(F.desc_nulls_last("over_budget_amount"), "campaign_id")


# ---------------------------------------------------------------- QRY-5
def _campaign_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("campaign_id").agg(
        *_sums(fact, "spend_usd", "conversion_value_usd", "conversions"))


def _roi_cols(with_conv: bool = True):
    cols = [M.round_money("spend_usd").alias("total_spend"),
            M.round_money("conversion_value_usd").alias("total_conversion_value"),
            M.round_ratio("conversion_value_usd", "spend_usd").alias("roi")]
    if with_conv:
        cols += [M.round_money("conversions").alias("total_conversions"),
                 M.round_ratio("spend_usd", "conversions").alias("cpa")]
    return cols


def roi_by_product_line(fact: DataFrame, dim: DataFrame) -> DataFrame:
    j = _campaign_totals(fact).join(dim.select("campaign_id", "product_line"), "campaign_id")
    g = j.groupBy("product_line").agg(
        *[F.sum(c).alias(c) for c in ("spend_usd", "conversion_value_usd", "conversions")])
    return g.select("product_line", *_roi_cols()).orderBy(F.desc("roi"), "product_line")


def roi_by_platform(fact: DataFrame) -> DataFrame:
    g = fact.groupBy("platform").agg(*_sums(fact, "spend_usd", "conversion_value_usd"))
    return g.select("platform", *_roi_cols(with_conv=False)).orderBy("platform")


def roi_by_campaign(fact: DataFrame, dim: DataFrame) -> DataFrame:
    j = _campaign_totals(fact).join(
        dim.select("campaign_id", "campaign_name_standardized", "product_line"), "campaign_id")
    cols = _roi_cols()
    return j.select("campaign_id", "campaign_name_standardized", "product_line",
                    cols[0], cols[1], cols[2], cols[4]).orderBy(F.desc("roi"), "campaign_id")


# ---------------------------------------------------------------- RPT-3/4/6
def kpi_overview(fact: DataFrame, dim: DataFrame) -> DataFrame:
    per = _campaign_totals(fact).join(dim.select("campaign_id", "brand"), "campaign_id")
    g = per.agg(F.sum("spend_usd").alias("s"), F.sum("conversions").alias("c"),
                F.count(F.lit(1)).alias("active_campaigns"),
                F.count_distinct("brand").alias("brands"))
    return g.select(M.round_money("s").alias("total_spend"),
                    M.round_money("c").alias("total_conversions"),
                    M.round_ratio("s", "c").alias("average_cpa"),
                    "active_campaigns", "brands")


def platform_share(fact: DataFrame) -> DataFrame:
    g = fact.groupBy("platform").agg(*_sums(fact, "spend_usd"))
    total = g.select(F.sum("spend_usd").cast("double")).scalar()
    return g.select("platform", M.round_money("spend_usd").alias("spend_usd"),
                    F.round(F.col("spend_usd").cast("double") / total * 100, 1)
                    .alias("share_pct")).orderBy(F.desc("spend_usd"), "platform")


def top_campaigns(fact: DataFrame, dim: DataFrame, n: int = 3) -> DataFrame:
    j = _campaign_totals(fact).join(dim.select("campaign_id", "campaign_name_standardized"),
                                    "campaign_id")
    return j.select("campaign_id", "campaign_name_standardized",
                    M.round_money("spend_usd").alias("spend"),
                    M.round_money("conversions").alias("conversions"),
                    M.round_ratio("spend_usd", "conversions").alias("cpa"),
                    ).orderBy(F.desc("conversions"), "campaign_id").limit(n)


# ---------------------------------------------------------------- RPT-7/8/9
def visit_summary(fact: DataFrame, dim: DataFrame, visits: DataFrame) -> DataFrame:
    """RPT-7 per campaign region: total spend, actual visits in weeks with
    spend, spend per visit, and the cheapest / dearest week by cost per
    visit (ties -> earlier / later week)."""
    weekly = spend_vs_visits(fact, dim, visits, rounded=False)
    g = weekly.groupBy("campaign_region").agg(
        F.sum("s").alias("s"), F.sum("total_store_visits").alias("v"))
    w = weekly.filter(F.col("cost_per_visit").isNotNull())
    ext = w.groupBy("campaign_region").agg(
        F.min_by("week", F.struct("cost_per_visit", "week")).alias("best_week"),
        F.min("cost_per_visit").alias("best_cost_per_visit"),
        F.max_by("week", F.struct("cost_per_visit", "week")).alias("worst_week"),
        F.max("cost_per_visit").alias("worst_cost_per_visit"))
    return g.join(ext, "campaign_region", "left").select(
        "campaign_region", M.round_money("s").alias("total_spend_usd"),
        F.col("v").cast("bigint").alias("total_store_visits"),
        M.round_ratio("s", "v").alias("spend_per_visit"),
        "best_week", "best_cost_per_visit", "worst_week", "worst_cost_per_visit"
    ).orderBy("campaign_region")


def budget_status_counts(fact: DataFrame, dim: DataFrame, metadata: DataFrame) -> DataFrame:
    bc = budget_compliance(fact, dim, metadata)
    g = bc.groupBy("budget_status").agg(F.count(F.lit(1)).alias("campaigns"))
    total = g.select(F.sum("campaigns").cast("double")).scalar()
    return g.select("budget_status", "campaigns",
                    F.round(F.col("campaigns").cast("double") / total * 100, 1)
                    .alias("pct")).orderBy("budget_status")


def product_line_share(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """RPT-9: spend share of each product line next to its ROI."""
    j = _campaign_totals(fact).join(dim.select("campaign_id", "product_line"), "campaign_id")
    g = j.groupBy("product_line").agg(
        *[F.sum(c).alias(c) for c in ("spend_usd", "conversion_value_usd")])
    total = g.select(F.sum("spend_usd").cast("double")).scalar()
    return g.select("product_line", M.round_money("spend_usd").alias("total_spend"),
                    M.round_ratio("conversion_value_usd", "spend_usd").alias("roi"),
                    F.round(F.col("spend_usd").cast("double") / total * 100, 1)
                    .alias("spend_share_pct")).orderBy(F.desc("roi"), "product_line")


def campaign_cpa_vs_average(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """RPT-9: each campaign's CPA against the blended CPA of all campaigns."""
    per = _campaign_totals(fact).join(dim.select("campaign_id", "campaign_name_standardized"),
                                      "campaign_id")
    avg_cpa = per.select(M.ratio(F.sum("spend_usd"), F.sum("conversions"))).scalar()
    cpa = M.ratio("spend_usd", "conversions")
    return per.select("campaign_id", "campaign_name_standardized",
                      F.round(cpa, 2).alias("cpa"),
                      F.round(avg_cpa, 2).alias("average_cpa"),
                      F.round(cpa - avg_cpa, 2).alias("cpa_gap")
                      ).orderBy("cpa_gap", "campaign_id")
