"""Data-quality rules (DQ-1 .. DQ-17, RPT-10).

Every rule is a DataFrame job that returns a small table (a profile, or the
violating keys).  Thresholds are parameters whose defaults are the values of
the source system's monitoring plan.  Rolling comparisons run over daily or
weekly aggregates, partitioned by source/platform/region, so a window
partition holds at most one row per day of the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions import dates as D
from spendlens.functions import money as M

# Thresholds of the monitoring plan.
ROWCOUNT_WARN_PCT = 20.0
ROWCOUNT_CRITICAL_PCT = 50.0
DUPLICATE_SHARE_PCT = 5.0
NON_USD_SHARE_PCT = 10.0
CPA_LIMIT = 60.0
CONVERSION_RATE_MIN_PCT = 1.0
VISIT_DROP_PCT = 30.0
FORECAST_DEVIATION_USD = 100_000.0
LOSS_SPEND_PCT = 0.5
LOSS_CONVERSIONS_PCT = 1.0
LOSS_VISITS_PCT = 5.0
PLATFORM_MISMATCH_PCT = 5.0


def _count() -> Column:
    return F.count(F.lit(1))


def _pct(part, whole, digits: int = 1) -> Column:
    return F.round(M.ratio(part, whole) * 100, digits)


# ---------------------------------------------------------------- DQ-1 / SRC-7 / SET-3
def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(_count().alias("row_count")).select(F.lit(name).alias("table_name"),
                                                        "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- DQ-2 / DQ-3 / DQ-4
def meta_profile(stg: DataFrame) -> DataFrame:
    spend = F.col("spend_usd")
    note = F.col("currency_conversion_note")
    return stg.agg(_count().alias("total_records"),
                   F.count_if(spend.isNull()).alias("null_spend"),
                   F.count_if(spend < 0).alias("negative_spend"),
                   F.count_if(F.col("currency_used") == "USD").alias("usd_records"),
                   F.count_if(note.startswith("Converted")).alias("converted_records"),
                   F.count_if(note.startswith("Assumed")).alias("assumed_records"))


def google_profile(stg: DataFrame) -> DataFrame:
    return stg.agg(_count().alias("total_records"),
                   F.count_if(F.col("spend_usd").isNull()).alias("null_spend"),
                   M.round_money(M.exact_sum(stg, "spend_usd")).alias("total_spend_usd"))


# ---------------------------------------------------------------- DQ-5
def platform_totals(perf: DataFrame) -> DataFrame:
    g = perf.groupBy("platform").agg(_count().alias("record_count"),
                                     M.exact_sum(perf, "spend_usd").alias("s"),
                                     M.exact_sum(perf, "conversions").alias("c"))
    return g.select("platform", "record_count", M.round_money("s").alias("total_spend"),
                    M.round_money("c").alias("total_conversions"))


# ---------------------------------------------------------------- DQ-6
def visit_fill_profile(stg_visits: DataFrame) -> DataFrame:
    z = F.col("is_zero_filled")
    return stg_visits.agg(_count().alias("total_records"),
                          F.count_if(z == 1).alias("zero_filled"),
                          F.count_if(z == 0).alias("actual_records"),
                          F.min("date").alias("min_date"), F.max("date").alias("max_date"))


# ---------------------------------------------------------------- DQ-7
def watermark_summary(tracking: DataFrame) -> DataFrame:
    """tracking: table_name, last_processed_load_timestamp."""
    ts = F.col("last_processed_load_timestamp")
    return tracking.agg(_count().alias("tracked_tables"), F.min(ts).alias("oldest_timestamp"),
                        F.max(ts).alias("newest_timestamp"))


def outside_calendar(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact rows whose date the calendar lacks: reports by month leave them out."""
    days = dim_date.select(F.col("date").alias("_day"))  # one row per day
    return fact.join(days, F.col("date") == F.col("_day"), "left_anti").agg(
        _count().alias("outside_calendar"))


# ---------------------------------------------------------------- DQ-9
def rowcount_vs_average(daily: DataFrame, *, source: str = "source", date: str = "date",
                        count: str = "row_count", days: int = 7,
                        warn_pct: float = ROWCOUNT_WARN_PCT,
                        critical_pct: float = ROWCOUNT_CRITICAL_PCT) -> DataFrame:
    """Each day's row count against the average per day over the previous ``days``
    calendar days of the same source that lie in its date range; a day without rows
    counts 0, and is reported."""
    span = daily.groupBy(source).agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    grid = span.select(source, F.explode(F.sequence("_a", "_b")).alias(date))
    x = grid.join(daily.select(source, date, count), [source, date], "left").withColumn(
        count, F.coalesce(count, F.lit(0).cast("bigint")))
    # the grid has a row for every day: so many rows back are so many days back
    w = Window.partitionBy(source).orderBy(date).rowsBetween(-days, -1)
    x = x.withColumn("_avg", F.try_divide(F.sum(count).over(w).cast("double"), F.count(count).over(w)))
    dev = F.round(F.try_divide(F.col(count) - F.col("_avg"), F.col("_avg")) * 100, 1)
    x = x.withColumn("deviation_pct", dev)
    sev = (F.when(F.col("_avg").isNull(), F.lit("no_history"))
           .when(F.col("_avg") == 0, F.when(F.col(count) == 0, "ok").otherwise("critical"))
           .when(F.abs("deviation_pct") > critical_pct, F.lit("critical"))
           .when(F.abs("deviation_pct") > warn_pct, F.lit("warning"))
           .otherwise(F.lit("ok")))
    return x.select(source, date, count, F.round("_avg", 2).alias("avg_prev_7d"),
                    "deviation_pct", sev.alias("severity"))


# ---------------------------------------------------------------- DQ-10
def duplicate_share(deduped: DataFrame, *, date: str = "date",
                    limit_pct: float = DUPLICATE_SHARE_PCT) -> DataFrame:
    """Per day: share of input records that were duplicates (from the
    de-duplicator's ``duplicate_count``)."""
    g = deduped.groupBy(date).agg(F.sum("duplicate_count").alias("records"),
                                  F.sum(F.col("duplicate_count") - 1).alias("duplicates"))
    share = _pct("duplicates", "records", 2)
    return g.select(date, "records", "duplicates", share.alias("share_pct"),
                    (share > limit_pct).cast("int").alias("alert"))


# ---------------------------------------------------------------- DQ-11
def non_usd_share(converted: DataFrame, limit_pct: float = NON_USD_SHARE_PCT) -> DataFrame:
    g = converted.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        _count().alias("records"),
        F.count_if(F.col("currency_used") != "USD").alias("non_usd_records"))
    share = _pct("non_usd_records", "records", 2)
    return g.select("year", "month", "records", "non_usd_records", share.alias("share_pct"),
                    (share > limit_pct).cast("int").alias("alert"))


# ---------------------------------------------------------------- DQ-12
def missing_fx_rates(converted: DataFrame) -> DataFrame:
    """Non-USD rows converted with the 1.0 fall-back because no rate exists."""
    bad = converted.filter((F.col("currency_used") != "USD") & (F.col("_fx_found") == 0))
    return bad.groupBy("currency_used", F.year("date").alias("year"),
                       F.month("date").alias("month")).agg(_count().alias("rows"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(_count().alias("rows")).filter(F.col("rows") > 1)


def key_collisions(df: DataFrame, narrow_key: list[str], dropped: str) -> DataFrame:
    """Groups of the narrower key that hold more than one value of the
    column the key leaves out (rows that a keyed write on ``narrow_key``
    collapses, quirk D2)."""
    per = df.groupBy(*narrow_key, dropped).agg(_count().alias("_n"))
    g = per.groupBy(*narrow_key).agg(F.sum("_n").alias("rows"), _count().alias("names"))
    return g.filter(F.col("names") > 1)


def unmapped_keys(rows: DataFrame, mapping: DataFrame, key: str = "dma_code",
                  name: str = "dma_name", value: str = "attributed_visits") -> DataFrame:
    """Keys that the inner join to the mapping would drop, with their volume."""
    lost = rows.join(mapping.select(key), key, "left_anti")
    per_name = lost.groupBy(key, name).agg(_count().alias("rows"), F.sum(value).alias(value))
    return per_name.groupBy(key).agg(F.max(name).alias(name), F.sum("rows").alias("rows"),
                                     F.sum(value).alias(value))


def unacceptable_conditions(*, converted: DataFrame, keyed: DataFrame, keys: list[str],
                            spend: DataFrame, visits: DataFrame,
                            mapping: DataFrame) -> DataFrame:
    """DQ-12 as one table: rule, violations."""
    parts = [
        missing_fx_rates(converted).agg(F.sum("rows").alias("n"))
        .select(F.lit("missing_fx_rate").alias("rule"), "n"),
        duplicate_keys(keyed, keys).agg(_count().alias("n"))
        .select(F.lit("duplicate_primary_key").alias("rule"), "n"),
        spend.agg(F.count_if(F.col("spend_usd") < 0).alias("n"))
        .select(F.lit("negative_spend").alias("rule"), "n"),
        unmapped_keys(visits, mapping).agg(_count().alias("n"))
        .select(F.lit("unmapped_dma").alias("rule"), "n"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("rule", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("violations"))


# ---------------------------------------------------------------- DQ-13
def cpa_alerts(fact: DataFrame, limit: float = CPA_LIMIT) -> DataFrame:
    """Days whose blended CPA exceeds ``limit``."""
    g = fact.groupBy("date").agg(M.exact_sum(fact, "spend_usd").alias("s"),
                                 M.exact_sum(fact, "conversions").alias("c"))
    cpa = M.round_ratio("s", "c")
    return g.select("date", M.round_money("s").alias("spend_usd"),
                    M.round_money("c").alias("conversions"), cpa.alias("cpa")
                    ).filter(F.col("cpa") > limit)


def conversion_rate_alerts(fact: DataFrame, min_pct: float = CONVERSION_RATE_MIN_PCT) -> DataFrame:
    """Daily conversions / clicks in percent, flagged below ``min_pct``."""
    g = fact.groupBy("date").agg(M.exact_sum(fact, "conversions").alias("c"),
                                 F.sum("clicks").alias("clicks"))
    rate = _pct("c", "clicks", 2)
    return g.select("date", M.round_money("c").alias("conversions"),
                    F.col("clicks").cast("bigint").alias("clicks"),
                    rate.alias("conversion_rate_pct"),
                    F.coalesce(rate < min_pct, F.lit(False)).cast("int").alias("alert"))


def visit_drop_alerts(visits: DataFrame, drop_pct: float = VISIT_DROP_PCT) -> DataFrame:
    """Weeks where a region's visits fell by more than ``drop_pct`` percent
    against its previous week."""
    weekly = visits.groupBy("mapped_region", D.week_label("date").alias("week")).agg(
        F.sum("attributed_visits").alias("visits"))
    w = Window.partitionBy("mapped_region").orderBy("week")
    x = weekly.withColumn("prev_visits", F.lag("visits").over(w))
    drop = F.round((F.col("prev_visits") - F.col("visits")).cast("double")
                   / F.col("prev_visits") * 100, 1)
    x = x.withColumn("drop_pct", F.when(F.col("prev_visits") > 0, drop))
    return x.filter(F.col("drop_pct") > drop_pct).select(
        "mapped_region", "week", "visits", "prev_visits", "drop_pct")


# ---------------------------------------------------------------- DQ-14
def spend_vs_forecast(fact: DataFrame, forecast: DataFrame | None = None, *,
                      limit: float = FORECAST_DEVIATION_USD, days: int = 7) -> DataFrame:
    """Daily spend per platform against a forecast (``date, platform,
    forecast_spend``).  Without one, the forecast is the average of the
    previous ``days`` calendar days of the same platform."""
    daily = fact.groupBy("platform", "date").agg(M.exact_sum(fact, "spend_usd").alias("s"))
    if forecast is None:
        day = F.datediff("date", F.lit("1970-01-01").cast("date"))
        w = Window.partitionBy("platform").orderBy(day).rangeBetween(-days, -1)
        # per calendar day since the platform's first: a day without spend counts 0
        first = F.min(day).over(Window.partitionBy("platform"))
        n = F.least(F.lit(days), day - first)
        x = daily.withColumn("forecast_spend", F.try_divide(
            F.coalesce(F.sum("s").over(w), F.lit(0)).cast("double"), F.nullif(n, F.lit(0))))
    else:
        x = daily.join(forecast, ["platform", "date"], "left")
    dev = F.col("s").cast("double") - F.col("forecast_spend")
    return x.select("platform", "date", M.round_money("s").alias("spend_usd"),
                    M.round_half_up("forecast_spend", 2).alias("forecast_spend"),
                    M.round_half_up(dev, 2).alias("deviation"),
                    F.coalesce(F.abs(dev) > limit, F.lit(False)).cast("int").alias("alert"))


# ---------------------------------------------------------------- DQ-15 / DQ-16
def reconcile(bronze: DataFrame, gold: DataFrame, *, by: str = "platform",
              spend_pct: float = LOSS_SPEND_PCT, conv_pct: float = LOSS_CONVERSIONS_PCT,
              mismatch_pct: float = PLATFORM_MISMATCH_PCT) -> DataFrame:
    """Totals per ``by`` before and after the pipeline, with loss percentages."""
    b = bronze.groupBy(by).agg(M.exact_sum(bronze, "spend_usd").alias("bs"),
                               M.exact_sum(bronze, "conversions").alias("bc"))
    g = gold.groupBy(by).agg(M.exact_sum(gold, "spend_usd").alias("gs"),
                             M.exact_sum(gold, "conversions").alias("gc"))
    j = b.join(g, by, "left")
    sl = F.round(M.ratio(F.col("bs") - F.coalesce("gs", F.lit(0)), "bs") * 100, 3)
    cl = F.round(M.ratio(F.col("bc") - F.coalesce("gc", F.lit(0)), "bc") * 100, 3)
    return j.select(by, M.round_money("bs").alias("bronze_spend"),
                    M.round_money("gs").alias("gold_spend"), sl.alias("spend_loss_pct"),
                    M.round_money("bc").alias("bronze_conversions"),
                    M.round_money("gc").alias("gold_conversions"),
                    cl.alias("conversion_loss_pct"),
                    (sl > spend_pct).cast("int").alias("spend_loss_alert"),
                    (cl > conv_pct).cast("int").alias("conversion_loss_alert"),
                    (F.abs(sl) > mismatch_pct).cast("int").alias("spend_mismatch_alert"))


def reconcile_visits(raw_visits: DataFrame, fact_visits: DataFrame, *,
                     loss_pct: float = LOSS_VISITS_PCT) -> DataFrame:
    """DQ-15 for store visits: actual visits in the raw input against the
    fact (unmapped DMAs drop out there)."""
    zero = F.lit(0).cast("bigint")
    raw = raw_visits.select(F.col("attributed_visits").cast("bigint").alias("r"), zero.alias("f"))
    fact = (fact_visits.filter(F.col("is_zero_filled") == 0)
            .select(zero.alias("r"), F.col("attributed_visits").cast("bigint").alias("f")))
    j = raw.unionByName(fact).agg(F.sum("r").alias("raw_visits"), F.sum("f").alias("fact_visits"))
    lost = F.round(M.ratio(F.col("raw_visits") - F.col("fact_visits"), "raw_visits") * 100, 3)
    return j.select(F.col("raw_visits").cast("bigint").alias("raw_visits"),
                    F.col("fact_visits").cast("bigint").alias("fact_visits"),
                    lost.alias("visit_loss_pct"),
                    F.coalesce(lost > loss_pct, F.lit(False)).cast("int").alias("alert"))


# ---------------------------------------------------------------- DQ-17
def source_freshness(last_seen: DataFrame, *, as_of=None, max_lag_days: int = 1) -> DataFrame:
    """last_seen: source, last_date.  Lag against ``as_of`` (default: the
    newest source) and a stale flag."""
    ref = F.lit(as_of) if as_of is not None else last_seen.select(F.max("last_date")).scalar()
    lag = F.datediff(ref, F.col("last_date"))
    return last_seen.select("source", "last_date", lag.alias("lag_days"),
                            (lag > max_lag_days).cast("int").alias("stale"))


def pipeline_health(tracking: DataFrame, log: DataFrame, listing: DataFrame,
                    expected_files: list[str], *, as_of, stall_hours: float = 1.0,
                    max_log_gap_days: int = 1) -> DataFrame:
    """DQ-17 on the pipeline's own state: rule, subject, detail.

    * ``file_missing``: an expected landing file is not present;
    * ``tracking_stalled``: a watermark older than ``stall_hours`` before
      ``as_of``;
    * ``ingestion_gap``: an expected file without a successful ingestion in
      the last ``max_log_gap_days`` days."""
    spark = tracking.sparkSession
    expected = spark.createDataFrame([(f,) for f in expected_files], "file_name string")
    missing = expected.join(listing.select(F.col("entry").alias("file_name")), "file_name", "left_anti").select(
        F.lit("file_missing").alias("rule"), F.col("file_name").alias("subject"),
        F.lit(None).cast("string").alias("detail"))
    limit = D.ntz_lit(as_of) - F.expr(f"INTERVAL {int(stall_hours * 60)} MINUTES")
    stalled = tracking.filter(F.col("last_processed_load_timestamp") < limit).select(
        F.lit("tracking_stalled").alias("rule"), F.col("table_name").alias("subject"),
        F.col("last_processed_load_timestamp").cast("string").alias("detail"))
    # a file is known by its landing entry, its own name or its folder's
    paths = listing.select(F.col("path").alias("source_file"), F.col("entry").alias("file_name"))
    last_ok = (log.filter(F.col("status") == "success").join(paths, "source_file")
               .groupBy("file_name").agg(F.max("ingested_at").alias("last_ok"))
               .withColumnRenamed("file_name", "_entry"))
    since = D.ntz_lit(as_of) - F.expr(f"INTERVAL {int(max_log_gap_days)} DAYS")
    gaps = (expected.join(last_ok, expected.file_name == last_ok._entry, "left")
            .filter(F.col("last_ok").isNull() | (F.col("last_ok") < since))
            .select(F.lit("ingestion_gap").alias("rule"), F.col("file_name").alias("subject"),
                    F.col("last_ok").cast("string").alias("detail")))
    return missing.unionByName(stalled).unionByName(gaps)


# ---------------------------------------------------------------- RPT-10
def issue_summary(issues: Mapping[str, tuple[DataFrame, Column, Column]]) -> DataFrame:
    """issue -> (table, aggregate counting affected records, aggregate
    counting all records)."""
    parts = [df.agg(aff.cast("bigint").alias("records_affected"),
                    tot.cast("bigint").alias("total_records"))
             .select(F.lit(name).alias("issue"), "records_affected", "total_records")
             for name, (df, aff, tot) in issues.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("pct", _pct("records_affected", "total_records", 1))
