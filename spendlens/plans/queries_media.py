"""Queries that run the real bronze, silver and gold builders on landing lines that
Spark derives from the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators.merge import insert_ignore, upsert
from spendlens.operators.names import name_log_from_months, name_month_summary
from spendlens.plans import bindings as B
from spendlens.plans import bronze as BR
from spendlens.plans import gold as G
from spendlens.plans import quality as Q
from spendlens.plans import silver as S
from spendlens.plans.catalog import register, with_ctes
from spendlens.plans.queries_ops import google_export_lines
from spendlens.sources import files as SRC
from spendlens.sources import reference as REF

LOADED = dt.datetime(2026, 8, 1, 6)


def _positions(df: DataFrame, name: str, *cols: str) -> DataFrame:
    return df.select(*cols, F.lit(name).alias("_source_file"), F.lit(0).cast("bigint").alias("_block"),
                     "_row")


def meta_lines(spark: SparkSession, d: str) -> DataFrame:
    """A Meta-style CSV line per lineitem: a quoted name with quotes and a comma, a currency
    that is dollars, padded lower-case dollars, or missing."""
    li = B.table(spark, d, "lineitem")
    day = F.col("l_shipdate").cast("date").cast("string")
    values = {
        "date": day, "timestamp_pst": F.concat(day, F.lit(" 20:30:00")), "campaign_id": F.col("l_suppkey"),
        "campaign_name": F.concat(F.lit('"'), F.col("l_linestatus"), F.lit('", '), F.col("l_partkey")),
        "adset_id": F.col("l_orderkey"), "ad_id": F.col("l_linenumber"), "objective": F.lit("sales"),
        "placement": F.col("l_returnflag"), "impressions": F.col("l_partkey"),
        "clicks": F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".0")),
        "spend_usd": F.col("l_extendedprice").cast("decimal(12,2)"),
        "currency": F.when(F.col("l_linenumber") % 3 == 0, "USD")
                     .when(F.col("l_linenumber") % 3 == 1, " usd "),
        "conversions": F.col("l_quantity").cast("decimal(12,2)"), "conversion_value_usd": F.lit("")}
    line = F.to_csv(F.struct(*[values[c].cast("string").alias(c) for c in SRC.META_COLUMNS]),
                    {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return li.select(line.alias("line"),
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("_row"))


def parsed_meta(spark: SparkSession, d: str) -> DataFrame:
    kinds = ", ".join(f"{c} string" for c in SRC.META_COLUMNS)
    rec = F.struct(F.from_csv("line", kinds, {"escape": '"'}).alias("j"), F.col("_row"))
    rows = meta_lines(spark, d).select(F.inline(F.array(rec))).select("j.*", "_row")
    return _positions(rows, "meta", *SRC.META_COLUMNS)


@register("meta_csv_typed", """
SELECT CAST(l_shipdate AS DATE) AS date,
       CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL '28 hours 30 minutes' AS timestamp_utc,
       CAST(l_suppkey AS VARCHAR) AS campaign_id,
       '"' || l_linestatus || '", ' || l_partkey AS campaign_name,
       CAST(l_orderkey AS VARCHAR) AS adset_id, CAST(l_linenumber AS VARCHAR) AS ad_id,
       CAST(l_partkey AS BIGINT) AS impressions, CAST(l_quantity AS BIGINT) AS clicks,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS spend_amount,
       if(l_linenumber % 3 = 2, NULL, 'USD') AS original_currency,
       CAST(l_linenumber % 3 = 2 AS INTEGER) AS currency_missing
FROM lineitem""")
def q_meta_csv_typed(spark, d):
    """SRC-1 + TAB-1: quoted CSV text to typed bronze rows."""
    good, _ = BR.clean_meta(parsed_meta(spark, d), LOADED)
    return good.select("date", "timestamp_utc", "campaign_id", "campaign_name", "adset_id", "ad_id",
                       "impressions", "clicks", "spend_amount", "original_currency", "currency_missing")


@register("unified_from_landing", """
WITH g AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, o_custkey, o_orderstatus AS st, o_orderkey,
         CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(14,2)) AS price
  FROM orders),
best AS (
  SELECT * FROM (SELECT *, COUNT(DISTINCT if(st = 'F', day, NULL)) OVER k AS times FROM g
                 WINDOW k AS (PARTITION BY date, o_custkey, st))
  QUALIFY row_number() OVER (PARTITION BY date, o_custkey, st ORDER BY
    if(times > 1, day, NULL) DESC NULLS LAST, if(times > 1, 0, trunc(price)) DESC, o_orderkey) = 1),
fact AS (
  SELECT 'google' AS platform, date, CAST(o_custkey AS VARCHAR) AS campaign_id, st AS placement,
         price AS spend, if(st = 'F', CAST(day AS TIMESTAMP), NULL) AS tm FROM best
  UNION ALL
  SELECT 'meta', CAST(l_shipdate AS DATE), CAST(l_suppkey AS VARCHAR), l_returnflag,
         CAST(l_extendedprice AS DECIMAL(14,2)), CAST(l_shipdate AS TIMESTAMP) + INTERVAL '28 hours 30 minutes'
  FROM lineitem)
SELECT platform, campaign_id, placement, COUNT(*) AS fact_rows, COUNT(tm) AS with_time, MAX(tm) AS newest,
       CAST(SUM(spend) AS DOUBLE) AS spend_usd
FROM fact GROUP BY platform, campaign_id, placement""")
def q_unified_from_landing(spark, d):
    """Landing lines of both platforms -> bronze -> silver -> unified -> fact, by the builders
    the pipeline uses; most Google records have no timestamp."""
    from spendlens.plans.pipeline import _unified_batch

    order = ["_load_timestamp", *SRC.ORDER_COLS]
    meta, _ = BR.clean_meta(parsed_meta(spark, d), LOADED)
    # columns that no later step reads, and that the key fixes, are left behind before a shuffle
    meta = insert_ignore(None, meta.drop("timestamp_pst"), BR.META_KEY, ordinal=SRC.ORDER_COLS)
    lines = google_export_lines(spark, d)
    rec = F.struct(F.from_json("line", SRC.GOOGLE_SCHEMA).alias("j"), F.col("_row"))
    rows = _positions(lines.select(F.inline(F.array(rec))).select("j.*", "_row"), "google",
                      *[f.name for f in SRC.GOOGLE_SCHEMA.fields])
    google, _ = BR.clean_google(SRC.flatten_google(rows), LOADED)
    google = insert_ignore(None, BR.dedup_google(google), BR.GOOGLE_KEY, ordinal=SRC.ORDER_COLS)
    stg_meta = S.build_stg_meta(meta, REF.exchange_rates(spark), LOADED, extra=SRC.ORDER_COLS)
    stg_google = S.build_stg_google(google, LOADED, extra=SRC.ORDER_COLS)
    batch = _unified_batch(stg_meta, stg_google, LOADED).drop("currency_used", "currency_conversion_note",
                                                              "_staged_timestamp")
    perf = upsert(None, batch, S.PERF_KEY, ["_platform_order", *order])
    times = perf.select("platform", "campaign_id", "placement", "timestamp_utc", *[
        c for c in S.PERF_KEY if c not in ("platform", "campaign_id", "placement")])
    fact = G.build_fact_daily_performance(perf).join(times, S.PERF_KEY)
    return fact.groupBy("platform", "campaign_id", "placement").agg(
        F.count("*").alias("fact_rows"), F.count("timestamp_utc").alias("with_time"),
        F.max("timestamp_utc").alias("newest"),
        F.sum(F.col("spend_usd").cast("decimal(14,2)")).cast("double").alias("spend_usd"))


def _keyed_orders(spark, d):
    """A nullable two-column key with many repetitions."""
    return B.table(spark, d, "orders").select(
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("customer"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderkey").alias("position"))


@register("insert_ignore_null_keys", """
WITH o AS (
  SELECT if(o_custkey % 5 = 0, NULL, o_custkey) AS customer,
         NULLIF(o_orderpriority, '1-URGENT') AS priority,
         CAST(o_orderdate AS DATE) AS day, o_orderkey AS position FROM orders)
SELECT customer, priority, MIN(position) AS position FROM o GROUP BY customer, priority
HAVING MIN(day) >= DATE '1995-01-01'""")
def q_insert_ignore_null_keys(spark, d):
    """SNK-1 with NULLs in the key: a NULL key that is stored is not inserted again."""
    o = _keyed_orders(spark, d)
    old = F.col("day") < F.lit("1995-01-01").cast("date")
    return insert_ignore(o.filter(old), o.filter(~old), ["customer", "priority"],
                         ordinal="position").select("customer", "priority", "position")


@register("insert_ignore_bloom", """
WITH o AS (
  SELECT if(o_custkey % 5 = 0, NULL, o_custkey) AS customer,
         NULLIF(o_orderpriority, '1-URGENT') AS priority,
         CAST(o_orderdate AS DATE) AS day, o_orderkey AS position FROM orders)
SELECT customer, priority, MIN(position) AS position FROM o GROUP BY customer, priority
HAVING MIN(day) >= DATE '1998-01-01'""")
def q_insert_ignore_bloom(spark, d):
    """SNK-1 of a small batch into a large table: stored keys pass a Bloom filter of the
    batch's keys before they are shuffled."""
    o = _keyed_orders(spark, d)
    old = F.col("day") < F.lit("1998-01-01").cast("date")
    return insert_ignore(o.filter(old), o.filter(~old), ["customer", "priority"],
                         ordinal="position", prefilter=True).select("customer", "priority", "position")


@register("name_log_two_batches", """
WITH e AS (
  SELECT CAST(ts AS DATE) AS date, user_id AS campaign_id, event_type AS campaign_name,
         if(value < 100, 'meta', 'google') AS platform, event_id % 3 AS batch FROM events),
m AS (
  SELECT campaign_id, campaign_name, platform, date_trunc('month', date) AS mon, batch = 0 AS later,
         MIN(date) AS a, MAX(date) AS b, COUNT(DISTINCT date) AS n
  FROM e GROUP BY ALL),
kept AS (SELECT * FROM m QUALIFY later OR NOT bool_or(later) OVER (
           PARTITION BY campaign_id, campaign_name, platform, mon))
SELECT campaign_id, campaign_name, platform, MIN(a) AS first_seen_date, MAX(b) AS last_seen_date,
       CAST(SUM(n) AS BIGINT) AS days_active,
       CAST(MAX(b) = MAX(MAX(b)) OVER (PARTITION BY campaign_id) AS INTEGER) AS is_current
FROM kept GROUP BY campaign_id, campaign_name, platform""")
def q_name_log_two_batches(spark, d):
    """TAB-19 over two runs: a name of the first that the second lacks keeps its history."""
    e = B.table(spark, d, "events")
    rows = e.select(F.col("ts").cast("date").alias("date"), F.col("user_id").alias("campaign_id"),
                    F.col("event_type").alias("campaign_name"),
                    F.when(F.col("value") < 100, "meta").otherwise("google").alias("platform"),
                    F.date_trunc("month", "ts").cast("date").alias("_month"), "event_id")
    first, second = (name_month_summary(rows.filter(c)) for c in ("event_id % 3 != 0", "event_id % 3 = 0"))
    return name_log_from_months(
        upsert(first, second, ["campaign_id", "campaign_name", "platform", "_month"]))


@register("fact_outside_calendar", with_ctes(B.ADS_FACT_SQL) + """
SELECT COUNT(*) AS outside_calendar FROM ads_fact
WHERE date < DATE '1993-01-01' OR date > DATE '1996-12-31'""")
def q_fact_outside_calendar(spark, d):
    """Rows that reports by month leave out, counted against a calendar of four years."""
    days = REF.calendar(spark, dt.date(1993, 1, 1), dt.date(1996, 12, 31))
    return Q.outside_calendar(B.ads_fact(spark, d), days)
