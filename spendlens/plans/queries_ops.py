"""Registered operator queries (dedup, keyed writes, watermarks, currency,
unification, calendar, zero-fill, name log, parsing) on the bound tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendlens.functions import dates as D
from spendlens.functions import money as M
from spendlens.functions import text as T
from spendlens.operators import watermark as WM
from spendlens.operators.dedup import best_record, last_per_key
from spendlens.operators.merge import insert_ignore, upsert
from spendlens.operators.names import multi_name_campaigns, name_change_log
from spendlens.plans import bindings as B
from spendlens.plans import gold as G
from spendlens.plans import silver as S
from spendlens.plans.catalog import register, with_ctes
from spendlens.sources.reference import exchange_rates_for_years, fx_rates_values_sql


# ------------------------------------------------------------------ AGG-11
def lineitem_versions(spark, d):
    li = B.table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.date_trunc("month", "l_shipdate").cast("date").alias("ts"),
                     F.col("l_extendedprice").alias("size"), "l_partkey", "l_suppkey",
                     "l_quantity", F.col("l_shipdate").cast("date").alias("ship_date"))


_LINEITEM_VERSIONS_SQL = """versions AS (
  SELECT l_orderkey, l_linenumber, CAST(date_trunc('month', l_shipdate) AS DATE) AS ts,
         l_extendedprice AS size, l_partkey, l_suppkey, l_quantity,
         CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem)"""

_DEDUP_BEST_CTES = _LINEITEM_VERSIONS_SQL + """,
g AS (
  SELECT *, COUNT(*) OVER k AS n, MIN(ts) OVER k AS lo, MAX(ts) OVER k AS hi
  FROM versions WINDOW k AS (PARTITION BY l_orderkey, l_linenumber)),
r AS (
  SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY CASE WHEN lo <> hi THEN ts END DESC NULLS LAST,
               CASE WHEN lo = hi THEN size END DESC NULLS LAST,
               l_orderkey DESC, l_linenumber DESC, ts DESC, size DESC, l_partkey DESC,
               l_suppkey DESC, l_quantity DESC, ship_date DESC) AS rn
  FROM g),
deduped AS (
  SELECT l_orderkey, l_linenumber, ts, size, l_partkey, l_suppkey, l_quantity, ship_date,
         CAST(CASE WHEN n > 1 THEN 1 ELSE 0 END AS INTEGER) AS duplicate_combined,
         CAST(n AS INTEGER) AS duplicate_count
  FROM r WHERE rn = 1)
"""


def dedup_lineitem(spark, d):
    return best_record(lineitem_versions(spark, d), ["l_orderkey", "l_linenumber"],
                       ts="ts", size="size")


_DEDUP_BEST_SQL = "WITH " + _DEDUP_BEST_CTES


@register("dedup_best_record", _DEDUP_BEST_SQL + "SELECT * FROM deduped")
def q_dedup_best_record(spark, d):
    return dedup_lineitem(spark, d)


def _event_rows(spark, d):
    e = B.table(spark, d, "events")
    return e.select(F.col("ts").cast("date").alias("date"), "user_id", "event_type", "ts",
                    "value", "event_id")


_EVENT_ROWS_SQL = """ev AS (
  SELECT CAST(ts AS DATE) AS date, user_id, event_type, ts, value, event_id FROM events)"""


@register("dedup_newest_event", with_ctes(_EVENT_ROWS_SQL) + """,
g AS (
  SELECT *, COUNT(*) OVER k AS n, MIN(ts) OVER k AS lo, MAX(ts) OVER k AS hi
  FROM ev WINDOW k AS (PARTITION BY date, user_id, event_type)),
r AS (
  SELECT *, row_number() OVER (
      PARTITION BY date, user_id, event_type
      ORDER BY CASE WHEN lo <> hi THEN ts END DESC NULLS LAST,
               CASE WHEN lo = hi THEN value END DESC NULLS LAST, event_id ASC) AS rn
  FROM g)
SELECT date, user_id, event_type, ts, value, event_id,
       CAST(CASE WHEN n > 1 THEN 1 ELSE 0 END AS INTEGER) AS duplicate_combined,
       CAST(n AS INTEGER) AS duplicate_count
FROM r WHERE rn = 1""")
def q_dedup_newest_event(spark, d):
    return best_record(_event_rows(spark, d), ["date", "user_id", "event_type"], ts="ts",
                       size="value", ordinal="event_id", drop_ordinal=False)


# ------------------------------------------------------------------ SNK-1 / JON-14
@register("dedup_insert_ignore", with_ctes(_EVENT_ROWS_SQL) + """,
loaded AS (SELECT * FROM ev WHERE date <= (SELECT min(date) FROM ev) + 14),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY date, user_id, event_type ORDER BY event_id) AS rn
  FROM ev)
SELECT date, user_id, event_type, ts, value, event_id FROM firsts f
WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM loaded l
  WHERE l.date = f.date AND l.user_id = f.user_id AND l.event_type = f.event_type)""")
def q_dedup_insert_ignore(spark, d):
    ev = _event_rows(spark, d)
    first_day = ev.select(F.min("date")).scalar()
    loaded = ev.filter(F.col("date") <= F.date_add(first_day, 14))
    return insert_ignore(loaded, ev, ["date", "user_id", "event_type"], ordinal="event_id")


# ------------------------------------------------------------------ SNK-2
@register("upsert_last_wins", """
WITH li AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date, l_extendedprice,
         l_quantity, l_partkey, l_suppkey FROM lineitem),
b AS (SELECT min(ship_date) AS lo, datediff('day', min(ship_date), max(ship_date)) // 2 AS half
      FROM li),
u AS (
  SELECT li.*, 0 AS _src FROM li, b WHERE ship_date < b.lo + CAST(b.half AS INTEGER)
  UNION ALL
  SELECT li.*, 1 AS _src FROM li, b WHERE ship_date >= b.lo + CAST(b.half AS INTEGER)),
r AS (
  SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY _src DESC, ship_date DESC, l_orderkey DESC, l_linenumber DESC, ship_date DESC,
               l_extendedprice DESC, l_quantity DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM u)
SELECT l_orderkey, l_linenumber, ship_date, l_extendedprice, l_quantity, l_partkey, l_suppkey
FROM r WHERE rn = 1""")
def q_upsert_last_wins(spark, d):
    li = B.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date"),
        "l_extendedprice", "l_quantity", "l_partkey", "l_suppkey")
    b = li.agg(F.min("ship_date").alias("lo"), F.max("ship_date").alias("hi"))
    lo = b.select("lo").scalar()
    half = b.select(F.floor(F.datediff("hi", "lo") / 2).cast("int")).scalar()
    split = F.date_add(lo, half)
    current = li.filter(F.col("ship_date") < split)
    batch = li.filter(F.col("ship_date") >= split)
    return upsert(current, batch, ["l_orderkey", "l_linenumber"], order=["ship_date"])


# ------------------------------------------------------------------ SNK-5 / FIL-1 / FIL-2
_WM_SQL = """
WITH ev AS (SELECT CAST(ts AS DATE) AS date, ts, event_id, user_id, value FROM events),
wm AS (SELECT max(ts) AS w FROM ev WHERE date <= (SELECT min(date) FROM ev) + 14)
SELECT event_id, ts, user_id, value FROM ev, wm WHERE ev.ts {op} wm.w"""


def _since_first_two_weeks(spark, d, inclusive):
    e = B.table(spark, d, "events").select(F.col("ts").cast("date").alias("date"), "ts",
                                           "event_id", "user_id", "value")
    first_day = e.select(F.min("date")).scalar()
    wm = e.filter(F.col("date") <= F.date_add(first_day, 14)).select(F.max("ts")).scalar()
    return WM.since(e, wm, "ts", inclusive=inclusive).select("event_id", "ts", "user_id", "value")


@register("incremental_strict", _WM_SQL.format(op=">"))
def q_incremental_strict(spark, d):
    return _since_first_two_weeks(spark, d, inclusive=False)


@register("incremental_inclusive", _WM_SQL.format(op=">="))
def q_incremental_inclusive(spark, d):
    return _since_first_two_weeks(spark, d, inclusive=True)


# ------------------------------------------------------------------ currency (JON-1/2, PRJ-4/11/12)
def fx_input(spark, d):
    """Order amounts in the currency of the customer's region: USD, padded
    lower-case CAD, GBP, EUR (no rate) or missing."""
    o = B.table(spark, d, "orders")
    c = B.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = B.table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    rk = F.col("n_regionkey")
    raw_cur = (F.when(rk == 0, "USD").when(rk == 1, " cad ").when(rk == 2, "GBP")
               .when(rk == 3, "eur").otherwise(""))
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    cur = T.upper_or_null(raw_cur)
    return j.select(F.col("o_orderkey").alias("row_id"),
                    F.col("o_orderdate").cast("date").alias("date"),
                    F.col("o_totalprice").alias("spend_amount"),
                    F.col("o_totalprice").alias("conversion_value_amount"),
                    cur.alias("original_currency"),
                    cur.isNull().cast("int").alias("currency_missing"))


def fx_converted(spark, d):
    rows = fx_input(spark, d)
    # from the orders alone: the joins of `rows` are not run a second time for it
    y = F.year("o_orderdate")
    years = B.table(spark, d, "orders").agg(F.min(y).alias("lo"), F.max(y).alias("hi")) \
        .select(F.explode(F.sequence("lo", "hi")).alias("year"))
    rates = exchange_rates_for_years(years)
    return S.convert_currency(rows, rates, calendar=None, amount_cols={
        "spend_usd": "spend_amount", "conversion_value_usd": "conversion_value_amount"})


_FX_SQL = f"""
WITH fx_input AS (
  SELECT o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS date, o_totalprice AS amount,
         NULLIF(upper(regexp_replace(CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN ' cad '
                                       WHEN 2 THEN 'GBP' WHEN 3 THEN 'eur' ELSE '' END,
                                     '^\\s+|\\s+$', '', 'g')), '') AS original_currency
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
years AS (SELECT unnest(generate_series(min(year(date)), max(year(date)))) AS year FROM fx_input),
base(month, cur, rate) AS ({fx_rates_values_sql()}),
rates AS (SELECT y.year, b.month, b.cur AS from_currency, b.rate FROM years y, base b),
converted AS (
  SELECT c.row_id, c.date, c.original_currency,
         CASE WHEN c.original_currency IS NULL THEN 1 ELSE 0 END AS currency_missing,
         CAST(ROUND(CAST(c.amount AS DECIMAL(20,6))
                    * COALESCE(CAST(r.rate AS DECIMAL(12,6)), 1), 2) AS DOUBLE) AS spend_usd,
         COALESCE(c.original_currency, 'USD') AS currency_used,
         CASE WHEN c.original_currency IS NULL THEN 'Assumed USD (missing in source)'
              WHEN c.original_currency = 'USD' THEN 'USD (native)'
              ELSE 'Converted from ' || c.original_currency END AS currency_conversion_note,
         CASE WHEN r.rate IS NULL THEN 0 ELSE 1 END AS fx_found
  FROM fx_input c
  LEFT JOIN rates r ON year(c.date) = r.year AND month(c.date) = r.month
                   AND COALESCE(c.original_currency, 'USD') = r.from_currency)
"""


@register("fx_convert", _FX_SQL + """
SELECT row_id, date, original_currency, currency_missing, spend_usd, currency_used,
       currency_conversion_note FROM converted""")
def q_fx_convert(spark, d):
    return fx_converted(spark, d).select(
        "row_id", "date", "original_currency", "currency_missing", "spend_usd",
        "currency_used", "currency_conversion_note")


# ------------------------------------------------------------------ PRJ-13
_MICROS_SQL = """
WITH m AS (SELECT event_id, CAST(CAST(value AS DECIMAL(12,2)) * 1000000 AS BIGINT) + event_id
                              AS cost_micros FROM events)
SELECT event_id, cost_micros, cost_micros * 3 AS conversions_value_micros,
       CAST(ROUND(CAST(cost_micros AS DECIMAL(20,0)) * CAST(0.000001 AS DECIMAL(7,6)), 2) AS DOUBLE)
         AS spend_usd,
       CAST(ROUND(CAST(cost_micros * 3 AS DECIMAL(20,0)) * CAST(0.000001 AS DECIMAL(7,6)), 2)
            AS DOUBLE) AS conversion_value_usd
FROM m"""


@register("micros_convert", _MICROS_SQL)
def q_micros_convert(spark, d):
    e = B.table(spark, d, "events")
    m = e.select("event_id", ((F.col("value").cast("decimal(12,2)") * F.lit(1000000))
                              .cast("bigint") + F.col("event_id")).alias("cost_micros"))
    m = m.withColumn("conversions_value_micros", F.col("cost_micros") * 3)
    return m.select("event_id", "cost_micros", "conversions_value_micros",
                    M.micros_to_dollars("cost_micros").alias("spend_usd"),
                    M.micros_to_dollars("conversions_value_micros").alias("conversion_value_usd"))


# ------------------------------------------------------------------ SET-2 / PRJ-6 / PRJ-14
_UNIFY_COLS = ["date", "campaign_id", "platform", "adset_id", "ad_id", "objective", "placement",
               "spend_usd", "conversions", "seq"]


def unified_rows(spark, d):
    li = B.table(spark, d, "lineitem")
    spend = F.round(B._dec("l_extendedprice") * (F.lit(1) - B._dec("l_discount", 3, 2)), 2)
    meta = li.select(F.col("l_shipdate").cast("date").alias("date"),
                     F.col("l_suppkey").alias("campaign_id"), F.lit("meta").alias("platform"),
                     F.col("l_partkey").cast("string").alias("adset_id"),
                     F.col("l_orderkey").cast("string").alias("ad_id"),
                     F.col("l_returnflag").alias("objective"),
                     F.col("l_linestatus").alias("placement"),
                     spend.cast("double").alias("spend_usd"),
                     F.col("l_quantity").alias("conversions"),
                     F.col("l_linenumber").cast("bigint").alias("seq"))
    o = B.table(spark, d, "orders")
    google = o.select(F.col("o_orderdate").cast("date").alias("date"),
                      F.col("o_custkey").alias("campaign_id"), F.lit("google").alias("platform"),
                      F.lit("").alias("adset_id"), F.lit("").alias("ad_id"),
                      F.lit("").alias("objective"), F.col("o_orderstatus").alias("placement"),
                      B._dec("o_totalprice", 14, 2).cast("double").alias("spend_usd"),
                      F.lit(1.0).alias("conversions"), F.col("o_orderkey").alias("seq"))
    return meta.unionByName(google)


_UNIFY_SQL = """
WITH u AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS campaign_id, 'meta' AS platform,
         CAST(l_partkey AS VARCHAR) AS adset_id, CAST(l_orderkey AS VARCHAR) AS ad_id,
         l_returnflag AS objective, l_linestatus AS placement,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))), 2)
              AS DOUBLE) AS spend_usd,
         l_quantity AS conversions, CAST(l_linenumber AS BIGINT) AS seq
  FROM lineitem
  UNION ALL
  SELECT CAST(o_orderdate AS DATE), o_custkey, 'google', '', '', '', o_orderstatus,
         CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE), 1.0, o_orderkey
  FROM orders),
r AS (
  SELECT *, row_number() OVER (
      PARTITION BY date, campaign_id, platform, adset_id, ad_id, objective, placement
      ORDER BY seq DESC, date DESC, campaign_id DESC, platform DESC, adset_id DESC, ad_id DESC,
               objective DESC, placement DESC, spend_usd DESC, conversions DESC, seq DESC) AS rn
  FROM u),
unified AS (
  SELECT date, campaign_id, platform, adset_id, ad_id, objective, placement, spend_usd,
         conversions, seq FROM r WHERE rn = 1)
"""


def unified(spark, d):
    return last_per_key(unified_rows(spark, d), S.PERF_KEY, ["seq"])


@register("unify_platforms", _UNIFY_SQL + "SELECT * FROM unified")
def q_unify_platforms(spark, d):
    return unified(spark, d)


# ------------------------------------------------------------------ SRC-10 / TAB-5 / TAB-16
@register("calendar_dim", with_ctes(B.ADS_FACT_SQL, B.date_dim_sql("ads_fact"))
          + "SELECT * FROM dim_date")
def q_calendar_dim(spark, d):
    return B.date_dim(B.ads_fact(spark, d))


# ------------------------------------------------------------------ TAB-13 / TAB-18 / TAB-7 / TAB-15
@register("zero_fill_visits", with_ctes(B.STG_STORE_VISITS_SQL) + "SELECT * FROM stg_store_visits")
def q_zero_fill_visits(spark, d):
    return B.stg_store_visits(spark, d)


@register("visits_region_fact", with_ctes(B.FACT_STORE_VISITS_SQL)
          + "SELECT * FROM fact_store_visits")
def q_visits_region_fact(spark, d):
    return B.fact_store_visits(spark, d)


@register("dma_dim", with_ctes(B.RAW_STORE_VISITS_SQL) + """
SELECT dma_code, max(dma_name) AS dma_name FROM raw_store_visits GROUP BY dma_code""")
def q_dma_dim(spark, d):
    raw = B.raw_store_visits(spark, d)
    return G.build_dim_dma(S.build_ref_dma_list(raw), raw)


@register("standardized_dim", with_ctes(B.CUSTOMER_CAMPAIGN_DIM_SQL) + "SELECT * FROM cust_dim")
def q_standardized_dim(spark, d):
    c = B.table(spark, d, "customer")
    n = B.table(spark, d, "nation")
    r = B.table(spark, d, "region")
    raw = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
           .join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
           .select(F.col("c_custkey").alias("campaign_id"), F.col("r_name").alias("brand"),
                   F.col("c_mktsegment").alias("product_line"),
                   B._region_label(F.col("n_regionkey")).alias("region")))
    return G.build_dim_campaign(S.build_ref_campaign_list(raw))


# ------------------------------------------------------------------ TAB-19 / DQ-8
def name_rows(spark, d):
    e = B.table(spark, d, "events")
    return e.select(F.col("ts").cast("date").alias("date"),
                    F.col("user_id").alias("campaign_id"),
                    F.col("event_type").alias("campaign_name"),
                    F.when(F.col("value") < 100, "meta").otherwise("google").alias("platform"))


_NAME_LOG_SQL = """
WITH perf AS (
  SELECT CAST(ts AS DATE) AS date, user_id AS campaign_id, event_type AS campaign_name,
         CASE WHEN value < 100 THEN 'meta' ELSE 'google' END AS platform FROM events),
log AS (
  SELECT campaign_id, campaign_name, platform, MIN(date) AS first_seen_date,
         MAX(date) AS last_seen_date, COUNT(DISTINCT date) AS days_active,
         CAST(MAX(date) = MAX(MAX(date)) OVER (PARTITION BY campaign_id) AS INTEGER) AS is_current
  FROM perf WHERE campaign_name <> '' GROUP BY campaign_id, campaign_name, platform)
"""


@register("name_change_log", _NAME_LOG_SQL + "SELECT * FROM log")
def q_name_change_log(spark, d):
    return name_change_log(name_rows(spark, d))


@register("multi_name_campaigns", _NAME_LOG_SQL + """
SELECT campaign_id, COUNT(DISTINCT campaign_name) AS name_count,
       CAST(SUM(CASE WHEN is_current = 1 THEN 1 ELSE 0 END) AS BIGINT) AS current_names
FROM log GROUP BY campaign_id HAVING COUNT(DISTINCT campaign_name) > 1
ORDER BY name_count DESC, campaign_id""")
def q_multi_name_campaigns(spark, d):
    return multi_name_campaigns(name_change_log(name_rows(spark, d)))


# ------------------------------------------------------------------ SRC-2/3 (JSON)
@register("json_flatten", """
SELECT event_id,
       TRY_CAST(NULLIF(regexp_extract(props, '"k"\\s*:\\s*(-?[0-9]+)', 1), '') AS BIGINT) AS k
FROM events""")
def q_json_flatten(spark, d):
    e = B.table(spark, d, "events")
    parsed = e.select("event_id", F.from_json("props", "k STRING").alias("p"))
    return parsed.select("event_id", T.to_long(F.col("p.k")).alias("k"))


# ------------------------------------------------------------------ PRJ-1/2/3/5/8 + SRC-1
@register("typed_clean", r"""
WITH raw AS (
  SELECT c_custkey AS campaign_id,
         ' ' || chr(9) || c_name || ' ' AS name_raw,
         ' ' || CAST(c_acctbal AS VARCHAR) || chr(9) AS acctbal_raw,
         '  ' || lower(c_mktsegment) || ' ' AS segment_raw,
         CASE WHEN c_acctbal > 5000 THEN CAST(c_acctbal * 400 AS VARCHAR) ELSE ' ' END AS budget_raw,
         CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nation_raw
  FROM customer),
s AS (
  SELECT campaign_id,
         regexp_replace(name_raw, '^\s+|\s+$', '', 'g') AS name,
         NULLIF(regexp_replace(acctbal_raw, '^\s+|\s+$', '', 'g'), '') AS acct,
         NULLIF(regexp_replace(segment_raw, '^\s+|\s+$', '', 'g'), '') AS seg,
         NULLIF(regexp_replace(budget_raw, '^\s+|\s+$', '', 'g'), '') AS budget,
         NULLIF(regexp_replace(nation_raw, '^\s+|\s+$', '', 'g'), '') AS nation
  FROM raw)
SELECT campaign_id, name, TRY_CAST(acct AS DOUBLE) AS acctbal, upper(seg) AS segment,
       TRY_CAST(budget AS DOUBLE) AS budget_usd,
       CASE WHEN TRY_CAST(budget AS DOUBLE) IS NULL THEN 0 ELSE 1 END AS budget_available,
       COALESCE(TRY_CAST(nation AS DOUBLE), 0.0) AS nation_or_zero
FROM s""")
def q_typed_clean(spark, d):
    c = B.table(spark, d, "customer")
    raw = c.select(
        F.col("c_custkey").alias("campaign_id"),
        F.concat(F.lit(" \t"), "c_name", F.lit(" ")).alias("name_raw"),
        F.concat(F.lit(" "), F.col("c_acctbal").cast("string"), F.lit("\t")).alias("acctbal_raw"),
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("segment_raw"),
        F.when(F.col("c_acctbal") > 5000, (F.col("c_acctbal") * 400).cast("string"))
        .otherwise(F.lit(" ")).alias("budget_raw"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_nationkey").cast("string"))
        .alias("nation_raw"))
    budget = T.to_double("budget_raw")
    return raw.select(
        "campaign_id", T.strip_all("name_raw").alias("name"),
        T.to_double("acctbal_raw").alias("acctbal"),
        T.upper_or_null("segment_raw").alias("segment"),
        budget.alias("budget_usd"), budget.isNotNull().cast("int").alias("budget_available"),
        T.to_double_or_zero("nation_raw").alias("nation_or_zero"))


# ------------------------------------------------------------------ PRJ-7
@register("shift_to_utc", """
WITH t AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a'
                        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp_pst
  FROM events)
SELECT event_id, timestamp_pst, TRY_CAST(timestamp_pst AS TIMESTAMP) + INTERVAL 8 HOUR AS timestamp_utc
FROM t""")
def q_shift_to_utc(spark, d):
    e = B.table(spark, d, "events")
    txt = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(D.format_wall_clock("ts"))
    t = e.select("event_id", txt.alias("timestamp_pst"))
    return t.select("event_id", "timestamp_pst",
                    D.shift_fixed_hours("timestamp_pst").alias("timestamp_utc"))


# ------------------------------------------------------------------ SRC-2/3 + TAB-2 + AGG-11
def google_export_lines(spark, d):
    """One Google-style nested JSON line per order (campaign = customer,
    channel = order status, month as the report date; the timestamp is
    present for finished orders only), with the order key as input
    position."""
    o = B.table(spark, d, "orders")
    month = F.date_trunc("month", "o_orderdate").cast("date").cast("string")
    ts = F.when(F.col("o_orderstatus") == "F",
                F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T00:00:00Z")))
    cost = (B._dec("o_totalprice", 14, 2) * F.lit(1000000)).cast("bigint")
    rec = F.struct(
        month.alias("date"), ts.alias("timestamp_utc"),
        F.struct(F.col("o_custkey").alias("id"),
                 F.concat(F.lit("G_"), F.col("o_custkey").cast("string")).alias("name"),
                 F.col("o_orderstatus").alias("advertising_channel_type")).alias("campaign"),
        F.struct(F.col("o_totalprice").cast("bigint").alias("impressions"),
                 F.lit(1).alias("clicks"), cost.alias("cost_micros"),
                 F.round(F.col("o_totalprice") / 1000, 2).alias("conversions"),
                 (cost * 2).alias("conversions_value_micros")).alias("metrics"))
    return o.select(F.to_json(rec).alias("line"), F.col("o_orderkey").alias("_row"))


@register("google_json_dedup", """
WITH lines AS (
  SELECT o_orderkey AS ord,
         json_object(
           'date', CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR),
           'timestamp_utc', CASE WHEN o_orderstatus = 'F'
                                 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T00:00:00Z' END,
           'campaign', json_object('id', o_custkey, 'name', 'G_' || CAST(o_custkey AS VARCHAR),
                                   'advertising_channel_type', o_orderstatus),
           'metrics', json_object(
              'impressions', CAST(trunc(o_totalprice) AS BIGINT), 'clicks', 1,
              'cost_micros', CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 1000000 AS BIGINT),
              'conversions', DROUND(o_totalprice / 1000, 2),
              'conversions_value_micros',
                 CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 1000000 AS BIGINT) * 2)) AS line
  FROM orders),
flat AS (
  SELECT ord,
         CAST(json_extract_string(line, '$.date') AS DATE) AS date,
         COALESCE(json_extract_string(line, '$.timestamp_utc'), '') AS timestamp_utc,
         json_extract_string(line, '$.campaign.id') AS campaign_id,
         json_extract_string(line, '$.campaign.name') AS campaign_name,
         json_extract_string(line, '$.campaign.advertising_channel_type') AS advertising_channel_type,
         CAST(json_extract_string(line, '$.metrics.impressions') AS BIGINT) AS impressions,
         CAST(json_extract_string(line, '$.metrics.cost_micros') AS BIGINT) AS cost_micros,
         CAST(json_extract_string(line, '$.metrics.conversions') AS DOUBLE) AS conversions
  FROM lines),
g AS (
  SELECT *, COUNT(*) OVER k AS n, MIN(timestamp_utc) OVER k AS lo, MAX(timestamp_utc) OVER k AS hi
  FROM flat WINDOW k AS (PARTITION BY date, campaign_id, campaign_name, advertising_channel_type)),
r AS (
  SELECT *, row_number() OVER (
      PARTITION BY date, campaign_id, campaign_name, advertising_channel_type
      ORDER BY CASE WHEN lo <> hi THEN timestamp_utc END DESC NULLS LAST,
               CASE WHEN lo = hi THEN impressions END DESC NULLS LAST, ord ASC) AS rn
  FROM g)
SELECT date, campaign_id, campaign_name, advertising_channel_type, timestamp_utc, impressions,
       cost_micros, conversions,
       CAST(CASE WHEN n > 1 THEN 1 ELSE 0 END AS INTEGER) AS duplicate_combined,
       CAST(n AS INTEGER) AS duplicate_count
FROM r WHERE rn = 1""")
def q_google_json_dedup(spark, d):
    from spendlens.plans import bronze as BR
    from spendlens.sources import files as SRC
    lines = google_export_lines(spark, d)
    # Parse each line once: expanding the struct behind a generator keeps the
    # optimizer from splitting from_json per field and copying it into the
    # quarantine filter (which would re-parse every line once per field).
    rec = F.struct(F.from_json("line", SRC.GOOGLE_SCHEMA).alias("j"), F.col("_row"))
    parsed = lines.select(F.inline(F.array(rec)))
    recs = parsed.select("j.*", F.lit("orders").alias("_source_file"),
                         F.lit(0).cast("bigint").alias("_block"), "_row")
    good, _bad = BR.clean_google(SRC.flatten_google(recs))
    best = BR.dedup_google(good)
    return best.select("date", "campaign_id", "campaign_name", "advertising_channel_type",
                       "timestamp_utc", "impressions", "cost_micros", "conversions",
                       "duplicate_combined", "duplicate_count")
