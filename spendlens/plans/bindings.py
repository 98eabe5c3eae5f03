"""Media-shaped views over the driver's generic tables.

The engine's builders and reports work on media tables (performance fact,
campaign dimension, store visits, campaign metadata).  To exercise them on the
read-only benchmark tables, each media table is *derived* from those tables by
Spark, so the work grows with them:

performance fact      lineitem: date = l_shipdate, campaign = l_suppkey,
                      platform = l_returnflag,
                      spend = extendedprice * (1 - discount) (exact decimal),
                      conversions = l_quantity, value = l_extendedprice
campaign dimension    supplier -> nation -> region: brand = r_name,
                      product_line = n_name, region = National for region
                      key 4, East for keys 0-1, West otherwise
store visits          orders -> customer: one visit per order, per
                      (order date, customer nation); DMA = nation
DMA -> region map     nation: East for region keys 0-1, West for 2-3;
                      nations of region 4 stay unmapped
campaign metadata     customer: product_line = c_mktsegment, budget =
                      400 * c_acctbal when c_acctbal > 5000 (else missing),
                      start/end = first/last order date
budget spend fact     orders: campaign = o_custkey, spend = o_totalprice
short-horizon fact    events: campaign = user_id, spend = value

Every ``*_SQL`` constant is the same derivation in DuckDB SQL, used by the
oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators.fill import zero_fill
from spendlens.sources.reference import calendar_spanning


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(c: str, p: int = 12, s: int = 2) -> Column:
    return F.col(c).cast(f"decimal({p},{s})")


def _region_label(regionkey: Column) -> Column:
    return (F.when(regionkey == 4, F.lit("National"))
            .when(regionkey < 2, F.lit("East")).otherwise(F.lit("West")))


# --------------------------------------------------------------------------
# performance fact (lineitem)
# --------------------------------------------------------------------------
def ads_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").alias("campaign_id"),
        F.col("l_returnflag").alias("platform"),
        F.col("l_partkey").alias("adset_id"),
        F.col("l_orderkey").alias("ad_id"),
        F.col("l_linenumber").alias("line_no"),
        (_dec("l_extendedprice") * (F.lit(1) - _dec("l_discount", 3, 2))).alias("spend_usd"),
        _dec("l_quantity").alias("conversions"),
        _dec("l_extendedprice").alias("conversion_value_usd"),
    )


ADS_FACT_SQL = """ads_fact AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS campaign_id,
         l_returnflag AS platform, l_partkey AS adset_id, l_orderkey AS ad_id,
         l_linenumber AS line_no,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS spend_usd,
         CAST(l_quantity AS DECIMAL(12,2)) AS conversions,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS conversion_value_usd
  FROM lineitem)"""


def campaign_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = (s.join(n, s.s_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey))
    region = _region_label(F.col("n_regionkey"))
    return j.select(
        F.col("s_suppkey").alias("campaign_id"),
        F.col("r_name").alias("brand"),
        F.col("n_name").alias("product_line"),
        region.alias("region"),
        F.concat(F.col("r_name"), F.lit("_"), F.col("n_name"), F.lit("_"), region)
        .alias("campaign_name_standardized"),
    )


_REGION_CASE = ("CASE WHEN n_regionkey = 4 THEN 'National' "
                "WHEN n_regionkey < 2 THEN 'East' ELSE 'West' END")

CAMPAIGN_DIM_SQL = f"""dim_campaign AS (
  SELECT s_suppkey AS campaign_id, r_name AS brand, n_name AS product_line,
         {_REGION_CASE} AS region,
         r_name || '_' || n_name || '_' || {_REGION_CASE} AS campaign_name_standardized
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""


def date_dim(fact: DataFrame) -> DataFrame:
    """Calendar covering the fact's own date range (one row per day)."""
    bounds = fact.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return calendar_spanning(bounds)


def date_dim_sql(fact_cte: str) -> str:
    return f"""dim_date AS (
  SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year,
         CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(dayofweek(d) AS INTEGER) AS day_of_week,
         CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP),
                                       INTERVAL 1 DAY)) AS d FROM {fact_cte}))"""


# --------------------------------------------------------------------------
# store visits (orders -> customer -> nation)
# --------------------------------------------------------------------------
def raw_store_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    visits = (o.join(c, o.o_custkey == c.c_custkey)
              .groupBy(F.col("o_orderdate").cast("date").alias("date"),
                       F.col("c_nationkey").alias("dma_code"))
              .agg(F.count(F.lit(1)).alias("attributed_visits")))
    return (visits.join(F.broadcast(n), visits.dma_code == n.n_nationkey)
            .select("date", "dma_code", F.col("n_name").alias("dma_name"),
                    "attributed_visits", F.lit(7).cast("bigint").alias("attribution_window_days")))


RAW_STORE_VISITS_SQL = """raw_store_visits AS (
  SELECT v.date, v.dma_code, n_name AS dma_name, v.attributed_visits,
         CAST(7 AS BIGINT) AS attribution_window_days
  FROM (SELECT CAST(o_orderdate AS DATE) AS date, c_nationkey AS dma_code,
               CAST(count(*) AS BIGINT) AS attributed_visits
        FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY 1, 2) v
  JOIN nation ON v.dma_code = n_nationkey)"""


def dma_region_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return (n.filter(F.col("n_regionkey") < 4)
            .select(F.col("n_nationkey").alias("dma_code"), F.col("n_name").alias("dma_name"),
                    F.when(F.col("n_regionkey") < 2, F.lit("East")).otherwise(F.lit("West"))
                    .alias("mapped_region")))


DMA_REGION_MAP_SQL = """dma_region_map AS (
  SELECT n_nationkey AS dma_code, n_name AS dma_name,
         CASE WHEN n_regionkey < 2 THEN 'East' ELSE 'West' END AS mapped_region
  FROM nation WHERE n_regionkey < 4)"""


def stg_store_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zero_fill(raw_store_visits(spark, sf_dir))


STG_STORE_VISITS_SQL = RAW_STORE_VISITS_SQL + """,
dma_list AS (SELECT dma_code, max(dma_name) AS dma_name FROM raw_store_visits GROUP BY dma_code),
grid AS (
  SELECT CAST(d AS DATE) AS date, dma_code, dma_name
  FROM dma_list,
       (SELECT unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP),
                                      INTERVAL 1 DAY)) AS d FROM raw_store_visits)),
stg_store_visits AS (
  SELECT g.date, g.dma_code, g.dma_name,
         COALESCE(v.attributed_visits, 0) AS attributed_visits,
         COALESCE(v.attribution_window_days, 0) AS attribution_window_days,
         CASE WHEN v.date IS NULL THEN 1 ELSE 0 END AS is_zero_filled
  FROM grid g LEFT JOIN raw_store_visits v ON g.date = v.date AND g.dma_code = v.dma_code)"""


def fact_store_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spendlens.plans.gold import build_fact_store_visits
    return build_fact_store_visits(stg_store_visits(spark, sf_dir),
                                   dma_region_map(spark, sf_dir))


FACT_STORE_VISITS_SQL = STG_STORE_VISITS_SQL + ",\n" + DMA_REGION_MAP_SQL + """,
fact_store_visits AS (
  SELECT sv.date, sv.dma_code, dm.dma_name, dm.mapped_region, sv.attributed_visits,
         sv.attribution_window_days, sv.is_zero_filled
  FROM stg_store_visits sv JOIN dma_region_map dm ON sv.dma_code = dm.dma_code)"""


# --------------------------------------------------------------------------
# campaign metadata and budget spend (customer, orders)
# --------------------------------------------------------------------------
def budget_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderdate").cast("date").alias("date"),
                    F.col("o_custkey").alias("campaign_id"),
                    F.col("o_orderstatus").alias("platform"),
                    _dec("o_totalprice", 14, 2).alias("spend_usd"))


BUDGET_FACT_SQL = """budget_fact AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_custkey AS campaign_id,
         o_orderstatus AS platform, CAST(o_totalprice AS DECIMAL(14,2)) AS spend_usd
  FROM orders)"""


def campaign_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    life = (table(spark, sf_dir, "orders")
            .groupBy(F.col("o_custkey").alias("cid"))
            .agg(F.min(F.col("o_orderdate").cast("date")).alias("campaign_start_date"),
                 F.max(F.col("o_orderdate").cast("date")).alias("campaign_end_date")))
    budget = F.when(F.col("c_acctbal") > 5000, _dec("c_acctbal") * F.lit(400))
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .join(life, c.c_custkey == life.cid, "left")
            .select(F.col("c_custkey").alias("campaign_id"),
                    F.col("c_mktsegment").alias("product_line"),
                    _region_label(F.col("n_regionkey")).alias("region"),
                    "campaign_start_date", "campaign_end_date",
                    budget.alias("budget_usd"),
                    budget.isNotNull().cast("int").alias("budget_available")))


CAMPAIGN_METADATA_SQL = f"""campaign_metadata AS (
  SELECT c_custkey AS campaign_id, c_mktsegment AS product_line,
         {_REGION_CASE} AS region,
         life.campaign_start_date, life.campaign_end_date,
         CASE WHEN c_acctbal > 5000 THEN CAST(c_acctbal AS DECIMAL(12,2)) * 400 END AS budget_usd,
         CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS budget_available
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey AS cid, min(CAST(o_orderdate AS DATE)) AS campaign_start_date,
                    max(CAST(o_orderdate AS DATE)) AS campaign_end_date
             FROM orders GROUP BY o_custkey) life ON c_custkey = life.cid)"""


def customer_campaign_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
         .join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    region = _region_label(F.col("n_regionkey"))
    return j.select(
        F.col("c_custkey").alias("campaign_id"),
        F.col("r_name").alias("brand"),
        F.col("c_mktsegment").alias("product_line"),
        region.alias("region"),
        F.concat(F.col("r_name"), F.lit("_"), F.col("c_mktsegment"), F.lit("_"), region)
        .alias("campaign_name_standardized"),
    )


CUSTOMER_CAMPAIGN_DIM_SQL = f"""cust_dim AS (
  SELECT c_custkey AS campaign_id, r_name AS brand, c_mktsegment AS product_line,
         {_REGION_CASE} AS region,
         r_name || '_' || c_mktsegment || '_' || {_REGION_CASE} AS campaign_name_standardized
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""


# --------------------------------------------------------------------------
# short-horizon fact (events)
# --------------------------------------------------------------------------
def events_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("ts").cast("date").alias("date"),
                    F.col("ts"),
                    F.col("event_id"),
                    F.col("user_id").alias("campaign_id"),
                    F.col("event_type").alias("campaign_name"),
                    _dec("value").alias("spend_usd"),
                    F.col("props"))


EVENTS_FACT_SQL = """events_fact AS (
  SELECT CAST(ts AS DATE) AS date, ts, event_id, user_id AS campaign_id,
         event_type AS campaign_name, CAST(value AS DECIMAL(12,2)) AS spend_usd, props
  FROM events)"""
