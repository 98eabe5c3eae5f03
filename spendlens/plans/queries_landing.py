"""Queries that write landing files derived from the test tables and load them with the
real readers, the stream and the incremental run."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators.fill import grid_state, zero_fill, zero_fill_delta
from spendlens.operators.merge import upsert
from spendlens.plans import bindings as B
from spendlens.plans import bronze as BR
from spendlens.plans.catalog import register
from spendlens.session import checkpoint_dir
from spendlens.sources import files as SRC
from spendlens.sources.reference import DMA_REGION_MAP
from spendlens.sources.store import TableStore

LOADED = dt.datetime(2026, 8, 1, 6)


def _folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/spendlens-landing/{label}-{uuid.uuid4().hex}"


def _write_csv(df: DataFrame, path: str) -> None:
    (df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def _strings(df: DataFrame, values: dict[str, Column], *more: str) -> DataFrame:
    return df.select(*[v.cast("string").alias(k) for k, v in values.items()], *more)


def _meta_values() -> dict[str, Column]:
    """A Meta row per lineitem, as ``queries_media.meta_lines`` has it."""
    day = F.col("l_shipdate").cast("date").cast("string")
    return {
        "date": day, "timestamp_pst": F.concat(day, F.lit(" 20:30:00")), "campaign_id": F.col("l_suppkey"),
        "campaign_name": F.concat(F.lit('"'), F.col("l_linestatus"), F.lit('", '), F.col("l_partkey")),
        "adset_id": F.col("l_orderkey"), "ad_id": F.col("l_linenumber"), "objective": F.lit("sales"),
        "placement": F.col("l_returnflag"), "impressions": F.col("l_partkey"),
        "clicks": F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".0")),
        "spend_usd": F.col("l_extendedprice").cast("decimal(12,2)"),
        "currency": F.when(F.col("l_linenumber") % 3 == 0, "USD")
                     .when(F.col("l_linenumber") % 3 == 1, " usd "),
        "conversions": F.col("l_quantity").cast("decimal(12,2)"), "conversion_value_usd": F.lit(None)}


@register("landing_csv_by_name", """
SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS VARCHAR) AS campaign_id,
       '"' || l_linestatus || '", ' || l_partkey AS campaign_name,
       CAST(l_orderkey AS VARCHAR) AS adset_id, CAST(l_linenumber AS VARCHAR) AS ad_id,
       CAST(l_partkey AS BIGINT) AS impressions, CAST(l_quantity AS BIGINT) AS clicks,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS spend_amount,
       if(l_linenumber % 3 = 2, NULL, 'USD') AS original_currency,
       'meta_ads_' || (1 + l_linenumber % 2) || '.csv' AS entry
FROM lineitem""")
def q_landing_csv_by_name(spark, d):
    """SRC-1/4/5: two landing folders whose files name the same columns in another order, one
    with a column more; listed, read by name in one pass, typed."""
    landing, values = _folder(spark, "by-name"), _meta_values()
    li = B.table(spark, d, "lineitem")
    rows = _strings(li, values, "l_linenumber").withColumn("note", F.lit('x, "y"'))
    _write_csv(rows.where("l_linenumber % 2 = 0").select(*SRC.META_COLUMNS), f"{landing}/meta_ads_1.csv")
    _write_csv(rows.where("l_linenumber % 2 = 1").select("note", *reversed(SRC.META_COLUMNS)),
               f"{landing}/meta_ads_2.csv")
    listed = SRC.list_files(spark, landing).where("source = 'meta_ads'")
    paths = [r["path"] for r in listed.select("path").collect()]
    good, _ = BR.clean_meta(SRC.read_csv_strings(spark, paths, SRC.META_COLUMNS), LOADED)
    return good.select("date", "campaign_id", "campaign_name", "adset_id", "ad_id", "impressions", "clicks",
                       "spend_amount", "original_currency",
                       F.element_at(F.split("_source_file", "/"), -2).alias("entry"))


_VISITS_SQL = """
v AS (
  SELECT CAST(o_orderdate AS DATE) AS date, CAST(c_nationkey AS VARCHAR) AS dma_code,
         o_orderkey % 3 AS part, COUNT(*) AS visits
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


@register("stream_landing_once", "WITH " + _VISITS_SQL + """
SELECT date, dma_code, 'Area "' || dma_code || '", x' AS dma_name, visits AS attributed_visits,
       CAST(if(part = 2, 28, 7) AS BIGINT) AS attribution_window_days,
       'store_visits_' || if(part = 2, 2, 1) || '.csv' AS entry
FROM v WHERE part != 1 QUALIFY row_number() OVER (PARTITION BY date, dma_code ORDER BY part) = 1""")
def q_stream_landing_once(spark, d):
    """STR-1: a stream that takes what has landed, twice.  The first file has its columns
    reversed, the second brings keys that are stored (they stay), a file of another name is
    left alone, and a third start finds nothing new."""
    from spendlens.streaming.landing import ingest_available

    landing, store = _folder(spark, "stream"), TableStore(spark, _folder(spark, "stream-tables"))
    days = (B.table(spark, d, "orders").join(B.table(spark, d, "customer"),
                                             F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.col("o_orderdate").cast("date").alias("day"), F.col("c_nationkey").alias("nation"),
                     (F.col("o_orderkey") % 3).alias("part")).agg(F.count("*").alias("n")))
    rows = _strings(days, {
        "date": F.col("day"), "dma_code": F.col("nation"),
        "dma_name": F.concat(F.lit('Area "'), F.col("nation"), F.lit('", x')), "attributed_visits": F.col("n"),
        "attribution_window_days": F.when(F.col("part") == 2, 28).otherwise(7)}, "part")
    _write_csv(rows.where("part = 0").select(*reversed(SRC.VISITS_COLUMNS)), f"{landing}/store_visits_1.csv")
    _write_csv(rows.where("part = 1").select(*SRC.VISITS_COLUMNS), f"{landing}/store_visits_old.csv")
    ingest_available(spark, landing, store, "store_visits")
    _write_csv(rows.where("part = 2").select(*SRC.VISITS_COLUMNS), f"{landing}/store_visits_2.csv")
    for _ in range(2):
        ingest_available(spark, landing, store, "store_visits")
    return store.read("raw_store_visits").select(
        *SRC.VISITS_COLUMNS, F.element_at(F.split("_source_file", "/"), -2).alias("entry"))


def _drop(spark: SparkSession, d: str, landing: str, second: bool) -> None:
    """Landing files of one drop: orders as Meta rows, customers as Google records and campaign
    metadata, orders a day and nation as visits of the mapped DMAs; dates of 2026."""
    o, c = B.table(spark, d, "orders"), B.table(spark, d, "customer")
    day = lambda k: F.date_add(F.lit("2026-01-01").cast("date"), (F.col(k) % 150).cast("int"))
    mine = F.col("date") >= "2026-05-01" if second else F.col("date") < "2026-05-01"
    tag = "2" if second else "1"
    meta = _strings(o, {
        "date": day("o_orderkey"), "timestamp_pst": F.concat(day("o_orderkey"), F.lit(" 01:00:00")),
        "campaign_id": F.col("o_custkey"), "campaign_name": F.concat(F.lit("C"), F.col("o_custkey")),
        "adset_id": F.col("o_orderkey"), "ad_id": F.lit("a"), "objective": F.col("o_orderstatus"),
        "placement": F.col("o_orderpriority"), "impressions": F.col("o_custkey"), "clicks": F.lit(1),
        "spend_usd": F.col("o_totalprice").cast("decimal(12,2)"),
        "currency": F.element_at(F.array(*map(F.lit, ("USD", " cad", "GBP", "EUR"))),
                                 (F.col("o_orderkey") % 4 + 1).cast("int")),
        "conversions": F.lit(1), "conversion_value_usd": F.lit(None)})
    _write_csv(meta.where(mine), f"{landing}/meta_ads_{tag}.csv")
    google = c.select(day("c_custkey").cast("string").alias("date"), F.to_json(F.struct(
        day("c_custkey").cast("string").alias("date"), F.struct(
            F.col("c_custkey").alias("id"), F.concat(F.lit("G"), F.col("c_custkey")).alias("name"),
            F.col("c_mktsegment").alias("advertising_channel_type")).alias("campaign"),
        F.struct(F.lit(1).alias("impressions"), F.lit(1).alias("clicks"),
                 (F.col("c_custkey") * 12345678).cast("bigint").alias("cost_micros"),
                 F.lit(1.5).alias("conversions"), F.lit(0).alias("conversions_value_micros"))
        .alias("metrics"))).alias("value"))
    google.where(mine).select("value").write.text(f"{landing}/google_ads_{tag}.json")
    dma = F.element_at(F.array(*[F.lit(x) for x, _, _ in DMA_REGION_MAP], F.lit("999")),
                       F.least(F.col("c_nationkey") + 1, F.lit(len(DMA_REGION_MAP) + 1)).cast("int"))
    visits = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
              .groupBy(day("o_orderkey").alias("day"), dma.alias("dma")).agg(F.count("*").alias("n")))
    visits = _strings(visits, {"date": F.col("day"), "dma_code": F.col("dma"),
                               "dma_name": F.concat(F.lit("D"), F.col("dma")),
                               "attributed_visits": F.col("n"), "attribution_window_days": F.lit(7)})
    # days of one remainder are missing for all, so that gaps are filled
    _write_csv(visits.where(mine).where("day(date) % 7 != 3"), f"{landing}/store_visits_{tag}.csv")
    part = F.col("c_custkey") % 2 == int(second)
    budget = (F.when(F.col("c_custkey") % 50 == 7, "n/a").when(F.col("c_acctbal") > 0, F.col("c_acctbal")
                                                               .cast("decimal(12,2)").cast("string")))
    _write_csv(_strings(c.where(part), {
        "campaign_id": F.col("c_custkey"), "brand": F.lit("Northwind"), "product_line": F.col("c_mktsegment"),
        "region": F.when(F.col("c_nationkey") % 2 == 0, "East"), "campaign_start_date": F.lit("2026-01-01"),
        "campaign_end_date": F.lit("2026-06-30"), "budget_usd": budget}),
        f"{landing}/campaign_metadata_{tag}.csv")


_DMA_SQL = ", ".join(f"({i}, '{code}', '{region}')" for i, (code, _, region) in enumerate(DMA_REGION_MAP))


@register("landing_two_drops", f"""
WITH m AS (SELECT DATE '2026-01-01' + CAST(o_orderkey % 150 AS INTEGER) AS date, o_custkey,
             CAST(o_totalprice AS DECIMAL(12,2)) AS price, o_orderkey % 4 AS cur FROM orders),
g AS (SELECT DATE '2026-01-01' + CAST(c_custkey % 150 AS INTEGER) AS date,
        ROUND(CAST(c_custkey * 12345678 AS DECIMAL(24,0)) / 1000000, 2) AS spend FROM customer),
fact AS (
  SELECT 'meta' AS platform, date, ROUND(price * CAST(CASE cur
    WHEN 1 THEN CASE month(date) WHEN 1 THEN 0.74 WHEN 2 THEN 0.74 WHEN 3 THEN 0.73 WHEN 4 THEN 0.73 ELSE 0.72 END
    WHEN 2 THEN CASE month(date) WHEN 1 THEN 1.27 WHEN 2 THEN 1.27 WHEN 3 THEN 1.26 WHEN 4 THEN 1.26 ELSE 1.25 END
    ELSE 1 END AS DECIMAL(6,2)), 2) AS spend FROM m
  UNION ALL SELECT 'google', date, CAST(spend AS DECIMAL(20,2)) FROM g),
dma(nation, code, region) AS (VALUES {_DMA_SQL}),
v AS (SELECT m.date, COALESCE(code, '999') AS code, COUNT(*) AS n
      FROM m JOIN customer ON o_custkey = c_custkey LEFT JOIN dma ON c_nationkey = nation
      WHERE day(m.date) % 7 != 3 GROUP BY ALL),
grid AS (SELECT CAST(d AS DATE) AS date, code FROM (SELECT DISTINCT code FROM v),
           generate_series((SELECT MIN(date) FROM v), (SELECT MAX(date) FROM v), INTERVAL 1 DAY) AS s(d)),
filled AS (SELECT grid.date, grid.code, n FROM grid LEFT JOIN v ON v.date = grid.date AND v.code = grid.code),
md AS (SELECT *, c_custkey % 50 = 7 AS bad, if(c_nationkey % 2 = 0, 'East', NULL) AS region FROM customer)
SELECT 'fact' AS section, platform AS k1, CAST(month(date) AS VARCHAR) AS k2, COUNT(*) AS n,
       CAST(SUM(spend) AS DOUBLE) AS total FROM fact GROUP BY ALL
UNION ALL SELECT 'visits', region, CAST(n IS NULL AS VARCHAR), COUNT(*), CAST(COALESCE(SUM(n), 0) AS DOUBLE)
  FROM filled JOIN dma USING (code) GROUP BY region, n IS NULL
UNION ALL SELECT 'dim', 'Northwind', region, COUNT(*),
    CAST(COUNT(if(region IS NULL, NULL, 'Northwind_' || c_mktsegment || '_' || region)) AS DOUBLE)
  FROM md WHERE NOT bad GROUP BY region
UNION ALL SELECT 'quarantine', 'campaign_metadata', 'bad budget', COUNT(*), NULL FROM md WHERE bad
  HAVING COUNT(*) > 0
UNION ALL SELECT 'log', 'meta_ads_' || if(date < DATE '2026-05-01', 1, 2) || '.csv', 'success', COUNT(*), 0
  FROM m GROUP BY ALL
UNION ALL SELECT 'log', 'google_ads_' || if(date < DATE '2026-05-01', 1, 2) || '.json', 'success', COUNT(*), 0
  FROM g GROUP BY ALL
UNION ALL SELECT 'log', 'store_visits_' || if(date < DATE '2026-05-01', 1, 2) || '.csv', 'success', COUNT(*), 0
  FROM v GROUP BY ALL
UNION ALL SELECT 'log', 'campaign_metadata_' || (1 + c_custkey % 2) || '.csv', 'success', COUNT(*), 0
  FROM md WHERE NOT bad GROUP BY ALL""")
def q_landing_two_drops(spark, d):
    """The incremental run over two drops and a third start with nothing new, all from files:
    matching rates, the DMA map, gaps of visits, scoped dimensions, quarantine, file log."""
    from spendlens.plans import pipeline

    landing, tables = _folder(spark, "drops"), _folder(spark, "drops-tables")
    for k in range(3):
        if k < 2:
            _drop(spark, d, landing, second=bool(k))
        pipeline.run(spark, landing, tables, dt.datetime(2026, 8, 1 + k, 6))
    store = TableStore(spark, tables)
    entry = F.element_at(F.split("source_file", "/"), -2)
    none = F.lit(None).cast("double")
    fact = store.read("fact_daily_performance")
    visits = store.read("fact_store_visits")
    gap = F.col("is_zero_filled") == 1
    parts = [
        fact.groupBy(F.lit("fact").alias("section"), F.col("platform").alias("k1"),
                     F.month("date").cast("string").alias("k2")).agg(
            F.count("*").alias("n"), F.sum(F.col("spend_usd").cast("decimal(20,2)")).cast("double").alias("total")),
        visits.groupBy(F.lit("visits").alias("section"), F.col("mapped_region").alias("k1"),
                       gap.cast("string").alias("k2")).agg(
            F.count("*").alias("n"), F.sum("attributed_visits").cast("double").alias("total")),
        store.read("dim_campaign").groupBy(F.lit("dim").alias("section"), F.col("brand").alias("k1"),
                                           F.col("region").alias("k2")).agg(
            F.count("*").alias("n"), F.count("campaign_name_standardized").cast("double").alias("total")),
        store.read("_quarantine").groupBy(F.lit("quarantine").alias("section"), F.col("source").alias("k1"),
                                          F.col("reason").alias("k2")).agg(
            F.count("*").alias("n"), F.first(none).alias("total")),
        store.read("_ingestion_log").groupBy(F.lit("log").alias("section"), entry.alias("k1"),
                                             F.col("status").alias("k2")).agg(
            F.sum("records_loaded").alias("n"), F.sum("records_skipped").cast("double").alias("total")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("zero_fill_two_batches", """
WITH v AS (
  SELECT CAST(o_orderdate AS DATE) AS date, c_nationkey AS nation, COUNT(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
named AS (
  SELECT nation, MAX('N' || nation || if(nation % 5 = 1 AND day(date) % 3 = 0, 'x', '')) AS name
  FROM v GROUP BY nation),
days AS (SELECT CAST(d AS DATE) AS date FROM generate_series(
  (SELECT MIN(date) FROM v), (SELECT MAX(date) FROM v), INTERVAL 1 DAY) AS s(d))
SELECT days.date, CAST(named.nation AS VARCHAR) AS dma_code, name AS dma_name,
       CAST(COALESCE(n, 0) AS BIGINT) AS attributed_visits,
       CAST(if(n IS NULL, 0, 7) AS BIGINT) AS attribution_window_days, CAST(n IS NULL AS INTEGER) AS is_zero_filled
FROM days CROSS JOIN named LEFT JOIN v ON v.date = days.date AND v.nation = named.nation""")
def q_zero_fill_two_batches(spark, d):
    """TAB-13, FIL-3, PRJ-16: a filled grid, then a batch with days beyond its range, new
    nations, gaps that close and changed names: only the rows it changes are worked out."""
    day = F.col("o_orderdate").cast("date")
    second = (F.dayofmonth(day) % 3 == 0) | (F.year(day) >= 1997) | (F.col("c_nationkey") % 7 == 3)
    visits = (B.table(spark, d, "orders").join(B.table(spark, d, "customer"),
                                               F.col("o_custkey") == F.col("c_custkey"))
              .groupBy(day.alias("date"), "c_nationkey", second.alias("second"))
              .agg(F.count("*").alias("attributed_visits"))
              .select("date", F.col("c_nationkey").cast("string").alias("dma_code"),
                      F.concat(F.lit("N"), F.col("c_nationkey"), F.when(
                          (F.col("c_nationkey") % 5 == 1) & (F.dayofmonth("date") % 3 == 0), "x")
                          .otherwise("")).alias("dma_name"),
                      "attributed_visits", F.lit(7).cast("bigint").alias("attribution_window_days"), "second"))
    first, batch = (visits.where(c).drop("second") for c in ("not second", "second"))
    rows, _ = zero_fill_delta(grid_state(first), batch, visits.drop("second"))
    return upsert(zero_fill(first), rows, ["date", "dma_code"])
