"""Landing files in the four source formats, derived by Spark from the
benchmark tables (used by bench.py to time the full pipeline at scale).

meta_ads      CSV  from lineitem (campaign = supplier, currency by the
                    supplier's region: USD, CAD, GBP, lower-case USD, missing)
google_ads    NDJSON from orders (campaign = customer, nested campaign and
                    metrics objects, cost in micros)
store_visits  CSV  orders per (date, customer nation); nations 0-14 take the
                    15 mapped DMA codes, the others unmapped codes
campaign_metadata CSV from supplier (budget missing when the balance <= 0)

Ship/order dates are mapped onto 2026-01-01 .. 2026-06-29 proportionally.
Rows dated before ``split`` go to the initial drop, the rest to later files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.sources.reference import DMA_REGION_MAP

DAYS = 180
START = "2026-01-01"
PRODUCT_LINES = ["Appliances", "Furniture", "Outdoor", "Seasonal"]


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _mapped_date(df: DataFrame, col: str) -> Column:
    lo = df.select(F.min(F.col(col).cast("date"))).scalar()
    hi = df.select(F.max(F.col(col).cast("date"))).scalar()
    span = F.datediff(hi, lo) + 1
    return F.date_add(F.lit(START).cast("date"),
                      F.floor(F.datediff(F.col(col).cast("date"), lo) * DAYS / span).cast("int"))


def _region(rk: Column) -> Column:
    return F.when(rk == 4, "National").when(rk < 2, "East").otherwise("West")


def meta_rows(spark, d) -> DataFrame:
    li = _t(spark, d, "lineitem")
    s = _t(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n = _t(spark, d, "nation").select("n_nationkey", "n_regionkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
    rk = F.col("n_regionkey")
    cur = (F.when(rk == 0, "USD").when(rk == 1, "CAD").when(rk == 2, "GBP")
           .when(rk == 3, "usd ").otherwise(""))
    date = _mapped_date(li, "l_shipdate")
    spend = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2)
    return j.select(
        date.cast("string").alias("date"),
        F.concat(date.cast("string"), F.lit(" "),
                 F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(":00:00"))
        .alias("timestamp_pst"),
        F.col("l_suppkey").cast("string").alias("campaign_id"),
        F.concat(F.lit("NW_"), F.col("l_suppkey").cast("string")).alias("campaign_name"),
        F.col("l_partkey").cast("string").alias("adset_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("ad_id"),
        F.col("l_returnflag").alias("objective"), F.col("l_linestatus").alias("placement"),
        (F.col("l_quantity") * 100).cast("bigint").cast("string").alias("impressions"),
        F.col("l_quantity").cast("bigint").cast("string").alias("clicks"),
        spend.cast("string").alias("spend_usd"), cur.alias("currency"),
        F.round(F.col("l_quantity") / 10, 2).cast("string").alias("conversions"),
        F.round(F.col("l_extendedprice") / 5, 2).cast("string").alias("conversion_value_usd"))


def google_rows(spark, d) -> DataFrame:
    o = _t(spark, d, "orders")
    date = _mapped_date(o, "o_orderdate")
    rec = F.struct(
        date.cast("string").alias("date"),
        F.concat(date.cast("string"), F.lit("T"),
                 F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":00:00Z"))
        .alias("timestamp_utc"),
        F.struct(F.col("o_custkey").alias("id"),
                 F.concat(F.lit("G_"), F.col("o_custkey").cast("string")).alias("name"),
                 F.col("o_orderpriority").alias("advertising_channel_type")).alias("campaign"),
        F.struct((F.col("o_totalprice") / 10).cast("bigint").alias("impressions"),
                 (F.col("o_totalprice") / 1000).cast("bigint").alias("clicks"),
                 (F.col("o_totalprice") * 1000).cast("bigint").alias("cost_micros"),
                 F.round(F.col("o_totalprice") / 20000, 2).alias("conversions"),
                 (F.col("o_totalprice") * 3000).cast("bigint").alias("conversions_value_micros"))
        .alias("metrics"))
    return o.select(date.cast("string").alias("date"), F.to_json(rec).alias("value"))


def visit_rows(spark, d) -> DataFrame:
    o = _t(spark, d, "orders").select("o_custkey", "o_orderdate")
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    codes = F.array(*[F.lit(code) for code, _, _ in DMA_REGION_MAP])
    names = F.array(*[F.lit(name) for _, name, _ in DMA_REGION_MAP])
    nk = F.col("c_nationkey")
    n_codes = len(DMA_REGION_MAP)
    dma_code = F.when(nk < n_codes, F.element_at(codes, nk + 1)) \
        .otherwise(F.concat(F.lit("9"), F.lpad(nk.cast("string"), 2, "0")))
    dma_name = F.when(nk < n_codes, F.element_at(names, nk + 1)) \
        .otherwise(F.concat(F.lit("Unmapped "), nk.cast("string")))
    date = _mapped_date(o, "o_orderdate")
    g = (o.join(c, o.o_custkey == c.c_custkey)
         .groupBy(date.alias("d"), dma_code.alias("dma_code"), dma_name.alias("dma_name"))
         .agg(F.count(F.lit(1)).alias("v")))
    return g.select(F.col("d").cast("string").alias("date"), "dma_code", "dma_name",
                    F.col("v").cast("string").alias("attributed_visits"),
                    F.lit("7").alias("attribution_window_days"))


def metadata_rows(spark, d) -> DataFrame:
    s = _t(spark, d, "supplier")
    n = _t(spark, d, "nation").select("n_nationkey", "n_regionkey")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
    lines = F.array(*[F.lit(x) for x in PRODUCT_LINES])
    return j.select(
        F.col("s_suppkey").cast("string").alias("campaign_id"), F.lit("Northwind").alias("brand"),
        F.element_at(lines, (F.col("s_nationkey") % len(PRODUCT_LINES)) + 1).alias("product_line"),
        _region(F.col("n_regionkey")).alias("region"),
        F.lit(START).alias("campaign_start_date"), F.lit("2026-06-30").alias("campaign_end_date"),
        F.when(F.col("s_acctbal") > 0, F.round(F.col("s_acctbal") * 100, 2).cast("string"))
        .otherwise(F.lit("")).alias("budget_usd"))


def _csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_drop(spark: SparkSession, sf_dir: str, landing: str, *, first: bool,
               split: str = "2026-06-01") -> None:
    """``first``: rows dated before ``split`` (plus all metadata) into the
    main files; otherwise the rest into additional dated files."""
    keep = (F.col("date") < split) if first else (F.col("date") >= split)
    tag = "daily" if first else "2026-06"
    _csv(meta_rows(spark, sf_dir).filter(keep), f"{landing}/meta_ads_{tag}.csv")
    (google_rows(spark, sf_dir).filter(keep).select("value")
     .write.mode("overwrite").text(f"{landing}/google_ads_{tag}.json"))
    _csv(visit_rows(spark, sf_dir).filter(keep), f"{landing}/store_visits_{tag}.csv")
    if first:
        _csv(metadata_rows(spark, sf_dir), f"{landing}/campaign_metadata.csv")
