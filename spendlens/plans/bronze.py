"""Bronze builders (TAB-1 .. TAB-4): typing, flags, quarantine, de-dup.

Each ``clean_*`` returns ``(good, quarantine)``.  A row whose required value
is missing or does not parse goes to the quarantine table with a reason
instead of aborting the run; both outputs come from one projection of the
input, split by a flag.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions import dates as D
from spendlens.functions import text as T
from spendlens.operators.dedup import best_record
from spendlens.sources.files import ORDER_COLS

META_KEY = ["date", "campaign_id", "campaign_name", "adset_id", "ad_id", "objective", "placement"]
GOOGLE_KEY = ["date", "campaign_id", "campaign_name", "advertising_channel_type"]
VISITS_KEY = ["date", "dma_code"]
METADATA_KEY = ["campaign_id"]

QUARANTINE_COLS = ["source", "reason", *ORDER_COLS, "record"]


def _once(df: DataFrame, values: dict[str, Column], *keep: str) -> DataFrame:
    """``values`` and the columns ``keep``.  The values stand behind ``inline``: no filter
    or projection above is pushed below it, so each is worked out once a row, however
    often it is used."""
    row = F.struct(*[v.alias(k) for k, v in values.items()])
    return df.select(F.inline(F.array(row)), *keep)


def _stripped(raw: DataFrame, columns: list[str], as_read: list[str]) -> DataFrame:
    """Columns stripped once, those of ``as_read`` also as they came (``_raw_``)."""
    return _once(raw, {c: T.strip_all(c) for c in columns} | {f"_raw_{c}": F.col(c) for c in as_read},
                 *ORDER_COLS)


def _split(rows: DataFrame, values: dict[str, Column], checks: list[tuple[str, Column]], source: str,
           record: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) of the typed ``values``.  checks: (reason, column over the typed
    values that is True when the row is bad); ``record``: raw columns for the quarantine."""
    raw = [c for c in rows.columns if c.startswith("_raw_")]
    typed = _once(rows, values, *raw, *ORDER_COLS)
    reason = F.lit(None).cast("string")
    for name, bad in reversed(checks):
        reason = F.when(bad, F.lit(name)).otherwise(reason)
    tagged = typed.withColumn("_reason", reason)
    extra = [c for c in values if c.startswith("_bad_")]
    good = tagged.filter(F.col("_reason").isNull()).drop("_reason", *raw, *extra)
    bad = tagged.filter(F.col("_reason").isNotNull()).select(
        F.lit(source).alias("source"), F.col("_reason").alias("reason"), *ORDER_COLS,
        F.to_json(F.struct(*[F.col(c) for c in record])).alias("record"))
    return good, bad


def clean_meta(raw: DataFrame, load_ts: _dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """TAB-1 typing: strip text, +8 h timestamp, currency flag, numbers."""
    columns = ["date", "timestamp_pst", "campaign_id", "campaign_name", "adset_id", "ad_id", "objective",
               "placement", "impressions", "clicks", "spend_usd", "currency", "conversions",
               "conversion_value_usd"]
    as_read = ["date", "impressions", "clicks", "spend_usd", "conversions", "conversion_value_usd",
               "campaign_id"]
    s = {c: F.col(c) for c in columns}
    text = {c: F.coalesce(s[c], F.lit("")) for c in columns}
    currency = F.upper(F.nullif(s["currency"], F.lit("")))
    values = {
        "date": s["date"].try_cast("date"),
        "timestamp_pst": s["timestamp_pst"],
        "timestamp_utc": D.shift_fixed_hours(s["timestamp_pst"]),
        "campaign_id": s["campaign_id"],
        "campaign_name": text["campaign_name"],
        "adset_id": text["adset_id"],
        "ad_id": text["ad_id"],
        "objective": text["objective"],
        "placement": text["placement"],
        "impressions": T.long_of(s["impressions"]),
        "clicks": T.long_of(s["clicks"]),
        "spend_amount": T.double_of(s["spend_usd"]),
        "original_currency": currency,
        "currency_missing": currency.isNull().cast("int"),
        "conversions": F.coalesce(T.double_of(s["conversions"]), F.lit(0.0)),
        "conversion_value_amount": F.coalesce(T.double_of(s["conversion_value_usd"]), F.lit(0.0)),
        "platform": F.lit("meta"),
        "_load_timestamp": D.ntz_lit(load_ts),
        "_bad_conversions": T.unparsed(s["conversions"], T.double_of(s["conversions"])),
        "_bad_value": T.unparsed(s["conversion_value_usd"], T.double_of(s["conversion_value_usd"])),
    }
    checks = [
        ("bad date", F.col("date").isNull()),
        ("missing campaign_id", F.col("campaign_id").isNull() | (F.col("campaign_id") == "")),
        ("bad impressions", F.col("impressions").isNull()),
        ("bad clicks", F.col("clicks").isNull()),
        ("bad spend", F.col("spend_amount").isNull()),
        ("number out of range", T.out_of_range("spend_amount") | T.out_of_range("conversions")
         | T.out_of_range("conversion_value_amount")),
        ("bad conversions", F.col("_bad_conversions")),
        ("bad conversion value", F.col("_bad_value")),
    ]
    return _split(_stripped(raw, columns, as_read), values, checks, "meta_ads",
                  [f"_raw_{c}" for c in as_read])


def clean_google(raw: DataFrame, load_ts: _dt.datetime | None = None
                 ) -> tuple[DataFrame, DataFrame]:
    """TAB-2 typing of the flattened JSON; corrupt lines are quarantined."""
    columns = ["date", "timestamp_utc", "campaign_id", "campaign_name", "advertising_channel_type",
               "impressions", "clicks", "cost_micros", "conversions", "conversions_value_micros"]
    s = {c: F.col(c) for c in columns}
    values = {
        "date": s["date"].try_cast("date"),
        **{c: F.coalesce(s[c], F.lit("")) if c != "campaign_id" else s[c] for c in columns[1:5]},
        **{c: T.double_of(s[c]) if c == "conversions" else T.long_of(s[c]) for c in columns[5:]},
        "platform": F.lit("google"),
        "_load_timestamp": D.ntz_lit(load_ts),
    }
    checks = [
        ("unparseable json", F.col("_raw__corrupt").isNotNull()),
        ("bad date", F.col("date").isNull()),
        ("missing campaign", F.col("campaign_id").isNull()),
        ("bad metrics", F.col("impressions").isNull() | F.col("clicks").isNull()
         | F.col("cost_micros").isNull() | F.col("conversions").isNull()
         | F.col("conversions_value_micros").isNull()),
        ("number out of range", T.out_of_range("conversions")),
    ]
    return _split(_stripped(raw, columns, ["_corrupt", "date"]), values, checks, "google_ads",
                  ["_raw__corrupt", "_raw_date", "campaign_id"])


def dedup_google(clean: DataFrame) -> DataFrame:
    """AGG-11 on the Google export: one row per key; newest timestamp when
    the group's timestamps differ, else most impressions; then input order.
    A missing timestamp counts as the empty string (lowest)."""
    return best_record(clean, GOOGLE_KEY, ts="timestamp_utc", size="impressions",
                       ordinal=ORDER_COLS, drop_ordinal=False)


def clean_store_visits(raw: DataFrame, load_ts: _dt.datetime | None = None
                       ) -> tuple[DataFrame, DataFrame]:
    """TAB-3 typing."""
    columns = ["date", "dma_code", "dma_name", "attributed_visits", "attribution_window_days"]
    values = {
        "date": F.col("date").try_cast("date"),
        "dma_code": F.col("dma_code"),
        "dma_name": F.col("dma_name"),
        "attributed_visits": T.long_of(F.col("attributed_visits")),
        "attribution_window_days": T.long_of(F.col("attribution_window_days")),
        "_load_timestamp": D.ntz_lit(load_ts),
    }
    checks = [("bad date", F.col("date").isNull()),
              ("missing dma_code", F.col("dma_code").isNull() | (F.col("dma_code") == "")),
              ("bad visits", F.col("attributed_visits").isNull()),
              ("bad window", F.col("attribution_window_days").isNull())]
    return _split(_stripped(raw, columns, ["date", "attributed_visits"]), values, checks, "store_visits",
                  ["_raw_date", "dma_code", "_raw_attributed_visits"])


def clean_campaign_metadata(raw: DataFrame, load_ts: _dt.datetime | None = None
                            ) -> tuple[DataFrame, DataFrame]:
    """TAB-4 typing: budget may be missing (flagged), not malformed."""
    columns = ["campaign_id", "brand", "product_line", "region", "campaign_start_date",
               "campaign_end_date", "budget_usd"]
    budget = T.double_of(F.col("budget_usd"))
    values = {
        **{c: F.col(c) for c in columns[:4]},
        **{c: F.col(c).try_cast("date") for c in columns[4:6]},
        "budget_usd": budget,
        "budget_available": budget.isNotNull().cast("int"),
        "_load_timestamp": D.ntz_lit(load_ts),
        "_bad_budget": T.unparsed(F.col("budget_usd"), budget),
    }
    checks = [("missing campaign_id", F.col("campaign_id").isNull() | (F.col("campaign_id") == "")),
              ("bad budget", F.col("_bad_budget")),
              ("number out of range", T.out_of_range("budget_usd"))]
    return _split(_stripped(raw, columns, ["budget_usd"]), values, checks, "campaign_metadata",
                  ["campaign_id", "_raw_budget_usd"])
