"""End-to-end pipeline on fixture files: bronze -> silver -> gold, re-runs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fixtures import META_HEADER, META_ROWS, VISITS_ROWS, write_landing
from spendlens.plans import pipeline
from spendlens.sources.store import TableStore

RUN1 = dt.datetime(2026, 8, 1, 6, 0, 0)
RUN2 = dt.datetime(2026, 8, 2, 6, 0, 0)
RUN3 = dt.datetime(2026, 8, 3, 6, 0, 0)


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipe")
    raw = write_landing(str(base / "landing"))
    tables = str(base / "tables")
    res = pipeline.run(spark, raw, tables, RUN1)
    return spark, raw, tables, res


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_bronze_counts_and_quarantine(first_run):
    spark, raw, tables, res = first_run
    st = TableStore(spark, tables)
    # 13 meta rows: 1 quarantined, 1 exact key duplicate skipped
    assert res.loads["meta_ads"] == {"status": "success", "inserted": 11, "skipped": 1, "files": 1}
    q = st.read("_quarantine")
    reasons = rows(q, "source", "reason")
    assert ("meta_ads", "bad impressions") in reasons
    assert ("google_ads", "unparseable json") in reasons
    assert ("google_ads", "bad metrics") in reasons
    assert ("campaign_metadata", "bad budget") in reasons
    assert sum(1 for s, _ in reasons if s == "google_ads") == 3


def test_meta_cleaning(first_run):
    spark, _, tables, _ = first_run
    m = TableStore(spark, tables).read("raw_meta_ads")
    by_ad = {r["ad_id"]: r for r in m.collect()}
    assert by_ad["ad2"]["original_currency"] == "CAD"
    assert by_ad["ad4"]["currency_missing"] == 1 and by_ad["ad4"]["original_currency"] is None
    assert by_ad["ad7"]["timestamp_utc"] == dt.datetime(2026, 6, 1, 20, 0, 0)
    assert by_ad["ad7"]["conversions"] == 0.0
    assert by_ad["ad8"]["timestamp_utc"] is None
    assert by_ad["ad8"]["campaign_name"] == "NW_App_East"
    assert [r[0].rsplit("/", 1)[-1] for r in m.select("_source_file").distinct().collect()] == [
        "meta_ads_daily.csv"]
    dup = [r for r in m.collect() if r["adset_id"] == "as9"]
    assert len(dup) == 1 and dup[0]["spend_amount"] == 11.0


def test_google_dedup(first_run):
    spark, _, tables, _ = first_run
    g = TableStore(spark, tables).read("raw_google_ads")
    by = {(r["campaign_id"], str(r["date"])): r for r in g.collect()}
    assert by[("7", "2026-02-03")]["impressions"] == 100          # numeric id read as text
    assert by[("13", "2026-02-04")]["impressions"] == 6           # "6.0"
    assert by[("9", "2026-02-05")]["impressions"] == 100          # newest timestamp
    assert by[("9", "2026-02-05")]["duplicate_count"] == 2
    assert by[("10", "2026-02-06")]["impressions"] == 300         # equal ts -> max impressions
    assert by[("11", "2026-02-07")]["impressions"] == 20          # first of the newest
    assert by[("11", "2026-02-07")]["duplicate_count"] == 3
    assert by[("12", "2026-02-08")]["impressions"] == 40          # missing ts is lowest
    assert g.agg(F.sum("duplicate_count")).first()[0] == 11       # valid input rows


def test_silver_currency(first_run):
    spark, _, tables, _ = first_run
    s = TableStore(spark, tables).read("stg_meta_ads")
    by_ad = {r["ad_id"]: r for r in s.collect()}
    assert by_ad["ad2"]["spend_usd"] == 148.0
    assert by_ad["ad3"]["spend_usd"] in (381.64, 30.0)  # ad3 also used by the D2 pair
    assert by_ad["ad4"]["currency_used"] == "USD"
    assert by_ad["ad4"]["currency_conversion_note"] == "Assumed USD (missing in source)"
    assert by_ad["ad5"]["spend_usd"] == 70.0
    assert by_ad["ad5"]["currency_conversion_note"] == "Converted from EUR"
    assert by_ad["ad6"]["spend_usd"] == 80.0
    assert by_ad["ad1"]["currency_conversion_note"] == "USD (native)"
    # D2: two names on one silver key collapse to the later row
    d2 = [r for r in s.collect() if str(r["date"]) == "2026-04-02"]
    assert len(d2) == 1 and d2[0]["campaign_name"] == "New_Name"
    g = {r["campaign_id"]: r for r in TableStore(spark, tables).read("stg_google_ads").collect()}
    assert g["7"]["spend_usd"] == 2.5 and g["7"]["conversion_value_usd"] == 9.0


def test_gold(first_run):
    spark, _, tables, res = first_run
    st = TableStore(spark, tables)
    perf = st.read("stg_daily_performance")
    fact = st.read("fact_daily_performance")
    assert fact.count() == perf.count()
    assert perf.filter("platform = 'google'").count() == 6
    # zero fill: 5 days x 3 DMAs, 7 filled; the unmapped DMA drops out of the fact
    sv = st.read("stg_store_visits")
    assert sv.count() == 15 and sv.filter("is_zero_filled = 1").count() == 7
    fsv = st.read("fact_store_visits")
    assert fsv.count() == 10
    assert fsv.filter("dma_code = '999'").count() == 0
    assert st.read("dim_date").count() == 366
    assert st.read("dim_campaign").count() == 7
    assert res.checks["null_spend"] == 0 and res.checks["negative_spend"] == 0
    names = st.read("log_campaign_name_changes")
    from spendlens.operators.names import name_change_log
    full = name_change_log(st.read("stg_daily_performance"))
    cols = ["campaign_id", "campaign_name", "platform", "first_seen_date", "last_seen_date",
            "days_active", "is_current"]
    assert sorted(map(tuple, names.select(*cols).collect())) == \
        sorted(map(tuple, full.select(*cols).collect()))
    cur = names.filter("campaign_id = '1003' AND is_current = 1").collect()
    assert {r["campaign_name"] for r in cur} == {"New_Name"}


def test_rerun_is_idempotent(first_run, spark):
    _, raw, tables, _ = first_run
    st = TableStore(spark, tables)
    before = {t: st.read(t).count() for t in ("raw_meta_ads", "stg_daily_performance",
                                              "fact_daily_performance", "fact_store_visits")}
    res = pipeline.run(spark, raw, tables, RUN2)
    assert all(v["status"] == "unchanged" for v in res.loads.values())
    after = {t: st.read(t).count() for t in before}
    assert before == after
    log = st.read("_ingestion_log")
    assert log.count() == 4          # unchanged files write no log row


def test_changed_file_same_keys_and_late_visits(first_run, spark):
    _, raw, tables, _ = first_run
    st = TableStore(spark, tables)
    # same keys, restated values: loaded 0, all skipped (bronze keeps first value)
    restated = [r[:10] + ["999.99"] + r[11:] for r in META_ROWS]
    import csv
    with open(os.path.join(raw, "meta_ads_daily.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(META_HEADER)
        w.writerows(restated)
    # a late row for a formerly zero-filled day
    late = VISITS_ROWS + [["2026-01-04", "501", "New York", "130", "7"]]
    with open(os.path.join(raw, "store_visits.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["date", "dma_code", "dma_name", "attributed_visits",
                    "attribution_window_days"])
        w.writerows(late)
    res = pipeline.run(spark, raw, tables, RUN3)
    assert res.loads["meta_ads"]["status"] == "success"
    assert res.loads["meta_ads"]["inserted"] == 0
    assert res.loads["store_visits"]["inserted"] == 1
    fsv = st.read("fact_store_visits")
    r = fsv.filter("date = DATE'2026-01-04' AND dma_code = '501'").first()
    assert r["attributed_visits"] == 130 and r["is_zero_filled"] == 0
    assert fsv.count() == 10


def test_pipeline_health(first_run, spark):
    from spendlens.plans import quality as Q
    from spendlens.sources import files as SRC
    from spendlens.sources.store import INGESTION_LOG, LOG_SCHEMA, TRACKING, TRACKING_SCHEMA
    _, raw, tables, _ = first_run
    st = TableStore(spark, tables)
    listing = SRC.list_files(spark, raw)
    expected = list(SRC.SOURCE_FILES.values()) + ["extra_source.csv"]
    log = st.read_or_empty(INGESTION_LOG, LOG_SCHEMA)
    h = Q.pipeline_health(st.read_or_empty(TRACKING, TRACKING_SCHEMA), log, listing, expected,
                          as_of=dt.datetime(2026, 8, 10))
    got = rows(h, "rule", "subject")
    assert ("file_missing", "extra_source.csv") in got
    assert ("ingestion_gap", "extra_source.csv") in got
    assert any(r == "tracking_stalled" for r, _ in got)
    fresh = Q.pipeline_health(st.read_or_empty(TRACKING, TRACKING_SCHEMA), log, listing,
                              list(SRC.SOURCE_FILES.values()), as_of=RUN3, max_log_gap_days=3)
    assert [r for r in rows(fresh, "rule", "subject") if r[0] in ("file_missing", "ingestion_gap")] \
        == []


def test_failing_source_does_not_stop_the_run(spark, tmp_path, monkeypatch):
    raw = write_landing(str(tmp_path / "landing"))
    tables = str(tmp_path / "tables")
    real = pipeline._read_clean

    def flaky(spark_, source, *args):
        if source == "store_visits":
            raise OSError("simulated read failure")
        return real(spark_, source, *args)

    monkeypatch.setattr(pipeline, "_read_clean", flaky)
    with pytest.raises(pipeline.SourceFailed, match="simulated read failure") as failure:
        pipeline.run(spark, raw, tables, RUN1)
    res = failure.value.result
    assert res.loads["store_visits"]["status"] == "failed"
    assert res.loads["meta_ads"]["status"] == "success"
    st = TableStore(spark, tables)
    log = st.read("_ingestion_log")
    assert [r.error for r in log.filter("status = 'failed'").collect()] == [
        "OSError: simulated read failure"]
    assert st.read("fact_daily_performance").count() > 0
    # the failed file is retried by the next run
    monkeypatch.setattr(pipeline, "_read_clean", real)
    res2 = pipeline.run(spark, raw, tables, RUN2)
    assert res2.loads["store_visits"]["status"] == "success"
    assert st.read("fact_store_visits").count() == 10


def test_pipeline_is_zone_independent(spark, tmp_path):
    raw = write_landing(str(tmp_path / "landing"))
    tables = str(tmp_path / "tables")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        pipeline.run(spark, raw, tables, RUN1)
        st = TableStore(spark, tables)
        m = {r["ad_id"]: r for r in st.read("raw_meta_ads").collect()}
        assert m["ad7"]["timestamp_utc"] == dt.datetime(2026, 6, 1, 20, 0, 0)
        assert m["ad7"]["_load_timestamp"] == RUN1
        assert st.read("fact_store_visits").count() == 10
        res = pipeline.run(spark, raw, tables, RUN2)
        assert all(v["status"] == "unchanged" for v in res.loads.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
