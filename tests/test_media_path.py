"""Files in, gold tables and reports out: the cases that single operators don't show."""

import csv
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from fixtures import METADATA_HEADER, METADATA_ROWS, VISITS_HEADER, VISITS_ROWS
from spendlens.plans import pipeline
from spendlens.plans import quality as Q
from spendlens.plans import reports as R
from spendlens.sources import files as SRC
from spendlens.sources.store import TableStore

HEADER = ["currency", "clicks", "impressions", "campaign_name", "date", "timestamp_pst",
          "campaign_id", "adset_id", "ad_id", "objective", "placement", "spend_usd",
          "conversions", "conversion_value_usd", "a column nobody asked for"]


def meta(name="N", spend="100.00", ad="a1", day="2026-03-02", campaign="1001"):
    return ["USD", "5", "1000", name, day, f"{day} 10:00:00", campaign, "s", ad, "o", "p", spend,
            "0.00004", "7", "x"]


def write(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def google(day, name, ts=None):
    rec = {"date": day, "campaign": {"id": 1002, "name": name, "advertising_channel_type": "S"},
           "metrics": {"impressions": 10, "clicks": 1, "cost_micros": 2_500_000, "conversions": 1,
                       "conversions_value_micros": 9_000_000}}
    return json.dumps(rec | ({"timestamp_utc": ts} if ts else {}))


META = [meta('Big "Sale", East'), meta("two\nlines", ad="a2"), meta("", ad="a3"),
        meta(spend="1e30", ad="a4"), meta(spend="NaN", ad="a5"), meta(ad="a6", day="2027-03-01")]


@pytest.fixture(scope="module")
def story(spark, tmp_path_factory):
    """Google alone (no timestamp); then Meta, visits and metadata; then restated files."""
    base = tmp_path_factory.mktemp("media path")
    raw, tables = str(base / "the landing + files"), str(base / "tables")
    os.makedirs(raw)
    day = lambda n: dt.datetime(2026, 8, n, 6)
    with open(f"{raw}/google_ads_daily.json", "w") as f:
        f.write("\n".join([google("2026-03-02", "G1"), google("2026-03-03", "G2", "2026-03-03T04:05:06Z")]))
    results = [pipeline.run(spark, raw, tables, day(1), multiline=("meta_ads",))]
    write(f"{raw}/meta_ads_daily.csv", HEADER, META)
    write(f"{raw}/store_visits.csv", VISITS_HEADER, VISITS_ROWS)
    write(f"{raw}/campaign_metadata.csv", METADATA_HEADER, METADATA_ROWS)
    write(f"{raw}/store_visits_backup.csv", VISITS_HEADER, VISITS_ROWS)
    results.append(pipeline.run(spark, raw, tables, day(2), multiline=("meta_ads",)))
    write(f"{raw}/meta_ads_daily.csv", HEADER, [r[:11] + ["999.99"] + r[12:] if r[11] == "100.00" else r
                                                for r in META])
    write(f"{raw}/meta_ads_2.csv", HEADER, [meta("Renamed")])
    results.append(pipeline.run(spark, raw, tables, day(3), multiline=("meta_ads",)))
    return TableStore(spark, tables), results, raw


def test_google_without_timestamp_and_meta_share_one_table(story):
    store, _, _ = story
    perf = store.read("stg_daily_performance")
    assert dict(perf.dtypes)["timestamp_utc"] == "timestamp_ntz"
    got = {(r.platform, r.campaign_name): r.timestamp_utc for r in perf.collect()}
    assert got["google", "G1"] is None
    assert got["google", "G2"] == dt.datetime(2026, 3, 3, 4, 5, 6)
    assert got["meta", "Renamed"] == dt.datetime(2026, 3, 2, 18)


def test_columns_go_by_name_and_quotes_are_read(story):
    store, _, _ = story
    rows = {r.ad_id: r for r in store.read("raw_meta_ads").where("campaign_name != 'Renamed'").collect()}
    assert (rows["a1"].impressions, rows["a1"].clicks) == (1000, 5)
    assert rows["a1"].campaign_name == 'Big "Sale", East' and rows["a2"].campaign_name == "two\nlines"


def test_first_values_stay_also_under_empty_keys(story):
    store, results, _ = story
    assert results[1].loads["meta_ads"] == {"status": "success", "inserted": 4, "skipped": 0, "files": 1}
    assert results[2].loads["meta_ads"] == {"status": "success", "inserted": 1, "skipped": 4, "files": 2}
    spend = {r.ad_id: r.spend_amount for r in store.read("raw_meta_ads").collect()}
    assert spend["a3"] == 100.0


def test_bad_numbers_are_quarantined_once(story):
    store, _, _ = story
    reasons = [r.reason for r in store.read("_quarantine").where("source = 'meta_ads'").collect()]
    assert reasons == ["number out of range"] * 2


def test_overwritten_names_keep_their_history(story):
    store, _, _ = story
    names = {r.campaign_name for r in store.read("log_campaign_name_changes").collect()}
    assert {'Big "Sale", East', "Renamed", "two\nlines", "G1", "G2"} <= names


def test_run_checks(story, spark):
    store, results, raw = story
    assert results[2].checks["outside_calendar"] == 1 and results[2].unmatched_files == 1
    assert results[2].checks["watermarks"]["newest_timestamp"] == dt.datetime(2026, 8, 3, 6)
    health = Q.pipeline_health(store.read("_pipeline_tracking"), store.read("_ingestion_log"),
                               SRC.list_files(spark, raw), ["meta_ads_daily.csv", "store_visits.csv"],
                               as_of=dt.datetime(2026, 8, 3, 6), stall_hours=100)
    assert health.count() == 0


def test_reports_run_on_the_stored_tables(story):
    store, _, _ = story
    fact, dim, days = (store.read(t) for t in ("fact_daily_performance", "dim_campaign", "dim_date"))
    visits, md = store.read("fact_store_visits"), store.read("raw_campaign_metadata")
    reports = [R.blended_cpa(fact, dim, days), R.cpa_by_month(fact, dim, days),
               R.spend_by_month(fact, days), R.spend_cpa_by_year_month(fact, days), R.weekly_spend(fact),
               R.wow_growth(fact, dim), R.spend_vs_visits(fact, dim, visits),
               R.spend_vs_visits_fanout(fact, dim, visits),
               R.spend_vs_visits_region_fanout(fact, dim, visits), R.budget_compliance(fact, dim, md),
               R.over_budget_only(fact, dim, md), R.budget_known_only(fact, dim, md),
               R.budget_peer_average(fact, md), R.roi_by_product_line(fact, dim), R.roi_by_platform(fact),
               R.roi_by_campaign(fact, dim), R.kpi_overview(fact, dim), R.platform_share(fact),
               R.top_campaigns(fact, dim), R.visit_summary(fact, dim, visits),
               R.budget_status_counts(fact, dim, md), R.product_line_share(fact, dim),
               R.campaign_cpa_vs_average(fact, dim)]
    for df in reports:
        df.collect()
    cpa = {(r.brand, r.month): r.total_conversions for r in reports[0].collect()}
    assert cpa["Northwind", 3] == 2.0  # two of Google; Meta's 0.00004 are there, below the cent
    assert fact.where("platform = 'meta'").agg(F.sum("conversions")).first()[0] == pytest.approx(0.00016)


def test_growth_report_reads_the_last_months_only(story):
    store, _, _ = story
    plan = R.wow_growth(store.read("fact_daily_performance"), store.read("dim_campaign"))
    text = plan._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_month" in text


def test_load_plan_has_no_path_list_and_no_cache(spark, story):
    _, _, raw = story
    good, _ = pipeline._read_clean(spark, "store_visits", [f"{raw}/store_visits.csv"], None)
    plan = good._jdf.queryExecution().toString()
    assert "array_position" not in plan and "InMemoryRelation" not in plan


def test_interrupted_replacement_is_mended(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    store.overwrite("dim", spark.createDataFrame([(1,)], "a int"))
    new = spark.createDataFrame([(2,)], "a int")
    new.write.parquet(store._aside("dim", "staged"))  # whole, not yet swapped in
    assert [r.a for r in store.read("dim").collect()] == [1]
    os.makedirs(store.root + "/_replaced", exist_ok=True)
    os.rename(store.path("dim"), store._aside("dim", "replaced"))  # the run dies here
    assert [r.a for r in store.read("dim").collect()] == [2]
    with pytest.raises(TypeError, match="dim.a is int"):
        store.append("dim", spark.createDataFrame([("x",)], "a string"))


def test_files_with_differing_headers_load_in_one_pass(spark, tmp_path):
    folder = tmp_path / "store_visits.csv"
    os.makedirs(folder)
    write(str(folder / "part-0.csv"), VISITS_HEADER, VISITS_ROWS[:2])
    write(str(folder / "part-1.csv"), VISITS_HEADER[::-1], [r[::-1] for r in VISITS_ROWS[:2]])
    write(str(folder / "part-2.csv"), ["x", *VISITS_HEADER[:3]], [["x", *r[:3]] for r in VISITS_ROWS[:2]])
    with open(folder / "part-3.csv", "w", encoding="utf-8-sig", newline="") as f:
        f.write(" date ,dma_code\r\n\r\n2026-01-01,\"5\"\"0,1\"\r\n2026-01-02\r\n")
    open(folder / "part-4.csv", "w").close()
    paths = [str(folder / f"part-{i}.csv") for i in range(5)]
    df = SRC.read_csv_strings(spark, paths, SRC.VISITS_COLUMNS)
    got = sorted(map(tuple, df.drop(*SRC.ORDER_COLS).collect()), key=str)
    rows = [tuple(r) for r in VISITS_ROWS[:2]]
    want = rows * 2 + [(*r[:3], None, None) for r in rows]
    want += [("2026-01-01", '5"0,1', None, None, None), ("2026-01-02", None, None, None, None)]
    assert got == sorted(want, key=str)


def test_lines_are_cut_by_their_own_header_and_not_shuffled(spark, tmp_path):
    for n in range(1, 12):  # more widths than are cut separately
        names = [f"x{i}" for i in range(n - 1)] + ["dma_code"]
        lines = [",".join(names), ",".join(str(i) for i in range(n)), ",".join(map(str, range(n + 3))),
                 '"a,b"' + "," * (n - 1) + f'"c""{n}', "short"]
        (tmp_path / f"store_visits_{n}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    paths = [str(p) for p in tmp_path.iterdir()]
    df = SRC.read_csv_strings(spark, paths, ["dma_code", "x0"])
    got = {}
    for r in df.orderBy("_source_file", "_row").collect():
        n = int(r["_source_file"].split("_")[-1].split(".")[0])
        got.setdefault(n, []).append((r["dma_code"], r["x0"]))
    for n, rows in got.items():
        none = n == 1
        assert rows[:2] == [(str(n - 1), None if none else "0")] * 2, n
        assert rows[3] == (("short", None) if none else (None, "short")), n
        if n > 1:
            assert rows[2][1] == "a,b", n
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(got) == 11 and "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_the_unified_write_leaves_unread_columns_behind(spark):
    from spendlens.plans.queries_media import q_unified_from_landing

    df = q_unified_from_landing(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "timestamp_pst, timestamp_pst#" not in plan.split("Generate")[0]


def test_jobs_of_a_read_do_not_grow_with_the_files(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()

    def jobs(n):
        folder = tmp_path / f"f{n}"
        os.makedirs(folder)
        paths = []
        for i in range(n):
            paths.append(str(folder / f"store_visits_{i}.csv"))
            write(paths[-1], VISITS_HEADER, VISITS_ROWS)
        spark.sparkContext.setJobGroup(f"files-{n}", "")
        assert SRC.read_csv_strings(spark, paths, SRC.VISITS_COLUMNS).count() == n * len(VISITS_ROWS)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(f"files-{n}"))

    assert jobs(20) <= jobs(2) + 1
