"""End-to-end batch run: landing files -> bronze -> silver -> gold.

``run(spark, raw_dir, table_dir)`` is the Spark counterpart of the source
system's pipeline.  It is incremental:

* a landing file is re-read only when its size or modification time differs
  from its last successful ingestion (SNK-4); unchanged files write no log row;
* bronze tables take new keys only (insert-or-ignore, SNK-1);
* every silver/gold table keeps a high-water mark on ``_load_timestamp`` and
  upserts only rows past it (SNK-2, SNK-5), touching only the month
  partitions present in the batch.

Rows never travel to the driver: only watermarks (one scalar per table), the months a batch touches (used as
partition filters) and the changed files' paths do.  A source that fails is logged
as ``failed`` and retried by the next run; the other sources proceed, and the run
raises ``SourceFailed`` at its end.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.functions import dates as D

from spendlens.operators import watermark as WM
from spendlens.operators.fill import grid_state, zero_fill_delta
from spendlens.operators.merge import insert_ignore
from spendlens.operators.names import name_log_from_months, name_month_summary
from spendlens.plans import bronze as BR
from spendlens.plans import gold as G
from spendlens.plans import quality as Q
from spendlens.plans import silver as S
from spendlens.sources import files as SRC
from spendlens.sources import reference as REF
from spendlens.sources.store import (INGESTION_LOG, QUARANTINE, TRACKING, TableStore,
                                     changed_files, now_utc, touched_values)

MONTH = "_month"  # not "month": the calendar has one, and reports join it


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.date_trunc("month", "date").cast("date"))


@dataclass
class RunResult:
    run_ts: _dt.datetime
    loads: dict = field(default_factory=dict)        # source -> {inserted, skipped, status}
    unmatched_files: int = 0                         # landing files that belong to no source
    checks: dict = field(default_factory=dict)


BRONZE = {
    "meta_ads": ("raw_meta_ads", BR.META_KEY),
    "google_ads": ("raw_google_ads", BR.GOOGLE_KEY),
    "store_visits": ("raw_store_visits", BR.VISITS_KEY),
    "campaign_metadata": ("raw_campaign_metadata", BR.METADATA_KEY),
}


class SourceFailed(RuntimeError):
    """Raised at the end of a run in which sources failed; ``result`` has them all."""

    def __init__(self, result: RunResult):
        self.result = result
        failed = {s: v["error"] for s, v in result.loads.items() if v.get("status") == "failed"}
        super().__init__("; ".join(f"{s}: {e}" for s, e in failed.items()))


CSV_SOURCES = {
    "meta_ads": (SRC.META_COLUMNS, BR.clean_meta),
    "store_visits": (SRC.VISITS_COLUMNS, BR.clean_store_visits),
    "campaign_metadata": (SRC.METADATA_COLUMNS, BR.clean_campaign_metadata),
}


def type_rows(source: str, raw: DataFrame, run_ts) -> tuple[DataFrame, DataFrame]:
    """Type a source's raw rows: (good, quarantine)."""
    if source == "google_ads":
        good, bad = BR.clean_google(raw, run_ts)
        return BR.dedup_google(good), bad
    return CSV_SOURCES[source][1](raw, run_ts)


def _read_clean(spark: SparkSession, source: str, paths: list[str], run_ts,
                multiline: bool = False):
    """Parse and type the changed files of a source: (good, quarantine)."""
    raw = (SRC.flatten_google(SRC.read_json_lines(spark, paths)) if source == "google_ads" else
           SRC.read_csv_strings(spark, paths, CSV_SOURCES[source][0], multiline))
    return type_rows(source, raw, run_ts)


def store_rows(store: TableStore, source: str, table: str, keys, good: DataFrame, bad: DataFrame,
               todo: DataFrame, run_ts, result, mode: str = "ignore") -> DataFrame:
    """Quarantine and insert-or-ignore the typed rows of the files in ``todo`` (path,
    file_size_bytes, file_modified_time); returns their ingestion-log rows, one per file.

    ``mode='replace'`` lets a changed file's rows replace the stored ones of the same
    keys (D8); the default keeps the first values."""
    dated = "date" in keys
    if dated:
        good = _with_month(good)
    # typed once, as a table of the shared folder; read by the steps below
    staged = good.checkpoint(eager=True)
    existing = store.read(table)
    per_file = staged.groupBy("_source_file").agg(F.count(F.lit(1)).alias("n"))
    # only the months this batch touches can hold its keys; filtering the partition column
    # on them prunes the scans of the stored table to those directories
    months = touched_values(staged, MONTH) if dated else []
    if mode == "replace":
        store.upsert(table, staged, keys, ["_load_timestamp", *SRC.ORDER_COLS],
                     MONTH if dated else None)
        stored = per_file.withColumnRenamed("n", "new")
    else:
        if dated and existing is not None:
            existing = existing.filter(F.col(MONTH).isin(months))
        store.append(table, insert_ignore(existing, staged, keys, SRC.ORDER_COLS, prefilter=True),
                     partition_by=[MONTH] if dated else ())
        written = store.read(table).filter(F.col("_load_timestamp") == D.ntz_lit(run_ts))
        if dated:
            written = written.filter(F.col(MONTH).isin(months))
        stored = written.groupBy("_source_file").agg(F.count(F.lit(1)).alias("new"))
    # after the load, and in place of what these files had there before
    store.replace_files(QUARANTINE, bad.withColumn("_load_timestamp", D.ntz_lit(run_ts)),
                        todo.select("path"), source)
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    new = F.coalesce("new", F.lit(0)).cast("bigint")
    per_file, stored = (x.withColumn("path", SRC.listed_path(F.col("_source_file")))
                        .drop("_source_file") for x in (per_file, stored))
    counts = (todo.join(per_file, "path", "left").join(stored, "path", "left")
              .select(F.col("path").alias("source_file"), D.ntz_lit(run_ts).alias("ingested_at"),
                      "file_size_bytes", "file_modified_time", new.alias("records_loaded"),
                      (n - new).alias("records_skipped"), F.lit("success").alias("status"),
                      F.lit(None).cast("string").alias("error"))).checkpoint(eager=True)
    sums = counts.agg(F.sum("records_loaded").alias("i"), F.sum("records_skipped").alias("s"),
                      F.count(F.lit(1)).alias("f")).first()
    result.loads[source] = {"status": "success", "inserted": sums["i"], "skipped": sums["s"],
                            "files": sums["f"]}
    return counts


def _load_source(spark, store, source, table, keys, todo: DataFrame, run_ts, result,
                 mode: str = "ignore", multiline: bool = False) -> DataFrame:
    """Type and store the changed files of one source; returns its ingestion-log rows."""
    paths = [r["path"] for r in todo.select("path").collect()]  # of this run's changed files
    good, bad = _read_clean(spark, source, paths, run_ts, multiline)
    return store_rows(store, source, table, keys, good, bad, todo, run_ts, result, mode)


def load_bronze(spark: SparkSession, store: TableStore, raw_dir: str, run_ts,
                result: RunResult, mode: str = "ignore", multiline: tuple[str, ...] = ()) -> None:
    """Extract + transform + keyed load of the landing files that changed.

    All changed files of a source are read in one job; the paths of the changed files
    are the only rows that reach the driver, as Spark's readers take them from there."""
    listing = SRC.list_files(spark, raw_dir).checkpoint(eager=True)
    changed = changed_files(listing.filter(F.col("source").isNotNull()),
                            store.last_success()).checkpoint(eager=True)
    present = {r["source"]: r["n"] for r in
               listing.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    todo_of = {r["source"]: r["n"] for r in
               changed.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    result.unmatched_files = present.get(None, 0)
    for source in SRC.SOURCE_SUFFIX:
        table, keys = BRONZE[source]
        if source not in present:
            result.loads[source] = {"status": "missing"}
            continue
        if source not in todo_of:
            result.loads[source] = {"status": "unchanged", "inserted": 0}
            continue
        todo = changed.filter(F.col("source") == source)
        try:
            log = _load_source(spark, store, source, table, keys, todo, run_ts, result, mode,
                               source in multiline)
        except Exception as e:  # noqa: BLE001 -- SRC-6: the others go on; run() raises at the end
            error = f"{type(e).__name__}: {e}"
            result.loads[source] = {"status": "failed", "error": error}
            zero = F.lit(0).cast("bigint")
            log = todo.select(F.col("path").alias("source_file"),
                              D.ntz_lit(run_ts).alias("ingested_at"), "file_size_bytes",
                              "file_modified_time", zero.alias("records_loaded"),
                              zero.alias("records_skipped"), F.lit("failed").alias("status"),
                              F.lit(error).alias("error"))
        store.append(INGESTION_LOG, log)


class Watermarks:
    """The run's view of ``_pipeline_tracking``: read once, updated in
    memory, persisted at the end of each layer.  Persisting late only means a
    crashed run re-processes a batch, which the keyed upserts absorb."""

    def __init__(self, store: TableStore):
        self.store = store
        t = store.read(TRACKING)
        # one row per tracked table
        self.values = {} if t is None else {
            r["table_name"]: r["last_processed_load_timestamp"] for r in t.collect()}
        self.dirty: dict = {}

    def get(self, table: str):
        return self.values.get(table)

    def advance(self, table: str, value) -> None:
        if value is None:
            return
        prev = self.values.get(table)
        if prev is None or value > prev:
            self.values[table] = value
            self.dirty[table] = value

    def persist(self) -> None:
        if self.dirty:
            self.store.write_watermarks(self.values)
            self.dirty = {}


def _batch(store: TableStore, wm: Watermarks, source: str, target: str, inclusive: bool):
    """Rows of ``source`` past ``target``'s watermark and the largest load
    time among them (one aggregate over the pushed-down filter).  ``None``
    when nothing is newer than the watermark (an inclusive filter alone would
    re-read the last batch)."""
    df = store.read(source)
    if df is None:
        return None
    mark = wm.get(target)
    batch = WM.since(df, mark, "_load_timestamp", inclusive=inclusive)
    hi = batch.agg(F.max("_load_timestamp")).first()[0]
    if hi is None or (mark is not None and hi <= mark):
        return None
    return batch, hi


def _refresh_name_log(store: TableStore, batch: DataFrame) -> None:
    """TAB-19, incrementally: the name summaries of the months this batch touched are
    recomputed from those partitions of the unified table and upserted by name, so that
    a name that a later file overwrote keeps its history; the log is folded from the
    summaries (one row per campaign/name/platform/month, far smaller than the fact)."""
    months = touched_values(_with_month(batch), MONTH)
    perf = store.read("stg_daily_performance").filter(F.col(MONTH).isin(months))
    store.upsert("log_name_months", name_month_summary(perf, MONTH),
                 ["campaign_id", "campaign_name", "platform", MONTH], (), MONTH)
    store.overwrite("log_campaign_name_changes",
                    name_log_from_months(store.read("log_name_months")))


def _refresh_visit_grid(store: TableStore, batch: DataFrame, run_ts) -> None:
    """TAB-13: the staged grid of visits.  Its state (a row per DMA) is kept, so that a batch
    writes the days, DMAs and gaps it changes, and only their months are rewritten."""
    raw = store.read("raw_store_visits").drop(*SRC.ORDER_COLS)
    state = store.read("_visit_grid")
    if state is None:
        store.overwrite("stg_store_visits", _with_month(S.build_stg_store_visits(raw, run_ts)), [MONTH])
        store.overwrite("_visit_grid", grid_state(raw))
        return
    rows, new_state = zero_fill_delta(state, batch, raw, carry=("_load_timestamp",), run_ts=run_ts)
    rows = _with_month(rows.withColumn("_staged_timestamp", D.ntz_lit(run_ts)))
    store.upsert("stg_store_visits", rows, S.VISITS_KEY, ["_load_timestamp"], MONTH)
    # last: a run that dies before works the same rows out again
    store.overwrite("_visit_grid", new_state)


def _write_once(store: TableStore, name: str, df: DataFrame) -> None:
    """Fixed reference tables are written when absent."""
    if store.read(name) is None:
        store.overwrite(name, df)


def build_silver(spark: SparkSession, store: TableStore, run_ts, wm: Watermarks,
                 calendar: tuple[_dt.date, _dt.date] = (REF.CALENDAR_START, REF.CALENDAR_END)
                 ) -> None:
    _write_once(store, "ref_calendar", REF.calendar(spark, *calendar))
    _write_once(store, "ref_exchange_rates", REF.exchange_rates(spark))
    _write_once(store, "ref_dma_region_map", REF.dma_region_map(spark))
    rates = store.read("ref_exchange_rates")
    order = ["_load_timestamp", *SRC.ORDER_COLS]

    step = _batch(store, wm, "raw_meta_ads", "stg_meta_ads", inclusive=True)
    if step:
        batch, hi = step
        stg = S.build_stg_meta(batch, rates, run_ts, extra=SRC.ORDER_COLS, calendar=calendar)
        store.upsert("stg_meta_ads", _with_month(stg), S.META_KEY, order, MONTH)
        wm.advance("stg_meta_ads", hi)

    step = _batch(store, wm, "raw_google_ads", "stg_google_ads", inclusive=True)
    if step:
        batch, hi = step
        stg = S.build_stg_google(batch, run_ts, extra=SRC.ORDER_COLS)
        store.upsert("stg_google_ads", _with_month(stg), S.GOOGLE_KEY, order, MONTH)
        wm.advance("stg_google_ads", hi)

    meta = _batch(store, wm, "stg_meta_ads", "stg_daily_performance", inclusive=False)
    google = _batch(store, wm, "stg_google_ads", "stg_daily_performance", inclusive=False)
    if meta or google:
        perf = _unified_batch(meta[0] if meta else None, google[0] if google else None, run_ts)
        store.upsert("stg_daily_performance", _with_month(perf), S.PERF_KEY,
                     ["_platform_order", *order], MONTH)
        for st in (meta, google):
            if st:
                wm.advance("stg_daily_performance", st[1])
        _refresh_name_log(store, perf)

    step = _batch(store, wm, "raw_store_visits", "ref_dma_list", inclusive=False)
    if step:
        batch, hi = step
        _refresh_visit_grid(store, batch.drop(*SRC.ORDER_COLS), run_ts)
        store.upsert("ref_dma_list", S.build_ref_dma_list(batch), ["dma_code"])
        wm.advance("ref_dma_list", hi)

    step = _batch(store, wm, "raw_campaign_metadata", "ref_campaign_list", inclusive=False)
    if step:
        batch, hi = step
        store.upsert("ref_campaign_list", S.build_ref_campaign_list(batch), ["campaign_id"])
        wm.advance("ref_campaign_list", hi)
    wm.persist()


def _unified_batch(meta, google, run_ts) -> DataFrame:
    """Meta rows then Google rows in the unified shape (SET-2)."""
    keep = [*S.PERF_COLS, *SRC.ORDER_COLS, "_platform_order"]
    staged = D.ntz_lit(run_ts)
    parts = []
    if meta is not None:
        parts.append(meta.withColumn("_staged_timestamp", staged)
                     .withColumn("_platform_order", F.lit(0)).select(*keep))
    if google is not None:
        g = S.google_as_performance(google.withColumn("_staged_timestamp", staged),
                                    extra=SRC.ORDER_COLS)
        parts.append(g.withColumn("_platform_order", F.lit(1)).select(*keep))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_gold(spark: SparkSession, store: TableStore, run_ts, wm: Watermarks) -> None:
    step = _batch(store, wm, "raw_campaign_metadata", "dim_campaign", inclusive=False)
    cl = store.read("ref_campaign_list")
    if step and cl is not None:
        batch, hi = step
        scoped = cl.join(batch.select("campaign_id").distinct(), "campaign_id", "left_semi")
        store.upsert("dim_campaign", G.build_dim_campaign(scoped), ["campaign_id"])
        wm.advance("dim_campaign", hi)

    step = _batch(store, wm, "raw_store_visits", "dim_dma", inclusive=False)
    dl = store.read("ref_dma_list")
    if step and dl is not None:
        batch, hi = step
        store.upsert("dim_dma", G.build_dim_dma(dl, batch), ["dma_code"])
        wm.advance("dim_dma", hi)

    _write_once(store, "dim_date", store.read("ref_calendar"))

    step = _batch(store, wm, "stg_daily_performance", "fact_daily_performance", inclusive=False)
    if step:
        batch, hi = step
        fact = _with_month(G.build_fact_daily_performance(batch))
        store.upsert("fact_daily_performance", fact, G.FACT_PERF_KEY, (), MONTH)
        wm.advance("fact_daily_performance", hi)

    step = _batch(store, wm, "stg_store_visits", "fact_store_visits", inclusive=False)
    if step:
        batch, hi = step
        fsv = G.build_fact_store_visits(batch, store.read("ref_dma_region_map"))
        store.upsert("fact_store_visits", _with_month(fsv), G.FACT_VISITS_KEY, (), MONTH)
        wm.advance("fact_store_visits", hi)
    wm.persist()


def validate(store: TableStore) -> dict:
    """In-run checks: row counts and null/negative spend in the fact."""
    names = ["raw_meta_ads", "raw_google_ads", "raw_store_visits", "raw_campaign_metadata",
             "ref_calendar", "ref_exchange_rates", "ref_dma_list", "ref_campaign_list",
             "ref_dma_region_map", "stg_meta_ads", "stg_google_ads", "stg_daily_performance",
             "stg_store_visits", "dim_campaign", "dim_dma", "dim_date",
             "fact_daily_performance", "fact_store_visits", "log_campaign_name_changes"]
    present = {n: df for n in names if (df := store.read(n)) is not None}
    counts = {r["table_name"]: r["row_count"] for r in Q.table_counts(present).collect()}
    out = {"row_counts": counts}
    fact = present.get("fact_daily_performance")
    if fact is not None:
        r = fact.agg(F.count_if(F.col("spend_usd").isNull()).alias("null_spend"),
                     F.count_if(F.col("spend_usd") < 0).alias("negative_spend")).first()
        out["null_spend"], out["negative_spend"] = r["null_spend"], r["negative_spend"]
        if "dim_date" in present:
            out["outside_calendar"] = Q.outside_calendar(fact, present["dim_date"]).first()[
                "outside_calendar"]
    tracking = store.read(TRACKING)
    if tracking is not None:
        out["watermarks"] = Q.watermark_summary(tracking).first().asDict()
    return out


def run(spark: SparkSession, raw_dir: str, table_dir: str,
        run_ts: _dt.datetime | None = None, *, mode: str = "ignore",
        multiline: tuple[str, ...] = (),
        calendar: tuple[_dt.date, _dt.date] = (REF.CALENDAR_START, REF.CALENDAR_END),
        strict_rates: bool = False, raise_on_failure: bool = True) -> RunResult:
    """One incremental run.

    ``mode``: 'ignore' keeps the first values of a bronze key, 'replace' the latest file's
    (D8).  ``multiline``: CSV sources whose values may hold line ends.  ``calendar``:
    first and last day of the calendar (of a new store) and of the rates' validity; fact
    rows outside it are counted in ``checks['outside_calendar']``.  ``strict_rates``:
    fail if a Meta row's currency has no rate for its month (D4).  Sources that fail do
    not stop the others; ``SourceFailed`` is raised at the end unless told otherwise."""
    if mode not in ("ignore", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    run_ts = run_ts or now_utc()
    store = TableStore(spark, table_dir)
    result = RunResult(run_ts)
    load_bronze(spark, store, raw_dir, run_ts, result, mode, multiline)
    meta = store.read("raw_meta_ads") if strict_rates else None
    if meta is not None:
        lacking = Q.missing_fx_rates(S.convert_currency(
            meta, REF.exchange_rates(spark), amount_cols={"spend_usd": "spend_amount"},
            calendar=calendar))
        rows = lacking.limit(5).collect()  # for the message only
        if rows:
            raise ValueError(f"no exchange rate for {[tuple(r) for r in rows]}")
    wm = Watermarks(store)
    build_silver(spark, store, run_ts, wm, calendar)
    build_gold(spark, store, run_ts, wm)
    result.checks = validate(store)
    if raise_on_failure and any(v["status"] == "failed" for v in result.loads.values()):
        raise SourceFailed(result)
    return result
