"""STR-1: landing folder ingested once per file with availableNow."""

import csv
import os

from fixtures import META_HEADER, META_ROWS
from spendlens.sources.store import TableStore
from spendlens.streaming.landing import ingest_available


def _write(path, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(META_HEADER)
        w.writerows(rows)


def test_available_now_picks_up_new_files_once(spark, workdir):
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    store = TableStore(spark, os.path.join(workdir, "tables"))
    _write(os.path.join(landing, "meta_ads_1.csv"), META_ROWS[:6])
    ingest_available(spark, landing, store, "meta_ads")
    assert store.read("raw_meta_ads").count() == 6
    ingest_available(spark, landing, store, "meta_ads")          # nothing new
    assert store.read("raw_meta_ads").count() == 6
    # a new file with 2 new keys and 1 key already loaded
    _write(os.path.join(landing, "meta_ads_2.csv"), META_ROWS[6:8] + META_ROWS[:1])
    ingest_available(spark, landing, store, "meta_ads")
    assert store.read("raw_meta_ads").count() == 8


def test_stream_then_build_matches_batch(spark, workdir):
    from fixtures import write_landing
    from spendlens.plans import pipeline
    from spendlens.streaming.landing import ingest_and_build

    landing = write_landing(os.path.join(workdir, "landing2"))
    streamed = TableStore(spark, os.path.join(workdir, "streamed"))
    ingest_and_build(spark, landing, streamed.root)
    batch_root = os.path.join(workdir, "batch")
    pipeline.run(spark, landing, batch_root)
    batch = TableStore(spark, batch_root)
    for t in ("fact_daily_performance", "fact_store_visits", "dim_campaign"):
        cols = [c for c in batch.read(t).columns if c not in ("month",)]
        a = sorted(map(tuple, batch.read(t).select(*cols).collect()), key=repr)
        b = sorted(map(tuple, streamed.read(t).select(*cols).collect()), key=repr)
        assert a == b, t


def test_odd_files_stream_as_they_load_in_batch(spark, workdir):
    """Swapped columns, quoted quotes and commas, a file of another name, a folder of part
    files: rows, quarantine and log are the batch path's."""
    from spendlens.plans import pipeline
    from spendlens.streaming.landing import ingest_and_build

    landing = os.path.join(workdir, "odd")
    os.makedirs(os.path.join(landing, "meta_ads_7.csv"))
    named = [list(r) for r in META_ROWS[:6]]
    for r in named:
        r[3] = f'Big "{r[3]}", sale'
    swap = list(META_HEADER)
    a, b = swap.index("impressions"), swap.index("clicks")
    swap[a], swap[b] = swap[b], swap[a]

    def write(name, header, rows):
        with open(os.path.join(landing, name), "w", newline="") as f:
            w = csv.writer(f)
            w.writerow(header)
            for r in rows:
                w.writerow([r[META_HEADER.index(c)] if c in META_HEADER else "?" for c in header])

    write("meta_ads_1.csv", swap, named[:3])
    write("meta_ads_7.csv/part-0.csv", [*META_HEADER, "extra"], named[3:5])
    write("meta_ads_7.csv/part-1.csv", swap[::-1], [*named[5:], *META_ROWS[8:9]])
    write("meta_ads_backup.csv", META_HEADER, META_ROWS[9:])
    streamed, batch = (TableStore(spark, os.path.join(workdir, n)) for n in ("odd-stream", "odd-batch"))
    ingest_and_build(spark, landing, streamed.root)
    pipeline.run(spark, landing, batch.root)
    for table, n in (("raw_meta_ads", 6), ("_quarantine", 1), ("_ingestion_log", 3),
                     ("fact_daily_performance", 6)):
        drop = [c for c in ("_load_timestamp", "_staged_timestamp", "ingested_at", "_row", "file_modified_time")
                if c in batch.read(table).columns]
        x, y = (sorted(map(str, s.read(table).drop(*drop).select(
            *sorted(set(batch.read(table).columns) - set(drop))).collect())) for s in (streamed, batch))
        assert x == y and len(x) == n, table
    got = {r.ad_id: r for r in streamed.read("raw_meta_ads").collect()}
    assert (got["ad1"].impressions, got["ad1"].clicks) == (1000, 50)
    assert got["ad1"].campaign_name == 'Big "NW_App_East", sale'


def test_a_replayed_epoch_is_refused(spark, workdir):
    from spendlens.streaming import landing as L

    store = TableStore(spark, os.path.join(workdir, "replay"))
    path = os.path.join(workdir, "meta_ads_1.csv")
    _write(path, META_ROWS[:4])
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start",
                                         "_metadata.file_size", "_metadata.file_modification_time").toDF(
        "value", "_source_file", "_block", "_size", "_modified")
    lines = lines.withColumn("_modified", lines["_modified"].cast("timestamp_ntz"))
    write = L._batch_writer(store, "meta_ads", "replace")
    for epoch, logged in ((0, 1), (0, 1), (1, 2)):
        write(lines, epoch)
        assert store.read("_ingestion_log").count() == logged
        assert store.read("raw_meta_ads").count() == 4
