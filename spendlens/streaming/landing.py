"""STR-1: pick up newly landed files once, load them keyed, keep progress.

A file-source stream over the landing folder with ``trigger(availableNow=True)``
processes every file that arrived since the last run and then stops; the
stream checkpoint (kept in the table store, i.e. shared storage) records
which files were consumed, so a restarted job neither skips nor repeats a
file.  The stream carries lines of text; a micro-batch is bound by each file's
own header, typed, quarantined, inserted and logged by the code of the batch
path, so that both read the same files in the same way.

Every micro-batch that was written is kept in ``_stream_epochs`` by query and
epoch id: one that is replayed after a failure is refused.  If the failure came
between the write and that note, the keyed write adds nothing twice.

The file source treats a file name as consumed once; files rewritten in place
under the same name are the batch path's job (``pipeline.load_bronze`` with
size/modification-time change detection).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spendlens.plans import pipeline
from spendlens.sources import files as SRC
from spendlens.sources import reference as REF
from spendlens.sources.store import INGESTION_LOG, TableStore, now_utc

EPOCHS = "_stream_epochs"
_FILE = ["_size", "_modified"]


def _stream(spark: SparkSession, landing_dir: str, source: str) -> DataFrame:
    """Lines of the source's files, and of the part files of its folders, with the file's
    place, size and modification time."""
    files = f"{landing_dir.rstrip('/')}/{source}*.{SRC.SOURCE_SUFFIX[source]}"
    entry = F.regexp_extract("_source_file", f"/({source}[^/]*)(?:/[^/]*)?$", 1)
    lines = spark.readStream.option("encoding", "UTF-8").text(files)
    return (lines.select("value", F.col("_metadata.file_path").alias("_source_file"),
                         F.col("_metadata.file_block_start").alias("_block"),
                         F.col("_metadata.file_size").alias("_size"),
                         F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_modified"))
            .where(entry.rlike(SRC.source_pattern(source))))


def _seen(store: TableStore, query: str, epoch: int) -> bool:
    done = store.read(EPOCHS)
    return done is not None and not done.where(
        (F.col("query") == query) & (F.col("epoch") == epoch)).isEmpty()


def _batch_writer(store: TableStore, source: str, mode: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        if _seen(store, query, epoch_id):
            return
        run_ts = now_utc()
        # the row inside the split: not allowed on the streaming plan itself
        lines = batch.withColumn("_row", F.monotonically_increasing_id().bitwiseAND(
            F.lit((1 << 33) - 1)))
        todo = (batch.groupBy("_source_file", *_FILE).agg(F.count("*").alias("_n"))
                .select(SRC.listed_path(F.col("_source_file")).alias("path"),
                        F.col("_size").alias("file_size_bytes"),
                        F.col("_modified").alias("file_modified_time"))).checkpoint(eager=True)
        table, keys = pipeline.BRONZE[source]
        good, bad = pipeline.type_rows(source, _raw(source, lines), run_ts)
        result = pipeline.RunResult(run_ts)
        log = pipeline.store_rows(store, source, table, keys, good, bad, todo, run_ts, result, mode)
        store.append(INGESTION_LOG, log)
        done = store.spark.createDataFrame(
            [(query, epoch_id, source, run_ts)],
            "query string, epoch bigint, source string, loaded_at timestamp_ntz")
        store.append(EPOCHS, done)
    return write


def _raw(source: str, lines: DataFrame) -> DataFrame:
    position = ["value", *SRC.ORDER_COLS]
    if source == "google_ads":
        return SRC.flatten_google(SRC.parse_json_lines(lines.select(*position)))
    return SRC.bind_by_name(lines.select(*position), pipeline.CSV_SOURCES[source][0])


def ingest_available(spark: SparkSession, landing_dir: str, store: TableStore,
                     source: str, mode: str = "ignore") -> StreamingQuery:
    """Start the stream for one source, process what is available, stop.
    Returns the finished query (``lastProgress`` has the counts)."""
    q = (_stream(spark, landing_dir, source).writeStream
         .foreachBatch(_batch_writer(store, source, mode))
         .option("checkpointLocation", store.path(f"_checkpoints/{source}"))
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q


def ingest_and_build(spark: SparkSession, landing_dir: str, table_dir: str, *, mode: str = "ignore",
                     calendar=(REF.CALENDAR_START, REF.CALENDAR_END)) -> dict:
    """Streaming counterpart of ``pipeline.run``: each source's new landing
    files are ingested by its stream (availableNow), then the silver and gold
    tables are advanced from their watermarks exactly as in the batch run
    (``mode`` and ``calendar`` as there)."""
    store = TableStore(spark, table_dir)
    progress = {}
    for source in SRC.SOURCE_SUFFIX:
        q = ingest_available(spark, landing_dir, store, source, mode)
        progress[source] = (q.lastProgress or {}).get("numInputRows", 0)
    run_ts = now_utc()
    wm = pipeline.Watermarks(store)
    pipeline.build_silver(spark, store, run_ts, wm, calendar)
    pipeline.build_gold(spark, store, run_ts, wm)
    return progress
