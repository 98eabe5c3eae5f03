"""Parquet table store: keyed upserts without MERGE, watermarks, audit log.

Layout: ``<root>/<table>/`` is a Parquet directory, optionally partitioned
(facts by ``_month``).  A table keeps its column types: other types are refused.

overwrite  The new table is written whole beside the old one, then swapped in by
         renames; ``read`` mends a swap that was cut short.
upsert   Only the partitions the batch touches are read, merged with the
         batch (last write wins per key, see ``operators.merge.upsert``) and
         rewritten with dynamic partition overwrite; untouched months are not
         read or written.  The merged result is checkpointed first (reliable
         checkpoint in the shared ``spark.checkpoint.dir``), which cuts the
         lineage to the files about to be replaced and means a lost executor
         does not need the old files to recompute.
append   New files next to the old ones (audit log, quarantine, bronze
         inserts).
state    ``_pipeline_tracking`` (one watermark per table) and
         ``_ingestion_log`` are ordinary small tables in the same store.

Re-running a batch is idempotent: keys plus last-write-wins give the same
table.  The interface (``read`` / ``append`` / ``upsert`` / ``overwrite``) is
narrow so a table format with native MERGE can replace it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators.merge import upsert as merge_upsert
from spendlens.session import checkpoint_dir
from spendlens.sources.files import listed_path

TRACKING = "_pipeline_tracking"
INGESTION_LOG = "_ingestion_log"
QUARANTINE = "_quarantine"

TRACKING_SCHEMA = "table_name string, last_processed_load_timestamp timestamp_ntz"
LOG_SCHEMA = ("source_file string, ingested_at timestamp_ntz, file_size_bytes bigint, "
              "file_modified_time timestamp_ntz, records_loaded bigint, records_skipped bigint, "
              "status string, error string")


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        checkpoint_dir(spark)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # ------------------------------------------------------------------ read
    def read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path(name))
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.read.parquet(self.path(name)) if self._mend(name) else None
            if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return None
            raise

    def read_or_empty(self, name: str, schema: str) -> DataFrame:
        df = self.read(name)
        return df if df is not None else self.spark.createDataFrame([], schema)

    def _check(self, name: str, current: DataFrame | None, df: DataFrame) -> None:
        """A table keeps its column types: writing others is refused."""
        if current is not None:
            old = {f.name: f.dataType for f in current.schema.fields}
            for f in df.schema.fields:
                if f.name in old and old[f.name] != f.dataType:
                    raise TypeError(f"{name}.{f.name} is {old[f.name].simpleString()}, not "
                                    f"{f.dataType.simpleString()}")

    # ------------------------------------------------------------------ write
    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        self._check(name, self.read(name), df)
        w = df.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(name))

    def overwrite(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Full replace (small tables, full-refresh tables).  The new table is written
        whole beside the old one (which it may read), then the two are swapped by
        renames; a run that dies in between is mended by the next ``read``."""
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self._aside(name, "staged"))
        self._swap(name)

    def _aside(self, name: str, kind: str) -> str:
        return f"{self.root}/_{kind}/{name}"

    def _files(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _swap(self, name: str) -> None:
        fs, path = self._files()
        here, staged, old = (path(p) for p in (
            self.path(name), self._aside(name, "staged"), self._aside(name, "replaced")))
        fs.delete(old, True)
        fs.mkdirs(old.getParent())
        fs.mkdirs(here.getParent())
        if fs.exists(here):
            fs.rename(here, old)
        fs.rename(staged, here)
        fs.delete(old, True)

    def _mend(self, name: str) -> bool:
        """Finish or undo a swap that was cut short; False where there is nothing to mend."""
        fs, path = self._files()
        if fs.exists(path(self.path(name))):
            return False
        if fs.exists(path(self._aside(name, "staged") + "/_SUCCESS")):
            self._swap(name)
            return True
        if fs.exists(path(self._aside(name, "replaced"))):
            return fs.rename(path(self._aside(name, "replaced")), path(self.path(name)))
        return False

    def upsert(self, name: str, batch: DataFrame, keys: Sequence[str],
               order: Sequence[str] = (), partition_by: str | None = None) -> None:
        """Last write wins per key; with ``partition_by`` only the touched
        partitions are read and rewritten."""
        current = self.read(name)
        if current is None:
            # first write: nothing is read from the target, no staging needed
            w = merge_upsert(None, batch, keys, order).write.mode("overwrite")
            if partition_by:
                w = w.partitionBy(partition_by)
            w.parquet(self.path(name))
            return
        self._check(name, current, batch)
        if partition_by:
            # the batch feeds the partition list and the merge: worked out once
            batch = batch.checkpoint(eager=True)
            current = current.filter(F.col(partition_by).isin(
                touched_values(batch, partition_by)))
        merged = merge_upsert(current.select(*batch.columns), batch, keys, order)
        if not partition_by:
            self.overwrite(name, merged)
            return
        staged = merged.checkpoint(eager=True)
        w = staged.write.mode("overwrite")
        if partition_by:
            w = w.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
        w.parquet(self.path(name))

    def replace_files(self, name: str, df: DataFrame, files: DataFrame, source: str) -> None:
        """Rows of ``source`` in ``name`` that came from ``files`` (column ``path``, as
        listed) give way to ``df``; those of other files, and of other sources, stay.  Each
        source is a partition of its own, so others are neither read nor written.  Writing
        the same again changes nothing."""
        part = f"{name}/source={source}"
        df = df.drop("source")
        current = self.read(part)
        if current is not None:
            keep = current.join(files.select(F.col("path").alias("_gone")),
                                listed_path(F.col("_source_file")) == F.col("_gone"), "left_anti")
            df = keep.select(*df.columns).unionByName(df)
        self.overwrite(part, df)

    # ------------------------------------------------------------------ watermarks
    def write_watermarks(self, values: dict) -> None:
        """Replace the tracking table with the full set of watermarks (a
        handful of rows built on the driver; nothing is read from it)."""
        rows = self.spark.createDataFrame(sorted(values.items()), TRACKING_SCHEMA)
        self.overwrite(TRACKING, rows.coalesce(1))

    # ------------------------------------------------------------------ audit log
    def last_success(self) -> DataFrame:
        """AGG-13: latest successful log row per file."""
        log = self.read_or_empty(INGESTION_LOG, LOG_SCHEMA)
        ok = log.filter(F.col("status") == "success")
        latest = ok.groupBy("source_file").agg(
            F.max_by(F.struct("file_size_bytes", "file_modified_time"), "ingested_at").alias("l"))
        return latest.select("source_file", F.col("l.file_size_bytes").alias("file_size_bytes"),
                             F.col("l.file_modified_time").alias("file_modified_time"))


def touched_values(df: DataFrame, col: str) -> list:
    """Distinct values of a partition column in a batch (e.g. its months: a
    handful, bounded by the calendar).  Filtering the target with ``isin`` on
    them prunes the scan to those partition directories."""
    return [r[0] for r in df.select(col).distinct().collect()]


def changed_files(listing: DataFrame, last_success: DataFrame) -> DataFrame:
    """SNK-4: files whose size or modification time differ from their last
    successful ingestion (or that were never ingested).  Files are identified
    by their full path."""
    same = (listing.join(last_success, (listing.path == last_success.source_file)
                         & (listing.file_size_bytes == last_success.file_size_bytes)
                         & (listing.file_modified_time == last_success.file_modified_time),
                         "left_semi"))
    return listing.join(same.select("path"), "path", "left_anti")


def now_utc() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
