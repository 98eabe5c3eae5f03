"""Raw file sources (SRC-1 .. SRC-7, SNK-4 listing).

* CSV files are read with an explicit all-string schema (no inference);
  typing happens later, so a bad value never fails the read.
* Newline JSON is read with an explicit nested schema, metrics as strings
  (a JSON ``6.0`` under a bigint field would make the whole record corrupt),
  and a ``_corrupt`` column; blank lines are ignored by the reader.
* Every row carries its input position (file, block, row-in-split) so that
  "first/last in input order" rules stay deterministic when files are split
  across many tasks.
"""

from __future__ import annotations

import csv
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.session import checkpoint_dir

META_COLUMNS = ["date", "timestamp_pst", "campaign_id", "campaign_name", "adset_id", "ad_id",
                "objective", "placement", "impressions", "clicks", "spend_usd", "currency",
                "conversions", "conversion_value_usd"]
VISITS_COLUMNS = ["date", "dma_code", "dma_name", "attributed_visits", "attribution_window_days"]
METADATA_COLUMNS = ["campaign_id", "brand", "product_line", "region", "campaign_start_date",
                    "campaign_end_date", "budget_usd"]

GOOGLE_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("timestamp_utc", T.StringType()),
    T.StructField("campaign", T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("advertising_channel_type", T.StringType()),
    ])),
    T.StructField("metrics", T.StructType([
        T.StructField("impressions", T.StringType()),
        T.StructField("clicks", T.StringType()),
        T.StructField("cost_micros", T.StringType()),
        T.StructField("conversions", T.StringType()),
        T.StructField("conversions_value_micros", T.StringType()),
    ])),
    T.StructField("_corrupt", T.StringType()),
])

# Landing layout: a file (or folder of part files) directly under the landing folder
# belongs to a source when its whole name is the source's name, optionally followed by
# "_daily" and by a date or number, then the suffix: meta_ads_daily.csv,
# meta_ads_2026-01-05.csv, meta_ads_3.csv/part-0.csv.  Others are reported, not loaded.
SOURCE_SUFFIX = {"meta_ads": "csv", "google_ads": "json", "store_visits": "csv",
                 "campaign_metadata": "csv"}


def source_pattern(source: str) -> str:
    return rf"^{source}(_daily)?([_-]?[0-9][0-9A-Za-z_-]*)?\.{SOURCE_SUFFIX[source]}$"


# The single-file names of the source system (used for "expected file" checks).
SOURCE_FILES = {
    "meta_ads": "meta_ads_daily.csv",
    "google_ads": "google_ads_daily.json",
    "store_visits": "store_visits.csv",
    "campaign_metadata": "campaign_metadata.csv",
}

ORDER_COLS = ["_source_file", "_block", "_row"]
#: Numbers of names of headers by which lines are cut separately.
WIDTHS = 8


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def with_input_order(df: DataFrame) -> DataFrame:
    """Add the input position: ``_source_file`` (its full URI), ``_block`` (split start
    offset) and ``_row`` (row inside the split)."""
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"))


def listed_path(source_file: Column) -> Column:
    """``_source_file``, a percent-encoded URI, as the listing writes the path."""
    return F.url_decode(F.replace(source_file, F.lit("+"), F.lit("%2B")))


def csv_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of CSV files as text, with their input position."""
    return with_input_order(spark.read.option("encoding", "UTF-8").text(paths))


def _values(line: Column, width: int) -> Column:
    """The values of a CSV line as an array of strings; quotes inside quotes are doubled."""
    slots = ", ".join(f"c{i} string" for i in range(width))
    return F.array(*[F.from_csv(line, slots, {"escape": '"'})[f"c{i}"] for i in range(width)])


def file_headers(lines: DataFrame) -> DataFrame:
    """``(_source_file, _header_row, _header)``: the first line of every file and its row.

    One scan for all files, however many: a file's first line is that of the least row of
    its first split, found with partial aggregation."""
    return (lines.where("_block = 0").groupBy("_source_file")
            .agg(F.min(F.struct("_row", "value")).alias("_first"))
            .select("_source_file", F.col("_first._row").alias("_header_row"),
                    F.regexp_replace("_first.value", "^\ufeff", "").alias("_header")))


def _stored(headers: DataFrame) -> DataFrame:
    """Headers as a table in the shared folder: the files are read for them once, and Spark
    knows that they are few before it plans the join, so that the lines are not shuffled."""
    spark = headers.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/spendlens-headers/{uuid.uuid4().hex}"
    headers.write.parquet(path)
    return spark.read.schema(headers.schema).parquet(path)


def _place(column: str) -> Column:
    """Index of a column in ``_names``, NULL if it is not there."""
    return F.array_min(F.transform("_names", lambda n, i: F.when(n == column, i)))


def bind_by_name(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of CSV files bound to ``columns`` by each file's own header.

    ``lines``: ``value`` and the input position; further columns stay.  Every line is cut
    into as many values as its file's header has names (the numbers of names are all that
    reaches the driver; beyond ``WIDTHS`` of them, as many as the widest has), and takes
    those at its header's places, so that files with differing headers, in one folder or
    not, are read in one pass.  Columns a file lacks are NULL, columns not asked for are
    ignored, order does not matter; of a repeated name the first counts."""
    headers = _stored(file_headers(lines))
    names = F.split("_header", ",")
    widths = sorted(headers.agg(F.collect_set(F.size(names))).first()[0] or [1])[-WIDTHS:]
    width = widths[-1]
    head = F.transform(_values(F.col("_header"), width), lambda n: F.trim(n))
    # the places of the columns; NULL where the file has none
    at = headers.select("_source_file", "_header_row", "_header", head.alias("_names")).select(
        F.col("_source_file").alias("_of"), "_header_row", "_header",
        F.when(F.size(names).isin(widths), F.size(names)).otherwise(width).alias("_width"),
        F.array(*map(_place, columns)).alias("_at"))
    rows = (lines.join(at, F.col("_source_file") == F.col("_of"))
            .where(~((F.col("_block") == 0) & (F.col("_row") == F.col("_header_row"))))
            .where(F.trim("value") != ""))
    extra = [c for c in lines.columns if c not in ("value", *ORDER_COLS)]
    # cut once: what stands behind inline() is not worked out again for each column
    # a line of fewer values than asked for costs a raised and dropped exception
    cut = rows.select(F.inline(F.array(F.struct(*[F.when(F.col("_width") == w, F.from_csv(
        "value", ", ".join(f"c{i} string" for i in range(w)), {"escape": '"'})).alias(f"_v{w}")
        for w in widths]))), "_width", "_at", *ORDER_COLS, *extra)
    values = F.lit(None).cast("array<string>")
    for w in widths:
        values = F.when(F.col("_width") == w, F.array(*[F.col(f"_v{w}.c{i}") for i in range(w)])).otherwise(values)
    return cut.select(*[F.get(values, F.col("_at")[i]).alias(c)
                        for i, c in enumerate(columns)], *ORDER_COLS, *extra)


def read_csv_strings(spark: SparkSession, path: str | list[str], columns: list[str],
                     multiline: bool = False) -> DataFrame:
    """SRC-1/4/5: header CSV, UTF-8, every value a string, bound by header name (see
    ``bind_by_name``), each file by its own header.

    Quotes inside quoted values are doubled (``""``).  ``multiline``: values may hold
    line ends; each file is then read by one task, files of one header together."""
    paths = [path] if isinstance(path, str) else sorted(set(path))
    lines = csv_lines(spark, paths)
    if not multiline:
        return bind_by_name(lines, columns)
    # one row per file: the readers below take their paths from the driver
    by_header: dict[str, list[str]] = {}
    for r in file_headers(lines).select(listed_path(F.col("_source_file")).alias("p"), "_header").collect():
        by_header.setdefault(r["_header"], []).append(r["p"])
    out = None
    for header, group in by_header.items():
        names = [n.strip() for n in next(csv.reader([header]))]
        df = (spark.read.schema(string_schema([f"c{i}" for i in range(len(names))]))
              .option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
              .option("escape", '"').option("multiLine", True).csv(group))
        part = with_input_order(df).select(
            *[(F.col(f"c{names.index(c)}") if c in names else F.lit(None).cast("string")).alias(c)
              for c in columns], *ORDER_COLS)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], string_schema(columns)).select(
            *columns, F.lit("").alias("_source_file"), F.lit(0).cast("bigint").alias("_block"),
            F.lit(0).cast("bigint").alias("_row"))
    return out


def parse_json_lines(lines: DataFrame, schema: T.StructType = GOOGLE_SCHEMA) -> DataFrame:
    """Lines of newline JSON (``value`` and the input position; further columns stay) with a
    corrupt-record column; blank lines are ignored, as the JSON reader does."""
    rest = [c for c in lines.columns if c != "value"]
    rec = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return (lines.where(F.trim("value") != "")
            .select(F.inline(F.array(F.struct(rec.alias("_j")))), *rest).select("_j.*", *rest))


def read_json_lines(spark: SparkSession, path: str | list[str],
                    schema: T.StructType = GOOGLE_SCHEMA) -> DataFrame:
    """SRC-2: newline JSON with a corrupt-record column (not DROPMALFORMED,
    which would also drop valid JSON with one mistyped field)."""
    df = (spark.read.schema(schema).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt").json(path))
    return with_input_order(df)


def flatten_google(df: DataFrame) -> DataFrame:
    """SRC-3: campaign.{id,name,advertising_channel_type} and metrics.* to
    top-level columns; a missing or non-object ``campaign``/``metrics`` gives
    NULLs."""
    return df.select(
        "date", "timestamp_utc",
        F.col("campaign.id").alias("campaign_id"),
        F.col("campaign.name").alias("campaign_name"),
        F.col("campaign.advertising_channel_type").alias("advertising_channel_type"),
        F.col("metrics.impressions").alias("impressions"),
        F.col("metrics.clicks").alias("clicks"),
        F.col("metrics.cost_micros").alias("cost_micros"),
        F.col("metrics.conversions").alias("conversions"),
        F.col("metrics.conversions_value_micros").alias("conversions_value_micros"),
        "_corrupt", *ORDER_COLS)


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """SNK-4 listing of the landing folder, recursively: ``path``,
    ``file_name`` (path relative to the folder), ``entry`` (its first
    component: the file itself or the folder holding part files), ``source``,
    size and modification time.  The ``binaryFile`` source reads file contents
    only when the ``content`` column is selected, so this is a metadata scan;
    marker files (``_SUCCESS``, ``.crc``) are skipped."""
    base = re.sub(r"^file:/*", "/", directory.rstrip("/"))
    schema = ("path string, file_name string, entry string, source string, "
              "file_size_bytes bigint, file_modified_time timestamp_ntz")
    try:
        df = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
              .load(directory).select("path", "length", "modificationTime"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    rel = F.regexp_replace("path", "^.*?" + re.escape(base) + "/", "")
    leaf = F.element_at(F.split(rel, "/"), -1)
    entry = F.element_at(F.split(rel, "/"), 1)
    source = F.lit(None).cast("string")
    for src in SOURCE_SUFFIX:
        source = F.when(entry.rlike(source_pattern(src)), F.lit(src)).otherwise(source)
    out = df.select("path", rel.alias("file_name"), entry.alias("entry"),
                    source.alias("source"), F.col("length").alias("file_size_bytes"),
                    F.col("modificationTime").cast("timestamp_ntz").alias("file_modified_time"),
                    leaf.alias("_leaf"))
    return out.filter(~F.col("_leaf").startswith("_") & ~F.col("_leaf").startswith(".")) \
        .drop("_leaf")
