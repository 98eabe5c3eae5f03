"""Token counts through a digest cache.

The cache is a Parquet folder of (tokenizer, digest, n_tokens): the digest of the
normalised content, and the tokenizer's version, a digest of its file and of its
library's version.  A run joins the documents' digests to it, encodes each
distinct missing content once, appends those, and joins again.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm.common import materialise, shared_folder
from spendlens.llm.tokens import is_word_local, token_counter

CACHE = "tokenizer string, digest binary, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file, its library and that library's version."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        body = hashlib.sha256(f.read()).hexdigest()
    mark = f"{library} {importlib.metadata.version(library)} {body}"
    return hashlib.sha256(mark.encode()).hexdigest()


def normalised(text: Column, path: str) -> Column:
    """What cannot change the count is made equal: for tokenizers that drop white
    space and case, runs of blanks and ASCII case, but in texts that may hold a
    special string.  For all others the text is taken as it is."""
    if path.endswith(".model"):
        return text
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if not is_word_local(spec):
        return text
    marks = [F.contains(text, F.lit(t["content"][:2])) for t in spec["added_tokens"]]
    special = F.lit(False)
    for m in marks:
        special = special | m
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(special, text).otherwise(F.trim(F.regexp_replace(lower, r"[ \t\n\r]+", " ")))


def read_cache(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; empty where nothing is stored."""
    try:
        stored = spark.read.schema(CACHE).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE)
    # a digest that two runs stored at the same time is there twice, with one count
    return (stored.where(F.col("tokenizer") == version).groupBy("digest")
            .agg(F.min("n_tokens").alias("n_tokens")))


def encode_counts(texts: DataFrame, path: str) -> DataFrame:
    """(digest, text) -> (digest, n_tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(path)
        for b in batches:
            n = count(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(n, pa.int64())],
                                             names=["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(run, "digest binary, n_tokens bigint")


def count_tokens(docs: DataFrame, path: str, cache: str | None = None, limit: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per input row.

    ``cache``: the folder that counts are read from and appended to; a new one in
    the shared folder if not given.  A null text counts as empty: no bytes, no
    tokens.  Null and repeated ids are kept; other columns are not looked at; an
    empty table gives an empty table and stores nothing.
    """
    spark = docs.sparkSession
    cache = cache or shared_folder(spark, "token-cache")
    version = tokenizer_version(path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn(
        "digest", F.unhex(F.sha2(normalised(F.col("text"), path), 256)))
    # equal contents are merged within each task before they are shuffled
    missing = whole.select("digest", "text").dropDuplicates(["digest"])
    missing = missing.join(read_cache(spark, cache, version), "digest", "left_anti")
    (encode_counts(missing, path).select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
     .write.mode("append").parquet(cache))
    rows = whole.select("doc_id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes"))
    # both sides are plain tables: Spark can split the rows of a hot content
    counts = materialise(read_cache(spark, cache, version), "token-counts")
    return (rows.join(counts, "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
