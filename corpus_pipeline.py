"""The corpus pipeline: four operators of ``spendlens.llm`` over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept,
and its result is written as Parquet and read back as the next one's ``docs``.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spendlens.llm import pii, quality, simhash
from spendlens.llm.common import materialise, table
from spendlens.llm.packing import pack_documents
from spendlens.llm.registry import register


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return simhash.keep_first(docs, shingle=3, radius=2)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, are masked in the texts."""
    return pii.sanitise(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' token ids are packed into sequences of 2048."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("personal_data", mask_personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: A classifier's fit, fingerprints and tokenizers have no SQL form.
ORACLE_SQL = None


@register("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
