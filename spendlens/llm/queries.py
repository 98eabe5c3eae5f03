"""The registered queries: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import pieces, pii, quality
from spendlens.llm.alignment import align_and_score
from spendlens.llm.common import shared_folder, table
from spendlens.llm.embeddings import near_vectors
from spendlens.llm.iblt import fingerprint_edits
from spendlens.llm.packing import pack_documents
from spendlens.llm.registry import register
from spendlens.llm.simhash import simhash_components
from spendlens.llm.spelling import count_words, variant_groups
from spendlens.llm.templates import main_text
from spendlens.llm.token_counts import count_tokens
from spendlens.llm.url_sql import URL_SQL
from spendlens.llm.urls import Rule, judge_urls
from spendlens.llm.warc import read_warc, write_warc


@register("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=2)


@register("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


@register("op8_embedding_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


@register("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@register("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"), limit=2048)


URL_RULES = [Rule("net/", "block"), Rule("example.net/en/", "allow"),
             Rule("example.com/de/", "block"), Rule("org/fr/", "allow")]


@register("op3_url_filters", URL_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of the same id: bad if of low quality or toxic."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), outcomes, URL_RULES).drop("bad_rate", "lower")


@register("op5_warc")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return read_warc(spark, folder, payloads=False).drop("url", "payload")


@register("op4_document_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@register("op6_sentencepiece")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.summary(pieces.encode(table(spark, sf_dir, "documents"), model, bpe=True), model)


@register("op11_cross_tokenizer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_and_score(table(spark, sf_dir, "documents"),
                           public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@register("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(count_words(table(spark, sf_dir, "documents")))


@register("op13_html_extraction")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
