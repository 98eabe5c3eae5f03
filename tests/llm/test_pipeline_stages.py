"""The pipeline against each stage's operator and a plain version of the last ones."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spendlens.llm.quality import score_documents
from tests.llm.test_simhash import brute_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_pipeline_against_plain_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "personal_data", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    keep = {r.doc_id for r in score_documents(docs, labels).where("keep").collect()}
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id in keep}
    fp = {i: plain_fingerprint(t) for i, t in text.items()}
    group = brute_components(sorted(fp), [(a, b) for a in fp for b in fp if a < b
                                          and (fp[a] ^ fp[b]).bit_count() <= 2])
    first = {i for i in fp if group[i] == i}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    stage = docs
    for name, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, SF)
        assert stage.columns == docs.columns
        stage = spark.createDataFrame(stage.collect(), docs.schema)
    masked = {r.doc_id: r.text for r in stage.collect()}
    assert set(masked) == first
    clean = [i for i in first if not any(c in text[i] for c in "@0123456789")]
    assert len(clean) > 50 and all(masked[i] == text[i] for i in clean)

    got = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {
        i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in masked.items()}
