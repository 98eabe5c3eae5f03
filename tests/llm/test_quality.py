import random

import numpy as np
from pyspark.sql import functions as F

from spendlens.llm.quality import (CoTrained, LOGIT_BINS, META_FEATURES, TEXT_FEATURES, _cuts,
                                   _verdicts, co_train, features, keep_good, meta_features,
                                   score_documents, text_features)

SF = "/root/testdata/sf0.01"


def load(spark):
    return (spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy(spark):
    docs, labels = load(spark)
    train = labels.where(F.pmod(F.hash("doc_id"), F.lit(4)) != 0)
    test = labels.where(F.pmod(F.hash("doc_id"), F.lit(4)) == 0)
    rows = score_documents(docs, train).join(test, "doc_id").collect()
    good = [r.keep for r in rows if r.quality == 1]
    bad = [r.keep for r in rows if r.quality == 0]
    assert len(bad) >= 8 and np.mean(good) >= 0.97 and np.mean(bad) <= 0.2


def test_pseudo_labels_reach_the_other_view(spark):
    """Only the metadata view can learn from the labels; the text view learns a
    sign of its own from the metadata view's confident verdicts."""
    r = random.Random(1)
    rows = []
    for i in range(600):
        good = r.random() < 0.5
        known = i < 200
        text = " ".join(r.choice(["alpha", "beta", "gamma"]) for _ in range(20))
        rows.append((i, text if known else (text if good else text.replace("a", "&&&") + " $$$"),
                     "en" if good else "xx", "s", 100, float(good) if known else None))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, "
                                     "n_chars bigint, quality double")
    labels = df.where("quality is not null").select("doc_id", "quality")
    alone = co_train(features(df), labels, rounds=0)
    both = co_train(features(df), labels, rounds=2, confident=0.9)
    bad = np.array([text_features("bet&&& g&&&mm&&& $$$")])
    good = np.array([text_features("beta gamma alpha")])
    meta = np.array([meta_features("en", "s", 100)])
    gap = lambda m: (m.logits(good, meta)[0] - m.logits(bad, meta)[0])[0]
    assert gap(both) > gap(alone) + 0.5


def test_keep_good_keeps_rows_as_they_are(spark):
    docs, labels = load(spark)
    docs = docs.withColumn("quality", F.lit("q")).withColumn("ft", F.lit(1))
    got = keep_good(docs, labels)
    assert got.schema == docs.schema
    scored = {r.doc_id for r in score_documents(docs, labels).where("keep").collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    kept = got.collect()
    assert {r.doc_id for r in kept} == scored and all(r == rows[r.doc_id] for r in kept)


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0),
            (None, "x y", None, "b", -5), (3, "&&& " * 100_000, "en", None, 400_000),
            (9007199254740993, "ok text", "en", "a", 7)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0), (3, 0), (4, 1)],
                                   "doc_id bigint, quality int")
    got = score_documents(docs, labels)
    ids = sorted((r.doc_id for r in got.collect()), key=repr)
    assert ids == sorted((r[0] for r in rows), key=repr)
    assert all(0 <= r.quality_score <= 1 for r in got.collect())
    assert score_documents(docs.limit(0), labels).count() == 0
    none = score_documents(docs, labels.limit(0)).collect()
    assert len(none) == 6 and all(r.keep for r in none)
    assert keep_good(docs, labels.where("quality = 1")).count() == 6
    assert score_documents(docs.select("doc_id", "text"), labels).count() == 6


def test_feature_sizes():
    for t in (None, "", "a", "one two\nthree &&&", "\ud800"):
        assert len(text_features(t)) == TEXT_FEATURES and np.isfinite(text_features(t)).all()
    assert len(meta_features(None, None, float("nan"))) == META_FEATURES
    assert isinstance(CoTrained(np.zeros(3), np.zeros(3), np.zeros(3)).threshold, float)


def test_compression_sees_the_whole_text():
    """Junk behind the first MiB counts: it does not compress as the start does."""
    r = random.Random(4)
    start = "the same words again and again " * 40_000
    junk = "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(1 << 20))
    clean, mixed = (text_features(t)[-1] for t in (start, start[:1 << 20] + junk))
    assert clean < 0.05 and 0.25 < mixed < 0.5


def test_both_views_teach_with_production_parameters(spark):
    """Given tables, parameters as in the query: each view gives labels of both classes
    in every round, and the text view ends elsewhere than without them."""
    docs, labels = load(spark)
    feats = features(docs)
    both = co_train(feats, labels)
    assert [g[:2] for g in both.given] == [(r, v) for r in (1, 2, 3) for v in ("text", "meta")]
    assert all(good > 0 and bad > 0 for _, _, good, bad in both.given)
    alone = co_train(feats, labels, rounds=0, steps=16)
    assert np.abs(both.text - alone.text).max() > 0.01 and alone.given == []


def test_equal_scores_give_no_verdict():
    counts = np.zeros(LOGIT_BINS)
    counts[4200] = 100
    good, bad = _verdicts(np.arange(LOGIT_BINS), _cuts(counts, 0.9, 0.05, 0.97))
    assert not good[4200] and not bad[4200]
    counts[4190] = counts[4210] = 10
    good, bad = _verdicts(np.arange(LOGIT_BINS), _cuts(counts, 0.5, 0.05, 0.97))
    assert good[4210] and bad[4190] and not (good & bad).any() and not good[4200] and not bad[4200]


def test_sums_run_in_all_partitions(spark):
    from pyspark import TaskContext

    from spendlens.llm.quality import _sum_arrays

    def seen(b):
        out = np.zeros(64)
        out[TaskContext.get().partitionId()] = len(b)
        return out

    sums = _sum_arrays(spark.range(6400).repartition(64), seen, 64)
    assert sums.sum() == 6400 and (sums > 0).all()
