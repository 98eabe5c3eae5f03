import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from spendlens.llm import pieces
from spendlens.llm.pieces import (backtrace, decode, encode, entries, lattice, product, resolve, summary,
                                  transfer)

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def unigram_model():
    """The same pieces and scores as a unigram model: the library's own Viterbi."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    m = pb.ModelProto()
    m.ParseFromString(open(MODEL, "rb").read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:  # small scores: sums are exact in single precision
        if p.type == 1:
            p.score = max(-2000.0, p.score) / 16
    return m.SerializeToString()


def chain(lat, text, cuts):
    """Encodes by chunks, one matrix each, as the Spark job does."""
    out, parts = [], []
    for a, b in zip(cuts, cuts[1:]):
        base = max(0, a - 2 * lat.longest)
        start = entries(lat, text[base:b], base, a)
        found = transfer(lat, text[base:b], base, a, b, start)
        if b == len(text):
            found = {x: v for x, v in found.items() if x[0] == b}
        m = {}
        for x, v in found.items():
            for i in np.flatnonzero(v > -np.inf):
                m.setdefault(start[i], {})[x] = v[i]
        parts.append(m)
    for (a, b), (e, x) in zip(zip(cuts, cuts[1:]), resolve(parts)):
        base = max(0, a - 2 * lat.longest)
        out += backtrace(lat, text[base:b], base, a, b, e, x)
    return lat.output(out), parts


def texts():
    r = random.Random(7)
    pools = ["the and ing tion heonre", "aaab  ", "   \n\t", "é日本語😀①ß ", "0123 .,!?", "er"]
    words = "the and of heronth blering thation ndsh verlich ción ément  été".split(" ")
    out = [" ".join(r.choice(words) for _ in range(60)) for _ in range(25)]
    out += ["".join(r.choice(r.choice(pools)) for _ in range(200)) for _ in range(25)]
    return out + [" " * 150, "a" * 200, "er" * 90, "日" * 120]


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_chunks_equal_the_library(kind):
    model = MODEL if kind == "bpe" else unigram_model()
    lat, sp = lattice(model, kind == "bpe"), pieces.processor(model)
    for t in texts():
        norm = sp.normalize(t)
        cuts = sorted({0, len(norm), *range(50, len(norm) - 33, 41)})
        want = sp.encode(t)
        got, parts = chain(lat, norm, cuts)
        if kind == "bpe":
            assert got == want, t
        else:  # equal scores may be segmented otherwise
            score = lambda ids: sum(sp.get_score(i) if not sp.is_byte(i) else 0 for i in ids)
            assert got == want or score(got) == pytest.approx(score(want)), t
        assert got == chain(lat, norm, [0, len(norm)])[0] or kind == "unigram"


def test_products_are_associative():
    lat, sp = lattice(MODEL, True), pieces.processor(MODEL)
    norm = sp.normalize(texts()[0])
    _, (a, b, c, *_) = chain(lat, norm, [0, 60, 120, 180, len(norm)])
    assert product(product(a, b), c) == product(a, product(b, c))


def test_operator_against_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ts = texts() + ["", " ", "x", " ".join(texts()) * 3]
    rows = list(enumerate(ts)) + [(None, ts[0] * 2), (0, ts[0] * 2), (5, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("k1", F.lit("x")).withColumn(
        "ids", F.lit(0))
    got = encode(df, MODEL, giant=100, chunk=40, block=3).collect()
    want = sorted(((i, sp.encode(t or "")) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=repr) == want
    assert encode(df.limit(0), MODEL, giant=100).count() == 0


def test_round_trip_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = encode(docs, MODEL, giant=8000, chunk=2000, block=2)
    got = {r.doc_id: r for r in decode(ids, MODEL).collect()}
    sums = {r.doc_id: r for r in summary(ids, MODEL).collect()}
    for d in docs.collect():
        assert list(got[d.doc_id].ids) == sp.encode(d.text) and got[d.doc_id].text == d.text
        assert sums[d.doc_id].decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()
        assert sums[d.doc_id].n_tokens == len(got[d.doc_id].ids)
    null = spark.createDataFrame([(1, None)], "i int, ids array<int>")
    assert decode(null, MODEL).first().text is None
