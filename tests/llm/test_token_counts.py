import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spendlens.llm import token_counts
from spendlens.llm.token_counts import count_tokens, tokenizer_version
from spendlens.llm.tokens import TokenCounter

WORD = public_tokenizers.path("word_bpe_49k.json")


def texts():
    r = random.Random(3)
    pools = ["abcDEF 's't 12 .,!'", "".join(map(chr, range(0, 0x180))), " \t\n\r\x0b\x85\xa0ab",
             "日本語😀é́ẞΣσςİ", "<|startoftext|> <|endoftext|>", "ÀÉÎõüßµ²½ªº ab\xad"]
    out = ["", " ", "<|endoftext|>", "a<|startoftext|>b", "A <|STARTOFTEXT|>", "x" * 5000, "ΑΣ ΑΣ."]
    return out + ["".join(r.choice(p) for _ in range(r.randrange(60))) for p in pools
                  for _ in range(300)]


def test_counts_equal_the_library():
    tok, count = Tokenizer.from_file(WORD), TokenCounter(WORD)
    count.CHARS, count.REMEMBER = 500, 300
    ts = texts()
    assert count(ts) == [len(tok.encode(t, add_special_tokens=False).ids) for t in ts]
    byte = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(byte)
    assert TokenCounter(byte)(ts) == [len(tok.encode(t, add_special_tokens=False).ids) for t in ts]
    model = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    assert TokenCounter(model)(ts) == [len(sp.encode(t)) for t in ts]


def test_operator_on_odd_texts(spark):
    tok = Tokenizer.from_file(WORD)
    ts = [t for t in texts()] + [t.upper().replace(" ", "  ") for t in texts()[:300]]
    df = spark.createDataFrame(list(enumerate(ts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in
           count_tokens(df, WORD, limit=9).collect()}
    for i, t in enumerate(ts):
        n = len(tok.encode(t, add_special_tokens=False).ids)
        assert got[i] == (len(t.encode()), n, n > 9), repr(t)


def test_table_against_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tok = Tokenizer.from_file(WORD)
    want = {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs, WORD).collect()} == want


def test_only_distinct_misses_are_encoded(spark, workdir, monkeypatch):
    seen, real = [], token_counts.encode_counts
    monkeypatch.setattr(token_counts, "encode_counts",
                        lambda t, p: (seen.append(t.count()), real(t, p))[1])
    cache = f"{workdir}/cache"
    df = spark.createDataFrame([(1, "a b"), (2, "A  b\n"), (3, "c"), (None, "c"), (3, None)],
                               "doc_id bigint, text string").withColumn("digest", F.lit("d"))
    rows = lambda d: sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in
                             count_tokens(d, WORD, cache).collect()), key=repr)
    first = rows(df)
    assert first == sorted([(1, 3, 2), (2, 5, 2), (3, 1, 1), (None, 1, 1), (3, 0, 0)], key=repr)
    assert rows(df) == first
    more = df.unionByName(spark.createDataFrame([(9, "new", "")], "doc_id bigint, text string, digest string"))
    assert (9, 3, 1) in rows(more)
    assert seen == [3, 0, 1]
    # another tokenizer shares the folder, not the counts
    byte = public_tokenizers.path("byte_bpe_50k.json")
    assert tokenizer_version(byte) != tokenizer_version(WORD)
    assert count_tokens(df, byte, cache).count() == 5 and seen[-1] == 4


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert count_tokens(empty, WORD).count() == 0


@pytest.mark.parametrize("path,same", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_normalisation_is_only_for_tokenizers_that_allow_it(spark, path, same):
    df = spark.createDataFrame([("A  b",), ("a b",)], "t string").select(
        token_counts.normalised(F.col("t"), public_tokenizers.path(path)).alias("n"))
    assert (len({r.n for r in df.collect()}) == 1) is same
