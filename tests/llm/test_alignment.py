import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from spendlens.llm import alignment
from spendlens.llm.alignment import align_and_score, merge, pack, unpack

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts():
    r = random.Random(11)
    odd = [None, "", " ", "\n", "a", "  a  b ", "▁x", "<|endoftext|>", "</s><0x41>", "日本語😀é",
           "naïve ﬁne ½", "x" * 5000, "\x00\x01", " \xa0  ", "word " * 3000, "<unk> é̄"]
    pools = ["abc de. ", "éàß ñ'", "12 ,.-", "日本語 ", "😀a "]
    return odd + ["".join(r.choice(p) for _ in range(r.randrange(80))) for p in pools for _ in range(60)]


def plain(rows):
    """The contract, token by token."""
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    side = alignment.side(A)
    docs = []
    for doc_id, text in rows:
        doc = {"doc_id": doc_id, "n_a": 0, "n_b": 0, "groups": [], "links": []}
        docs.append(doc)
        if not text:
            continue
        a = tok.encode(" " + text, add_special_tokens=False).ids
        b = sp.encode(text)
        b_bytes = [bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i)
                   else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        want = (" " + text).encode()
        if b"".join(side.bytes[i] for i in a) != want or b"".join(b_bytes) != want:
            continue
        def spans(ids, parts):
            at, out = 0, []
            for i, p in zip(ids, parts):
                out.append((i, at, at + len(p)))
                at += len(p)
            return out
        sa, sb = spans(a, [side.bytes[i] for i in a]), spans(b, b_bytes)
        j0 = 0
        for i, s, e in sa:
            while sb[j0][2] <= s:
                j0 += 1
            for j, t, f in sb[j0:]:
                if t >= e:
                    break
                doc["links"].append((i, j))
        cuts = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
        start = 0
        ia = ib = 0
        for c in cuts:
            ga, gb = [], []
            while ia < len(sa) and sa[ia][2] <= c:
                ga.append(sa[ia][0])
                ia += 1
            while ib < len(sb) and sb[ib][2] <= c:
                gb.append(sb[ib][0])
                ib += 1
            doc["groups"].append((ga, gb))
            start = c
        assert start == len(want)
        doc["n_a"], doc["n_b"] = len(a), len(b)
    count = Counter(p for d in docs for p in set(d["links"]))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for d in docs:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in d["groups"])
        out.append((d["doc_id"], d["n_a"], d["n_b"], len(d["groups"]), len(d["links"]),
                    sum(count[p] == top[p[0]] for p in d["links"]), sum(count[p] for p in d["links"]),
                    hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def key(row):
    return tuple((x is None, x) for x in row)


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=key)


def test_equals_the_plain_version(spark):
    rows = list(enumerate(texts())) + [(None, "of the"), (3, "of the"), (3, "of the")]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows],
                               "doc_id long, text string, row string, n_a int, pairs int")
    assert rows_of(align_and_score(df.repartition(5), A, B)) == sorted(plain(rows), key=key)


def test_batches_that_span_files_of_several_tasks(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # more small files than cores: a task of the scoring reads several of them
    assert rows_of(align_and_score(df.repartition(40), A, B)) == sorted(plain(rows), key=key)


def test_small_lanes_portions_and_blocks_give_the_same(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(texts()) if i % 3 == 0]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    short = alignment.align(df, A, B, lane=3, chars=50)
    whole = alignment.align(df, A, B)
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"]
    assert sorted(short.select(cols).collect()) == sorted(whole.select(cols).collect())
    monkeypatch.setattr(alignment, "TILE", 300)
    aligned = alignment.materialise(whole, "test-alignment")
    wide = len(alignment.side(B).bytes)
    few = alignment.score_links(aligned, wide, block=40).select("doc_id", "n_best", "count_sum")
    assert sorted(few.collect()) == sorted((r[0], r[5], r[6]) for r in plain(rows))


def test_merge_parts_long_documents():
    r = random.Random(4)
    n = 100_000
    cut = np.unique([r.randrange(1, n) for _ in range(n // 3)] + [n])
    ends_a = np.unique(np.concatenate([cut[::2], [n]]))
    ends_b = np.unique(np.concatenate([cut[::3], [n]]))
    off = [np.array([0, e.size]) for e in (ends_a, ends_b)]
    one = merge(ends_a, ends_b, *off, lane=10 ** 9)
    many = merge(ends_a, ends_b, *off, lane=50)
    for x, y in zip(one, many):
        assert np.array_equal(np.sort(x), np.sort(y))
    assert np.array_equal(np.sort(ends_a[one[2]]), np.intersect1d(ends_a, ends_b))


def test_pack_round_trip():
    docs = np.array([0, 0, 3, 3, 7])
    codes = np.array([5, 70_000, 0, 2 ** 31, 12])
    times = np.array([1, 300, 2, 1, 70_000])
    for x, y in zip(unpack(pack(docs, codes, times, 32_000), 32_000), (docs, codes, times)):
        assert np.array_equal(x, y)
    assert all(p.size == 0 for p in unpack(pack(0, codes[:0], times[:0], 9), 9))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align_and_score(df, A, B).collect() == []
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert rows_of(align_and_score(df, A, B)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
