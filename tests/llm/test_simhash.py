import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spendlens.llm.components import connected_components, spanning_forest
from spendlens.llm.simhash import fingerprint, keep_first, near_fingerprints, simhash_components


def brute_components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def test_fingerprint_matches_plain_version():
    r = random.Random(3)
    texts = ["", " \n\t ", None, "one", "One two", "ÀB c d", "a b c\x1cd e f"]
    texts += [" ".join(r.choice(["a", "B", "cé", "dd", "\n"]) for _ in range(r.randrange(40)))
              for _ in range(60)]
    for t in texts:
        assert fingerprint(t) == plain_fingerprint(t), t
    long = "x y z w " * 40_000
    assert fingerprint(long) == plain_fingerprint(long[:-1])


def test_spanning_forest_is_a_star_per_component():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 300, 200), r.integers(0, 300, 200)
    x, y = spanning_forest(a, b)
    want = brute_components(range(300), zip(a.tolist(), b.tolist()))
    assert dict(zip(x.tolist(), y.tolist())) == {k: v for k, v in want.items() if k != v}


def test_components_path_star_and_empty(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    edges = spark.createDataFrame(path + star + [(7, 7), (None, 3)], "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(edges.repartition(8)).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 50)}}
    assert connected_components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("blocks,tile", [(4, 512), (2, 7), (1, 5)])
def test_near_fingerprints_against_all_pairs(spark, blocks, tile):
    r = random.Random(5)
    fps = {0, (1 << 64) - 1, 1, 3, 1 << 63}
    for _ in range(60):
        x = r.getrandbits(64)
        fps |= {x, x ^ 1 << r.randrange(64), x ^ 5 << r.randrange(60), x ^ 0b10101}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = near_fingerprints(spark.createDataFrame([(s,) for s in signed], "fp bigint"),
                              2, blocks, tile)
    want = brute_components(signed, [(a, b) for i, a in enumerate(signed) for b in signed[:i]
                                     if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2])
    got = {x.node: x.root for x in connected_components(edges).collect()}
    assert {s: got.get(s, s) for s in signed} == want


def test_simhash_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fp = {i: plain_fingerprint(t) for i, t in rows}
    want = brute_components(sorted(fp), [(a, b) for a in fp for b in fp if a < b
                                         and (fp[a] ^ fp[b]).bit_count() <= 2])
    got = simhash_components(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{f:016x}" for i, f in fp.items()}
    assert len(got) == len(rows)


def test_simhash_odd_rows(spark):
    rows = [(5, None, "x"), (3, "", "y"), (9, " \n", None), (4, "a b c d", "fp"), (4, "a b c d", "r"),
            (None, "a b c d", None), (8, "quite another text here", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash_components(docs).collect())
    assert got == [(-1, 4), (3, 3), (4, 4), (4, 4), (5, 3), (8, 8), (9, 3)]
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 4, 4, 8]
    assert simhash_components(docs.limit(0)).count() == 0
    extra = docs.withColumn("component_id", F.lit("c")).withColumn("first", F.lit(1))
    assert simhash_components(extra).count() == 7


def test_keep_first_with_a_clashing_column(spark):
    rows = [(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, "quite another text here", "z"), (None, "a", "n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _kept string").withColumn("_KEPT_", F.lit(1))
    from spendlens.llm.simhash import keep_first

    got = keep_first(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r["_kept"]) for r in got.collect()), key=str) == [(1, "x"), (3, "z"), (None, "n")]
