import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from spendlens.llm import iblt
from spendlens.llm.iblt import (compare_texts, difference, digests, fingerprint, fingerprint_edits,
                                peel, sketch, subtract, with_next)


def paragraphs(text):
    out = set()
    for p in re.split(iblt.PARAGRAPH_END, text or ""):
        if len(p) > iblt.RUN:
            first, *rest = re.split(iblt.RUN_END, p[iblt.RUN:])
            for q in [p[:iblt.RUN] + first, *rest]:
                out |= {q[k:k + iblt.LONGEST] for k in range(0, len(q), iblt.LONGEST)}
        else:
            out.add(p)
    return {p for p in out if p.strip(" ")}


def plain_likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def sets(spark, rows):
    return spark.createDataFrame(rows, "i int, a array<bigint>, b array<bigint>")


def test_subtract_and_peel(spark):
    r = random.Random(1)
    rows = []
    for i in range(60):
        both = [r.getrandbits(63) for _ in range(r.randrange(25))]
        rows.append((i, both + [r.getrandbits(63) for _ in range(r.randrange(4))],
                     [-r.getrandbits(63) for _ in range(r.randrange(4))] + both))
    df = sets(spark, rows)
    got = df.select("i", peel(subtract(sketch(F.col("a"), 36), sketch(F.col("b"), 36)), 36).alias("d"),
                    peel(subtract(sketch(F.col("a"), 12), sketch(F.col("b"), 12)), 12).alias("small")
                    ).collect()
    peeled = 0
    for x in got:
        want = {(d, 1) for d in set(rows[x.i][1]) - set(rows[x.i][2])}
        want |= {(d, -1) for d in set(rows[x.i][2]) - set(rows[x.i][1])}
        for d in (x.d, x.small):
            assert d is None or sorted(map(tuple, d)) == sorted(want)
        peeled += x.d is not None
    assert peeled >= 55
    # too many differences for 12 cells: failure is seen, not guessed
    full = sets(spark, [(0, list(range(1, 40)), [])])
    assert full.select(peel(subtract(sketch(F.col("a"), 12), sketch(F.col("b"), 12)), 12)).first()[0] is None


@pytest.mark.parametrize("levels", [iblt.RETRIES, (2,), (1,)])
def test_difference_retries_until_exact(spark, levels):
    r = random.Random(2)
    rows = []
    for i, (same, only) in enumerate([(0, 0), (5, 1), (30, 3), (10, 25), (0, 60), (300, 40), (40, 0)]):
        both = [r.getrandbits(62) for _ in range(same)]
        rows.append((i, both + [r.getrandbits(62) for _ in range(only)],
                     [r.getrandbits(62) for _ in range(only // 2)] + both))
    for x in sets(spark, rows).select("i", "a", "b", difference(F.col("a"), F.col("b"), retries=levels)
                                      .alias("d")).collect():
        want = {(d, 1) for d in set(x.a) - set(x.b)} | {(d, -1) for d in set(x.b) - set(x.a)}
        assert sorted(map(tuple, x.d)) == sorted(want), x.i


def test_fingerprints_follow_the_set(spark):
    df = spark.createDataFrame([("a\nb.\nc",), ("b.\nc\n \na\na",), ("a\nb",), ("",), (None,)], "t string")
    f = [r[0] for r in df.select(fingerprint(sketch(digests(F.col("t")), iblt.CELLS))).collect()]
    assert f[0] == f[1] != f[2] and f[3] == f[4] and len({*f}) == 3


def test_stored_fingerprints_subtract(spark):
    r = random.Random(8)
    rows = []
    for i in range(40):
        both = [f"line {r.random()}" for _ in range(r.randrange(200))]
        rows.append(("\n".join(both), "\n".join(both + [f"more {r.random()}" for _ in range(r.randrange(3))])))
    df = spark.createDataFrame(rows, "o string, n string")
    small = lambda c: sketch(digests(F.col(c)), iblt.CELLS)
    got = df.select("o", "n", fingerprint(small("o")).alias("f"), fingerprint(small("n")).alias("g"))
    got = got.select("o", "n", peel(subtract(iblt.cells_of(F.col("f")), iblt.cells_of(F.col("g"))),
                                    iblt.CELLS).alias("d")).collect()
    for x in got:
        new = set(x.n.split("\n")) - set(x.o.split("\n")) - {""}
        assert x.d is not None and len(x.d) >= len(new) and all(e.sign == -1 for e in x.d if x.o)


def test_a_text_of_many_paragraphs_is_linear(spark):
    import time

    r = random.Random(9)
    lines = [f"{r.random()}" for _ in range(100_000)]
    other = [f"{r.random()}" for _ in range(100_000)]
    rows = [("\n".join(lines), "\n".join(lines[:75_000] + other[:25_000])), ("\n".join(lines), "\n".join(other))]
    df = spark.createDataFrame(rows, "o string, n string").repartition(2)
    began = time.time()
    got = sorted((len(x.removed), len(x.added)) for x in compare_texts(df, "o", "n").collect())
    assert got == [(25_000, 25_000), (100_000, 100_000)] and time.time() - began < 120


def test_compare_texts(spark):
    df = spark.createDataFrame([("x\ny.\nz", "x\nq", 1), (None, "", 2), ("x", None, 3)],
                               "o string, n string, likeness int")
    for c in ("_a", "_b", "_d", "_A_"):
        df = df.withColumn(c, F.lit(c))
    assert [c for c in df.columns if c != "likeness"] == [
        c for c in compare_texts(df, "o", "n").columns if c not in ("removed", "added", "likeness")]
    got = compare_texts(df, "o", "n").collect()
    assert all(r["_a"] == "_a" and r["_b"] == "_b" and r["_d"] == "_d" for r in got)
    assert [(len(r.removed), len(r.added), r.likeness) for r in got] == [(2, 1, 0.25), (0, 0, 1.0), (1, 0, 0.0)]


@pytest.mark.parametrize("ids", [range(300), [0] * 150 + [5] * 3 + [2**62, -(2**62), None, None],
                                 [i * i * i for i in range(120)]])
@pytest.mark.parametrize("in_range", [10, 1000])
def test_next(spark, ids, in_range):
    rows = [(i, f"t{k:04d}") for k, i in enumerate(ids)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = {r[1]: order[(k + 1) % len(order)][1] for k, r in enumerate(order)}
    got = with_next(df, "doc_id", "text", in_range, 8)
    assert {r.text: r.next for r in got.collect()} == want


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + nxt[:cut]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(),
                    round(plain_likeness(t, edited), 9), round(plain_likeness(t, nxt), 9)))
    return sorted(out, key=repr)


def actual(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))
                   for r in df.collect()), key=repr)


def test_table_against_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = fingerprint_edits(docs)
    assert actual(got) == expected([(r.doc_id, r.text) for r in docs.collect()])
    rows = got.collect()
    assert sum(r.near_edited for r in rows) > 2 * sum(r.near_next for r in rows)
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().toString())


def test_odd_rows(spark):
    rows = [(3, None), (1, "é😀é😀\nab"), (1, "x"), (None, "a. b. c"), (2, ""), (9, "same"), (9, "same"),
            (5, "\n".join(f"line {i}" for i in range(1500)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("next", F.lit("n")).withColumn(
        "n", F.lit(1))
    assert actual(fingerprint_edits(df)) == expected(rows)
    assert fingerprint_edits(df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "abcdefgh")], "doc_id bigint, text string")
    assert actual(fingerprint_edits(one)) == expected([(1, "abcdefgh")])


def test_an_edit_of_one_line_keeps_its_likeness(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghiklmnoprstuvwy") for _ in range(r.randrange(2, 9)))
    say = lambda n: " ".join(word() for _ in range(n))
    lines = [" ".join(f"{say(8)}." for _ in range(40)), say(600),
             "".join(r.choice("0123456789abcdef") for _ in range(6000)),
             "".join(chr(r.randrange(0x4e00, 0x9fff)) for _ in range(4000)), "ab" * 20_000,
             "".join(r.choice("\U0001f600\u00e9gkqw") for _ in range(3000))]
    rows = [(t, t[:len(t) // 2] + "@#" + t[len(t) // 2 + 2:]) for t in lines]
    got = compare_texts(spark.createDataFrame(rows, "o string, n string"), "o", "n").collect()
    like = {lines.index(x.o): x.likeness for x in got}
    assert all(like[i] > 0.8 for i in (0, 1, 2, 3, 5)) and like[4] >= 0.25, like
    assert all(len(x.removed) <= 4 and len(x.added) <= 4 for x in got)


def test_paragraphs_are_the_same_in_java_and_python(spark):
    r = random.Random(7)
    pools = ["abgyqz 0123 ", "gkq. !?\"')", "\u65e5\u672c\u3002\uff01\u4e00\u4e01", "\u00e9\U0001f600gk", "abc\n g."]
    texts = ["".join(r.choice(r.choice(pools[k % 5:k % 5 + 1] * 3 + pools[:1])) for _ in range(r.randrange(900)))
             for k in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for x in df.select("t", F.size(digests(F.col("t"))).alias("n")).collect():
        assert x.n == len(paragraphs(x.t))
