import random
import re
import zlib
from collections import Counter

from spendlens.llm import spelling
from spendlens.llm.spelling import count_words, variant_groups


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def plain(words, ratio=5):
    form = {}
    out = {}
    for w, n in words.items():
        others = sorted(((-m, v) for v, m in words.items() if near(w, v)))
        if others and -others[0][0] >= ratio * n:
            form[w] = others[0][1]
        out[w] = [len(others)]
    rows = []
    for w, n in words.items():
        last = w
        while last in form:
            last = form[last]
        rows.append((w, form.get(w), last, n, out[w][0], words[form[w]] if w in form else None))
    return sorted(rows)


def groups(spark, words, **options):
    df = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, w string")
    return sorted(map(tuple, variant_groups(df.repartition(3), **options).collect()))


def test_equals_brute_force(spark):
    r = random.Random(5)
    words = {"".join(r.choice("abé") for _ in range(r.randrange(1, 6))): r.choice([1, 1, 5, 5, 30, 200, 2000])
             for _ in range(220)}
    assert groups(spark, words) == plain(words)
    assert groups(spark, words, ratio=2) == plain(words, 2)


def test_runs_of_one_letter_ties_and_chains(spark):
    words = {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "aaaaaaaaa": 625, "baaaaa": 25, "aaaaab": 25,
             "lonely": 9, "àààààà": 5, "abcdef": 7, "abdcef": 99}
    assert groups(spark, words) == plain(words)


def test_words_deeper_than_the_named_nodes(spark, monkeypatch):
    long = "xy" * 3000
    words = {long: 5, long + "z": 30, long[:-1]: 7, long[:2000] + "q" + long[2001:]: 6, "q" + long: 300}
    assert groups(spark, words) == plain(words)
    monkeypatch.setattr(spelling, "DEEP", 2)
    r = random.Random(6)
    names = [spelling.node_names(w) for w in ("abcd", "abce", "abcd")]
    assert names[0] == names[2] and names[0][:3] == names[1][:3] and names[0][3] != names[1][3]
    del r


def plain_words(rows, shortest=6, fewest=5, slip=199):
    count = Counter()
    lower = {i: i + 32 for i in range(65, 91)}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % slip == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            count[w] += 1
    return {w: n for w, n in count.items() if len(w) >= shortest and n >= fewest}


def test_words_of_texts(spark):
    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdeÉé×ÿZ") for _ in range(r.randrange(4, 10))) for _ in range(60)]
    rows = [(i, " ,.-😀1_".join(r.choice(vocabulary) for _ in range(60))) for i in range(80)]
    rows += [(None, "abcdefg " * 9), (1, None), (2, ""), (7, "Straße straße STRASSE Łódźabcdef " * 6),
             (8, "y" * 100_000)] + [(9, "y" * 100_000)] * 5
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in rows],
                               "doc_id long, text string, word string, n int")
    for slip in (199, 3):
        got = {x["word"]: x["n"] for x in count_words(df, slip=slip).collect()}
        assert got == plain_words(rows, slip=slip)


def test_whole_table_against_deletion_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = plain_words([(x["doc_id"], x["text"]) for x in docs.collect()])
    rests = {}
    for w in words:
        for i in range(len(w)):
            rests.setdefault((w[:i] + w[i + 1:]), set()).add(w)
    linked = {w: set() for w in words}
    for rest, own in rests.items():
        for w in own | ({rest} if rest in words else set()):
            linked[w] |= {v for v in own | ({rest} if rest in words else set()) if near(w, v)}
    got = {x["word"]: x for x in variant_groups(count_words(docs)).collect()}
    assert {w: x["n"] for w, x in got.items()} == words
    assert {w: x["n_near"] for w, x in got.items()} == {w: len(v) for w, v in linked.items()}
    for w, x in got.items():
        best = min(((-words[v], v) for v in linked[w]), default=(0, None))
        want = best[1] if -best[0] >= 5 * words[w] else None
        assert (x["form"], x["form_n"]) == (want, words.get(want))
        assert x["root"] == (got[want]["root"] if want else w)


def test_empty_tables(spark):
    assert variant_groups(spark.createDataFrame([], "word string, n long")).collect() == []
    assert count_words(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect() == []
