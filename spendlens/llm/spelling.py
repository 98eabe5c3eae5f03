"""Spelling variants by a dictionary of trie-node pairs.

Every prefix of a word is a node of the forward trie, every suffix a node of the
reversed trie; nodes are numbered, so a prefix or suffix of any length is one
integer.  A word with its code point i *skipped* is the pair (node before i, node
after i); a word *split* at i, where a code point may be inserted, is the pair
(node before i, node from i).  Two words with an equal skip pair differ by one
replaced code point; a word whose skip pair equals another's split pair is that
one with one code point inserted.  Nothing else is near, so joining the pairs
gives exactly the words that differ by one inserted, deleted or replaced code
point, and no pair of words has to be compared.

A pair's words differ in one code point only, so a group of the join holds at
most one word for each letter of the alphabet, and one that splits there.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import materialise

#: Nodes deeper than so many code points are named by a 128-bit digest of their string,
#: so that a word's node names take space in proportion to its length, not to its square.
DEEP = 48
SPLIT, SKIP, SKIP_FIRST = 0, 1, 2  # the last: not the same code point as the one before
_PAIR = "p bigint, s bigint, kind tinyint, n bigint, w bigint"


def node_names(word: str) -> list[str]:
    """Names of the nodes on a word's path in its trie, at depth 1, 2 and so on."""
    names = [word[:i] for i in range(1, min(len(word), DEEP) + 1)]
    if len(word) > DEEP:
        state = hashlib.blake2b(word[:DEEP].encode(), digest_size=16)
        for c in word[DEEP:]:
            state.update(c.encode())
            names.append("\0" + state.hexdigest())
    return names


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (w, at, name): depth in the forward trie, below zero in the reversed one."""
    for batch in batches:
        w, at, name = [], [], []
        for i, word in zip(batch.column("w").to_pylist(), batch.column("word").to_pylist()):
            path = ["f" + x for x in node_names(word)] + ["r" + x for x in node_names(word[::-1])]
            w += [i] * len(path)
            at += [*range(1, len(word) + 1), *range(-1, -len(word) - 1, -1)]
            name += path
            if len(name) > 1 << 18:
                yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(at, pa.int32()), pa.array(name)],
                                                 names=["w", "at", "name"])
                w, at, name = [], [], []
        yield pa.RecordBatch.from_arrays(
            [pa.array(w, pa.int64()), pa.array(at, pa.int32()), pa.array(name, pa.string())],
            names=["w", "at", "name"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The skip and split pairs of words, from (w, word, n, path: at and node)."""
    kinds = (pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.int64())
    for batch in batches:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=["p", "s", "kind", "n", "w"])

        cols = (batch.column(c).to_pylist() for c in ("w", "word", "n", "path"))
        for w, word, n, path in zip(*cols):
            # the roots are nodes of both tries, 0; other nodes are numbered from 1
            node = {x["at"]: x["node"] for x in path} | {0: 0}
            end = len(word)
            for i in range(end + 1):
                p = node.get(i)
                if p is None:  # no other word has this prefix, nor any longer one
                    break
                s = node.get(i - end)
                if s is not None:
                    out.append((p, s, SPLIT, n, w))
                s = node.get(i + 1 - end) if i < end else None
                if s is not None:
                    out.append((p, s, SKIP_FIRST if i == 0 or word[i] != word[i - 1] else SKIP, n, w))
            if len(out) > 1 << 17:
                yield flush()
                out.clear()
        yield flush()


def number_words(words: DataFrame) -> DataFrame:
    """``(w, word, n)``, stored; ``w`` ascends with the words' code-point order."""
    return materialise(words.select("word", "n").orderBy("word")
                       .select(F.monotonically_increasing_id().alias("w"), "word",
                               F.col("n").cast("bigint").alias("n")), "spelling-words")


def near_words(numbered: DataFrame) -> DataFrame:
    """``(w, n_near, best)`` for words with near words: how many, and of these the one of
    largest n (ties: smallest in code-point order) as ``best.w`` and ``-best.less``."""
    names = materialise(numbered.select("w", "word").mapInArrow(_names, "w bigint, at int, name string"),
                        "spelling-names")
    # a node that one word alone has stands in no two words' pairs
    nodes = materialise(names.groupBy("name").agg(F.count("*").alias("words")).where("words > 1")
                        .select("name", (F.monotonically_increasing_id() + 1).alias("node")),
                        "spelling-nodes")
    paths = (names.join(nodes, "name").groupBy("w")
             .agg(F.collect_list(F.struct("at", "node")).alias("path")))
    pairs = numbered.join(paths, "w").select("w", "word", "n", "path").mapInArrow(_pairs, _PAIR)
    # at most one word for each letter, and one that splits there
    groups = (pairs.groupBy("p", "s")
              .agg(F.collect_list(F.struct((-F.col("n")).alias("less"), "w", "kind")).alias("m"))
              .where("size(m) > 1")
              .select("m", F.array_sort(F.filter("m", lambda x: x["kind"] != SPLIT)).alias("skip"))
              .select("m", "skip", F.filter("skip", lambda x: x["kind"] == SKIP_FIRST).alias("first"),
                      F.filter("m", lambda x: x["kind"] == SPLIT).alias("split")))

    def rank(x: Column) -> Column:
        return F.struct(x["less"].alias("less"), x["w"].alias("w"))

    x, other = F.col("x"), F.get("skip", F.lit(0))
    other = F.when(other["w"] == x["w"], F.get("skip", F.lit(1))).otherwise(other)
    each = groups.select("skip", "first", "split", F.explode("m").alias("x")).select(
        x["w"].alias("w"),
        F.when(x["kind"] == SPLIT, F.size("first"))
        .otherwise(F.size("skip") - 1 + F.when(x["kind"] == SKIP_FIRST, F.size("split")).otherwise(0))
        .alias("near"),
        F.when(x["kind"] == SPLIT, rank(F.get("first", F.lit(0))))
        .when(x["kind"] == SKIP, rank(other))
        .otherwise(F.array_min(F.filter(F.array(rank(other), rank(F.get("split", F.lit(0)))),
                                        lambda r: r["w"].isNotNull()))).alias("best"))
    return (each.where("near > 0").groupBy("w")
            .agg(F.sum("near").alias("n_near"), F.min("best").alias("best")))


def variant_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for distinct words with their counts.

    ``n_near``: words that differ by one inserted, deleted or replaced code point.  A
    word's form is its near word of largest n (ties: smallest in code-point order), if
    that n is ``ratio`` times the word's own or more; ``root`` follows forms to the last,
    the word itself if it has none.  ``words`` are distinct, not null and not empty, n
    positive; other columns are not looked at; an empty table gives an empty one.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, or forms could run in circles")
    numbered = number_words(words)
    near = near_words(numbered).select("w", "n_near", F.col("best.w").alias("f"),
                                       (-F.col("best.less")).alias("form_n"))
    found = materialise(
        numbered.join(near, "w", "left")
        .withColumn("has", F.coalesce(F.col("form_n") >= F.col("n") * ratio, F.lit(False)))
        .select("w", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                F.when(F.col("has"), F.col("f")).alias("f"),
                F.when(F.col("has"), F.col("form_n")).alias("form_n")), "spelling-forms")
    roots = found.where("f is not null").select("w", F.col("f").alias("root"))
    span = found.agg(F.max("n").alias("a"), F.min("n").alias("b")).first()
    hops = math.floor(math.log(span["a"] / span["b"], ratio)) + 1 if span["a"] else 0
    for _ in range(math.ceil(math.log2(hops)) if hops > 1 else 0):  # each doubles the hops
        roots = materialise(roots, "spelling-roots")
        ahead = roots.select(F.col("w").alias("at"), F.col("root").alias("next"))
        roots = (roots.join(ahead, F.col("root") == F.col("at"), "left")
                 .select("w", F.coalesce("next", "root").alias("root")))
    names = found.select(F.col("w").alias("at"), F.col("word").alias("name"))
    named = (roots.join(found.select("w", "f"), "w")
             .join(names.select(F.col("at").alias("f"), F.col("name").alias("form")), "f")
             .join(names.select(F.col("at").alias("root"), F.col("name").alias("last")), "root")
             .select("w", "form", "last"))
    return (found.join(named, "w", "left")
            .select("word", "form", F.coalesce("last", "word").alias("root"), "n",
                    F.col("n_near").cast("bigint").alias("n_near"), "form_n"))


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6,
                fewest: int = 5, slip: int = 199) -> DataFrame:
    """``(word, n)``: words of at least ``shortest`` code points that occur ``fewest`` times.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF in a whole text, A-Z
    lower-cased.  Slips are planted: where ``slip`` divides the crc32 of
    ``<id>:<word>`` (a null id: nothing before the colon), its code point at that
    number modulo its length is left out.  Null texts have no words; repeated rows count.
    """
    capitals = "".join(map(chr, range(65, 91)))
    word = F.col("word")
    # a shorter run makes no word; a match can't begin inside a run
    runs = F.regexp_extract_all(F.col("t"), F.lit(f"[A-Za-zÀ-ÿ]{{{shortest},}}"), F.lit(0))
    rows = (docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"),
                        F.col(text_col).alias("t"))
            .select("i", F.explode(runs).alias("word"))
            .select("i", F.translate(word, capitals, capitals.lower()).alias("word"))
            .withColumn("h", F.crc32(F.concat("i", F.lit(":"), "word")))
            .select(F.when(F.col("h") % slip != 0, word).otherwise(F.concat(
                F.substr(word, F.lit(1), (F.col("h") % F.char_length("word")).cast("int")),
                F.substr(word, (F.col("h") % F.char_length("word")).cast("int") + 2))).alias("word")))
    return (rows.where(F.char_length("word") >= shortest).groupBy("word")
            .agg(F.count("*").alias("n")).where(F.col("n") >= fewest))
