"""SimHash near-duplicates by tiled exact comparison.

A document's fingerprint takes a majority vote, bit by bit, over the XXH64
hashes of its word shingles.  Distinct fingerprints are cut into tiles of equal
*population signature* (the number of set bits in each of ``blocks`` equal parts
of the fingerprint).  The Hamming distance of two fingerprints is at least the
sum of the differences of their signatures, so only tile pairs whose signatures
differ by the radius or less are compared; those are compared exactly, with
numpy exclusive-or and bit counts.  Nothing is missed.

A tile pair yields a spanning forest of its links, not the links themselves, so
a large group of near copies costs rows in proportion to its size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import materialise, unused
from spendlens.llm.components import EDGE_SCHEMA, connected_components, spanning_forest

SEED = 42
#: Shingles voted on at a time; bounds the memory a very long text takes.
VOTES = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash, unsigned.  A-Z is lower-cased; words are runs without
    ASCII white space; a text of fewer words than ``shingle`` has one shingle,
    the whole word sequence; null, empty and blank texts give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    starts = starts[:n].tolist()
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, VOTES):
        part = np.array([digest(joined[s:e], SEED) for s, e in
                         zip(starts[at:at + VOTES], ends[at:at + VOTES])], np.uint64)
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)``: one row per input row, ``fp`` the signed 64-bit fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64))],
                names=["doc_id", "fp"])

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id bigint, fp bigint"))


def _signature(fp: Column, blocks: int) -> list[Column]:
    width = 64 // blocks
    return [F.bit_count(F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1)))
            if blocks > 1 else F.bit_count(fp) for i in range(blocks)]


def _steps(blocks: int, radius: int) -> list[tuple[int, ...]]:
    """Signature differences of sum ``radius`` or less, one of each opposite two."""
    return [d for d in itertools.product(range(-radius, radius + 1), repeat=blocks)
            if sum(map(abs, d)) <= radius and d >= (0,) * blocks]


def _compare(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for xs, ys, same in zip(batch["xs"], batch["ys"], batch["same"]):
                x, y = np.asarray(xs, np.int64), np.asarray(ys, np.int64)
                near = np.bitwise_count(x[:, None].view(np.uint64) ^ y.view(np.uint64)) <= radius
                if same:
                    near = np.triu(near, 1)
                i, j = np.nonzero(near)
                if len(i):
                    a, b = spanning_forest(x[i], y[j])
                    left.append(a)
                    right.append(b)
            yield pd.DataFrame({"a": np.concatenate(left), "b": np.concatenate(right)})

    return run


def near_fingerprints(fps: DataFrame, radius: int = 2, blocks: int = 4,
                      tile: int = 512) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints within ``radius`` bits.

    ``fps``: one column ``fp``, distinct.  ``tile`` bounds a tile's rows (in the
    mean: rows go to a signature's tiles by hash), not what is compared: a
    signature with more fingerprints gets more tiles, all pairs of them compared.
    """
    sig = _signature(F.col("fp"), blocks)
    base = 64 // blocks + 1 + 2 * radius  # shifted by the radius, no step leaves the range

    def code(parts: list[Column]) -> Column:
        out = F.lit(0).cast("bigint")
        for p in parts:
            out = out * base + p + radius
        return out

    fps = fps.withColumn("sig", code(sig))
    # at most (64 / blocks + 1) ^ blocks rows: 83,521 for four blocks
    sizes = fps.groupBy("sig").agg(F.count("*").alias("n"))
    sizes = F.broadcast(sizes) if (64 // blocks + 1) ** blocks <= 100_000 else sizes
    tiles = materialise(
        fps.join(sizes, "sig")
        .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / tile)))
        .groupBy("sig", "chunk").agg(F.collect_list("fp").alias("xs")), "simhash-tiles")
    steps = [sum(s * base ** (blocks - 1 - i) for i, s in enumerate(d))
             for d in _steps(blocks, radius)]
    left = tiles.select(F.col("sig").alias("lsig"), F.col("chunk").alias("lchunk"), "xs",
                        F.explode(F.array(*[F.col("sig") + s for s in steps])).alias("sig"))
    right = tiles.select("sig", "chunk", F.col("xs").alias("ys"))
    pairs = (left.join(right, "sig")
             .where("lsig != sig or lchunk <= chunk")
             .select("xs", "ys", (F.expr("lsig = sig and lchunk = chunk")).alias("same")))
    return pairs.mapInPandas(_compare(radius), EDGE_SCHEMA)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, radius: int = 2, blocks: int = 4,
                       tile: int = 512) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    Two rows are linked when their fingerprints differ in ``radius`` bits or
    fewer; ``component_id`` is the smallest ``doc_id`` reachable by links, the
    row's own included.  Null and empty texts have fingerprint 0 and are linked
    like any other; repeated ids keep their rows; a row with a null id gets a
    fingerprint and the component of its group (null if the group has no id);
    other columns are not looked at; an empty table gives an empty table.
    """
    rows = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-class")
    roots = connected_components(
        near_fingerprints(classes.select("fp"), radius, blocks, tile))
    linked = (classes.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    ids = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    # a table of its own, so that the last join's sides are plain shuffles that
    # Spark can split where one fingerprint has many rows
    named = materialise(linked.join(ids, "root").select("fp", "component_id"), "simhash-named")
    return (rows.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Rows of ``docs`` whose id is their component's smallest; all columns kept.
    Of rows that repeat an id, all or none stay; rows with a null id stay."""
    found = simhash_components(docs, id_col, **options)
    (mark,) = unused(docs, "kept")
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(mark)).distinct()
    return (docs.join(kept, F.col(id_col) == F.col(mark), "left")
            .where(F.col(mark).isNotNull() | F.col(id_col).isNull())
            .drop(mark))
