"""Connected components of an edge table, and union-find for small arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.session import checkpoint_dir

EDGE_SCHEMA = "a bigint, b bigint"


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) that connect exactly
    what the edges (a[i], b[i]) connect; at most one edge per node."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[:len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:  # min-label hooking with pointer jumping
        lo = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], lo)
        np.minimum.at(new, root[y], lo)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _local_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    a = b = np.empty(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, batch["a"].to_numpy(np.int64)])
        b = np.concatenate([b, batch["b"].to_numpy(np.int64)])
        a, b = spanning_forest(a, b)
    yield pd.DataFrame({"a": a, "b": b})


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` of bigint nodes -> ``(node, root)`` for every node that
    has an edge to another node; ``root`` is the smallest node it reaches.

    Each partition first reduces its edges to a spanning forest, then large-star
    and small-star steps alternate until nothing moves.  Every step is
    checkpointed in ``spark.checkpoint.dir``.  Self-loops, repeated edges and an
    empty table are fine; edges with a null end are ignored.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    e = (edges.where("a is not null and b is not null and a != b")
         .select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
         .mapInPandas(_local_forest, EDGE_SCHEMA)
         .distinct().checkpoint())
    seen = _summary(e)
    while seen[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # checkpointed, so that the join below can split a hub's rows
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")).checkpoint()
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .distinct())
        # rows of a node are few now: one for each smaller neighbour's minimum
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.collect_set("b").alias("bs"))
        e = (least.select(F.explode(F.transform("bs", lambda b: F.struct(
                F.when(b == F.col("m"), F.col("a")).otherwise(b).alias("a"),
                F.col("m").alias("b")))).alias("x"))
             .select("x.a", "x.b").distinct().checkpoint())
        now = _summary(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _summary(e: DataFrame) -> tuple:
    row = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
