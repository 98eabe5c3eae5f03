"""Near-duplicate vectors through a pivot-permutation index.

Each vector is described by its ``prefix`` nearest reference points (pivots),
nearest first.  Inverted lists hold, per label and pivot, the vectors that name
it; two vectors are candidates when they share at least ``shared`` pivots, and a
candidate pair is a link when its cosine, in double precision, reaches the
threshold.  By the pigeonhole principle a vector need only enter the lists of
its ``prefix - shared + 1`` rarest pivots for any such pair to meet, and a pair
is counted in the list of the rarest pivot that both share, so once.

Equal vectors are one class with a multiplicity.  Lists longer than ``block``
are cut into blocks and all block pairs are compared, so a hot list is spread
over many tasks and none is capped.  A block pair yields link counts and a
spanning forest, never the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import materialise
from spendlens.llm.components import connected_components, spanning_forest

#: The index's free parameters; the tests measure recall with these.
PIVOTS, PREFIX, SHARED, BLOCK = 128, 12, 6, 1024
#: Rows, of all, from which the pivots are drawn: the ones with the smallest hashes.
SAMPLE = 4096


def choose_pivots(vectors: DataFrame, pivots: int, sample: int = SAMPLE) -> np.ndarray:
    """Unit vectors spread out by farthest-first choice among a bounded sample: the
    ``sample`` vectors of the smallest hash (the bound is this parameter)."""
    rows = (vectors.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(sample)
            .select("v").collect())
    if not rows:
        return np.empty((0, 0))
    x = _unit(pd.Series([r.v for r in rows]))
    picked, best = [0], x @ x[0]
    while len(picked) < min(pivots, len(x)):
        picked.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[picked[-1]])
    return x[picked]


def usable(col: str) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    v = F.col(col)
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                  & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(ok & F.exists(v, lambda x: x != 0), F.lit(False))


def describe(vectors: DataFrame, pivots: np.ndarray, prefix: int) -> DataFrame:
    """Adds ``pivots``: the nearest ``prefix`` pivots, nearest first (ties: lower number)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                near = np.argsort(-(_unit(batch["v"]) @ pivots.T), axis=1, kind="stable")[:, :prefix]
                yield batch.assign(pivots=list(near.astype(np.int32)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInPandas(run, schema + ", pivots array<int>")


def _unit(vs) -> np.ndarray:
    x = np.array(vs.tolist(), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _verify(n_pivots: int, shared: int, threshold: float):
    """For a pair of blocks of one list: (node, links, root) rows, ``root`` a node
    that ``node`` is connected to, ``links`` weighted by multiplicities."""
    def incidence(prefixes) -> np.ndarray:
        p = np.array(prefixes.tolist())
        m = np.zeros((len(p), n_pivots), np.float32)
        np.put_along_axis(m, p, 1, axis=1)
        return m

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, pivot, part, other = key
        x = rows[rows["part"] == part]
        y = x if part == other else rows[rows["part"] == other]
        if not len(x) or not len(y):
            return pd.DataFrame(columns=["node", "links", "root"])
        mx, my = incidence(x["pivots"]), incidence(y["pivots"])
        hit = mx @ my.T >= shared
        # pivots are numbered from the rarest: the pair belongs to the list of the
        # lowest that both share
        hit &= (mx[:, :pivot] @ my[:, :pivot].T) == 0
        if part == other:
            hit = np.triu(hit, 1)
        i, j = np.nonzero(hit)
        near = np.empty(0, bool)
        if len(i):
            ux, uy = _unit(x["v"]), _unit(y["v"])
            near = ((ux @ uy.T)[i, j] if len(i) > 4 * (len(x) + len(y))
                    else np.einsum("ij,ij->i", ux[i], uy[j])) >= threshold
        i, j = i[near], j[near]
        xi, yi = x["id"].to_numpy(np.int64), y["id"].to_numpy(np.int64)
        links = np.concatenate([np.bincount(i, y["n"].to_numpy()[j], len(x)),
                                np.bincount(j, x["n"].to_numpy()[i], len(y))]).astype(np.int64)
        a, b = spanning_forest(xi[i], yi[j])
        return pd.concat([
            pd.DataFrame({"node": np.concatenate([xi, yi])[links > 0],
                          "links": links[links > 0],
                          "root": pd.array([None] * int((links > 0).sum()), "Int64")}),
            pd.DataFrame({"node": a, "links": 0, "root": pd.array(b, "Int64")})])

    return run


def near_vectors(table: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                 vec_col: str = "embedding", label_col: str | None = "label",
                 n_pivots: int = PIVOTS, prefix: int = PREFIX, shared: int = SHARED,
                 block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Two rows link when their labels are equal and not null (or no label column is
    given) and their cosine reaches ``threshold``.  Vectors that are null, empty,
    zero, or hold a null or non-finite component have no links; vectors of each
    length are compared among themselves, by an index of their own.  Equal vectors
    link with each other.  Rows that repeat an id each count.  ``component_id`` is the smallest
    id reachable, the own included; a null id stays null and is nobody's
    smallest.  Other columns are not looked at; an empty table stays empty.
    """
    label = F.col(label_col) if label_col else F.lit(0)
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"),
                        F.col(vec_col).alias("v"), label.alias("g"))
    rows = rows.withColumn("v", F.when(usable("v") & F.col("g").isNotNull(), F.col("v")))
    rows = rows.withColumn("key", F.when(F.col("v").isNotNull(), F.concat_ws(
        ":", F.xxhash64("g", "v"), F.xxhash64(F.lit(1), "g", "v"))))
    # one row per class; `id` is the class's node, the smallest vec_id where there is one
    classes = materialise(
        rows.where("key is not null").groupBy("key")
        .agg(F.first("g").alias("g"), F.first("v").alias("v"), F.count("*").alias("n"),
             F.min("vec_id").alias("first"))
        .withColumn("id", F.xxhash64("key")), "pivot-classes")
    found = None
    for (size,) in classes.select(F.size("v").alias("s")).distinct().collect():
        part = _links(classes.where(F.size("v") == size), threshold, n_pivots, prefix, shared, block)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                           F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    found = materialise(found, "pivot-links")
    links = found.groupBy(F.col("node").alias("id")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("root is not null")
                                 .select(F.col("node").alias("a"), F.col("root").alias("b")))
    joined = (classes.drop("v", "g").join(links, "id", "left")
              .join(roots.withColumnRenamed("node", "id"), "id", "left")
              .withColumn("root", F.coalesce("root", "id")))
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialise(
        joined.join(smallest, "root")
        .select("key", "component_id",
                (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "pivot-named")
    out = rows.drop("v", "g").join(named, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      F.when(F.col("vec_id").isNotNull(), component).alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _links(classes: DataFrame, threshold: float, n_pivots: int, prefix: int, shared: int,
           block: int) -> DataFrame:
    points = choose_pivots(classes, n_pivots)
    prefix = min(prefix, len(points))
    shared = min(shared, prefix)
    described = materialise(describe(classes.select("id", "g", "n", "v"), points, prefix),
                            "pivot-described")
    counts = dict(described.select(F.explode("pivots").alias("p")).groupBy("p").count().collect())
    rarest = sorted(range(len(points)), key=lambda p: (counts.get(p, 0), p))  # at most n_pivots
    number = [0] * len(points)
    for i, p in enumerate(rarest):
        number[p] = i
    numbers = F.array(*[F.lit(i) for i in number])
    lists = (described
             .withColumn("pivots", F.sort_array(F.transform(
                 "pivots", lambda p: F.get(numbers, p))))
             .select("g", F.explode(F.slice("pivots", 1, prefix - shared + 1)).alias("pivot"),
                     "id", "n", "pivots", "v"))
    sizes = materialise(lists.groupBy("g", "pivot")
                        .agg(F.ceil(F.count("*") / block).alias("parts")), "pivot-lists")
    # a row of part p, of P, meets the parts 0..P-1: pair (p, o) or (o, p)
    pairs = (lists.join(sizes, ["g", "pivot"])
             .withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
             .withColumn("o", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
             .select("g", "pivot", F.least("part", "o").alias("lo"),
                     F.greatest("part", "o").alias("hi"), "part", "id", "n", "pivots", "v"))
    return (pairs.groupBy("g", "pivot", "lo", "hi")
            .applyInPandas(_verify(len(points), shared, threshold),
                           "node bigint, links bigint, root bigint"))
