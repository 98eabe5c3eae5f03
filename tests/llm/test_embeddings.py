import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm.embeddings import near_vectors
from tests.llm.test_simhash import brute_components

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    """{row number: (links, component)} by comparing all pairs."""
    units = []
    for _, v, g in rows:
        ok = v and g is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)
        x = np.array(v, np.float32).astype(float) if ok else None
        units.append(x / np.linalg.norm(x) if ok else None)
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold]
    group = brute_components(range(len(rows)), links)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[group[i]] = min(r[0], least.get(group[i], r[0]))
    return sorted((r[0] is None, r[0] or 0, sum(i in e for e in links),
                   least.get(group[i]) if r[0] is not None else None)
                  for i, r in enumerate(rows)), len(links)


def rows_of(df):
    return sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id)
                  for r in df.collect())


def planted(seed, groups=12, dim=16, hot=60):
    r = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = r.normal(size=dim)
        for _ in range(hot if g == 0 else int(r.integers(1, 8))):
            v = centre + r.normal(size=dim) * 0.12
            rows.append((len(rows) * 3, [float(np.float32(x)) for x in v], int(g % 2)))
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 16])
def test_links_against_brute_force(spark, block):
    rows = planted(1)
    want, n = brute(rows)
    got = rows_of(near_vectors(spark.createDataFrame(rows, SCHEMA), n_pivots=8, prefix=4, shared=2,
                               block=block))
    found = sum(x[2] for x in got) / 2
    assert found >= 0.95 * n and all(a[2] <= b[2] for a, b in zip(got, want))
    if found == n:
        assert got == want


def test_everything_shared_is_exact(spark):
    """When each vector names all pivots the index misses nothing."""
    rows = planted(2, groups=8, hot=30)
    want, _ = brute(rows)
    got = rows_of(near_vectors(spark.createDataFrame(rows, SCHEMA), n_pivots=5, prefix=5, shared=5,
                               block=8))
    assert got == want


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = df.orderBy("vec_id").toPandas()
    v = np.stack(x["embedding"]).astype(float)
    # near copies of every fourth vector at cosines from 0.98 up
    r = np.random.default_rng(0)
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    noise = r.normal(size=v[::4].shape) * r.uniform(0.0, 0.025, (len(v[::4]), 1))
    rows = list(zip(range(len(v)), v.tolist(), x["label"].tolist()))
    rows += [(len(v) + i, c.tolist(), l) for i, (c, l) in
             enumerate(zip(v[::4] + noise, x["label"].tolist()[::4]))]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA)).agg(F.sum("n_links")).first()[0]
    u = np.array([q[1] for q in rows], np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    lab = np.array([q[2] for q in rows])
    want = (((u @ u.T) >= 0.98) & (lab[:, None] == lab)).sum() - len(u)
    assert want > 500 and 0.99 * want <= got <= want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (7, [1.0, 0.0], 2),
            (8, [1.0, 0.0], None), (9, None, 1), (10, [0.0, 0.0], 1), (11, [1.0, None], 1),
            (12, [nan, 1.0], 1), (13, [inf, 1.0], 1), (None, [1.0, 0.0], 1), (14, [], 1),
            (15, [1.0, 0.0, 0.0], 1), (16, [3.0, 0.0, 0.0], 1), (17, [1e30, 1e-30], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("k")).withColumn("n", F.lit(2))
    got = rows_of(near_vectors(df))
    assert got == brute(rows)[0]
    assert near_vectors(df.limit(0)).count() == 0
    assert near_vectors(df.where("vec_id in (9, 10)")).count() == 2
    kept = {r.vec_id: r.kept for r in near_vectors(df).collect() if r.vec_id != 2}
    assert kept[7] and kept[9] and not kept[5] and kept[15] and not kept[16] and not kept[None]
