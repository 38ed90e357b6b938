"""The inverted multi-index against all pairs, and its odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import multiindex

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows):
    """Links and components by all pairs; every row is a node."""
    size = max([2, *(len(v or ()) for _, v in rows)])
    units = []
    for _, v in rows:
        ok = bool(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)
        x = np.array([*(v if ok else ()), *[0.0] * (size - (len(v) if ok else 0))])
        x = x / np.abs(x).max() if ok else x
        units.append(x / np.linalg.norm(x) if ok else x)
    x = np.array(units).reshape(-1, size)
    met = x @ x.T >= 0.95
    np.fill_diagonal(met, False)
    part = np.arange(len(rows))
    while True:
        new = np.minimum(part, np.where(met, part[None], len(rows)).min(1, initial=len(rows)))
        if np.array_equal(new, part):
            break
        part = new
    ids = {}
    for p, (i, _) in zip(part, rows):
        if i is not None:
            ids[p] = min(i, ids.get(p, i))
    out = [(i, int(n), ids.get(p), i is not None and ids.get(p) == i) for (i, _), n, p in zip(rows, met.sum(1), part)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def cloud(rng, centre, degrees, n, dim=64):
    """Vectors at this angle from the centre in random directions."""
    side = rng.normal(size=(n, dim))
    side -= np.outer(side @ centre, centre)
    side /= np.linalg.norm(side, axis=1)[:, None]
    a = np.radians(degrees)
    return (np.cos(a) * centre + np.sin(a) * side).tolist()


def unit(rng, dim=64):
    x = rng.normal(size=dim)
    return x / np.linalg.norm(x)


@pytest.mark.parametrize("tile", [2048, 30])
def test_clouds(spark, monkeypatch, tile):
    """A ball, its rim, chains of balls, scaled copies and unrelated vectors: all links."""
    monkeypatch.setattr(multiindex, "TILE", tile)
    rng = np.random.default_rng(4)
    one, two = unit(rng), unit(rng)
    near = np.array(cloud(rng, two, 15, 1)[0])
    vectors = [v.tolist() for v in rng.normal(size=(300, 64))]
    vectors += cloud(rng, one, 5, 150) + cloud(rng, one, 12, 40) + cloud(rng, two, 3, 90) + cloud(rng, near, 3, 90) + cloud(rng, unit(rng), 2, 3)
    vectors += [(np.array(v) * 7).tolist() for v in vectors[-5:]] + vectors[300:320] * 3
    rows = list(enumerate(vectors))
    got, want = rows_of(multiindex.near_vectors(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))
    assert len({r[2] for r in got}) == len({r[2] for r in want})


def test_recall_at_the_threshold():
    """Neighbours exactly at the threshold are met at the target, closer ones nearly always."""
    rng = np.random.default_rng(8)
    sample = rng.normal(size=(6000, 64))
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    index = multiindex.Index(sample, 100_000, 0.95, 0.99)
    assert index.n == 16 and not len(index.balls)
    other = rng.normal(size=(1000, 64))
    other /= np.linalg.norm(other, axis=1)[:, None]
    for degrees, least in ((18.19, 0.97), (9, 0.995)):
        pair = np.array([cloud(rng, x, degrees, 1)[0] for x in other])
        (a, _, (rows, homes)), (b, _, (rows2, homes2)) = index.place(other), index.place(pair)
        one, two = set(zip(rows, homes)), set(zip(rows2, homes2))
        assert sum((i, b[i]) in one if a[i] <= b[i] else (i, a[i]) in two for i in range(1000)) >= least * 1000
    assert np.bincount(index.place(other)[2][0]).mean() < 0.1 * index.n**2


def test_odd_vectors(spark):
    """NULLs, zeros, non-finite and missing components, other lengths, repeated and NULL ids, clashing names."""
    v = [3.0, 4.0, 0.0]
    rows = [(1, v), (2, v), (2, v), (None, v), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]), (7, [math.nan, 1.0, 1.0]),
            (8, [math.inf, 1.0, 1.0]), (9, [3.0, 4.0]), (10, [3e200, 4e200, 0.0]), (11, [3e-300, 4e-300]), (12, [-3.0, -4.0, 0.0]),
            (None, [0.0, 0.0, 1.0]), (None, [0.0, 0.01, 1.0]), (-5, [0.0, 1.0, 0.0]), (2, [0.0, 1.0, 0.01]), (None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("digest", "unit", "copies", "pid", "cell", "x", "home", "part", "component"):
        df = df.withColumn(c, F.lit(1))
    assert rows_of(multiindex.near_vectors(df)) == brute(rows)
    assert multiindex.near_vectors(df.limit(0)).count() == 0
    assert rows_of(multiindex.near_vectors(df.filter("vec_id in (3, 5)"))) == [(3, 0, 3, True), (5, 0, 5, True)]


def test_all_rows_one_vector(spark):
    df = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    assert {tuple(r)[1:3] for r in multiindex.near_vectors(df).collect()} == {(2999, 0)}


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    extra = df.filter("vec_id % 10 = 0").select((F.col("vec_id") + 10**6).alias("vec_id"), F.transform("embedding", lambda c: c * 0.9 + 0.01).alias("embedding"))
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").union(extra).collect()]
    got, want = rows_of(multiindex.near_vectors(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    assert sum(r[1] for r in want) > 300 and got == want
