"""Look-ups at a point in time against plain loops, with hot keys split."""

import random

import pytest
from pyspark.sql import functions as F

from sedimenta.operators.asof import as_of

SPLIT = [{}, {"hot_rows": 5, "small_bytes": 0, "bucket_rows": 4}]


def brute(facts, points, inclusive):
    out = []
    for k, t, i in points:
        seen = [(u, v) for q, u, v in facts if q == k and t is not None and u is not None and (u < t or inclusive and u == t)]
        values = [v for _, v in seen if v is not None]
        known = [(u, v) for u, v in seen if v is not None]
        out.append((k, t, i, sum(values) if values else None, max(known)[1] if known else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", SPLIT)
@pytest.mark.parametrize("inclusive", [False, True])
def test_as_of(spark, split, inclusive):
    rng = random.Random(1)
    key = lambda: rng.choice([1, 1, 1, 1, 2, 3, None])
    time = lambda: rng.choice([*range(12), None])
    facts = [(key(), time(), rng.choice([None, *range(-5, 6)])) for _ in range(150)]
    points = [(key(), time(), i) for i in range(80)] + [(9, 4, 99), (1, 3, 5), (1, 3, 5)]
    f = spark.createDataFrame(facts, "k int, at int, v int").repartition(3)
    p = spark.createDataFrame(points, "k int, t int, i int").repartition(3)
    got = as_of(f, p, ["k"], "at", "t", {"total": "v"}, {"newest": "v"}, inclusive, **split)
    assert got.columns == ["k", "t", "i", "total", "newest"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(facts, points, inclusive)


def test_no_pairs_of_facts_and_points(spark):
    """One window, no join: a key with many facts and points multiplies nothing."""
    f = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("at"), F.lit(1).alias("v"))
    got = as_of(f, f.select("k", F.col("at").alias("t")), ["k"], "at", "t", {"n": "v"})
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.agg(F.sum("n")).first()[0] == 1000 * 999 // 2
