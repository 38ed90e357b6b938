"""Cases that the tables do not hold: merges, extremes, failing rules."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.operators import layout, merge as mg, quality as q
from sedimenta.operators.percentiles import exact_percentiles
from sedimenta.operators.windows import global_rank
from sedimenta.plans import models
from sedimenta import scale
from sedimenta.registry import QUERIES
from sedimenta.scale import hot_keys, work_path


def table(spark, n=20, buckets=4):
    path = work_path(spark, "repairs")
    return mg.write_bucketed(spark.range(n).withColumn("v", F.lit(1)), path, ["id"], buckets)


def state(spark, path):
    return sorted(tuple(r) for r in mg.read_bucketed(spark, path).select("id", "v").collect())


def test_merge_deletes_and_adds_columns(spark):
    path = table(spark)
    change = spark.createDataFrame([(1, 5, "x"), (2, -1, "y"), (30, 7, "z")], "id int, v int, note string")
    assert mg.merge_into(spark, path, change, ["id"], 4, mg.newer("v"), F.col("s.v") < 0) > 0
    got = {r.id: (r.v, r.note) for r in mg.read_bucketed(spark, path).collect()}
    assert len(got) == 20 and 2 not in got and got[1] == (5, "x") and got[30] == (7, "z") and got[3] == (1, None)
    assert mg.read_bucketed(spark, path).schema["id"].dataType.simpleString() == "bigint"


def test_interrupted_merge_changes_nothing(spark, monkeypatch):
    path = table(spark)
    before = state(spark, path)
    change = spark.createDataFrame([(1, 5), (40, 6)], "id long, v int")
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            mg.merge_into(spark, path, change, ["id"], 4, mg.newer("v"))
    assert state(spark, path) == before
    mg.merge_into(spark, path, change, ["id"], 4, mg.newer("v"))
    assert state(spark, path) == sorted([(i, 5 if i == 1 else 1) for i in range(20)] + [(40, 6)])


def test_merge_refuses(spark):
    path = table(spark)
    with pytest.raises(ValueError):
        mg.merge_into(spark, path, spark.range(2).withColumn("v", F.lit(2)), ["id"], 8, mg.newer("v"))
    for rows in ([(1, 2), (1, 3)], [(None, 2)]):
        with pytest.raises(ValueError):
            mg.merge_into(spark, path, spark.createDataFrame(rows, "id long, v int"), ["id"], 4, mg.newer("v"))


def test_snapshot_diff_of_changed_columns(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    new = spark.createDataFrame([(1, "a", None), (2, "b", "n")], "k int, v string, x string")
    assert sorted(r.k for r in mg.snapshot_diff(old, new, ["k"]).collect()) == [1, 2]


def test_checksum_sees_places_of_nulls(spark):
    a = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    b = spark.createDataFrame([(None, "a"), ("b", None)], "x string, y string")
    assert mg.checksum(a).first() != mg.checksum(b).first()


@pytest.mark.parametrize("split", [False, True])
def test_percentile_of_infinities(spark, split):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, math.inf)], "k int, v double")
    sizes = {"hot_rows": 1, "small_bytes": 0} if split else {}
    assert exact_percentiles(df, ["k"], "v", {"top": 1.0}, **sizes).first()["top"] == math.inf


def test_rank_of_nan_and_smallest_integer(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "v double")
    assert {str(r.v): r.r for r in global_rank(df, "v", "r").collect()} == {"nan": 1, "1.0": 2, "None": 3}
    df = spark.createDataFrame([(-(2**63),), (5,)], "v long")
    assert {r.v: r.r for r in global_rank(df, "v", "r").collect()} == {5: 1, -(2**63): 2}


def test_hot_key_of_a_small_file(spark):
    path = work_path(spark, "one-key")
    spark.range(12_000_000).select(F.lit(7).alias("k")).write.parquet(path)
    assert [r.k for r in hot_keys(spark.read.parquet(path), ["k"]).collect()] == [7]


def test_rule_failing_on_a_value(spark):
    df = spark.createDataFrame([("1",), ("x",)], "n string")
    got = {r.rule_name: r for r in q.run_rules(df, [q.Rule("bad", "cast(n as int) < 0"), q.Rule("good", "n is null")]).collect()}
    assert got["bad"].severity == "CRITICAL" and not got["bad"].is_valid and got["good"].is_valid


def test_uniqueness_of_an_empty_table(spark):
    assert q.uniqueness(spark.createDataFrame([], "k int"), "k").first()["distinct_values"] == 0


def test_tree_over_neighbouring_values():
    x = np.array([[1.0], [np.nextafter(1.0, 2.0)]])
    assert all(len(models.grow_tree(0, x, seed)) == 3 for seed in range(50))


def test_zorder_refuses_too_many_bits(spark):
    df = spark.range(4).select(*[F.col("id").alias(f"c{i}") for i in range(9)])
    with pytest.raises(ValueError):
        layout.zorder(df, df.columns, 2)


@pytest.mark.parametrize("many", [False, True])
def test_star_queries_are_built_without_joins(spark, monkeypatch, many):
    """No plan with a join runs before the result is asked for; where tables are
    large, single scans are sampled."""
    seen = []
    collect = type(spark.range(0)).collect
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda df: seen.append(str(df._jdf.queryExecution().optimizedPlan().toString())) or collect(df))
    if many:
        monkeypatch.setattr(scale, "HOT_ROWS", 500)
        monkeypatch.setattr(scale, "SAMPLE_HITS", 250)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("revenue_by_category", "daily_summary", "sales_by_category_daily", "fact_sales", "rfm_features"):
            QUERIES[name](spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert any("Sample" in p for p in seen) == many and not [p for p in seen if "Join" in p]


def test_rows_come_from_footers(spark):
    path = work_path(spark, "rows")
    spark.range(1000).write.parquet(path)
    df = spark.read.parquet(path)
    assert scale.rows_in_files(df.join(df.select("id"), "id")) == 1000 and scale.rows_in_files(spark.range(3)) is None


def test_tasks_of_a_join_by_rows(spark, monkeypatch):
    """Where the session has few partitions, the rows of the files decide how many tasks a shuffled join has."""
    query, sf = QUERIES["revenue_by_category"], "/root/testdata/sf0.01"
    want = sorted(query(spark, sf).collect())
    monkeypatch.setattr(scale, "TASK_ROWS", 1000)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    for threshold, shuffles in (("20k", 1), ("-1", 3)):  # products are broadcast, products are shuffled
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            got = query(spark, sf)
            text = got._jdf.queryExecution().optimizedPlan().toString()
            assert text.count(f", {-(-lines // 1000)}") == shuffles and text.count("RepartitionByExpression") == shuffles
            assert sorted(got.collect()) == want
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
