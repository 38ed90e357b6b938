"""Anomaly detector and classifier on rows with known structure."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sedimenta.plans import churn, features as ft, models


@pytest.fixture(scope="module")
def fraud(spark):
    rng = np.random.default_rng(7)
    good = [(i, float(rng.normal(100, 20)), float(rng.normal(14, 3)), 0) for i in range(950)]
    bad = [(950 + i, float(rng.normal(900, 150)), float(rng.normal(3, 1)), 1) for i in range(50)]
    return spark.createDataFrame(good + bad, "id long, amount double, hour double, is_fraud int")


def test_isolation_forest_finds_outliers(spark, fraud):
    one = models.detect_anomalies(fraud, "id", ["amount", "hour"], 0.05, trees=50).persist()
    assert one.filter("predicted_fraud = 1").count() == 50
    r = ft.confusion(one, "is_fraud", "predicted_fraud").first()
    assert r["recall"] > 0.9 and r["precision"] > 0.9
    # The same rows and seed give the same scores, whatever the partitioning.
    two = models.detect_anomalies(fraud.repartition(5), "id", ["amount", "hour"], 0.05, trees=50)
    diff = one.join(two.select("id", F.col("anomaly_score").alias("b")), "id")
    assert diff.filter(F.abs(F.col("anomaly_score") - F.col("b")) > 1e-12).isEmpty()


def test_few_rows_have_scores_of_their_size(spark, fraud):
    """With 40 rows the mean depth is that of 40 rows: ordinary rows score near a half, not below."""
    few = fraud.filter("id < 39 or id = 960")
    nodes = models.fit_isolation_forest(few, "id", ["amount", "hour"], trees=50)
    got = {r.id: r.s for r in few.select("id", models.isolation_score(nodes, ["amount", "hour"], 40).alias("s")).collect()}
    assert got[960] == max(got.values()) > 0.6 and 0.4 < np.median(list(got.values())) < 0.55
    flagged = models.detect_anomalies(few, "id", ["amount", "hour"], 0.02, trees=50).filter("predicted_fraud = 1")
    assert [r.id for r in flagged.collect()] == [960]


def test_average_path():
    assert models.average_path([0, 1, 2]).tolist() == [0.0, 0.0, 1.0]
    assert models.average_path(256) == pytest.approx(10.24, abs=0.02)


def test_churn_forest(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(500):
        days = int(rng.integers(1, 180))
        churned = int(days > 90) if rng.random() < 0.95 else int(days <= 90)
        rows.append((i, days, int(rng.integers(1, 20)), float(rng.uniform(10, 900)), float(rng.uniform(5, 99)), 2, 2, churned))
    df = spark.createDataFrame(
        rows, "customer_id long, recency_days int, frequency int, monetary double, avg_order_value double, active_days int, categories_purchased int, churned int")
    model, scored = models.fit_churn(df, trees=20, depth=5)
    r = models.churn_report(scored).first()
    assert r["roc_auc"] > 0.85 and r["accuracy"] > 0.8
    assert models.churn_importance(model, spark).first()["feature"] == "recency_days"


def test_churn_forest_after_an_observation(spark):
    """Counts observed earlier in the session do not keep the model from being sent to the executors."""
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    df = spark.range(400).select(
        F.col("id").alias("customer_id"), *[(F.col("id") % (k + 7)).alias(c) for k, c in enumerate(models.CHURN_FEATURES)],
        (F.col("id") % 7 > 3).cast("int").alias("churned"))
    _, scored = models.fit_churn(df, trees=5, depth=5)
    assert models.churn_report(scored).first()["roc_auc"] > 0.95


def test_churn_forest_passes(spark):
    """Every level goes on from cached nodes, in tasks of one size; a second run over the same rows grows the same trees."""
    df = spark.range(3000).select(
        F.col("id").alias("customer_id"), *[(F.xxhash64("id", F.lit(c)) % 50).alias(c) for c in models.CHURN_FEATURES],
        (F.col("id") % 7 > 3).cast("int").alias("churned"))
    one, two = (models.fit_churn(x, trees=5, depth=5)[0].stages[-1] for x in (df.coalesce(1), df.orderBy(F.desc("id"))))
    assert one.getOrDefault("cacheNodeIds") and one.getOrDefault("checkpointInterval") == -1
    assert one.toDebugString.splitlines()[1:] == two.toDebugString.splitlines()[1:]


def test_churn_before_a_cutoff(spark):
    """Customers order at rates of their own: what came before tells something of what follows, not all."""
    rng, start, orders = np.random.default_rng(5), dt.date(2020, 1, 1), []
    for c in range(400):
        day, gap = float(rng.uniform(0, 60)), float(rng.choice([25, 60, 150, 400]))
        while day < 720:
            orders.append((len(orders), c, start + dt.timedelta(days=int(day)), int(rng.integers(1, 90))))
            day += rng.exponential(gap)
    df = spark.createDataFrame(orders, "order_id long, customer_id long, order_date date, amount long").withColumn(
        "amount", F.col("amount").cast("decimal(18,2)"))
    lines = df.select("order_id", (F.col("order_id") % 7).alias("product_id"))
    products = spark.range(7).select(F.col("id").alias("product_id"), (F.col("id") % 3).alias("category"))
    at = churn.cutoffs(F.lit("2021-12-20").cast("date"), 3)
    rows = churn.training_rows(df, lines, products, at)
    _, scored = models.fit_churn(rows, trees=20, depth=5)
    assert 0.6 < models.churn_report(scored).first()["roc_auc"] < 0.97
    # Orders from the cutoff on change no feature, orders before it no label.
    day = F.lit("2021-06-23").cast("date")
    later = df.filter(F.col("order_date") < day)
    one, two = ({r.customer_id: r for r in churn.training_rows(x, lines, products, [day]).collect()} for x in (df, later))
    assert {i: r[1:-1] for i, r in one.items()} == {i: r[1:-1] for i, r in two.items()}
    assert all(r.churned == 1 for r in two.values()) and 0 < sum(r.churned for r in one.values()) < len(one)


def test_split_keeps_class_shares(spark):
    df = spark.range(20_000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    shares = ft.stratified_split(df, "id", 0.2).groupBy("y").agg(F.avg(F.col("is_test").cast("int")).alias("s")).collect()
    assert all(abs(r["s"] - 0.2) < 0.03 for r in shares)


def test_lookup_refuses_a_repeated_key(spark):
    f = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k int, x double")
    with pytest.raises(ValueError):
        ft.lookup(spark.createDataFrame([(1,)], "k int"), f, "k")
