"""Customer and order features, and the tables built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.merge import assert_unique
from sedimenta.plans.star import ratio
from sedimenta.scale import durable, skew_join

CHURN_DAYS = 90


def rfm_features(orders: DataFrame, lines: DataFrame, products: DataFrame, today: Column) -> DataFrame:
    """Recency, frequency, monetary value and breadth per customer.

    Order figures and category counts are aggregated apart, so an order with
    many lines does not multiply its amount.
    """
    per = orders.groupBy("customer_id").agg(
        F.datediff(today, F.max("order_date")).alias("recency_days"),
        F.count_distinct("order_id").alias("frequency"),
        F.sum("amount").alias("monetary"),
        F.count(F.lit(1)).alias("_n"),
        F.count_distinct("order_date").alias("active_days"),
    )
    bought = skew_join(lines.select("order_id", "product_id"), orders.select("order_id", "customer_id"), ["order_id"])
    pairs = bought.select("customer_id", "product_id").distinct()
    kinds = (
        skew_join(pairs, products.select("product_id", "category"), ["product_id"], same_keys=lines)
        .groupBy("customer_id").agg(F.count_distinct("category").alias("categories_purchased"))
    )
    return per.join(kinds, "customer_id", "left").select(
        "customer_id", "recency_days", "frequency",
        F.col("monetary").cast("double").alias("monetary"),
        ratio(F.col("monetary"), F.col("_n")).alias("avg_order_value"),
        "active_days",
        F.coalesce("categories_purchased", F.lit(0)).alias("categories_purchased"),
        (F.col("recency_days") > CHURN_DAYS).cast("int").alias("churned"),
    )


def rfm_segments(features: DataFrame, high: float, middle: float) -> DataFrame:
    """Segment labels for recency, frequency and monetary value."""
    days, n, spent = F.col("recency_days"), F.col("frequency"), F.col("monetary")
    return features.select(
        "*",
        F.when(days <= 30, "Active").when(days <= 90, "At Risk").otherwise("Churned").alias("recency_segment"),
        F.when(n >= 10, "High").when(n >= 5, "Medium").otherwise("Low").alias("frequency_segment"),
        F.when(spent >= high, "High Value").when(spent >= middle, "Medium Value").otherwise("Low Value")
        .alias("monetary_segment"),
    )


def order_features(orders: DataFrame, today: Column) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("amount").alias("_sum"),
        F.max("order_date").alias("last_order_date"),
    ).select(
        "customer_id", "order_count", F.col("_sum").cast("double").alias("total_spent"),
        ratio(F.col("_sum"), F.col("order_count")).alias("avg_order"),
        "last_order_date", F.datediff(today, "last_order_date").alias("days_since_last_order"),
    )


def anomaly_features(events: DataFrame) -> DataFrame:
    """Value, hour, weekday and how active the user is over all days."""
    activity = events.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("lifetime_events"))
    return skew_join(
        events.select(
            "event_id", "user_id", "event_type", "value", F.hour("ts").alias("hour"),
            F.dayofweek("ts").alias("day_of_week"),
        ),
        activity, ["user_id"],
    )


def lookup(rows: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Join a feature table on its primary key, which is checked first.

    The features are written once, and both the check and the join read them.
    """
    return skew_join(rows, assert_unique(durable(features, "features"), [key]), [key], "left")


def churn_by_segment(segments: DataFrame) -> DataFrame:
    return segments.groupBy("recency_segment", "frequency_segment").agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum("churned").alias("churned_count")
    ).withColumn("churn_rate_pct", F.round(ratio(F.col("churned_count") * 100, F.col("customer_count")), 2))


def risk_level(predicted: Column, score: Column) -> Column:
    return (
        F.when(predicted == 1, "High Risk").when(score < -0.3, "Medium Risk").otherwise("Low Risk")
    )


def with_risk(orders: DataFrame, checked: DataFrame, key: str) -> DataFrame:
    """Orders with prediction, score and risk level.

    ``checked`` must be unique on ``key``; otherwise orders would multiply.
    """
    return lookup(orders, checked.select(key, "predicted_fraud", "anomaly_score"), key).withColumn(
        "risk_level", risk_level(F.col("predicted_fraud"), F.col("anomaly_score"))
    )


def fraud_summary(rows: DataFrame, amount: str) -> DataFrame:
    flagged = F.col("predicted_fraud") == 1
    return rows.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(flagged).alias("flagged_orders"),
        F.sum(F.when(flagged, F.col(amount).cast("decimal(18,2)"))).cast("double").alias("flagged_amount"),
    ).withColumn("fraud_rate_pct", F.round(ratio(F.col("flagged_orders") * 100, F.col("total_orders")), 2))


def confusion(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """Confusion matrix, precision, recall, f1 and accuracy of a 0/1 prediction."""
    y, p = F.col(label), F.col(predicted)
    one = rows.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = one.select(
        "*",
        F.coalesce(ratio(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), F.lit(0.0)).alias("recall"),
        F.coalesce(ratio(tn, tn + fn), F.lit(0.0)).alias("precision_0"),
        F.coalesce(ratio(tn, tn + fp), F.lit(0.0)).alias("recall_0"),
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    )
    f1 = lambda a, b: F.coalesce(F.try_divide(2 * F.col(a) * F.col(b), F.col(a) + F.col(b)), F.lit(0.0))
    return out.withColumn("f1", f1("precision", "recall")).withColumn("f1_0", f1("precision_0", "recall_0"))


def stratified_split(rows: DataFrame, key: str, test_share: float) -> DataFrame:
    """Add ``is_test``.  The hash of the key decides, so each class is split
    in the same share, a re-run gives the same split, and nothing is shuffled."""
    # First 8 hex digits of md5: an unsigned 32-bit number.
    bucket = F.conv(F.left(F.md5(F.col(key).cast("string")), F.lit(8)), 16, 10).cast("bigint")
    return rows.withColumn("is_test", bucket < int(test_share * 2**32))
