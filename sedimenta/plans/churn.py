"""Churn training rows at cutoffs: features end there, the label begins there.

A row is a customer at a cutoff.  Features come from orders before it, the
label from the ``CHURN_DAYS`` days that follow, so that no feature holds the
answer.  Orders of a day and first purchases of a category are facts of the
customer; one look-up at the cutoff and one at its end give all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.asof import as_of
from sedimenta.plans.features import CHURN_DAYS
from sedimenta.plans.star import ratio
from sedimenta.scale import durable, skew_join

FEATURES = ["recency_days", "frequency", "monetary", "avg_order_value", "active_days", "categories_purchased"]


def cutoffs(newest: Column, n: int, days: int = CHURN_DAYS) -> list[Column]:
    """``n`` cutoffs ``days`` apart, the last one ``days`` before the newest order, so that every label is known."""
    return [F.date_sub(newest, days * (k + 1)) for k in range(n)]


def facts(orders: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """``(customer_id, day, orders, amount, days, kinds)``: what a customer's
    days add to the counts.  A category counts on the day of its first order."""
    days = orders.groupBy("customer_id", F.col("order_date").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("amount"))
    bought = skew_join(lines.select("order_id", "product_id"), orders.select("order_id", "customer_id", "order_date"), ["order_id"])
    first = bought.groupBy("customer_id", "product_id").agg(F.min("order_date").alias("day"))
    first = skew_join(first, products.select("product_id", "category"), ["product_id"], same_keys=lines)
    first = first.groupBy("customer_id", "category").agg(F.min("day").alias("day"))
    kinds = first.groupBy("customer_id", "day").agg(F.count(F.lit(1)).alias("kinds"))
    amount = days.schema["amount"].dataType
    return days.select("customer_id", "day", "orders", "amount", F.lit(1).cast("long").alias("days"), F.lit(0).cast("long").alias("kinds")).union(
        kinds.select("customer_id", "day", F.lit(0).cast("long"), F.lit(0).cast(amount), F.lit(0).cast("long"), "kinds"))


def training_rows(orders: DataFrame, lines: DataFrame, products: DataFrame, at: list[Column], days: int = CHURN_DAYS, **split) -> DataFrame:
    """A row per cutoff and customer with an order before it: the features and
    ``churned``, 1 if no order follows in ``days`` days from the cutoff on."""
    known = durable(facts(orders, lines, products), "facts")
    customers = known.groupBy("customer_id").agg(F.min("day").alias("since"))
    points = customers.select("customer_id", "since", F.explode(F.array(*at)).alias("cutoff")).filter("since < cutoff")
    points = points.select("customer_id", "cutoff", F.explode(F.array(
        F.struct(F.col("cutoff").alias("time"), F.lit(False).alias("after")),
        F.struct(F.date_add("cutoff", days).alias("time"), F.lit(True).alias("after")))).alias("x")).select("customer_id", "cutoff", "x.*")
    ordered = known.withColumn("ordered", F.when(F.col("orders") > 0, F.col("day")))
    seen = as_of(ordered, points, ["customer_id"], "day", "time",
                 sums={c: c for c in ("orders", "amount", "days", "kinds")}, last={"latest": "ordered"}, **split)
    before = lambda c: F.max(F.when(~F.col("after"), F.col(c)))
    out = seen.groupBy("customer_id", "cutoff").agg(
        before("latest").alias("latest"), before("orders").alias("frequency"), before("amount").alias("spent"),
        before("days").alias("active_days"), before("kinds").alias("categories_purchased"), F.max("orders").alias("upto"))
    return out.select(
        "customer_id", "cutoff", F.datediff("cutoff", "latest").alias("recency_days"), "frequency",
        F.col("spent").cast("double").alias("monetary"), ratio(F.col("spent"), F.col("frequency")).alias("avg_order_value"),
        "active_days", "categories_purchased", (F.col("upto") == F.col("frequency")).cast("int").alias("churned"))


def order_history(orders: DataFrame, **split) -> DataFrame:
    """Every order with its customer's figures on the days before it."""
    days = orders.groupBy("customer_id", F.col("order_date").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("sum"))
    seen = as_of(days, orders.select("order_id", "customer_id", "order_date"), ["customer_id"], "day", "order_date",
                 sums={"n": "n", "sum": "sum"}, last={"latest": "day"}, **split)
    return seen.select("order_id", "customer_id", "order_date", F.coalesce("n", F.lit(0)).alias("orders_before"),
                       F.coalesce(F.col("sum").cast("double"), F.lit(0.0)).alias("spent_before"),
                       F.datediff("order_date", "latest").alias("days_since_order"))
