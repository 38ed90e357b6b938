"""Silver orders and customers, customer metrics, value and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.plans.star import ratio


def silver_orders(bronze: DataFrame, today: Column) -> DataFrame:
    """Orders with an id, a positive amount and no future date."""
    ok = F.col("order_id").isNotNull() & (F.col("amount") > 0) & (F.col("order_date") <= today)
    return (
        bronze.filter(ok)
        .withColumn("amount", F.col("amount").cast("decimal(10,2)"))
        .withColumn("order_year", F.year("order_date"))
        .withColumn("order_month", F.month("order_date"))
    )


def customer_metrics(orders: DataFrame) -> DataFrame:
    """Revenue, orders, first and last date, value and retention per customer."""
    return orders.groupBy("customer_id").agg(
        F.sum("amount").alias("total_revenue"),
        F.count(F.lit(1)).alias("order_count"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("latest_order_date"),
    ).select(
        "customer_id", "total_revenue", "order_count",
        ratio(F.col("total_revenue"), F.col("order_count")).alias("avg_order_value"),
        "first_order_date", "latest_order_date",
        F.col("total_revenue").alias("lifetime_value"),
        (F.col("order_count") > 1).alias("retention_flag"),
    )


def lifetime_value(metrics: DataFrame) -> DataFrame:
    """Active days and revenue per active day from ``customer_metrics``."""
    days = F.datediff("latest_order_date", "first_order_date")
    return metrics.withColumn("customer_lifespan_days", days).withColumn(
        "ltv_score", ratio(F.col("total_revenue"), F.col("customer_lifespan_days") + 1)
    )


def segment(revenue: Column, count: Column, high: float, middle: float) -> Column:
    return (
        F.when(revenue > high, "High Value").when(revenue > middle, "Medium Value")
        .when(count > 5, "Frequent Buyer").otherwise("New Customer")
    )


def segment_by_revenue(revenue: Column, high: float, middle: float) -> Column:
    return F.when(revenue > high, "High Value").when(revenue > middle, "Medium Value").otherwise("Standard")


def segment_by_orders(count: Column) -> Column:
    return F.when(count > 10, "High Value").when(count > 5, "Medium Value").otherwise("New Customer")


def silver_customers(customers: DataFrame, order_counts: DataFrame, today: Column) -> DataFrame:
    """Mail domain, age in days and segment; no future sign-up.

    ``order_counts`` has one row per customer, so the join has no hot key.
    """
    return (
        customers.filter(F.col("signup_date") <= today)
        .join(order_counts, "customer_id", "left")
        .withColumn("total_orders", F.coalesce("total_orders", F.lit(0)))
        .select(
            "customer_id",
            F.regexp_extract("email", "@(.+)", 1).alias("email_domain"),
            F.datediff(today, "signup_date").alias("customer_age_days"),
            "total_orders",
            segment_by_orders(F.col("total_orders")).alias("customer_segment"),
        )
    )


def monthly_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.date_format("order_date", "yyyy-MM").alias("month")).agg(
        F.sum("amount").alias("monthly_revenue"),
        F.count(F.lit(1)).alias("monthly_orders"),
        F.count_distinct("customer_id").alias("active_customers"),
    ).withColumn(
        "revenue_per_customer", ratio(F.col("monthly_revenue"), F.col("active_customers"))
    )


def product_months(sales: DataFrame, product: str, day: str, amount: str) -> DataFrame:
    """Gold table: sales per product and month of the valid rows."""
    valid = sales.filter(F.col(amount).isNotNull() & F.col(product).isNotNull())
    return valid.groupBy(product, F.date_format(day, "yyyy-MM").alias("month")).agg(
        F.sum(amount).alias("total_sales"), F.count(F.lit(1)).alias("transaction_count")
    ).withColumn(
        "avg_sale_amount", ratio(F.col("total_sales"), F.col("transaction_count"))
    )


def retention(orders: DataFrame) -> DataFrame:
    """Customers, repeat customers and their share, from counts per customer."""
    per = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("n") > 1).alias("repeat_customers"),
        F.sum("n").alias("orders"),
        F.sum(F.col("n") - 1).alias("repeat_orders"),
    ).withColumn(
        "repeat_rate_pct", F.round(ratio(F.col("repeat_customers") * 100, F.col("customers")), 4)
    )
