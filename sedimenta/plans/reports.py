"""Reports that join facts with customers and products."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from sedimenta.plans.star import ratio
from sedimenta.scale import broadcast_if_small, skew_join, durable


def daily_summary(
    fact: DataFrame, products: DataFrame, customer: DataFrame, nation: DataFrame, lines: DataFrame | None = None
) -> DataFrame:
    """Sales by city and category with the number of customers.  Hot products
    are looked for in ``lines``, which the fact rows come from.

    Lines are summed per customer and category first.  Each customer is then
    one row of its category, so counting rows counts distinct customers.
    """
    placed = skew_join(
        fact.select("customer_id", "product_id", "order_id", "line_total"),
        products.select("product_id", "category"), ["product_id"], same_keys=lines,
    )
    sums = placed.groupBy("customer_id", "category").agg(
        F.sum("line_total").alias("sales"), F.count("order_id").alias("n")
    )
    city = customer.join(broadcast_if_small(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("city")
    )
    return sums.join(city, "customer_id").groupBy("city", "category").agg(
        F.sum("sales").cast("double").alias("total_sales"),
        F.sum("n").alias("order_count"),
        F.count(F.lit(1)).alias("unique_customers"),
    )


def sales_by_category_daily(fact: DataFrame, products: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Hot products are looked for in ``lines``, which the fact rows come from."""
    sums = fact.groupBy("product_id", "order_date").agg(
        F.sum("line_total").alias("revenue"), F.sum("quantity").alias("units")
    )
    return (
        skew_join(sums, products.select("product_id", "category"), ["product_id"], same_keys=lines)
        .groupBy("category", "order_date")
        .agg(F.sum("revenue").cast("double").alias("revenue"), F.sum("units").alias("units"))
    )


def category_report(lines: DataFrame, products: DataFrame, brand: str) -> DataFrame:
    """Sales per category of one brand.  The filtered products are broadcast
    if they are small."""
    chosen = products.filter(F.col("brand") == brand).select("product_id", "category")
    return skew_join(lines, chosen, ["product_id"]).groupBy("category").agg(
        F.sum("line_total").cast("double").alias("total_sales"),
        F.count("order_id").alias("order_count"),
        F.round(ratio(F.sum("line_total"), F.count("line_total")), 4).alias("avg_order_value"),
    )


def slice_totals(orders: DataFrame, customers: DataFrame, city: str, since: str) -> DataFrame:
    """Orders and sales of one city since a day."""
    there = customers.filter(F.col("city") == city).select("customer_id")
    recent = orders.filter(F.col("order_date") >= F.lit(since).cast("date"))
    return skew_join(recent, there, ["customer_id"], "left_semi").agg(
        F.count("order_id").alias("order_count"), F.sum("amount").cast("double").alias("total_sales")
    )


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` persisted for the block, on memory and disk, and released after."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def city_counts_cached(orders: DataFrame) -> DataFrame:
    """Two counts over one cached read; the small results outlive the cache."""
    with kept(orders.select("priority", "status")) as cached:
        everything = durable(cached.groupBy("priority").agg(F.count(F.lit(1)).alias("orders")), "counts")
        done = durable(
            cached.filter(F.col("status") == "completed").groupBy("priority")
            .agg(F.count(F.lit(1)).alias("completed")), "counts",
        )
    return everything.join(done, "priority", "left")
