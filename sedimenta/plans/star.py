"""Star schema: dimensions, the sales fact and the reports over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.scale import is_broadcast, skew_join, spread
from sedimenta.sources import shapes


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.products(spark, sf_dir).withColumn(
        "profit_margin", F.col("retail_price") - F.col("cost_price")
    )


def dim_date(df: DataFrame, column: str) -> DataFrame:
    """One row per calendar day between the first and last date of ``df``."""
    span = df.agg(F.min(column).alias("a"), F.max(column).alias("b"))
    day = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return day.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofweek("date").alias("day_of_week"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
        F.dayofweek("date").isin(1, 7).alias("is_weekend"),
    )


def completed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of completed orders with customer and order date."""
    done = shapes.orders(spark, sf_dir, shapes.COMPLETED).select("order_id", "customer_id", "order_date")
    return skew_join(shapes.lines(spark, sf_dir), done, ["order_id"])


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grain: one row per line of a completed order."""
    cost = shapes.products(spark, sf_dir).select("product_id", "retail_price", "cost_price")
    joined = skew_join(completed_lines(spark, sf_dir), cost, ["product_id"], same_keys=shapes.lines(spark, sf_dir))
    return joined.select(
        "order_id", "line_number", "customer_id", "product_id", "order_date", "quantity",
        F.col("retail_price").alias("unit_price"),
        "line_total",
        (F.col("line_total") - F.col("quantity") * F.col("cost_price")).cast("decimal(18,4)").alias("profit"),
    )


def with_product(fact: DataFrame, dim: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Hot products are looked for in ``lines``, which the fact rows come from.
    Those were joined by product before."""
    return skew_join(fact, dim, ["product_id"], same_keys=lines, spread_rows=False)


def sales_kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("line_total").alias("_revenue"),
        F.count("line_total").alias("_n"),
        F.sum("profit").alias("_profit"),
    ).select(
        "total_orders",
        F.col("_revenue").cast("double").alias("total_revenue"),
        F.round(ratio(F.col("_revenue"), F.col("_n")), 4).alias("avg_order_value"),
        F.col("_profit").cast("double").alias("total_profit"),
        F.round(ratio(F.col("_profit"), F.col("_revenue")) * 100, 2).alias("profit_margin_pct"),
    )


def by_product(fact: DataFrame) -> DataFrame:
    """Sums per product: everything later joins products, not lines."""
    return fact.groupBy("product_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("quantity").alias("units_sold"),
        F.sum("line_total").alias("revenue"),
        F.sum("profit").alias("profit"),
    )


def by_attributes(fact: DataFrame, dim: DataFrame, attributes: list[str]) -> DataFrame:
    sums = by_product(fact).join(dim.select("product_id", *attributes), "product_id")
    return sums.groupBy(*attributes).agg(
        F.sum("order_count").alias("order_count"),
        F.sum("units_sold").alias("units_sold"),
        F.sum("revenue").cast("decimal(28,4)").alias("total_revenue"),
        F.sum("profit").cast("decimal(28,4)").alias("total_profit"),
    )


def top_products(fact: DataFrame, dim: DataFrame, n: int = 10, digits: int = 2) -> DataFrame:
    sums = by_attributes(fact, dim, ["product_name", "category", "brand"])
    return (
        sums.withColumn(
            "profit_margin_pct", F.round(ratio(F.col("total_profit"), F.col("total_revenue")) * 100, digits)
        )
        .orderBy(F.desc("total_revenue"), "product_name", "category", "brand")
        .limit(n)
        .withColumn("total_revenue", F.col("total_revenue").cast("double"))
        .withColumn("total_profit", F.col("total_profit").cast("double"))
    )


def revenue_by_category(fact: DataFrame, dim: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Distinct orders need the category on the line, so lines join here."""
    kinds = dim.select("product_id", "category")
    joined = with_product(fact, kinds, lines)
    if not is_broadcast(kinds):
        # Distinct orders are shuffled by order in any case; else the rows still lie by order.
        joined = spread(joined, ["order_id"], lines)
    return joined.groupBy("category").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.sum("line_total").alias("_revenue"),
        F.count("line_total").alias("_n"),
        F.sum("profit").alias("_profit"),
    ).select(
        "category", "order_count",
        F.col("_revenue").cast("double").alias("total_revenue"),
        F.round(ratio(F.col("_revenue"), F.col("_n")), 2).alias("avg_order_value"),
        F.col("_profit").cast("double").alias("total_profit"),
    )


def monthly_sales(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.trunc("order_date", "month").alias("month")).agg(
        F.count_distinct("order_id").alias("order_count"),
        F.sum("line_total").alias("revenue"),
        F.sum("profit").alias("profit"),
    )


def month_over_month(monthly: DataFrame) -> DataFrame:
    """Change against the month before.  The window has no partitions, but its
    input has one row per calendar month."""
    w = Window.orderBy("month")
    prev = F.lag("revenue").over(w)
    return monthly.select(
        "month", "order_count",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("profit").cast("double").alias("profit"),
        prev.cast("double").alias("prev_month_revenue"),
        (F.col("revenue") - prev).cast("double").alias("revenue_change"),
        F.round(ratio(F.col("revenue") - prev, prev) * 100, 2).alias("growth_pct"),
    )


def in_range(fact: DataFrame, first: str, last: str) -> DataFrame:
    day = F.col("order_date")
    return fact.filter(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
