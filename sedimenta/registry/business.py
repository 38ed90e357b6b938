"""Star schema, dashboard and customer queries."""

from pyspark.sql import functions as F

from sedimenta.plans import customers as cu, star
from sedimenta.plans.reports import (
    category_report, city_counts_cached, daily_summary, sales_by_category_daily, slice_totals,
)
from sedimenta.registry.base import query
from sedimenta.registry.sqlshapes import (
    CUSTOMER_ORDERS, CUSTOMERS, LINES, ORDERS, PRODUCTS,
)
from sedimenta.scale import skew_join
from sedimenta.sources import shapes

FACT = f"""(SELECT l.order_id, l.line_number, o.customer_id, l.product_id, o.order_date, l.quantity, p.retail_price AS unit_price, l.line_total,
  CAST(l.line_total - l.quantity * p.cost_price AS DECIMAL(18,4)) AS profit
  FROM {LINES} l JOIN {ORDERS} o USING (order_id) JOIN {PRODUCTS} p USING (product_id) WHERE o.status = 'completed')"""
DIM = f"(SELECT *, retail_price - cost_price AS profit_margin FROM {PRODUCTS})"
RANGE = ("1997-01-01", "1997-12-31")
IN_RANGE = "order_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"


def fact(spark, sf_dir):
    return star.fact_sales(spark, sf_dir)


def dim(spark, sf_dir):
    return star.dim_product(spark, sf_dir)


def year(spark, sf_dir):
    return star.in_range(fact(spark, sf_dir), *RANGE)


def doubles(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query("dim_product", f"""
SELECT product_id, product_name, category, brand, CAST(retail_price AS DOUBLE) AS retail_price, CAST(cost_price AS DOUBLE) AS cost_price,
  CAST(profit_margin AS DOUBLE) AS profit_margin FROM {DIM}""")
def dim_product(spark, sf_dir):
    return doubles(dim(spark, sf_dir), "retail_price", "cost_price", "profit_margin")


@query("dim_customer", f"""
SELECT customer_id, c.last_name AS customer_name, email, signup_date, segment, COUNT(order_id) > 0 AS is_active
FROM {CUSTOMERS} c LEFT JOIN {CUSTOMER_ORDERS} o USING (customer_id) GROUP BY ALL""")
def dim_customer(spark, sf_dir):
    active = shapes.customer_orders(spark, sf_dir).select("customer_id").distinct().withColumn("_seen", F.lit(True))
    return shapes.customers(spark, sf_dir).join(active, "customer_id", "left").select(
        "customer_id", F.col("last_name").alias("customer_name"), "email", "signup_date", "segment",
        F.col("_seen").isNotNull().alias("is_active"),
    )


@query("dim_date", f"""
SELECT CAST(d AS DATE) AS date, year(d)::INT AS year, quarter(d)::INT AS quarter, month(d)::INT AS month, (dayofweek(d) + 1)::INT AS day_of_week,
  strftime(d, '%Y-%m') AS year_month, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series(min(order_date)::TIMESTAMP, max(order_date)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM {ORDERS})""")
def dim_date(spark, sf_dir):
    return star.dim_date(shapes.orders(spark, sf_dir), "order_date")


@query("fact_sales", f"SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_total AS DOUBLE) AS line_total, CAST(profit AS DOUBLE) AS profit) FROM {FACT}")
def fact_sales(spark, sf_dir):
    return doubles(fact(spark, sf_dir), "unit_price", "line_total", "profit")


@query("sales_kpis", f"""
SELECT COUNT(DISTINCT order_id) AS total_orders, CAST(SUM(line_total) AS DOUBLE) AS total_revenue,
  round(CAST(SUM(line_total) AS DOUBLE) / COUNT(*), 4) AS avg_order_value, CAST(SUM(profit) AS DOUBLE) AS total_profit,
  round(CAST(SUM(profit) AS DOUBLE) / CAST(SUM(line_total) AS DOUBLE) * 100, 2) AS profit_margin_pct FROM {FACT}""")
def sales_kpis(spark, sf_dir):
    return star.sales_kpis(fact(spark, sf_dir))


@query("revenue_by_category", f"""
SELECT category, COUNT(DISTINCT order_id) AS order_count, CAST(SUM(line_total) AS DOUBLE) AS total_revenue,
  round(CAST(SUM(line_total) AS DOUBLE) / COUNT(*), 2) AS avg_order_value, CAST(SUM(profit) AS DOUBLE) AS total_profit
FROM {FACT} JOIN {DIM} USING (product_id) GROUP BY 1""")
def revenue_by_category(spark, sf_dir):
    return star.revenue_by_category(fact(spark, sf_dir), dim(spark, sf_dir), shapes.lines(spark, sf_dir))


_MONTHLY = f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, COUNT(DISTINCT order_id) AS order_count,
  SUM(line_total) AS revenue, SUM(profit) AS profit FROM {FACT} GROUP BY 1"""


@query("mom_growth", f"""
WITH m AS ({_MONTHLY}), p AS (SELECT *, lag(revenue) OVER (ORDER BY month) AS prev FROM m)
SELECT month, order_count, CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit, CAST(prev AS DOUBLE) AS prev_month_revenue,
  CAST(revenue - prev AS DOUBLE) AS revenue_change, round(CAST(revenue - prev AS DOUBLE) / CAST(prev AS DOUBLE) * 100, 2) AS growth_pct FROM p""")
def mom_growth(spark, sf_dir):
    return star.month_over_month(star.monthly_sales(fact(spark, sf_dir)))


def _top(where, digits):
    return f"""SELECT product_name, category, brand, COUNT(order_id) AS order_count, SUM(quantity)::BIGINT AS units_sold,
  CAST(SUM(line_total) AS DOUBLE) AS total_revenue, CAST(SUM(profit) AS DOUBLE) AS total_profit,
  round(CAST(SUM(profit) AS DOUBLE) / CAST(SUM(line_total) AS DOUBLE) * 100, {digits}) AS profit_margin_pct
FROM {FACT} JOIN {DIM} USING (product_id) WHERE {where} GROUP BY 1, 2, 3 ORDER BY SUM(line_total) DESC, 1, 2, 3 LIMIT 10"""


@query("top_products", _top("TRUE", 2))
def top_products(spark, sf_dir):
    return star.top_products(fact(spark, sf_dir), dim(spark, sf_dir))


@query("product_report", f"""
SELECT product_name, category, brand, COUNT(order_id) AS order_count, SUM(quantity)::BIGINT AS units_sold,
  CAST(SUM(line_total) AS DOUBLE) AS total_revenue, CAST(SUM(profit) AS DOUBLE) AS total_profit
FROM {FACT} JOIN {DIM} USING (product_id) GROUP BY 1, 2, 3""")
def product_report(spark, sf_dir):
    out = star.by_attributes(fact(spark, sf_dir), dim(spark, sf_dir), ["product_name", "category", "brand"])
    return doubles(out, "total_revenue", "total_profit")


# --- dashboard --------------------------------------------------------------

@query("dash_total_revenue", f"SELECT CAST(SUM(line_total) AS DOUBLE) AS total_revenue FROM {FACT} WHERE {IN_RANGE}")
def dash_total_revenue(spark, sf_dir):
    return year(spark, sf_dir).agg(F.sum("line_total").cast("double").alias("total_revenue"))


@query("dash_total_orders", f"SELECT COUNT(DISTINCT order_id) AS total_orders FROM {FACT} WHERE {IN_RANGE}")
def dash_total_orders(spark, sf_dir):
    return year(spark, sf_dir).agg(F.count_distinct("order_id").alias("total_orders"))


@query("dash_aov", f"SELECT round(CAST(SUM(line_total) AS DOUBLE) / COUNT(*), 2) AS avg_order_value FROM {FACT} WHERE {IN_RANGE}")
def dash_aov(spark, sf_dir):
    return year(spark, sf_dir).agg(
        F.round(star.ratio(F.sum("line_total"), F.count("line_total")), 2).alias("avg_order_value")
    )


@query("dash_monthly", f"""
SELECT month, CAST(revenue AS DOUBLE) AS revenue, order_count FROM ({_MONTHLY}) WHERE month BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""")
def dash_monthly(spark, sf_dir):
    return doubles(star.monthly_sales(year(spark, sf_dir)), "revenue").select("month", "revenue", "order_count")


@query("dash_category", f"""
SELECT category, CAST(SUM(line_total) AS DOUBLE) AS total_revenue, COUNT(DISTINCT order_id) AS order_count
FROM {FACT} JOIN {DIM} USING (product_id) WHERE {IN_RANGE} GROUP BY 1""")
def dash_category(spark, sf_dir):
    out = star.revenue_by_category(year(spark, sf_dir), dim(spark, sf_dir), shapes.lines(spark, sf_dir))
    return out.select("category", "total_revenue", "order_count")


@query("dash_top_products", f"SELECT product_name AS product, category, brand, units_sold, total_revenue AS revenue, profit_margin_pct FROM ({_top(IN_RANGE, 1)})")
def dash_top_products(spark, sf_dir):
    return star.top_products(year(spark, sf_dir), dim(spark, sf_dir), 10, 1).select(
        F.col("product_name").alias("product"), "category", "brand", "units_sold",
        F.col("total_revenue").alias("revenue"), "profit_margin_pct",
    )


@query("agg_daily_sales", f"SELECT order_date, CAST(SUM(line_total) AS DOUBLE) AS daily_revenue, COUNT(DISTINCT order_id) AS daily_orders FROM {FACT} GROUP BY 1")
def agg_daily_sales(spark, sf_dir):
    return fact(spark, sf_dir).groupBy("order_date").agg(
        F.sum("line_total").cast("double").alias("daily_revenue"), F.count_distinct("order_id").alias("daily_orders")
    )


@query("daily_summary", f"""
SELECT c.city, p.category, CAST(SUM(f.line_total) AS DOUBLE) AS total_sales, COUNT(f.order_id) AS order_count, COUNT(DISTINCT f.customer_id) AS unique_customers
FROM {FACT} f JOIN {PRODUCTS} p USING (product_id) JOIN (SELECT c_custkey, n_name AS city FROM customer JOIN nation ON c_nationkey = n_nationkey) c ON f.customer_id = c.c_custkey GROUP BY 1, 2""")
def daily_summary_(spark, sf_dir):
    t = lambda n: shapes.table(spark, sf_dir, n)
    return daily_summary(fact(spark, sf_dir), shapes.products(spark, sf_dir), t("customer"), t("nation"), shapes.lines(spark, sf_dir))


@query("param_slice", f"""
SELECT COUNT(order_id) AS order_count, CAST(SUM(amount) AS DOUBLE) AS total_sales FROM {CUSTOMER_ORDERS} JOIN {CUSTOMERS} USING (customer_id)
WHERE city = 'NATION_3' AND order_date >= DATE '1997-01-01'""")
def param_slice(spark, sf_dir):
    return slice_totals(
        shapes.customer_orders(spark, sf_dir), shapes.customers(spark, sf_dir), "NATION_3", "1997-01-01"
    )


@query("category_report", f"""
SELECT category, CAST(SUM(line_total) AS DOUBLE) AS total_sales, COUNT(order_id) AS order_count,
  round(CAST(SUM(line_total) AS DOUBLE) / COUNT(*), 4) AS avg_order_value FROM {LINES} JOIN {PRODUCTS} USING (product_id) WHERE brand = 'Brand#2' GROUP BY 1""")
def category_report_(spark, sf_dir):
    return category_report(shapes.lines(spark, sf_dir), shapes.products(spark, sf_dir), "Brand#2")


@query("cached_city_counts", f"""
SELECT priority, COUNT(*) AS orders, COUNT(*) FILTER (status = 'completed') AS completed FROM {ORDERS} GROUP BY 1""")
def cached_city_counts(spark, sf_dir):
    return city_counts_cached(shapes.orders(spark, sf_dir))


# --- customers --------------------------------------------------------------

_CM = f"""SELECT customer_id, CAST(SUM(amount) AS DOUBLE) AS total_revenue, COUNT(*) AS order_count,
  CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS avg_order_value, MIN(order_date) AS first_order_date, MAX(order_date) AS latest_order_date,
  CAST(SUM(amount) AS DOUBLE) AS lifetime_value, COUNT(*) > 1 AS retention_flag FROM {ORDERS} GROUP BY 1"""


@query("customer_metrics", _CM)
def customer_metrics(spark, sf_dir):
    return doubles(cu.customer_metrics(shapes.orders(spark, sf_dir)), "total_revenue", "lifetime_value")


@query("customer_ltv", f"""
SELECT customer_id, total_revenue, order_count, CAST(date_diff('day', first_order_date, latest_order_date) AS INTEGER) AS customer_lifespan_days,
  total_revenue / (date_diff('day', first_order_date, latest_order_date) + 1) AS ltv_score FROM ({_CM})""")
def customer_ltv(spark, sf_dir):
    out = cu.lifetime_value(cu.customer_metrics(shapes.orders(spark, sf_dir)))
    return doubles(out, "total_revenue").select(
        "customer_id", "total_revenue", "order_count", "customer_lifespan_days", "ltv_score"
    )


@query("revenue_monthly", f"""
SELECT strftime(order_date, '%Y-%m') AS month, CAST(SUM(amount) AS DOUBLE) AS monthly_revenue, COUNT(*) AS monthly_orders,
  COUNT(DISTINCT customer_id) AS active_customers, CAST(SUM(amount) AS DOUBLE) / COUNT(DISTINCT customer_id) AS revenue_per_customer FROM {ORDERS} GROUP BY 1""")
def revenue_monthly(spark, sf_dir):
    return doubles(cu.monthly_revenue(shapes.orders(spark, sf_dir)), "monthly_revenue")


@query("customer_segments", f"""
SELECT customer_id, CASE WHEN total_revenue > 3000000 THEN 'High Value' WHEN total_revenue > 2000000 THEN 'Medium Value'
  WHEN order_count > 5 THEN 'Frequent Buyer' ELSE 'New Customer' END AS customer_segment FROM ({_CM})""")
def customer_segments(spark, sf_dir):
    m = cu.customer_metrics(shapes.orders(spark, sf_dir))
    return m.select(
        "customer_id",
        cu.segment(F.col("total_revenue"), F.col("order_count"), 3000000, 2000000).alias("customer_segment"),
    )


@query("customer_segments_rev", f"""
SELECT customer_id, CASE WHEN total_revenue > 3000000 THEN 'High Value' WHEN total_revenue > 2000000 THEN 'Medium Value' ELSE 'Standard' END AS customer_segment FROM ({_CM})""")
def customer_segments_rev(spark, sf_dir):
    m = cu.customer_metrics(shapes.orders(spark, sf_dir))
    return m.select(
        "customer_id", cu.segment_by_revenue(F.col("total_revenue"), 3000000, 2000000).alias("customer_segment")
    )


@query("silver_customers", f"""
SELECT customer_id, regexp_extract(email, '@(.+)', 1) AS email_domain, CAST(date_diff('day', signup_date, DATE '2001-08-01') AS INTEGER) AS customer_age_days,
  coalesce(n, 0) AS total_orders, CASE WHEN n > 10 THEN 'High Value' WHEN n > 5 THEN 'Medium Value' ELSE 'New Customer' END AS customer_segment
FROM {CUSTOMERS} LEFT JOIN (SELECT customer_id, COUNT(*) AS n FROM {CUSTOMER_ORDERS} GROUP BY 1) USING (customer_id) WHERE signup_date <= DATE '2001-08-01'""")
def silver_customers(spark, sf_dir):
    counts = shapes.customer_orders(spark, sf_dir).groupBy("customer_id").agg(F.count(F.lit(1)).alias("total_orders"))
    return cu.silver_customers(shapes.customers(spark, sf_dir), counts, F.lit("2001-08-01").cast("date"))


@query("gold_product_month", f"""
SELECT product_id, strftime(ship_date, '%Y-%m') AS month, CAST(SUM(line_total) AS DOUBLE) AS total_sales, COUNT(*) AS transaction_count,
  CAST(SUM(line_total) AS DOUBLE) / COUNT(*) AS avg_sale_amount FROM {LINES} GROUP BY 1, 2""")
def gold_product_month(spark, sf_dir):
    return doubles(cu.product_months(shapes.lines(spark, sf_dir), "product_id", "ship_date", "line_total"), "total_sales")


@query("retention_summary", f"""
SELECT COUNT(*) AS customers, COUNT(*) FILTER (n > 1) AS repeat_customers, SUM(n)::BIGINT AS orders, SUM(n - 1)::BIGINT AS repeat_orders,
  round(COUNT(*) FILTER (n > 1) * 100.0 / COUNT(*), 4) AS repeat_rate_pct FROM (SELECT customer_id, COUNT(*) AS n FROM {ORDERS} GROUP BY 1)""")
def retention_summary(spark, sf_dir):
    return cu.retention(shapes.orders(spark, sf_dir))


@query("dim_customers_summary", f"""
SELECT customer_id, segment, city, coalesce(order_count, 0) AS order_count, total_revenue AS lifetime_value, ltv FROM {CUSTOMERS} LEFT JOIN (
  SELECT customer_id, COUNT(*) AS order_count, CAST(SUM(amount) AS DOUBLE) AS total_revenue,
    CAST(SUM(amount) AS DOUBLE) / (date_diff('day', MIN(order_date), MAX(order_date)) + 1) AS ltv FROM {CUSTOMER_ORDERS} GROUP BY 1) USING (customer_id)""")
def dim_customers_summary(spark, sf_dir):
    m = cu.lifetime_value(cu.customer_metrics(shapes.customer_orders(spark, sf_dir)))
    return shapes.customers(spark, sf_dir).join(m, "customer_id", "left").select(
        "customer_id", "segment", "city", F.coalesce("order_count", F.lit(0)).alias("order_count"),
        F.col("total_revenue").cast("double").alias("lifetime_value"), F.col("ltv_score").alias("ltv"),
    )


@query("fact_orders_enriched", f"""
SELECT o.order_id, o.customer_id, o.order_date, CAST(o.amount AS DOUBLE) AS amount, o.status, c.city, c.state, c.segment, n.lines, n.units
FROM {CUSTOMER_ORDERS} o LEFT JOIN {CUSTOMERS} c USING (customer_id) LEFT JOIN (SELECT order_id, COUNT(*) AS lines, SUM(quantity)::BIGINT AS units FROM {LINES} GROUP BY 1) n USING (order_id)""")
def fact_orders_enriched(spark, sf_dir):
    """Lines are counted per order before the join."""
    per_order = shapes.lines(spark, sf_dir).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"))
    c = shapes.customers(spark, sf_dir).select("customer_id", "city", "state", "segment")
    o = shapes.customer_orders(spark, sf_dir).join(per_order, "order_id", "left")
    return doubles(skew_join(o, c, ["customer_id"], "left"), "amount").drop("priority")


@query("sales_by_category_daily", f"""
SELECT category, order_date, CAST(SUM(line_total) AS DOUBLE) AS revenue, SUM(quantity)::BIGINT AS units FROM {FACT} JOIN {PRODUCTS} USING (product_id) GROUP BY 1, 2""")
def sales_by_category_daily_(spark, sf_dir):
    return sales_by_category_daily(fact(spark, sf_dir), shapes.products(spark, sf_dir), shapes.lines(spark, sf_dir))
