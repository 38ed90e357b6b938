"""Queries over tables by name: create, insert, append, replace, read back."""

from pyspark.sql import functions as F

from sedimenta.functions import text as tx
from sedimenta.plans import features as ft
from sedimenta.registry.base import query
from sedimenta.registry.business import DIM
from sedimenta.registry.insight import _CUTOFF_ROWS, _RULE_SQL, ruled, training
from sedimenta.registry.sqlshapes import CUSTOMERS, ORDERS, PRODUCTS
from sedimenta.sources import shapes, tables

_DAYS = "order_id, customer_id, CAST(amount AS DOUBLE) AS amount, order_date"


@query("table_bronze_silver", f"""
SELECT order_id, customer_id, amount, order_date, upper(left(status, 1)) || substr(status, 2) AS status, batch FROM (
  SELECT {_DAYS}, status, 1 AS batch FROM {ORDERS} WHERE order_date < DATE '1998-01-01'
  UNION ALL SELECT {_DAYS}, status, 2 FROM {ORDERS} WHERE order_date >= DATE '1998-01-01')""")
def table_bronze_silver(spark, sf_dir):
    """Bronze saved by name, the next load appended to it, silver overwritten from it twice."""
    db = tables.database(spark)
    orders = shapes.orders(spark, sf_dir).drop("priority").withColumn("amount", F.col("amount").cast("double"))
    early = F.col("order_date") < F.lit("1998-01-01").cast("date")
    bronze, silver = f"{db}.bronze_orders", f"{db}.silver_orders"
    for batch, rows in enumerate((orders.filter(early), orders.filter(~early)), 1):
        rows = rows.withColumn("batch", F.lit(batch))
        # The second load comes with its columns in another order.
        tables.append(rows.select(*sorted(rows.columns)) if batch == 2 else rows, bronze)
        tables.overwrite(spark.table(bronze).withColumn("status", F.initcap("status")), silver)
    return spark.table(silver)


@query("table_create_as_select", f"""
SELECT product_id, product_name, category, brand, CAST(retail_price AS DOUBLE) AS retail_price, CAST(cost_price AS DOUBLE) AS cost_price,
  CAST(profit_margin AS DOUBLE) AS profit_margin, dense_rank() OVER (ORDER BY category) AS category_no FROM {DIM}""")
def table_create_as_select(spark, sf_dir):
    """The product dimension created by a SELECT over a named table, then replaced by one over itself."""
    db = tables.database(spark)
    tables.append(shapes.products(spark, sf_dir), f"{db}.products")
    dim = f"{db}.dim_product"
    tables.create_as(spark, dim, f"""
        SELECT product_id, product_name, category, brand, CAST(retail_price AS DOUBLE) AS retail_price,
          CAST(cost_price AS DOUBLE) AS cost_price, CAST(retail_price - cost_price AS DOUBLE) AS profit_margin FROM {db}.products""")
    return tables.replace_as(spark, dim, f"""
        SELECT p.*, c.category_no FROM {dim} p
        JOIN (SELECT category, row_number() OVER (ORDER BY category) AS category_no FROM (SELECT DISTINCT category FROM {dim})) c
        ON p.category = c.category""").withColumn("category_no", F.col("category_no").cast("bigint"))


_KIND = "CASE " + " ".join(f"WHEN regexp_matches(lower(product_name), '{'|'.join(ws)}') THEN '{c}'" for c, ws in tx.CATEGORY_WORDS.items()) + f" ELSE '{tx.OTHER}' END"


@query("table_gold_ai", f"""
WITH o AS (SELECT event_id, user_id, predicted_fraud, CASE WHEN predicted_fraud = 1 THEN 'High Risk' WHEN anomaly_score < -0.3 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_level FROM {_RULE_SQL}),
p AS (SELECT {_KIND} AS kind FROM {PRODUCTS}), c AS ({_CUTOFF_ROWS})
SELECT 'orders_ai' AS gold, risk_level AS label, COUNT(*) AS n FROM o GROUP BY 2
UNION ALL SELECT 'customers_ai', CASE churned WHEN 1 THEN 'churned' ELSE 'kept' END, COUNT(*) FROM c GROUP BY 2
UNION ALL SELECT 'products_ai', kind, COUNT(*) FROM p GROUP BY 2""")
def table_gold_ai(spark, sf_dir):
    """Three gold tables: orders with risk, customers with features, products with a category; read back by name."""
    db = tables.database(spark)
    checked = ruled(spark, sf_dir)
    risk = ft.risk_level(F.col("predicted_fraud"), F.col("anomaly_score"))
    tables.overwrite(checked.withColumn("risk_level", risk), f"{db}.orders_ai")
    tables.overwrite(training(spark, sf_dir), f"{db}.customers_ai")
    named = tx.classify(shapes.products(spark, sf_dir), "product_name")
    tables.overwrite(named, f"{db}.products_ai")
    kept = F.when(F.col("churned") == 1, "churned").otherwise("kept")
    labels = {"orders_ai": F.col("risk_level"), "customers_ai": kept, "products_ai": F.col("ai_category")}
    counts = [spark.table(f"{db}.{t}").groupBy(c.alias("label")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("gold"), "label", "n")
              for t, c in labels.items()]
    return counts[0].union(counts[1]).union(counts[2])


@query("table_insert_into", f"""
SELECT 'DEL-' || customer_id AS request_id, customer_id, email, 'pending' AS status, CAST(NULL AS DATE) AS completed_on FROM {CUSTOMERS} WHERE NOT consent_marketing AND NOT consent_data_sharing
UNION ALL SELECT 'DEL-1', 'CUST''1', NULL, 'completed', DATE '2024-01-31'
UNION ALL SELECT 'DEL-2', 'CUST2', 'a@example.com', 'completed', NULL""")
def table_insert_into(spark, sf_dir):
    """A log table: rows inserted from a SELECT by name and as VALUES."""
    db = tables.database(spark)
    tables.append(shapes.customers(spark, sf_dir).select("customer_id", "email", "consent_marketing", "consent_data_sharing"), f"{db}.customers")
    log = f"{db}.deletion_requests"
    tables.create(spark, log, "request_id STRING, customer_id STRING, email STRING, status STRING, completed_on DATE")
    tables.insert_select(spark, log, f"""
        SELECT 'pending' AS status, email, customer_id, concat('DEL-', customer_id) AS request_id, CAST(NULL AS DATE) AS completed_on
        FROM {db}.customers WHERE NOT consent_marketing AND NOT consent_data_sharing""")
    tables.insert_rows(spark, log, [
        {"request_id": "DEL-1", "customer_id": "CUST'1", "email": None, "status": "completed", "completed_on": "2024-01-31"},
        {"request_id": "DEL-2", "customer_id": "CUST2", "email": "a@example.com", "status": "completed", "completed_on": None}])
    return spark.table(log)


@query("table_replace_partitions", f"""
SELECT order_id, CASE WHEN year(order_date) = 1997 THEN 'closed' ELSE status END AS status, year(order_date)::INT AS year FROM {ORDERS}""")
def table_replace_partitions(spark, sf_dir):
    """A table by year of which one year is loaded again."""
    db = tables.database(spark)
    rows = shapes.orders(spark, sf_dir).select("order_id", "status", F.year("order_date").alias("year"))
    name = f"{db}.orders_by_year"
    tables.overwrite(rows, name, ["year"])
    tables.overwrite_partitions(rows.filter("year = 1997").withColumn("status", F.lit("closed")), name)
    return spark.table(name)
