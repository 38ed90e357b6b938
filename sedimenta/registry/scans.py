"""Scans, sinks and ingestion."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.registry.base import query
from sedimenta.registry.sqlshapes import LINES, ORDERS, PRODUCTS
from sedimenta.scale import work_path
from sedimenta.sources import files, shapes

ORDER_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("status", T.StringType()),
])
PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("retail_price", T.DoubleType()),
])


def _orders(spark, sf_dir):
    df = shapes.orders(spark, sf_dir).withColumn("amount", F.col("amount").cast("double"))
    return df.select(*ORDER_SCHEMA.names)


_ORDERS_SQL = f"""SELECT order_id, customer_id, CAST(amount AS DOUBLE) AS amount, order_date, status FROM {ORDERS}"""


@query("scan_csv_inferred", _ORDERS_SQL)
def scan_csv_inferred(spark, sf_dir):
    path = work_path(spark, "csv")
    _orders(spark, sf_dir).write.csv(path, header=True)
    df = files.read_csv_inferred(spark, path)
    # Inference picks the narrowest type that fits the data.
    return df.select(
        F.col("order_id").cast("bigint"), F.col("customer_id").cast("bigint"),
        F.col("amount").cast("double"), "order_date", "status",
    )


@query("scan_csv_explicit", f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN o_orderkey % 109 = 0 THEN NULL ELSE o_totalprice END AS amount,
  CASE WHEN o_orderkey % 113 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'processing' END AS status,
  o_orderkey % 109 = 0 OR o_orderkey % 113 = 0 AS is_corrupt
FROM orders""")
def scan_csv_explicit(spark, sf_dir):
    """Fields that do not parse become NULL and their line is kept."""
    raw = _orders(spark, sf_dir)
    raw = raw.withColumn(
        "amount", F.when(F.col("order_id") % 109 == 0, "null").otherwise(F.col("amount").cast("string"))
    ).withColumn(
        "order_date",
        F.when(F.col("order_id") % 113 == 0, "invalid-date").otherwise(F.col("order_date").cast("string")),
    )
    path = work_path(spark, "csv")
    raw.write.csv(path, header=True)
    df = files.read_csv(spark, path, ORDER_SCHEMA, keep_corrupt=True)
    return df.select(*ORDER_SCHEMA.names, F.col(files.CORRUPT).isNotNull().alias("is_corrupt"))


@query("scan_json", f"""
SELECT product_id, product_name, category, brand, CAST(retail_price AS DOUBLE) AS retail_price FROM {PRODUCTS}""")
def scan_json(spark, sf_dir):
    path = work_path(spark, "json")
    df = shapes.products(spark, sf_dir).withColumn("retail_price", F.col("retail_price").cast("double"))
    df.select(*PRODUCT_SCHEMA.names).write.json(path)
    return files.read_json(spark, path, PRODUCT_SCHEMA)


@query("scan_parquet_roundtrip", _ORDERS_SQL)
def scan_parquet_roundtrip(spark, sf_dir):
    path = files.write_parquet(_orders(spark, sf_dir), work_path(spark, "parquet"))
    return files.read_parquet(spark, path)


def _csv_with_defects(spark, sf_dir, broken=True):
    """Orders as text of which some amounts and dates do not parse."""
    k = F.col("order_id")
    bad = lambda every, text, c: F.when((k % every == 0) & F.lit(broken), text).otherwise(F.col(c).cast("string"))
    path = work_path(spark, "defects")
    shapes.orders(spark, sf_dir).select(
        "order_id", "customer_id", bad(97, "n/a", "amount").alias("amount"), bad(101, "no date", "order_date").alias("order_date"), "status",
    ).write.csv(path, header=True)
    return path


_TEXT = (f"(SELECT order_id, customer_id, order_id % 97 = 0 AS no_amount, order_id % 101 = 0 AS no_date, amount, order_date, status, order_id || ',' || customer_id || ',' || "
         f"CASE WHEN order_id % 97 = 0 THEN 'n/a' ELSE amount::VARCHAR END || ',' || CASE WHEN order_id % 101 = 0 THEN 'no date' ELSE order_date::VARCHAR END || ',' || status AS record FROM {ORDERS})")


@query("scan_quarantine", f"""
SELECT order_id, CASE WHEN NOT no_amount THEN CAST(amount AS DOUBLE) END AS amount, CASE WHEN NOT no_date THEN order_date END AS order_date,
  CASE WHEN no_amount OR no_date THEN record END AS record FROM {_TEXT}""")
def scan_quarantine(spark, sf_dir):
    """Rows that fit the schema and, with their raw record, those that do not."""
    good, bad = files.quarantine(
        spark, _csv_with_defects(spark, sf_dir), ORDER_SCHEMA, work_path(spark, "good"), work_path(spark, "bad"))
    columns = ["order_id", "amount", "order_date"]
    return good.select(*columns, F.lit(None).cast("string").alias("record")).union(bad.select(*columns, "record"))


@query("scan_failfast", f"""
SELECT 'defects' AS file, TRUE AS failed, COUNT(*) AS bad_records, min(record) AS first_record FROM {_TEXT} WHERE no_amount OR no_date
UNION ALL SELECT 'clean', FALSE, 0, NULL""")
def scan_failfast(spark, sf_dir):
    """A fail-fast read stops at the first file and not at the second."""
    report = lambda name, broken: files.failfast_report(
        spark, _csv_with_defects(spark, sf_dir, broken), ORDER_SCHEMA).select(F.lit(name).alias("file"), "*")
    return report("defects", True).union(report("clean", False))


@query("bronze_append", f"""
SELECT order_id, customer_id, CAST(amount AS DOUBLE) AS amount, order_date, status, 1 AS batch FROM {ORDERS} WHERE order_date < DATE '1998-01-01'
UNION ALL
SELECT order_id, customer_id, CAST(amount AS DOUBLE), order_date, status, 2 FROM {ORDERS} WHERE order_date >= DATE '1998-01-01'""")
def bronze_append(spark, sf_dir):
    """Two loads appended to one table."""
    path = work_path(spark, "bronze")
    df = _orders(spark, sf_dir)
    early = F.col("order_date") < F.lit("1998-01-01").cast("date")
    files.append(df.filter(early).withColumn("batch", F.lit(1)), path)
    files.append(df.filter(~early).withColumn("batch", F.lit(2)), path)
    return files.read_parquet(spark, path)


@query("write_partitioned", f"""
SELECT year(order_date) AS year, month(order_date) AS month, COUNT(*) AS order_count,
  CAST(SUM(amount) AS DOUBLE) AS revenue
FROM {ORDERS} GROUP BY ALL""")
def write_partitioned(spark, sf_dir):
    """Write by year and month and read every directory; a year's filter opens
    its own only (see the tests)."""
    df = (
        shapes.orders(spark, sf_dir)
        .withColumn("year", F.year("order_date"))
        .withColumn("month", F.month("order_date"))
    )
    path = files.write_partitioned(df, work_path(spark, "by-month"), ["year", "month"])
    return (
        files.read_parquet(spark, path)
        .groupBy(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("amount").cast("double").alias("revenue"))
    )


@query("range_spine", """
SELECT floor(r.range / 1000) * 1000 AS key_block, COUNT(*) AS keys, COUNT(p_partkey) AS present
FROM range((SELECT min(p_partkey) FROM part), (SELECT max(p_partkey) + 1 FROM part)) r
LEFT JOIN part ON p_partkey = r.range GROUP BY 1""")
def range_spine(spark, sf_dir):
    """A range over the keys in use shows which of them are missing."""
    part = shapes.table(spark, sf_dir, "part").select("p_partkey")
    low, high = part.agg(F.min("p_partkey"), F.max("p_partkey")).first()
    spine = spark.range(low, high + 1)
    return (
        spine.join(part, F.col("id") == F.col("p_partkey"), "left")
        .groupBy((F.floor(F.col("id") / 1000) * 1000).cast("double").alias("key_block"))
        .agg(F.count(F.lit(1)).alias("keys"), F.count("p_partkey").alias("present"))
    )


@query("ingest_with_metadata", f"""
SELECT order_id, customer_id, CAST(amount AS DOUBLE) AS amount, order_date, status,
  TIMESTAMP '2024-02-01 00:00:00' AS ingestion_time, 'orders.parquet' AS source FROM {ORDERS}""")
def ingest_with_metadata(spark, sf_dir):
    return files.ingest(_orders(spark, sf_dir), "2024-02-01 00:00:00", "orders.parquet")


@query("ingest_json_files", f"""
SELECT COUNT(*) AS row_count, COUNT(DISTINCT product_id) AS products, TRUE AS has_file,
  TIMESTAMP '2024-02-01 00:00:00' AS ingestion_time FROM {PRODUCTS}""")
def ingest_json_files(spark, sf_dir):
    path = work_path(spark, "json")
    shapes.products(spark, sf_dir).select(*PRODUCT_SCHEMA.names).write.json(path)
    return files.ingest_files(spark, path, PRODUCT_SCHEMA, "2024-02-01 00:00:00").groupBy(
        "ingestion_time"
    ).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("product_id").alias("products"),
        F.bool_and(F.col("source_file").isNotNull()).alias("has_file"),
    )


@query("format_counts", """
SELECT 'csv' AS name, COUNT(*) AS row_count FROM orders
UNION ALL SELECT 'parquet', COUNT(*) FROM orders UNION ALL SELECT 'json', COUNT(*) FROM orders""")
def format_counts(spark, sf_dir):
    df = _orders(spark, sf_dir)
    csv, js, pq = (work_path(spark, k) for k in ("csv", "json", "parquet"))
    df.write.csv(csv, header=True)
    df.write.json(js)
    df.write.parquet(pq)
    return files.format_counts({
        "csv": files.read_csv(spark, csv, ORDER_SCHEMA),
        "parquet": files.read_parquet(spark, pq),
        "json": files.read_json(spark, js, ORDER_SCHEMA),
    })


@query("row_count_audit", f"""
SELECT 'products' AS name, COUNT(*) AS row_count FROM {PRODUCTS}
UNION ALL SELECT 'orders', COUNT(*) FROM {ORDERS}
UNION ALL SELECT 'lines', COUNT(*) FROM {LINES}
UNION ALL SELECT 'fact_sales', COUNT(*) FROM {LINES} l JOIN {ORDERS} o USING (order_id) WHERE status = 'completed'""")
def row_count_audit(spark, sf_dir):
    from sedimenta.plans import star

    return files.format_counts({
        "products": shapes.products(spark, sf_dir),
        "orders": shapes.orders(spark, sf_dir),
        "lines": shapes.lines(spark, sf_dir),
        "fact_sales": star.fact_sales(spark, sf_dir),
    })
