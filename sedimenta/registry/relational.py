"""Projection, filter, join, aggregate, sort, set and scalar operators."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions import cleaning
from sedimenta.operators import merge as mg
from sedimenta.operators.collecting import collect_distinct_pieces, collect_pieces
from sedimenta.operators.percentiles import exact_percentiles
from sedimenta.operators.windows import latest_per_key
from sedimenta.plans.star import ratio
from sedimenta.registry.base import query
from sedimenta.registry.sqlshapes import (
    CUSTOMER_ORDERS, CUSTOMERS, DIRTY, EVENTS_END, LINES, ORDERS, PRODUCTS,
)
from sedimenta.scale import broadcast_if_small, hot_keys, salted_join, skew_join
from sedimenta.sources import shapes

EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


# --- projection and filters -------------------------------------------------

@query("project", f"SELECT order_id, CAST(amount AS DOUBLE) AS total, 'north' AS region FROM {ORDERS}")
def project(spark, sf_dir):
    return shapes.orders(spark, sf_dir).select(
        "order_id", F.col("amount").cast("double").alias("total"), F.lit("north").alias("region")
    )


@query("filter_compare", "SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_quantity >= 45 AND l_discount < 0.02")
def filter_compare(spark, sf_dir):
    df = shapes.table(spark, sf_dir, "lineitem")
    return df.filter(F.col("l_quantity") >= 45).filter("l_discount < 0.02D").select(
        "l_orderkey", "l_quantity", "l_discount"
    )


@query("filter_boolean", f"""
SELECT order_id, amount, status, email FROM {DIRTY}
WHERE amount < 0 OR NOT regexp_matches(email, '{EMAIL}') OR NOT (status IN ('pending','completed','cancelled'))""")
def filter_boolean(spark, sf_dir):
    bad = (
        (F.col("amount") < 0)
        | ~F.col("email").rlike(EMAIL)
        | ~F.col("status").isin("pending", "completed", "cancelled")
    )
    return shapes.dirty_orders(spark, sf_dir).filter(bad).select("order_id", "amount", "status", "email")


@query("filter_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT','2-HIGH')")
def filter_in(spark, sf_dir):
    return shapes.table(spark, sf_dir, "orders").filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    ).select("o_orderkey", "o_orderpriority")


@query("filter_regex", f"SELECT order_id, email FROM {DIRTY} WHERE regexp_matches(email, '{EMAIL}')")
def filter_regex(spark, sf_dir):
    return shapes.dirty_orders(spark, sf_dir).filter(F.col("email").rlike(EMAIL)).select("order_id", "email")


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR contains(p_type, 'PROMO')")
def filter_like(spark, sf_dir):
    return shapes.table(spark, sf_dir, "part").filter(
        F.col("p_name").like("%ring%") | F.col("p_type").contains("PROMO")
    ).select("p_partkey", "p_name")


@query("filter_between", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
def filter_between(spark, sf_dir):
    return shapes.table(spark, sf_dir, "part").filter(F.col("p_size").between(10, 20)).select("p_partkey", "p_size")


@query("filter_last_n_days", f"""
SELECT event_id, ts FROM events WHERE ts >= {EVENTS_END} - INTERVAL 7 DAY""")
def filter_last_n_days(spark, sf_dir):
    """Relative to the newest row, which stands for the clock."""
    events = shapes.table(spark, sf_dir, "events")
    since = shapes.latest(events, "ts") - F.expr("INTERVAL 7 DAY")
    return events.filter(F.col("ts") >= since).select("event_id", "ts")


@query("case_segment", f"""
SELECT order_id, CASE WHEN amount IS NULL THEN 'unknown' WHEN amount > 300000 THEN 'large'
  WHEN amount > 100000 THEN 'medium' ELSE 'small' END AS size_class,
  coalesce(status, 'none') AS status, isnan(coalesce(amount, 0)) AS not_a_number FROM {DIRTY}""")
def case_segment(spark, sf_dir):
    a = F.col("amount")
    size = F.when(a.isNull(), "unknown").when(a > 300000, "large").when(a > 100000, "medium").otherwise("small")
    return shapes.dirty_orders(spark, sf_dir).select(
        "order_id", size.alias("size_class"), F.coalesce("status", F.lit("none")).alias("status"),
        F.isnan(F.coalesce("amount", F.lit(0.0))).alias("not_a_number"),
    )


@query("cast_types", f"""
SELECT order_id, CAST(CAST(amount AS DECIMAL(10,2)) AS DOUBLE) AS amount_dec, TRY_CAST(order_date AS DATE) AS day,
  TRY_CAST(substr(order_id, 4) AS BIGINT) AS number, TRY_CAST(status AS INTEGER) AS not_a_number FROM {DIRTY}""")
def cast_types(spark, sf_dir):
    return shapes.dirty_orders(spark, sf_dir).select(
        "order_id",
        F.col("amount").try_cast("decimal(10,2)").cast("double").alias("amount_dec"),
        F.col("order_date").try_cast("date").alias("day"),
        F.expr("try_cast(substr(order_id, 4) AS bigint)").alias("number"),
        F.col("status").try_cast("int").alias("not_a_number"),
    )


@query("null_fill_drop", f"""
SELECT order_id, customer_id, coalesce(amount, 0) AS amount, coalesce(status, 'unknown') AS status
FROM {DIRTY} WHERE order_id IS NOT NULL AND customer_id IS NOT NULL""")
def null_fill_drop(spark, sf_dir):
    df = shapes.dirty_orders(spark, sf_dir).select("order_id", "customer_id", "amount", "status")
    return df.na.drop(subset=["order_id", "customer_id"]).na.fill({"amount": 0.0, "status": "unknown"})


_RAW_CUSTOMERS = """SELECT '  ' || c_name || ' ' AS "Customer Name",
  CASE WHEN c_custkey % 79 = 0 THEN 'n/a' ELSE strftime(DATE '1994-01-01' + CAST(c_custkey % 1500 AS INTEGER), '%m/%d/%Y') END AS signup_date,
  CASE WHEN c_custkey % 67 = 0 THEN 'bad' ELSE CAST(c_custkey % 5 + 1 AS VARCHAR) END AS rating,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE lower(c_mktsegment) END AS comments FROM customer"""

_CLEAN_CUSTOMERS = f"""SELECT trim(lower("Customer Name")) AS customer_name,
  CAST(try_strptime(signup_date, '%m/%d/%Y') AS DATE) AS signup_date, TRY_CAST(rating AS INTEGER) AS rating,
  nullif(trim(comments), '') AS comments FROM ({_RAW_CUSTOMERS})"""


def raw_customers(spark, sf_dir):
    k = F.col("c_custkey")
    day = F.date_add(F.lit("1994-01-01").cast("date"), (k % 1500).cast("int"))
    return shapes.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("Customer Name"),
        F.when(k % 79 == 0, "n/a").otherwise(F.date_format(day, "MM/dd/yyyy")).alias("signup_date"),
        F.when(k % 67 == 0, "bad").otherwise((k % 5 + 1).cast("string")).alias("rating"),
        F.when(k % 3 == 0, "").otherwise(F.lower("c_mktsegment")).alias("comments"),
    )


def clean_customers_of(df):
    return df.withColumnRenamed("Customer Name", "customer_name").select(
        cleaning.tidy(F.col("customer_name")).alias("customer_name"),
        cleaning.parse_date(F.col("signup_date"), "MM/dd/yyyy").alias("signup_date"),
        F.col("rating").try_cast("int").alias("rating"),
        cleaning.blank_to_null(F.col("comments")).alias("comments"),
    )


@query("clean_customers", _CLEAN_CUSTOMERS)
def clean_customers(spark, sf_dir):
    return clean_customers_of(raw_customers(spark, sf_dir))


@query("rejects_split", f"""
SELECT CASE WHEN customer_name IS NOT NULL AND rating IS NOT NULL AND signup_date IS NOT NULL THEN 'silver' ELSE 'rejects' END AS layer,
  customer_name, signup_date, rating FROM ({_CLEAN_CUSTOMERS})""")
def rejects_split(spark, sf_dir):
    ok, bad = cleaning.split_valid(clean_customers(spark, sf_dir), ["customer_name", "rating", "signup_date"])
    cols = ["customer_name", "signup_date", "rating"]
    return ok.select(F.lit("silver").alias("layer"), *cols).union(bad.select(F.lit("rejects"), *cols))


@query("layer_counts", f"""
WITH c AS ({_CLEAN_CUSTOMERS}), n AS (SELECT COUNT(*) AS total,
  COUNT(*) FILTER (customer_name IS NOT NULL AND rating IS NOT NULL AND signup_date IS NOT NULL) AS ok FROM c)
SELECT total AS bronze, ok AS silver, total - ok AS rejects, round(ok * 100.0 / total, 4) AS preserved_pct FROM n""")
def layer_counts(spark, sf_dir):
    clean = clean_customers(spark, sf_dir)
    ok = F.col("customer_name").isNotNull() & F.col("rating").isNotNull() & F.col("signup_date").isNotNull()
    return clean.agg(F.count(F.lit(1)).alias("bronze"), F.count_if(ok).alias("silver")).select(
        "bronze", "silver", (F.col("bronze") - F.col("silver")).alias("rejects"),
        F.round(ratio(F.col("silver") * 100, F.col("bronze")), 4).alias("preserved_pct"),
    )


@query("dup_row_count", f"""
SELECT COUNT(*) AS total_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {DIRTY})) AS distinct_rows,
  COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {DIRTY})) AS duplicate_rows FROM {DIRTY}""")
def dup_row_count(spark, sf_dir):
    from sedimenta.operators.quality import duplicate_rows

    return duplicate_rows(shapes.dirty_orders(spark, sf_dir))


@query("dedup_keys", f"""
SELECT order_id, customer_id, amount, order_date, status, email FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_date DESC NULLS LAST, amount DESC NULLS LAST) AS rn FROM {DIRTY})
WHERE rn = 1 AND order_id IS NOT NULL""")
def dedup_keys(spark, sf_dir):
    df = shapes.dirty_orders(spark, sf_dir).filter(F.col("order_id").isNotNull())
    return latest_per_key(df, ["order_id"], [F.desc_nulls_last("order_date"), F.desc_nulls_last("amount")])


# --- joins ------------------------------------------------------------------

@query("join_inner", f"""
SELECT o.order_id, o.customer_id, c.segment, c.city, CAST(o.amount AS DOUBLE) AS amount
FROM {CUSTOMER_ORDERS} o JOIN {CUSTOMERS} c USING (customer_id)""")
def join_inner(spark, sf_dir):
    c = shapes.customers(spark, sf_dir).select("customer_id", "segment", "city")
    return skew_join(shapes.customer_orders(spark, sf_dir), c, ["customer_id"]).select(
        "order_id", "customer_id", "segment", "city", F.col("amount").cast("double").alias("amount")
    )


@query("join_left", f"""
SELECT o.order_id, o.customer_id, c.city FROM {CUSTOMER_ORDERS} o
LEFT JOIN (SELECT * FROM {CUSTOMERS} WHERE consent_marketing) c USING (customer_id)""")
def join_left(spark, sf_dir):
    """Orders without a match stay, with NULLs."""
    c = shapes.customers(spark, sf_dir).filter("consent_marketing").select("customer_id", "city")
    return skew_join(shapes.customer_orders(spark, sf_dir), c, ["customer_id"], "left").select(
        "order_id", "customer_id", "city"
    )


@query("join_broadcast", """
SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def join_broadcast(spark, sf_dir):
    """Both dimensions are broadcast after a check of their size."""
    t = lambda n: shapes.table(spark, sf_dir, n)
    return (
        t("customer")
        .join(broadcast_if_small(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(broadcast_if_small(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_name", "r_name")
    )


@query("join_sort_merge", f"""
SELECT o.order_id, l.line_number, l.product_id, o.status FROM {LINES} l JOIN {ORDERS} o USING (order_id)""")
def join_sort_merge(spark, sf_dir):
    o = shapes.orders(spark, sf_dir).select("order_id", "status").hint("merge")
    return skew_join(shapes.lines(spark, sf_dir), o, ["order_id"]).select(
        "order_id", "line_number", "product_id", "status"
    )


@query("join_salted", f"""
SELECT c.customer_id, c.segment, COUNT(*) AS orders, CAST(SUM(o.amount) AS DOUBLE) AS amount
FROM {CUSTOMER_ORDERS} o JOIN {CUSTOMERS} c USING (customer_id) GROUP BY ALL""")
def join_salted(spark, sf_dir):
    """The salted join with the largest customers treated as hot keys."""
    o = shapes.customer_orders(spark, sf_dir)
    c = shapes.customers(spark, sf_dir).select("customer_id", "segment")
    hot = hot_keys(o, ["customer_id"], hot_rows=15, small_bytes=0)
    return salted_join(o, c, ["customer_id"], "inner", hot).groupBy("customer_id", "segment").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount").cast("double").alias("amount")
    )


@query("join_theta", f"""
SELECT o.order_id, c.customer_id, o.order_date, c.signup_date FROM {CUSTOMER_ORDERS} o
JOIN {CUSTOMERS} c ON o.customer_id = c.customer_id AND o.order_date >= c.signup_date""")
def join_theta(spark, sf_dir):
    """Equality carries the join, the inequality filters its rows."""
    c = shapes.customers(spark, sf_dir).select("customer_id", "signup_date")
    return (
        skew_join(shapes.customer_orders(spark, sf_dir), c, ["customer_id"])
        .filter(F.col("order_date") >= F.col("signup_date"))
        .select("order_id", "customer_id", "order_date", "signup_date")
    )


@query("join_key_violations", f"""
SELECT order_id, COUNT(*) AS row_count FROM {DIRTY} GROUP BY 1 HAVING COUNT(*) > 1 OR order_id IS NULL""")
def join_key_violations(spark, sf_dir):
    return mg.key_violations(shapes.dirty_orders(spark, sf_dir), ["order_id"])


# --- aggregation ------------------------------------------------------------

@query("agg_basic", """
SELECT l_partkey AS product_id, SUM(CAST(l_quantity AS BIGINT))::BIGINT AS total_quantity, COUNT(*) AS order_count,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_price
FROM lineitem GROUP BY 1""")
def agg_basic(spark, sf_dir):
    return shapes.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total_quantity"),
        F.count(F.lit(1)).alias("order_count"),
        (F.sum(shapes.money("l_extendedprice")).cast("double") / F.count(F.lit(1))).alias("avg_price"),
    )


@query("agg_count_distinct", f"""
SELECT category, COUNT(DISTINCT brand) AS brands, COUNT(DISTINCT product_name) AS names FROM {PRODUCTS} GROUP BY 1""")
def agg_count_distinct(spark, sf_dir):
    return shapes.products(spark, sf_dir).groupBy("category").agg(
        F.count_distinct("brand").alias("brands"), F.count_distinct("product_name").alias("names")
    )


@query("agg_collect", f"""
SELECT customer_id, piece, array_to_string(list(order_id ORDER BY order_date, order_id), ',') AS order_history FROM (
  SELECT *, (row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) - 1) // 10 AS piece FROM {ORDERS})
GROUP BY 1, 2""")
def agg_collect(spark, sf_dir):
    """The whole order history per customer, in arrays of bounded length."""
    df = shapes.orders(spark, sf_dir).select("customer_id", "order_date", "order_id")
    lists = collect_pieces(df, ["customer_id"], "order_id", ["order_date", "order_id"], piece_rows=10)
    return lists.select(
        "customer_id", "piece", F.array_join(F.col("items").cast("array<string>"), ",").alias("order_history")
    )


@query("agg_collect_distinct", f"""
SELECT category, piece, array_to_string(list(brand ORDER BY brand), ',') AS brands FROM (
  SELECT *, (row_number() OVER (PARTITION BY category ORDER BY brand) - 1) // 10 AS piece FROM (SELECT DISTINCT category, brand FROM {PRODUCTS}))
GROUP BY 1, 2""")
def agg_collect_distinct(spark, sf_dir):
    sets = collect_distinct_pieces(shapes.products(spark, sf_dir), ["category"], "brand", piece_rows=10)
    return sets.select("category", "piece", F.array_join("items", ",").alias("brands"))


@query("agg_conditional", f"""
SELECT status, COUNT(*) FILTER (amount > 200000) AS large_orders,
  CAST(SUM(CASE WHEN priority = '1-URGENT' THEN amount ELSE 0 END) AS DOUBLE) AS urgent_amount FROM {ORDERS} GROUP BY 1""")
def agg_conditional(spark, sf_dir):
    urgent = F.when(F.col("priority") == "1-URGENT", F.col("amount")).otherwise(F.lit(0).cast("decimal(18,2)"))
    return shapes.orders(spark, sf_dir).groupBy("status").agg(
        F.count_if(F.col("amount") > 200000).alias("large_orders"),
        F.sum(urgent).cast("double").alias("urgent_amount"),
    )


@query("agg_stddev", "SELECT event_type, round(stddev_samp(value), 6) AS std_value FROM events GROUP BY 1")
def agg_stddev(spark, sf_dir):
    return shapes.table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.round(F.stddev("value"), 6).alias("std_value")
    )


@query("agg_having", f"""
SELECT customer_id, CAST(SUM(amount) AS DOUBLE) AS total_spent FROM {ORDERS} GROUP BY 1 HAVING SUM(amount) > 2500000""")
def agg_having(spark, sf_dir):
    return (
        shapes.orders(spark, sf_dir).groupBy("customer_id").agg(F.sum("amount").alias("total_spent"))
        .filter(F.col("total_spent") > 2500000)
        .withColumn("total_spent", F.col("total_spent").cast("double"))
    )


@query("sales_totals", f"""
SELECT COUNT(*) AS total_orders, CAST(SUM(amount) AS DOUBLE) AS total_revenue, CAST(MIN(amount) AS DOUBLE) AS smallest,
  CAST(MAX(amount) AS DOUBLE) AS largest FROM {ORDERS}""")
def sales_totals(spark, sf_dir):
    return shapes.orders(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("amount").cast("double").alias("total_revenue"),
        F.min("amount").cast("double").alias("smallest"),
        F.max("amount").cast("double").alias("largest"),
    )


_NUM = [*[(c, "orders") for c in ("o_orderkey", "o_custkey", "o_totalprice")],
        *[(c, "lineitem") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")]]


@query("describe_long", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", COUNT({c}) AS "count", round(avg(CAST({c} AS DOUBLE)), 4) AS mean,
  round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM {t}""" for c, t in _NUM))
def describe_long(spark, sf_dir):
    """Every numeric column of both tables, found by type."""
    numeric = lambda df: [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    from sedimenta.operators.profile import describe_numbers

    orders, lines = (shapes.table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    return describe_numbers(orders, numeric(orders)).union(describe_numbers(lines, numeric(lines)))


@query("summary_quartiles", """
SELECT round(quantile_cont(o_totalprice, 0.25), 4) AS p25, round(quantile_cont(o_totalprice, 0.5), 4) AS p50,
  round(quantile_cont(o_totalprice, 0.75), 4) AS p75 FROM orders""")
def summary_quartiles(spark, sf_dir):
    df = shapes.table(spark, sf_dir, "orders")
    q = exact_percentiles(df, [], "o_totalprice", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return q.select(*[F.round(c, 4).alias(c) for c in q.columns])


@query("quartiles_split", """
SELECT event_type, round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.75), 4) AS p75
FROM events GROUP BY 1""")
def quartiles_split(spark, sf_dir):
    """The counted form of the percentile, as used for groups too large for one task."""
    df = shapes.table(spark, sf_dir, "events")
    q = exact_percentiles(
        df, ["event_type"], "value", {"p25": 0.25, "p75": 0.75}, hot_rows=100, small_bytes=0, bucket_rows=50
    )
    return q.select("event_type", F.round("p25", 4).alias("p25"), F.round("p75", 4).alias("p75"))


@query("dup_keys", f"SELECT order_id, COUNT(*) AS n FROM {DIRTY} GROUP BY 1 HAVING COUNT(*) > 1")
def dup_keys(spark, sf_dir):
    return (
        shapes.dirty_orders(spark, sf_dir).groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )


_FIELDS = " || ".join(f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')" for c in (
    "order_id", "customer_id", "amount", "order_date", "status", "priority"))
_PARTS = " || '-' || ".join(
    f"lpad(sum(('0x' || substr(d, {8 * i + 1}, 8))::BIGINT)::VARCHAR, 20, '0')" for i in range(4))


@query("table_checksum", f"SELECT COUNT(*) AS row_count, {_PARTS} AS checksum FROM (SELECT md5({_FIELDS}) AS d FROM {ORDERS})")
def table_checksum(spark, sf_dir):
    return mg.checksum(shapes.orders(spark, sf_dir))


# --- sort and set operators -------------------------------------------------

@query("sort_multi", f"SELECT priority, amount::DOUBLE AS amount, order_id FROM {ORDERS} ORDER BY priority, amount DESC, order_id")
def sort_multi(spark, sf_dir):
    """The unique last key lets range partitioning cut runs of equal values."""
    return (
        shapes.orders(spark, sf_dir)
        .select("priority", F.col("amount").cast("double").alias("amount"), "order_id")
        .orderBy("priority", F.desc("amount"), "order_id")
    )


@query("schema_evolve_union", f"""
SELECT order_id, CAST(amount AS DOUBLE) AS amount, NULL::VARCHAR AS status, NULL::VARCHAR AS priority, 1 AS version FROM {ORDERS} WHERE order_date < DATE '1997-01-01'
UNION ALL SELECT order_id, CAST(amount AS DOUBLE), status, NULL, 2 FROM {ORDERS} WHERE order_date >= DATE '1997-01-01' AND order_date < DATE '1999-01-01'
UNION ALL SELECT order_id, CAST(amount AS DOUBLE), status, priority, 3 FROM {ORDERS} WHERE order_date >= DATE '1999-01-01'""")
def schema_evolve_union(spark, sf_dir):
    """Three versions of a feed, each with one column more; missing is NULL."""
    df = shapes.orders(spark, sf_dir).withColumn("amount", F.col("amount").cast("double"))
    day = lambda s: F.lit(s).cast("date")
    d = F.col("order_date")
    v1 = df.filter(d < day("1997-01-01")).select("order_id", "amount", F.lit(1).alias("version"))
    v2 = df.filter((d >= day("1997-01-01")) & (d < day("1999-01-01"))).select(
        "order_id", "amount", "status", F.lit(2).alias("version"))
    v3 = df.filter(d >= day("1999-01-01")).select(
        "order_id", "amount", "status", "priority", F.lit(3).alias("version"))
    return v1.unionByName(v2, allowMissingColumns=True).unionByName(v3, allowMissingColumns=True)


# --- scalar functions -------------------------------------------------------

@query("fn_string", """
SELECT c_custkey, upper(trim(c_name)) AS up, lower(c_mktsegment) AS low, c_name || '/' || c_mktsegment AS joined,
  concat_ws('-', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS ws, left(c_name, 4) AS l4, right(c_name, 4) AS r4,
  split_part(c_name, '#', 2) AS part2, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS padded, CAST(length(c_name) AS INTEGER) AS len FROM customer""")
def fn_string(spark, sf_dir):
    return shapes.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.upper(F.trim("c_name")).alias("up"),
        F.lower("c_mktsegment").alias("low"),
        F.concat("c_name", F.lit("/"), "c_mktsegment").alias("joined"),
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("ws"),
        F.left("c_name", F.lit(4)).alias("l4"),
        F.right("c_name", F.lit(4)).alias("r4"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("part2"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("padded"),
        F.length("c_name").alias("len"),
    )


@query("fn_regex", f"""
SELECT order_id, regexp_replace(email, '[0-9]+', '#', 'g') AS masked, regexp_extract(email, '@(.+)', 1) AS domain,
  TRY_CAST(regexp_replace('$' || amount::DECIMAL(18,2) || ' USD', '[^0-9.\\-]', '', 'g') AS DOUBLE) AS amount FROM {DIRTY}""")
def fn_regex(spark, sf_dir):
    priced = F.concat(F.lit("$"), F.col("amount").cast("decimal(18,2)").cast("string"), F.lit(" USD"))
    return shapes.dirty_orders(spark, sf_dir).select(
        "order_id",
        F.regexp_replace("email", "[0-9]+", "#").alias("masked"),
        F.regexp_extract("email", "@(.+)", 1).alias("domain"),
        cleaning.to_number(priced).alias("amount"),
    )


@query("fn_date", f"""
SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m') AS month_text, CAST(date_trunc('month', ts) AS DATE) AS month_start,
  CAST(date_diff('day', CAST(ts AS DATE), CAST({EVENTS_END} AS DATE)) AS INTEGER) AS age_days, CAST(ts AS DATE) + 30 AS due,
  CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(hour(ts) AS INTEGER) AS h, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow,
  CAST('2024-01-31 10:00:00' AS TIMESTAMP) AS fixed_ts FROM events""")
def fn_date(spark, sf_dir):
    events = shapes.table(spark, sf_dir, "events")
    end = shapes.latest(events, "ts").cast("date")
    day = F.col("ts").cast("date")
    return events.select(
        "event_id", day.alias("day"), F.date_format("ts", "yyyy-MM").alias("month_text"),
        F.trunc("ts", "month").alias("month_start"), F.datediff(end, day).alias("age_days"),
        F.date_add(day, 30).alias("due"), F.year("ts").alias("y"), F.month("ts").alias("m"),
        F.hour("ts").alias("h"), F.dayofweek("ts").alias("dow"),
        F.try_to_timestamp(F.lit("2024-01-31 10:00:00")).cast("timestamp_ntz").alias("fixed_ts"),
    )


@query("fn_math", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_orderkey % 7 AS m7, l_extendedprice / l_quantity AS unit,
  CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)), 1) AS DOUBLE) AS rounded,
  l_quantity * 100 - 5 AS lin, CASE WHEN l_discount = 0 THEN NULL ELSE round(l_tax / l_discount, 4) END AS safe_ratio FROM lineitem""")
def fn_math(spark, sf_dir):
    return shapes.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_orderkey") % 7).alias("m7"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"),
        F.round(F.col("l_extendedprice").cast("decimal(12,2)"), 1).cast("double").alias("rounded"),
        (F.col("l_quantity") * 100 - 5).alias("lin"),
        F.round(F.try_divide("l_tax", "l_discount"), 4).alias("safe_ratio"),
    )


@query("fn_hash", "SELECT c_custkey, sha256(c_name) AS name_hash, sha256(concat_ws('|', CAST(c_custkey AS VARCHAR), 's')) AS key_hash FROM customer")
def fn_hash(spark, sf_dir):
    return shapes.table(spark, sf_dir, "customer").select(
        "c_custkey", F.sha2("c_name", 256).alias("name_hash"),
        F.sha2(F.concat_ws("|", F.col("c_custkey").cast("string"), F.lit("s")), 256).alias("key_hash"),
    )


@query("fn_array", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, nullif(split_part(p_name, ' ', 9), '') AS ninth_word,
  list_contains(['PROMO','SMALL'], p_type) AS listed FROM part""")
def fn_array(spark, sf_dir):
    """``get`` gives NULL past the end of an array."""
    words = F.split("p_name", " ")
    return shapes.table(spark, sf_dir, "part").select(
        "p_partkey", F.get(words, F.lit(0)).alias("first_word"), F.get(words, F.lit(8)).alias("ninth_word"),
        F.array_contains(F.array(F.lit("PROMO"), F.lit("SMALL")), F.col("p_type")).alias("listed"),
    )
