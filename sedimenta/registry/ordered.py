"""Window queries."""

from pyspark.sql import functions as F

from sedimenta.operators import windows as w
from sedimenta.registry.base import query
from sedimenta.registry.sqlshapes import CHANGES, ORDERS
from sedimenta.sources import shapes

BY = ["customer_id"]
ORDER = ["order_date", "order_id"]
OVER = "(PARTITION BY customer_id ORDER BY order_date, order_id)"
# Small limits that make the largest customers count as hot keys, so that the
# split form runs on data of any size.
SPLIT = {"hot_rows": 15, "small_bytes": 0, "bucket_rows": 4}


def orders(spark, sf_dir, *cols):
    return shapes.orders(spark, sf_dir).select(*BY, *ORDER, *cols)


@query("win_order_sequence", f"SELECT customer_id, order_date, order_id, row_number() OVER {OVER} AS order_sequence FROM {ORDERS}")
def win_order_sequence(spark, sf_dir):
    return w.sequence_windows(orders(spark, sf_dir), BY, ORDER, number="order_sequence")


@query("win_prev_order", f"SELECT customer_id, order_date, order_id, lag(order_date) OVER {OVER} AS prev_order FROM {ORDERS}")
def win_prev_order(spark, sf_dir):
    return w.sequence_windows(orders(spark, sf_dir), BY, ORDER, lag={"prev_order": "order_date"})


@query("win_next_order", f"SELECT customer_id, order_date, order_id, lead(order_date) OVER {OVER} AS next_order FROM {ORDERS}")
def win_next_order(spark, sf_dir):
    return w.sequence_windows(orders(spark, sf_dir), BY, ORDER, lead={"next_order": "order_date"})


_RUNNING = f"""SELECT customer_id, order_date, order_id, CAST(SUM(amount) OVER (PARTITION BY customer_id ORDER BY order_date) AS DOUBLE) AS lifetime_spend FROM {ORDERS}"""


@query("win_running_total", _RUNNING)
def win_running_total(spark, sf_dir):
    """Orders of one day share a total."""
    out = w.peer_running_total(orders(spark, sf_dir, "amount"), BY, "order_date", "amount", "lifetime_spend")
    return out.drop("amount").withColumn("lifetime_spend", F.col("lifetime_spend").cast("double"))


@query("win_days_between", f"""
SELECT customer_id, order_date, order_id, CAST(date_diff('day', lag(order_date) OVER {OVER}, order_date) AS INTEGER) AS days_since_last_order FROM {ORDERS}""")
def win_days_between(spark, sf_dir):
    out = w.sequence_windows(orders(spark, sf_dir), BY, ORDER, lag={"prev": "order_date"})
    return out.withColumn("days_since_last_order", F.datediff("order_date", "prev")).drop("prev")


@query("win_repeat_flag", f"SELECT customer_id, order_date, order_id, row_number() OVER {OVER} > 1 AS is_repeat_customer FROM {ORDERS}")
def win_repeat_flag(spark, sf_dir):
    out = w.sequence_windows(orders(spark, sf_dir), BY, ORDER, number="n")
    return out.withColumn("is_repeat_customer", F.col("n") > 1).drop("n")


_RANK = f"""SELECT customer_id, CAST(total_revenue AS DOUBLE) AS total_revenue, rank() OVER (ORDER BY total_revenue DESC) AS customer_rank
FROM (SELECT customer_id, SUM(amount) AS total_revenue FROM {ORDERS} GROUP BY 1)"""


@query("win_customer_rank", _RANK)
def win_customer_rank(spark, sf_dir):
    per = shapes.orders(spark, sf_dir).groupBy("customer_id").agg(F.sum("amount").alias("total_revenue"))
    return w.global_rank(per, "total_revenue", "customer_rank").withColumn(
        "total_revenue", F.col("total_revenue").cast("double")
    )


@query("win_topn_per_group", f"""
SELECT customer_id, order_id, CAST(amount AS DOUBLE) AS amount, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY amount DESC, order_id) AS rank FROM {ORDERS}) WHERE rank <= 3""")
def win_topn_per_group(spark, sf_dir):
    df = shapes.orders(spark, sf_dir).select("customer_id", "order_id", "amount")
    top = w.top_n_per_group(df, BY, [F.desc("amount"), F.asc("order_id")], 3, "rank")
    return top.withColumn("amount", F.col("amount").cast("double")).withColumn("rank", F.col("rank").cast("bigint"))


@query("dedup_latest", f"""
SELECT user_id, status, amount, updated_at, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, seq DESC) AS rn FROM {CHANGES}) WHERE rn = 1""")
def dedup_latest(spark, sf_dir):
    return w.latest_per_key(
        shapes.change_log(spark, sf_dir), ["user_id"], [F.desc("updated_at"), F.desc("seq")]
    )


# --- the same operators with hot keys split ---------------------------------

@query("win_sequence_split", f"""
SELECT customer_id, order_date, order_id, row_number() OVER {OVER} AS order_sequence, lag(order_date) OVER {OVER} AS prev_order,
  lead(order_date) OVER {OVER} AS next_order,
  CAST(SUM(amount) OVER (PARTITION BY customer_id ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM {ORDERS}""")
def win_sequence_split(spark, sf_dir):
    out = w.sequence_windows(
        orders(spark, sf_dir, "amount"), BY, ORDER, number="order_sequence",
        lag={"prev_order": "order_date"}, lead={"next_order": "order_date"}, running={"running": "amount"}, **SPLIT,
    )
    return out.drop("amount").withColumn("running", F.col("running").cast("double"))


@query("win_running_total_split", _RUNNING)
def win_running_total_split(spark, sf_dir):
    out = w.peer_running_total(
        orders(spark, sf_dir, "amount"), BY, "order_date", "amount", "lifetime_spend", **SPLIT
    )
    return out.drop("amount").withColumn("lifetime_spend", F.col("lifetime_spend").cast("double"))


@query("win_customer_rank_split", _RANK)
def win_customer_rank_split(spark, sf_dir):
    per = shapes.orders(spark, sf_dir).groupBy("customer_id").agg(F.sum("amount").alias("total_revenue"))
    return w.global_rank(per, "total_revenue", "customer_rank", **SPLIT).withColumn(
        "total_revenue", F.col("total_revenue").cast("double")
    )
