"""Times the headline queries and, next to some, the plain way to do the same.

Prints one JSON line.  ``queries`` holds seconds per query (the faster of two
runs, plan included, all rows produced); ``plain`` the times of the direct
formulation a job of this kind starts from, for the same result:

* ``quality_per_rule``: one action per rule and column instead of one pass;
* ``full_refresh``: rewrite the whole table instead of the touched buckets;
* ``csv_scan``: the scan of the same rows from CSV instead of Parquet;
* ``shuffle_join``: the dimension shuffled instead of broadcast;
* ``uncached_counts``: two scans instead of one cached read.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sedimenta.operators import merge as mg, quality as q  # noqa: E402
from sedimenta.registry import QUERIES  # noqa: E402
from sedimenta.scale import work_path  # noqa: E402
from sedimenta.sources import files, shapes  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "agg_basic", "agg_count_distinct", "describe_long", "summary_quartiles",
    "join_inner", "join_sort_merge", "join_broadcast", "join_theta", "daily_summary",
    "win_order_sequence", "win_running_total", "win_customer_rank", "win_topn_per_group", "dedup_latest",
    "merge_newer_wins", "scd2_history", "as_of_state", "snapshot_diff", "run_incremental",
    "dq_rule_labels", "dq_expectations", "dq_column_profile", "dq_run_report", "dq_metrics",
    "fact_sales", "revenue_by_category", "mom_growth", "top_products", "customer_ltv", "sales_by_category_daily",
    "gdpr_access", "gdpr_erasure_orders", "tokenize", "audit_failed",
    "lineage_impact", "run_duration_p95", "rfm_features", "classify_text", "sentiment",
    "anomaly_iforest", "churn_rf", "stream_upsert", "zorder_layout",
]


def run(df):
    df.write.format("noop").mode("overwrite").save()


def timed(fn):
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def best(fn, runs=2):
    return round(min(timed(fn) for _ in range(runs)), 3)


def quality_per_rule(spark):
    """Row counts, null counts, distinct counts and rules as separate actions."""
    df = shapes.dirty_orders(spark, SF_DIR)
    df.count()
    for c in df.columns:
        df.filter(F.col(c).isNull()).count()
    df.select("order_id").distinct().count()
    df.filter("amount > 0").count()
    df.filter(F.col("status").isin(q.ORDER_STATUSES)).count()
    df.filter(F.col("email").isNotNull()).count()
    df.filter(F.col("email").rlike(q.EMAIL_PATTERN)).count()


def merge_cases(spark):
    """One percent of the orders change; the changes sit in recent keys."""
    orders = shapes.orders(spark, SF_DIR).withColumn("updated_at", F.col("order_date"))
    path = mg.write_bucketed(orders, work_path(spark, "bench-orders"), ["order_id"], 64)
    top = orders.agg(F.max("order_id")).first()[0]
    changed = orders.filter(F.col("order_id") == top).withColumn("updated_at", F.date_add("updated_at", 1))
    source = files.read_parquet(spark, files.write_parquet(changed, work_path(spark, "bench-changes")))

    def incremental():
        mg.merge_into(spark, path, source, ["order_id"], 64, mg.newer("updated_at"))

    def full():
        merged = mg.merge(mg.read_bucketed(spark, path), source, ["order_id"], mg.newer("updated_at"))
        mg.write_bucketed(merged, work_path(spark, "bench-full"), ["order_id"], 64)

    return incremental, full


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        try:
            times[name] = best(lambda: run(QUERIES[name](spark, SF_DIR)))
        except Exception as e:  # noqa: BLE001 - one broken query must not hide the others
            times[name] = None
            print(f"{name}: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
    plain = {}
    incremental, full = merge_cases(spark)
    times["merge_one_key"], plain["full_refresh"] = best(incremental), best(full)
    plain["quality_per_rule"] = best(lambda: quality_per_rule(spark))
    csv, parquet = work_path(spark, "bench-csv"), work_path(spark, "bench-parquet")
    lines = shapes.table(spark, SF_DIR, "lineitem")
    lines.write.csv(csv, header=True)
    lines.write.parquet(parquet)
    total = lambda df: run(df.agg(F.sum("l_extendedprice")))
    times["parquet_scan"] = best(lambda: total(files.read_parquet(spark, parquet)))
    plain["csv_scan"] = best(lambda: total(files.read_csv(spark, csv, lines.schema)))
    part = shapes.products(spark, SF_DIR).select("product_id", "category")
    sales = shapes.lines(spark, SF_DIR).select("product_id", "line_total")
    by = lambda df: run(df.groupBy("category").agg(F.sum("line_total")))
    times["broadcast_join"] = best(lambda: by(sales.join(F.broadcast(part), "product_id")))
    plain["shuffle_join"] = best(lambda: by(sales.join(part.hint("merge"), "product_id")))
    times["cached_city_counts"] = best(lambda: run(QUERIES["cached_city_counts"](spark, SF_DIR)))
    done = {k: v for k, v in times.items() if v is not None}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(done.values()), 3), "unit": "sec",
        "queries": times, "plain": plain, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
