"""Plans: what is pushed down, broadcast, limited early, and how many jobs run."""

import re

import pytest
from pyspark.sql import functions as F

from sedimenta import scale
from sedimenta.operators import quality as q
from sedimenta.operators.windows import latest_per_key
from sedimenta.plans import incremental as inc
from sedimenta.registry import QUERIES
from sedimenta.sources import shapes

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_filter_and_columns_reach_the_scan(spark):
    p = plan(QUERIES["filter_compare"](spark, SF))
    assert "FileScan parquet [l_orderkey#" in p and "l_tax" not in p
    assert "GreaterThanOrEqual(l_quantity,45.0)" in p and "LessThan(l_discount" in p


def test_status_and_dates_reach_the_scan(spark):
    p = plan(QUERIES["dash_total_revenue"](spark, SF))
    assert "EqualTo(o_orderstatus,F)" in p and "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in p


def test_watermark_reaches_the_scan(spark):
    p = plan(inc.read_after(shapes.change_log(spark, SF), "updated_at", shapes.CUTOVER, 24))
    assert "GreaterThan(ts,2024-01-14T00:00)" in p


def test_relative_date_reaches_the_scan(spark):
    assert "GreaterThanOrEqual(ts," in plan(QUERIES["filter_last_n_days"](spark, SF))


def test_small_dimension_is_broadcast(spark):
    assert plan(QUERIES["join_broadcast"](spark, SF)).count("BroadcastHashJoin") == 2


def test_large_dimension_is_not(spark):
    big = spark.range(10_000_000).withColumnRenamed("id", "k")
    assert "Broadcast" not in plan(spark.range(10).withColumnRenamed("id", "k").join(
        scale.broadcast_if_small(big), "k", "left"))


def test_sort_merge_hint(spark):
    assert "SortMergeJoin" in plan(QUERIES["join_sort_merge"](spark, SF))


def test_dedup_limits_groups_before_the_shuffle(spark):
    p = plan(latest_per_key(shapes.change_log(spark, SF), ["user_id"], [F.desc("updated_at"), F.desc("seq")]))
    below = p[p.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_top_n_limits_groups_before_the_shuffle(spark):
    p = plan(QUERIES["win_topn_per_group"](spark, SF))
    assert "Partial" in p[p.index("Exchange"):]


def test_top_products_takes_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_products"](spark, SF))


def test_distinct_count_shuffles_on_group_and_value(spark):
    p = plan(QUERIES["revenue_by_category"](spark, SF))
    assert re.search(r"hashpartitioning\(category#\d+, order_id#\d+L, ", p)


@pytest.mark.parametrize("name", [
    "customer_metrics", "win_running_total", "win_sequence_split", "win_customer_rank_split", "quartiles_split",
    "join_inner", "join_salted", "daily_summary", "fact_sales", "mom_growth", "merge_newer_wins", "scd2_history",
    "gdpr_access", "lineage_impact", "dq_run_report", "rfm_features", "anomaly_features", "snapshot_diff",
])
def test_no_cartesian_product(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p and "NestedLoop" not in p


@pytest.mark.parametrize("name", ["dq_metrics", "dq_expectations", "dq_validity", "dq_column_profile", "constraint_violations"])
def test_quality_scans_once(spark, name):
    assert plan(QUERIES[name](spark, SF)).count("FileScan") == 1


def test_text_stays_in_the_jvm(spark):
    for name in ("classify_text", "sentiment", "extract_attributes", "mask_pii", "tokenize"):
        assert "Python" not in plan(QUERIES[name](spark, SF))


def test_hot_keys_need_no_job_on_small_tables(spark):
    tracker = spark.sparkContext.statusTracker()
    orders = shapes.orders(spark, SF)
    spark.sparkContext.setJobGroup("none", "none")
    assert scale.hot_keys(orders, ["customer_id"]) is None
    assert list(tracker.getJobIdsForGroup("none")) == []


def test_expectations_run_one_job_each(spark):
    df = shapes.dirty_orders(spark, SF)
    assert plan(q.order_suite().evaluate(df)).count("FileScan") == 1




def test_incremental_merge_prunes_buckets(spark):
    from sedimenta.operators import merge as mg

    path = scale.work_path(spark, "bucketed")
    mg.write_bucketed(spark.range(1000).withColumn("v", F.lit(1)), path, ["id"], 32)
    change = spark.createDataFrame([(5, 2)], "id long, v int")
    assert mg.merge_into(spark, path, change, ["id"], 32, mg.newer("v")) == 1
    df = mg.read_bucketed(spark, path)
    assert df.count() == 1000 and df.filter("v = 2").count() == 1
    touched = spark.read.parquet(path).filter(F.col(mg.BUCKET).isin([3]))
    assert "PartitionFilters: [isnotnull(_bucket" in plan(touched)


def test_calls_that_do_not_scale_are_absent():
    """Rows reach the driver only where their number has a bound (see each call)."""
    import pathlib

    root = pathlib.Path(__file__).parents[1] / "sedimenta"
    text = {p.relative_to(root).as_posix(): p.read_text() for p in root.rglob("*.py")}
    # The optional subpackage has its own list, in its own tests.
    text = {f: s for f, s in text.items() if not f.startswith("llm/")}
    for word in ("localCheckpoint", "crossJoin", ".rdd", "F.udf", "toLocalIterator"):
        assert [f for f, s in text.items() if word in s] == []
    # The nodes of an isolation forest.
    assert [f for f, s in text.items() if "toPandas" in s] == ["plans/models.py"]
    # Hot keys, touched buckets, range cuts, constraint names, classes.
    assert {f for f, s in text.items() if ".collect()" in s} == {
        "scale.py", "operators/merge.py", "operators/layout.py", "operators/quality.py", "operators/windows.py",
        "plans/models.py",
    }


def test_metrics_are_observed_while_a_run_writes(spark):
    """Counts of a run equal those of its actions, its joins run once, and a first run is not slow."""
    from sedimenta.operators import merge as mg
    from sedimenta.scale import work_path

    day = lambda n: F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(n), F.lit(0), F.lit(0), F.lit(0))
    silver, state, rejects = (work_path(spark, n) for n in ("silver", "state", "rejects"))
    mg.write_bucketed(spark.range(10).select("id", F.lit("a").alias("op"), day(1).alias("ts")), silver, ["id"], 4)
    inc.append_state(spark, state, "j", "2024-01-01 00:00:00", "2024-01-01 00:00:00", 10, 0)
    rows = [(1, "a"), (1, "a"), (2, "x"), (20, "a"), (21, "x"), (None, "a")]
    log = spark.createDataFrame(rows, "id long, op string").withColumn("ts", day(5))
    r = inc.run_incremental(spark, log, silver, state, "j", ["id"], "ts", ["op"], 0, 4, rejects, F.col("s.op") == "x", iter([2.0, 5.0]).__next__)
    assert (r.read, r.rejected, r.processed, r.inserted, r.updated, r.deleted, r.total, r.seconds) == (6, 1, 4, 1, 1, 1, 10, 3.0)
    runs = inc.run_metrics(spark.read.schema(inc.STATE_SCHEMA).parquet(state), "j").collect()
    assert [tuple(x)[2:] for x in runs] == [(4, 6, 1, 1, 1, 1, 10, 3.0)]
    alerts = {x.alert: x.fired for x in inc.alerts_of_last_run(
        spark.read.schema(inc.STATE_SCHEMA).parquet(state), "j", day(5)).collect()}
    assert alerts == {"watermark_lag": False, "no_records": False, "duplicate_rate": True, "delete_rate": True, "slow_run": False}
