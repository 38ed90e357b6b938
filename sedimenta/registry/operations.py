"""Lineage and run-log queries."""

from pyspark.sql import functions as F

from sedimenta.plans import lineage as ln, runlogs as rl
from sedimenta.registry.base import query
from sedimenta.registry.sqlshapes import AUDIT, EDGES, EVENTS_END, RUNS
from sedimenta.sources import shapes


def edges(spark, sf_dir):
    return shapes.lineage_edges(spark, sf_dir)


def runs(spark, sf_dir):
    return shapes.job_runs(spark, sf_dir)


def since(spark, sf_dir, interval):
    return shapes.latest(shapes.table(spark, sf_dir, "events"), "ts") - F.expr(f"INTERVAL {interval}")


@query("lineage_recent", f"SELECT * FROM {EDGES} WHERE target_table LIKE '%9%' ORDER BY created_at DESC, source_table, target_table LIMIT 10")
def lineage_recent(spark, sf_dir):
    return ln.recent_edges(edges(spark, sf_dir), "%9%", 10)


_COLUMN_EDGES = f"""(SELECT source_table, target_table, unnest(['id','amount','status']) AS source_column, unnest(['id','total','state']) AS target_column,
  target_type AS transformation_type FROM {EDGES})"""


@query("lineage_columns", f"SELECT * FROM {_COLUMN_EDGES} WHERE target_table LIKE '%t1%' AND target_column <> 'id'")
def lineage_columns(spark, sf_dir):
    pairs = F.array(*[
        F.struct(F.lit(a).alias("source_column"), F.lit(b).alias("target_column"))
        for a, b in (("id", "id"), ("amount", "total"), ("status", "state"))
    ])
    columns = edges(spark, sf_dir).withColumn("p", F.explode(pairs)).select(
        "source_table", "target_table", "p.*", F.col("target_type").alias("transformation_type")
    )
    return columns.filter(F.col("target_table").like("%t1%") & (F.col("target_column") != "id"))


@query("lineage_neighbours", f"""
SELECT t AS table_name, SUM(u)::BIGINT AS upstream_count, SUM(d)::BIGINT AS downstream_count FROM (
  SELECT target_table AS t, 1 AS u, 0 AS d FROM {EDGES} UNION ALL SELECT source_table, 0, 1 FROM {EDGES}) GROUP BY 1""")
def lineage_neighbours(spark, sf_dir):
    return ln.neighbours(edges(spark, sf_dir))


@query("lineage_impact", f"""
WITH RECURSIVE e AS MATERIALIZED (SELECT source_table, target_table FROM {EDGES}), t AS (
  SELECT target_table AS table_name, 1 AS level FROM e WHERE source_table = 'lake.t1'
  UNION ALL SELECT e.target_table, t.level + 1 FROM e JOIN t ON e.source_table = t.table_name WHERE t.level < 10)
SELECT table_name, level, COUNT(*) AS impact_count FROM t GROUP BY 1, 2""")
def lineage_impact(spark, sf_dir):
    return ln.impact(edges(spark, sf_dir), "lake.t1")


@query("lineage_diagnosis", f"""
SELECT t.table_name, last_update, CASE WHEN t.kind = 'PROMO' THEN 'Table not registered' WHEN last_update IS NULL THEN 'No lineage information found'
  ELSE 'Lineage tracking appears normal' END AS diagnosis
FROM (SELECT 'lake.t' || p_partkey AS table_name, p_type AS kind FROM part) t
LEFT JOIN (SELECT target_table AS table_name, max(created_at) AS last_update FROM {EDGES} GROUP BY 1) USING (table_name)""")
def lineage_diagnosis(spark, sf_dir):
    tables = shapes.table(spark, sf_dir, "part").select(
        F.concat(F.lit("lake.t"), F.col("p_partkey").cast("string")).alias("table_name"), F.col("p_type").alias("kind")
    )
    return ln.diagnosis(tables, edges(spark, sf_dir), F.col("kind") != "PROMO").drop("kind")


@query("access_recent", f"""
SELECT user_email, table_name, "timestamp", action_type, audit_id FROM {AUDIT} WHERE action_type = 'view' AND "timestamp" >= {EVENTS_END} - INTERVAL 7 DAY
ORDER BY "timestamp" DESC, audit_id LIMIT 20""")
def access_recent(spark, sf_dir):
    out = rl.recent(
        shapes.audit_log(spark, sf_dir), "timestamp", "audit_id", since(spark, sf_dir, "7 DAY"),
        F.col("action_type") == "view", 20,
    )
    return out.select("user_email", "table_name", "timestamp", "action_type", "audit_id")


@query("job_daily", f"""
SELECT job_name, CAST(start_time AS DATE) AS execution_date, COUNT(*) AS total_runs, COUNT(*) FILTER (result_state = 'SUCCESS') AS successful_runs,
  CAST(SUM(CAST(execution_duration AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_duration_seconds, max(execution_duration) AS max_duration_seconds
FROM {RUNS} WHERE start_time >= {EVENTS_END} - INTERVAL 7 DAY GROUP BY 1, 2""")
def job_daily(spark, sf_dir):
    return rl.daily_runs(runs(spark, sf_dir).filter(F.col("start_time") >= since(spark, sf_dir, "7 DAY")))


@query("run_duration_p95", f"""
SELECT job_name, CAST(start_time AS DATE) AS run_date, CAST(SUM(CAST(execution_duration AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_duration,
  COUNT(*) AS run_count, round(quantile_cont(execution_duration, 0.95), 6) AS p95_duration FROM {RUNS} WHERE result_state = 'SUCCESS' GROUP BY 1, 2""")
def run_duration_p95(spark, sf_dir):
    return rl.duration_percentile(runs(spark, sf_dir))


@query("update_durations", f"""
SELECT job_name, run_id, result_state, start_time, end_time, date_diff('microsecond', start_time, end_time) // 1000000 AS duration_seconds
FROM {RUNS} WHERE start_time >= {EVENTS_END} - INTERVAL 24 HOUR ORDER BY start_time DESC, run_id LIMIT 10""")
def update_durations(spark, sf_dir):
    return rl.update_durations(runs(spark, sf_dir), since(spark, sf_dir, "24 HOUR"), 10)


_HEALTH = f"""SELECT *, success_count * 100.0 / total_runs AS success_rate, CASE WHEN success_count * 100.0 / total_runs >= 95 THEN 'Healthy'
  WHEN success_count * 100.0 / total_runs >= 80 THEN 'Warning' ELSE 'Critical' END AS health_status
FROM (SELECT job_name, COUNT(*) AS total_runs, COUNT(*) FILTER (result_state = 'SUCCESS') AS success_count FROM {RUNS} GROUP BY 1)"""


@query("job_health", _HEALTH)
def job_health(spark, sf_dir):
    return rl.health(runs(spark, sf_dir))


@query("job_alerts", f"""
SELECT upper(health_status) AS severity, 'Job ' || job_name || ' has ' || CAST(success_rate AS DECIMAL(5,1)) || '% success rate' AS message, job_name, success_rate
FROM ({_HEALTH}) WHERE health_status <> 'Healthy'""")
def job_alerts(spark, sf_dir):
    return rl.alerts(rl.health(runs(spark, sf_dir)))


@query("job_failures", f"""
SELECT run_id, start_time, end_time, result_state, error_message FROM {RUNS} WHERE job_name = 'job_7' AND start_time >= {EVENTS_END} - INTERVAL 10 DAY
  AND result_state IN ('FAILED','TIMEOUT','CANCELLED')""")
def job_failures(spark, sf_dir):
    return rl.failures(runs(spark, sf_dir), "job_7", since(spark, sf_dir, "10 DAY"))


@query("failure_categories", f"""
WITH f AS (SELECT *, CASE WHEN error_message LIKE '%OutOfMemoryError%' THEN 'Memory Issues' WHEN error_message LIKE '%timeout%' THEN 'Timeout Issues'
  WHEN error_message LIKE '%TableNotFoundException%' THEN 'Table Availability' WHEN error_message LIKE '%AnalysisException%' THEN 'Schema Issues' ELSE 'Other' END AS failure_category
  FROM {RUNS} WHERE result_state = 'FAILED')
SELECT failure_category, COUNT(*) AS occurrence_count, array_to_string(list(DISTINCT error_message ORDER BY error_message), '; ') AS sample_errors, CAST(0 AS BIGINT) AS piece FROM f GROUP BY 1""")
def failure_categories(spark, sf_dir):
    return rl.failure_categories(runs(spark, sf_dir))


@query("error_events", f"""
SELECT table_name, COUNT(*) AS error_count, array_to_string(list(DISTINCT error_message ORDER BY error_message), '; ') AS error_messages, CAST(0 AS BIGINT) AS piece FROM {AUDIT} WHERE NOT success GROUP BY 1""")
def error_events(spark, sf_dir):
    return rl.error_events(shapes.audit_log(spark, sf_dir))


@query("error_events_recent", f"""
SELECT audit_id, table_name, "timestamp", error_message FROM {AUDIT} WHERE NOT success AND "timestamp" >= {EVENTS_END} - INTERVAL 24 HOUR
ORDER BY "timestamp" DESC, audit_id LIMIT 100""")
def error_events_recent(spark, sf_dir):
    out = rl.recent(
        shapes.audit_log(spark, sf_dir), "timestamp", "audit_id", since(spark, sf_dir, "24 HOUR"), ~F.col("success"), 100
    )
    return out.select("audit_id", "table_name", "timestamp", "error_message")


@query("expectation_pass_rate", f"""
SELECT table_name AS dataset_name, action_type AS expectation_name, CAST("timestamp" AS DATE) AS check_date, COUNT(*) AS total_checks,
  COUNT(*) FILTER (row_count < 5000) AS passed_checks, COUNT(*) FILTER (row_count < 5000) * 100.0 / COUNT(*) AS pass_rate FROM {AUDIT}
GROUP BY 1, 2, 3 HAVING COUNT(*) FILTER (row_count < 5000) * 100.0 / COUNT(*) < 95""")
def expectation_pass_rate(spark, sf_dir):
    checks = shapes.audit_log(spark, sf_dir).select(
        F.col("table_name").alias("dataset_name"), F.col("action_type").alias("expectation_name"), "timestamp",
        (F.col("row_count") < 5000).alias("passed"),
    )
    return rl.pass_rates(checks, 95.0)
