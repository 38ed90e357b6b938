"""Reports over job-run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.collecting import collect_distinct_pieces
from sedimenta.operators.percentiles import exact_percentiles
from sedimenta.plans.star import ratio

FAILED_STATES = ["FAILED", "TIMEOUT", "CANCELLED"]


def daily_runs(runs: DataFrame) -> DataFrame:
    return runs.groupBy("job_name", F.col("start_time").cast("date").alias("execution_date")).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("result_state") == "SUCCESS").alias("successful_runs"),
        ratio(F.sum(F.col("execution_duration").cast("decimal(18,2)")), F.count("execution_duration"))
        .alias("avg_duration_seconds"),
        F.max("execution_duration").alias("max_duration_seconds"),
    )


def duration_percentile(runs: DataFrame) -> DataFrame:
    """Mean and exact 95th percentile of successful runs per job and day."""
    ok = runs.filter(F.col("result_state") == "SUCCESS").withColumn("run_date", F.col("start_time").cast("date"))
    keys = ["job_name", "run_date"]
    mean = ok.groupBy(*keys).agg(
        ratio(F.sum(F.col("execution_duration").cast("decimal(18,2)")), F.count("execution_duration"))
        .alias("avg_duration"),
        F.count(F.lit(1)).alias("run_count"),
    )
    p95 = exact_percentiles(ok, keys, "execution_duration", {"p95_duration": 0.95})
    return mean.join(p95, keys).withColumn("p95_duration", F.round("p95_duration", 6))


def update_durations(runs: DataFrame, since: Column, n: int) -> DataFrame:
    """The newest ``n`` runs since a time with their length in seconds."""
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return (
        runs.filter(F.col("start_time") >= since)
        .select("job_name", "run_id", "result_state", "start_time", "end_time", seconds.alias("duration_seconds"))
        .orderBy(F.desc("start_time"), "run_id")
        .limit(n)
    )


def health(runs: DataFrame) -> DataFrame:
    per_job = runs.groupBy("job_name").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("result_state") == "SUCCESS").alias("success_count"),
    )
    rate = ratio(F.col("success_count") * 100, F.col("total_runs"))
    return per_job.withColumn("success_rate", rate).withColumn(
        "health_status",
        F.when(F.col("success_rate") >= 95, "Healthy").when(F.col("success_rate") >= 80, "Warning")
        .otherwise("Critical"),
    )


def alerts(health_of_jobs: DataFrame) -> DataFrame:
    """One alert per unhealthy job, as rows."""
    return health_of_jobs.filter(F.col("health_status") != "Healthy").select(
        F.upper("health_status").alias("severity"),
        F.concat(
            F.lit("Job "), "job_name", F.lit(" has "),
            F.col("success_rate").cast("decimal(5,1)").cast("string"), F.lit("% success rate"),
        ).alias("message"),
        "job_name", "success_rate",
    )


def failures(runs: DataFrame, job: str, since: Column) -> DataFrame:
    return runs.filter(
        (F.col("job_name") == job) & (F.col("start_time") >= since) & F.col("result_state").isin(FAILED_STATES)
    ).select("run_id", "start_time", "end_time", "result_state", "error_message")


def failure_category(message: Column) -> Column:
    return (
        F.when(message.like("%OutOfMemoryError%"), "Memory Issues")
        .when(message.like("%timeout%"), "Timeout Issues")
        .when(message.like("%TableNotFoundException%"), "Table Availability")
        .when(message.like("%AnalysisException%"), "Schema Issues")
        .otherwise("Other")
    )


def failure_categories(runs: DataFrame) -> DataFrame:
    """Failures per category with the set of their messages."""
    failed = runs.filter(F.col("result_state") == "FAILED").withColumn(
        "failure_category", failure_category(F.col("error_message"))
    )
    return with_messages(failed, ["failure_category"], "error_message", "occurrence_count", "sample_errors")


def error_events(log: DataFrame) -> DataFrame:
    """Failed operations per table with the set of their messages."""
    return with_messages(
        log.filter(~F.col("success")), ["table_name"], "error_message", "error_count", "error_messages"
    )


def with_messages(rows: DataFrame, keys: list[str], message: str, count: str, messages: str) -> DataFrame:
    """Row count per key and all distinct messages, in pieces of bounded size.

    Rows are counted per message first, so only distinct messages move.
    """
    per = rows.groupBy(*keys, message).agg(F.count(F.lit(1)).alias("_n"))
    totals = per.groupBy(*keys).agg(F.sum("_n").alias(count))
    pieces = collect_distinct_pieces(per, keys, message).select(
        *keys, "piece", F.array_join("items", "; ").alias(messages)
    )
    return totals.join(pieces, keys, "left")


def recent(log: DataFrame, ts: str, tie: str, since: Column, where: Column, n: int) -> DataFrame:
    """The newest ``n`` rows since a time that satisfy a condition."""
    return log.filter((F.col(ts) >= since) & where).orderBy(F.desc(ts), tie).limit(n)


def pass_rates(checks: DataFrame, below: float) -> DataFrame:
    """Expectations whose daily pass rate is below a limit."""
    return (
        checks.groupBy("dataset_name", "expectation_name", F.col("timestamp").cast("date").alias("check_date"))
        .agg(F.count(F.lit(1)).alias("total_checks"), F.count_if("passed").alias("passed_checks"))
        .withColumn("pass_rate", ratio(F.col("passed_checks") * 100, F.col("total_checks")))
        .filter(F.col("pass_rate") < below)
    )
