"""Incremental load: watermark, lookback, dedup, merge, state."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.cleaning import split_valid
from sedimenta.operators import merge as mg
from sedimenta.operators.windows import latest_per_key
from sedimenta.scale import durable

STATE_SCHEMA = (
    "job_name string, start_time timestamp_ntz, last_watermark timestamp_ntz, "
    "records_processed bigint, status string, run_no bigint, records_read bigint, records_inserted bigint, "
    "records_updated bigint, records_deleted bigint, records_rejected bigint, records_total bigint, duration_sec double"
)
METRICS = ["records_read", "records_inserted", "records_updated", "records_deleted", "records_rejected", "records_total", "duration_sec"]


def changes_since(log: DataFrame, ts: str, since: Column) -> DataFrame:
    return log.filter(F.col(ts) >= since)


def watermark_of(state: DataFrame, job: str) -> str | None:
    """Last watermark of the newest successful run of ``job``."""
    row = (
        state.filter((F.col("job_name") == job) & (F.col("status") == "SUCCESS"))
        .agg(F.max_by("last_watermark", "run_no").cast("string")).first()
    )
    return row[0]


def read_after(log: DataFrame, ts: str, watermark: str, lookback_hours: int = 0) -> DataFrame:
    """Rows after the watermark, moved back by the lookback for late rows.

    The bound is a literal, so the scan skips files and row groups below it.
    """
    at = F.lit(watermark).cast(log.schema[ts].dataType) - F.expr(f"INTERVAL {lookback_hours} HOUR")
    return log.filter(F.col(ts) > at)


@dataclass(frozen=True)
class RunResult:
    """What a run did: keys merged, buckets rewritten, watermark reached, rows
    read with their copies, what became of them, and the seconds it took."""

    processed: int
    buckets: int
    watermark: str
    rejected: int = 0
    read: int = 0
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    total: int = 0
    seconds: float = 0.0


def run_incremental(
    spark: SparkSession,
    log: DataFrame,
    silver_path: str,
    state_path: str,
    job: str,
    keys: list[str],
    ts: str,
    tie: list[str],
    lookback_hours: int = 24,
    buckets: int = 1024,
    rejects_path: str | None = None,
    delete_when: Column | None = None,
    clock: Callable[[], float] = time.monotonic,
) -> RunResult:
    """One run over a table written by ``write_bucketed`` with ``buckets``.

    Only rows after the watermark are read and only buckets with a changed key
    are rewritten.  The state row is appended last: after a failure the next
    run reads the same rows again, and merging them twice changes nothing, as
    an update must be strictly newer.  An empty slice writes nothing.

    Rows with a NULL key match nothing and would be inserted by every run:
    they go to ``rejects_path``, in a folder per run, and are counted; without
    the path such a row is an error.  ``delete_when`` names source rows that
    delete their key.

    The state row holds the metrics of the run.  They are observed while the
    slice and the merged rows are written: nothing is read again for them.
    ``clock`` gives the seconds that its duration is the difference of.
    """
    began = clock()
    state = spark.read.schema(STATE_SCHEMA).parquet(state_path)
    watermark = watermark_of(state, job)
    if watermark is None:
        raise ValueError(f"no successful run of {job} to continue from")
    slice_ = read_after(log, ts, watermark, lookback_hours)
    keyed, unkeyed = split_valid(slice_, keys)
    run_no = state.filter(F.col("job_name") == job).agg(F.max("run_no")).first()[0] + 1
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    seen = Observation("slice")
    counted = slice_.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(missing).alias("rejected"), F.max(F.when(~missing, F.col(ts))).cast("string").alias("top"))
    order = [F.desc(ts), *[F.desc(c) for c in tie]]
    newest = durable(latest_per_key(split_valid(counted, keys)[0], keys, order), "slice")
    read, rejected, top = (seen.get[c] for c in ("read", "rejected", "top"))
    if rejected and rejects_path is None:
        raise ValueError(f"{rejected} rows without a key and no rejects_path")
    if rejected:
        unkeyed.write.mode("overwrite").parquet(f"{rejects_path}/run={run_no}")
    processed = newest.count()
    if processed == 0:
        return RunResult(0, 0, watermark, rejected, read)
    did = mg.merge_counted(spark, silver_path, newest, keys, buckets, mg.newer(ts), delete_when)
    # The lookback may hold only old rows: a watermark never moves back.
    reached = max(watermark, top)
    total = mg.read_bucketed(spark, silver_path).count()
    out = RunResult(processed, did.buckets, reached, rejected, read, did.inserted, did.updated, did.deleted, total, float(clock() - began))
    append_state(spark, state_path, job, watermark, reached, processed, run_no, dict(zip(
        METRICS, (read, did.inserted, did.updated, did.deleted, rejected, total, out.seconds))))
    return out


def append_state(
    spark: SparkSession, path: str, job: str, start: str, watermark: str, records: int, run_no: int,
    metrics: dict[str, float] | None = None,
) -> None:
    """One more row in the state table, which keeps the rows of all jobs.
    ``metrics`` are those of ``METRICS``; the row of a first load has none."""
    metrics = metrics or {}
    kinds = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], STATE_SCHEMA).schema}
    more = "".join(f", CAST(:{m} AS {kinds[m]}) AS {m}" for m in METRICS)
    spark.sql(
        "SELECT :job AS job_name, CAST(:start AS timestamp_ntz) AS start_time, "
        "CAST(:watermark AS timestamp_ntz) AS last_watermark, CAST(:n AS bigint) AS records_processed, "
        "'SUCCESS' AS status, CAST(:run AS bigint) AS run_no" + more,
        args={"job": job, "start": start, "watermark": watermark, "n": records, "run": run_no,
              **{m: metrics.get(m) for m in METRICS}},
    ).write.mode("append").parquet(path)


def run_alerts(
    metrics: DataFrame, lag_hours: float | Column, duration_sec: float | Column, usual_sec: float | Column
) -> DataFrame:
    """``alert, fired`` from the counts of a run.

    ``metrics`` has one row: ``records_read, records_deduplicated,
    records_deleted, records_total``.  A run without an earlier one is not slow.
    """
    value = lambda x: x if isinstance(x, Column) else F.lit(x)
    read, kept = F.col("records_read"), F.col("records_deduplicated")
    alerts = {
        "watermark_lag": value(lag_hours) > 4,
        "no_records": read == 0,
        "duplicate_rate": F.coalesce(F.try_divide((read - kept).cast("double"), read) > 0.10, F.lit(False)),
        "delete_rate": F.coalesce(
            F.try_divide(F.col("records_deleted").cast("double"), F.col("records_total")) > 0.05, F.lit(False)),
        "slow_run": F.coalesce(value(duration_sec) > 2 * value(usual_sec), F.lit(False)),
    }
    rows = [F.struct(F.lit(n).alias("alert"), c.alias("fired")) for n, c in alerts.items()]
    return metrics.select(F.inline(F.array(*rows)))


def run_metrics(state: DataFrame, job: str) -> DataFrame:
    """The metrics of every run of a job after its first load."""
    kept = (F.col("job_name") == job) & F.col("records_read").isNotNull()
    return state.filter(kept).select(
        "run_no", "last_watermark", F.col("records_processed").alias("records_deduplicated"), *METRICS)


def alerts_of_last_run(state: DataFrame, job: str, now: Column) -> DataFrame:
    """``alert, fired`` of the newest run from its state row: the watermark
    against ``now``, its duration against the mean of the runs before it."""
    row = F.struct("last_watermark", "records_deduplicated", *METRICS)
    one = run_metrics(state, job).agg(
        F.max_by(row, "run_no").alias("last"), F.sum("duration_sec").alias("seconds"), F.count("duration_sec").alias("runs"))
    one = one.select("last.*", F.try_divide(F.col("seconds") - F.col("last.duration_sec"), F.col("runs") - 1).alias("usual_sec"))
    lag = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_watermark").cast("timestamp"))) / 3_600_000_000
    return run_alerts(one.withColumn("lag_hours", lag), F.col("lag_hours"), F.col("duration_sec"), F.col("usual_sec"))


def status_summary(state: DataFrame, statuses: list[str]) -> DataFrame:
    """Rows, rows per status and the total amount, in one aggregation."""
    return state.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in statuses],
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total_value"),
    )
