"""MERGE, history and incremental loads over the change log."""

from pyspark.sql import functions as F

from sedimenta.operators import merge as mg
from sedimenta.operators.windows import latest_per_key
from sedimenta.plans import incremental as inc
from sedimenta.registry.base import query
from sedimenta.registry.sqlshapes import CHANGES, CUTOVER, ORDERS
from sedimenta.scale import work_path
from sedimenta.sources import shapes

KEY = ["user_id"]
COLS = "user_id, status, amount, updated_at, seq"


def log(spark, sf_dir):
    return shapes.change_log(spark, sf_dir)


def newest(df):
    return latest_per_key(df, KEY, [F.desc("updated_at"), F.desc("seq")])


def target(spark, sf_dir):
    """State at the cutover."""
    return newest(log(spark, sf_dir).filter(F.col("updated_at") < shapes.cutover()))


def source(spark, sf_dir):
    return newest(log(spark, sf_dir).filter(F.col("updated_at") >= shapes.cutover()))


def _newest(where: str) -> str:
    return (f"(SELECT {COLS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, seq DESC) AS rn "
            f"FROM {CHANGES} WHERE {where}) WHERE rn = 1)")


T = _newest(f"updated_at < {CUTOVER}")
S = _newest(f"updated_at >= {CUTOVER}")


def _merged(cond: str, delete: str = "FALSE") -> str:
    """MERGE as a full outer join; ``cond`` and ``delete`` see t and s."""
    picks = ", ".join(
        f"CASE WHEN t.user_id IS NULL OR (s.user_id IS NOT NULL AND ({cond})) THEN s.{c} ELSE t.{c} END AS {c}"
        for c in ("status", "amount", "updated_at", "seq"))
    return (f"SELECT coalesce(t.user_id, s.user_id) AS user_id, {picks} FROM {T} t FULL JOIN {S} s ON t.user_id = s.user_id "
            f"WHERE NOT (s.user_id IS NOT NULL AND ({delete}))")


@query("merge_upsert", _merged("TRUE"))
def merge_upsert(spark, sf_dir):
    return mg.merge(target(spark, sf_dir), source(spark, sf_dir), KEY)


@query("merge_newer_wins", _merged("s.updated_at > t.updated_at"))
def merge_newer_wins(spark, sf_dir):
    return mg.merge(target(spark, sf_dir), source(spark, sf_dir), KEY, update_when=mg.newer("updated_at"))


@query("merge_higher_version", _merged("s.seq > t.seq"))
def merge_higher_version(spark, sf_dir):
    return mg.merge(target(spark, sf_dir), source(spark, sf_dir), KEY, update_when=mg.higher_version("seq"))


def _by_week(df):
    return df.withColumn("updated_at", F.date_trunc("week", "updated_at").cast("timestamp_ntz"))


def _merged_week() -> str:
    t = f"(SELECT * REPLACE (CAST(date_trunc('week', updated_at) AS TIMESTAMP) AS updated_at) FROM {T})"
    s = f"(SELECT * REPLACE (CAST(date_trunc('week', updated_at) AS TIMESTAMP) AS updated_at) FROM {S})"
    cond = "s.updated_at > t.updated_at OR (s.updated_at = t.updated_at AND s.amount > t.amount)"
    return _merged(cond).replace(T, t).replace(S, s)


@query("merge_conflict_priority", _merged_week())
def merge_conflict_priority(spark, sf_dir):
    """Newer wins; among equally new rows the higher amount wins."""
    return mg.merge(
        _by_week(target(spark, sf_dir)), _by_week(source(spark, sf_dir)), KEY,
        update_when=mg.newer_then_priority("updated_at", "amount"),
    )


@query("merge_with_delete", _merged("s.updated_at > t.updated_at", "s.status = 'error'"))
def merge_with_delete(spark, sf_dir):
    """A source row with status ``error`` deletes its key."""
    return mg.merge(
        target(spark, sf_dir), source(spark, sf_dir), KEY,
        update_when=mg.newer("updated_at"), delete_when=F.col("s.status") == "error",
    )


@query("merge_metrics", f"""
WITH j AS (SELECT t.user_id AS tk, s.user_id AS sk, s.status AS ss, s.updated_at > t.updated_at AS newer FROM {T} t FULL JOIN {S} s ON t.user_id = s.user_id),
n AS (SELECT COUNT(*) FILTER (tk IS NULL AND ss <> 'error') AS i, COUNT(*) FILTER (tk IS NOT NULL AND sk IS NOT NULL AND ss <> 'error' AND newer) AS u,
  COUNT(*) FILTER (tk IS NOT NULL AND ss = 'error') AS d, COUNT(*) FILTER (NOT coalesce(ss = 'error', FALSE)) AS t FROM j)
SELECT 'records_read' AS metric, COUNT(*) AS n FROM {CHANGES} WHERE updated_at >= {CUTOVER}
UNION ALL SELECT 'records_inserted', i FROM n UNION ALL SELECT 'records_updated', u FROM n
UNION ALL SELECT 'records_deleted', d FROM n UNION ALL SELECT 'records_total', t FROM n""")
def merge_metrics(spark, sf_dir):
    read = log(spark, sf_dir).filter(F.col("updated_at") >= shapes.cutover())
    acts = mg.merge_actions(
        target(spark, sf_dir), newest(read), KEY, update_when=mg.newer("updated_at"),
        delete_when=F.col("s.status") == "error",
    )
    return mg.merge_counts(read, acts)


@query("scd2_history", f"""
SELECT {COLS}, lead(updated_at) OVER w AS valid_to, updated_at AS valid_from, lead(updated_at) OVER w IS NULL AS is_current
FROM {CHANGES} WINDOW w AS (PARTITION BY user_id ORDER BY updated_at, seq)""")
def scd2_history(spark, sf_dir):
    return mg.scd2(log(spark, sf_dir), KEY, "updated_at", ["updated_at", "seq"])


@query("as_of_state", f"SELECT * FROM {_newest(f'updated_at <= {CUTOVER}')}")
def as_of_state(spark, sf_dir):
    return mg.as_of(log(spark, sf_dir), KEY, "updated_at", shapes.cutover(), ["seq"])


@query("change_history", f"""
WITH h AS (SELECT CAST(updated_at AS DATE) AS batch, status = 'error' AS del, lag(status = 'error') OVER (PARTITION BY user_id ORDER BY updated_at, seq) AS prev FROM {CHANGES})
SELECT batch, COUNT(*) FILTER (NOT del AND coalesce(prev, TRUE)) AS inserts, COUNT(*) FILTER (NOT del AND NOT coalesce(prev, TRUE)) AS updates,
  COUNT(*) FILTER (del AND NOT coalesce(prev, TRUE)) AS deletes FROM h GROUP BY 1""")
def change_history(spark, sf_dir):
    return mg.change_history(
        log(spark, sf_dir), KEY, ["updated_at", "seq"],
        batch=F.col("updated_at").cast("date"), is_delete=F.col("status") == "error",
    )


@query("snapshot_diff", f"""
SELECT user_id, CASE WHEN t.status IS NULL THEN 'insert' ELSE 'update' END AS change_type FROM {S} s LEFT JOIN {T} t USING (user_id)
UNION ALL SELECT user_id, 'delete' FROM {T} t WHERE user_id NOT IN (SELECT user_id FROM {S})""")
def snapshot_diff(spark, sf_dir):
    return mg.snapshot_diff(target(spark, sf_dir), source(spark, sf_dir), KEY)


@query("idempotency_diff", "SELECT 1 AS runs, CAST(0 AS BIGINT) AS changed_rows")
def idempotency_diff(spark, sf_dir):
    """Merging the same rows twice gives the same table."""
    once = mg.merge(target(spark, sf_dir), source(spark, sf_dir), KEY, update_when=mg.newer("updated_at"))
    twice = mg.merge(once, source(spark, sf_dir), KEY, update_when=mg.newer("updated_at"))
    return mg.multiset_diff(once, twice).agg(
        F.lit(1).alias("runs"), F.count(F.lit(1)).alias("changed_rows")
    )


@query("multiset_changes", """
WITH a AS (SELECT o_custkey, o_orderstatus, COUNT(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01') AS before_count,
  COUNT(*) FILTER (o_orderdate >= TIMESTAMP '1998-01-01') AS after_count FROM orders GROUP BY 1, 2)
SELECT * FROM a WHERE before_count <> after_count""")
def multiset_changes(spark, sf_dir):
    """Which rows, with copies counted, differ between two halves of a table."""
    df = shapes.table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    cols = ["o_custkey", "o_orderstatus"]
    return mg.multiset_diff(df.filter(early).select(*cols), df.filter(~early).select(*cols))


@query("cdc_changes_since", f"SELECT {COLS} FROM {CHANGES} WHERE updated_at >= {CUTOVER}")
def cdc_changes_since(spark, sf_dir):
    return inc.changes_since(log(spark, sf_dir), "updated_at", shapes.cutover())


@query("incremental_read", f"SELECT {COLS} FROM {CHANGES} WHERE updated_at > {CUTOVER}")
def incremental_read(spark, sf_dir):
    """The watermark comes from the state table."""
    path = work_path(spark, "state")
    inc.append_state(spark, path, "orders", shapes.CUTOVER, shapes.CUTOVER, 0, 0)
    state = spark.read.schema(inc.STATE_SCHEMA).parquet(path)
    return inc.read_after(log(spark, sf_dir), "updated_at", inc.watermark_of(state, "orders"))


@query("incremental_lookback", f"SELECT {COLS} FROM {CHANGES} WHERE updated_at > {CUTOVER} - INTERVAL 48 HOUR")
def incremental_lookback(spark, sf_dir):
    return inc.read_after(log(spark, sf_dir), "updated_at", shapes.CUTOVER, 48)


BUCKETS = 16


def load_first(spark, sf_dir, job):
    """Full load up to the cutover: table and state."""
    silver, state = work_path(spark, "silver"), work_path(spark, "state")
    mg.write_bucketed(target(spark, sf_dir), silver, KEY, BUCKETS)
    inc.append_state(spark, state, job, shapes.CUTOVER, shapes.CUTOVER, 0, 0)
    return silver, state


def one_run(spark, sf_dir, silver, state):
    return inc.run_incremental(
        spark, log(spark, sf_dir), silver, state, "orders", KEY, "updated_at", ["seq"], 24, BUCKETS
    )


@query("run_incremental", f"SELECT {COLS} FROM {_newest('TRUE')}")
def run_incremental(spark, sf_dir):
    """A full load, an incremental run, and a second run that changes nothing."""
    silver, state = load_first(spark, sf_dir, "orders")
    one_run(spark, sf_dir, silver, state)
    one_run(spark, sf_dir, silver, state)
    return mg.read_bucketed(spark, silver)


@query("run_state", f"""
SELECT 'orders' AS job_name, 1::BIGINT AS run_no, max(updated_at) AS last_watermark, COUNT(DISTINCT user_id) AS records_processed, 'SUCCESS' AS status
FROM {CHANGES} WHERE updated_at > {CUTOVER} - INTERVAL 24 HOUR
UNION ALL SELECT 'orders', 0, {CUTOVER}, 0, 'SUCCESS'""")
def run_state(spark, sf_dir):
    silver, state = load_first(spark, sf_dir, "orders")
    one_run(spark, sf_dir, silver, state)
    return spark.read.schema(inc.STATE_SCHEMA).parquet(state).select(
        "job_name", "run_no", "last_watermark", "records_processed", "status"
    )


# Two runs with deletes: the first over the log before MIDDLE, the second over all of it.
MIDDLE_DAYS = 60


def two_runs(spark, sf_dir):
    """The runs take 10 and 30 seconds of a clock that is set by hand."""
    silver, state = load_first(spark, sf_dir, "orders")
    ticks = iter([0, 10, 100, 130])
    early = F.col("updated_at") < shapes.cutover() + F.expr(f"INTERVAL {MIDDLE_DAYS} DAY")
    for part in (log(spark, sf_dir).filter(early), log(spark, sf_dir)):
        inc.run_incremental(
            spark, part, silver, state, "orders", KEY, "updated_at", ["seq"], 24, BUCKETS,
            delete_when=F.col("s.status") == "error", clock=lambda: next(ticks),
        )
    return silver, spark.read.schema(inc.STATE_SCHEMA).parquet(state)


_MIDDLE = f"({CUTOVER} + INTERVAL {MIDDLE_DAYS} DAY)"
_RUNS = f"""
WITH c AS (SELECT * FROM {CHANGES}),
w AS (SELECT max(updated_at) AS w1 FROM c WHERE updated_at < {_MIDDLE}), e AS (SELECT max(updated_at) AS w2 FROM c),
t0 AS {T}, s1 AS {_newest(f"updated_at > {CUTOVER} - INTERVAL 24 HOUR AND updated_at < {_MIDDLE}")},
r1 AS (SELECT coalesce(s1.user_id, t0.user_id) AS user_id, s1.user_id AS sk, t0.user_id AS tk, s1.status AS ss, greatest(s1.updated_at, t0.updated_at) AS seen_at,
  s1.updated_at > t0.updated_at AS newer FROM t0 FULL JOIN s1 ON t0.user_id = s1.user_id),
t1 AS (SELECT user_id, seen_at FROM r1 WHERE NOT coalesce(ss = 'error', FALSE)),
s2 AS (SELECT * FROM {_newest("TRUE")} WHERE updated_at > (SELECT w1 FROM w) - INTERVAL 24 HOUR),
r2 AS (SELECT s2.user_id AS sk, t1.user_id AS tk, s2.status AS ss, s2.updated_at > t1.seen_at AS newer, coalesce(s2.user_id, t1.user_id) AS user_id FROM t1 FULL JOIN s2 ON t1.user_id = s2.user_id),
m AS (SELECT 1::BIGINT AS run_no, w1 AS last_watermark, (SELECT COUNT(*) FROM c WHERE updated_at > {CUTOVER} - INTERVAL 24 HOUR AND updated_at < {_MIDDLE}) AS records_read, sk, tk, ss, newer, 10.0::DOUBLE AS duration_sec FROM r1, w
  UNION ALL SELECT 2, w2, (SELECT COUNT(*) FROM c WHERE updated_at > w1 - INTERVAL 24 HOUR), sk, tk, ss, newer, 30.0::DOUBLE FROM r2, w, e),
runs AS (SELECT run_no, last_watermark, COUNT(sk) AS records_deduplicated, records_read, COUNT(*) FILTER (tk IS NULL AND ss <> 'error') AS records_inserted,
  COUNT(*) FILTER (tk IS NOT NULL AND ss <> 'error' AND newer) AS records_updated, COUNT(*) FILTER (tk IS NOT NULL AND ss = 'error') AS records_deleted,
  0::BIGINT AS records_rejected, COUNT(*) FILTER (NOT coalesce(ss = 'error', FALSE)) AS records_total, duration_sec FROM m GROUP BY run_no, last_watermark, records_read, duration_sec)
"""


@query("run_metrics", f"{_RUNS} SELECT * FROM runs")
def run_metrics(spark, sf_dir):
    """What two runs read, kept, inserted, updated and deleted, from their state rows."""
    return inc.run_metrics(two_runs(spark, sf_dir)[1], "orders")


@query("run_alerts", f"""{_RUNS},
l AS (SELECT * FROM runs WHERE run_no = 2)
SELECT 'watermark_lag' AS alert, TRUE AS fired UNION ALL SELECT 'no_records', records_read = 0 FROM l
UNION ALL SELECT 'duplicate_rate', (records_read - records_deduplicated) / records_read > 0.1 FROM l
UNION ALL SELECT 'delete_rate', records_deleted / records_total > 0.05 FROM l
UNION ALL SELECT 'slow_run', l.duration_sec > 2 * f.duration_sec FROM l, runs f WHERE f.run_no = 1""")
def run_alerts(spark, sf_dir):
    """Alerts of the second run, five hours after the newest change."""
    state = two_runs(spark, sf_dir)[1]
    now = shapes.latest(log(spark, sf_dir), "updated_at") + F.expr("INTERVAL 5 HOUR")
    return inc.alerts_of_last_run(state, "orders", now)


@query("run_incremental_deletes", f"{_RUNS} SELECT a.user_id, a.updated_at, a.status FROM {_newest('TRUE')} a JOIN r2 ON r2.user_id = a.user_id WHERE NOT coalesce(r2.ss = 'error', FALSE)")
def run_incremental_deletes(spark, sf_dir):
    """The table after two runs whose source rows may delete their key."""
    return mg.read_bucketed(spark, two_runs(spark, sf_dir)[0]).select("user_id", "updated_at", "status")


@query("merge_into_buckets", _merged("s.updated_at > t.updated_at"))
def merge_into_buckets(spark, sf_dir):
    """The same MERGE in place: only buckets with a changed key are rewritten."""
    silver, _ = load_first(spark, sf_dir, "orders")
    mg.merge_into(spark, silver, source(spark, sf_dir), KEY, BUCKETS, mg.newer("updated_at"))
    return mg.read_bucketed(spark, silver)


@query("status_summary", f"""
SELECT COUNT(*) AS total, COUNT(*) FILTER (status = 'purchase') AS purchase_count, COUNT(*) FILTER (status = 'signup') AS signup_count,
  COUNT(*) FILTER (status = 'error') AS error_count, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_value FROM {_newest('TRUE')}""")
def status_summary(spark, sf_dir):
    return inc.status_summary(newest(log(spark, sf_dir)), ["purchase", "signup", "error"])


@query("silver_orders_merge", f"""
SELECT order_id, customer_id, CAST(amount AS DOUBLE) AS amount, order_date, order_year, order_month FROM (
  SELECT order_id, customer_id, amount, order_date, year(order_date)::INT AS order_year, month(order_date)::INT AS order_month, status FROM {ORDERS})
WHERE amount > 0 AND order_date <= DATE '2001-01-01'""")
def silver_orders_merge(spark, sf_dir):
    """Cleaned orders of the later years merged into those of the earlier."""
    from sedimenta.plans.customers import silver_orders

    clean = silver_orders(shapes.orders(spark, sf_dir), F.lit("2001-01-01").cast("date"))
    old = clean.filter("order_year < 1999")
    new = clean.filter("order_year >= 1998")
    return mg.merge(old, new, ["order_id"]).select(
        "order_id", "customer_id", F.col("amount").cast("double").alias("amount"), "order_date", "order_year", "order_month"
    )
