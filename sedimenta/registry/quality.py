"""Data-quality queries over the orders with defects."""

from pyspark.sql import functions as F

from sedimenta.operators import profile, quality as q
from sedimenta.registry.base import query
from sedimenta.registry.sqlshapes import DIRTY, METRICS, ORDERS
from sedimenta.sources import shapes

EMAIL = q.EMAIL_PATTERN
COLUMNS = ["order_id", "customer_id", "amount", "order_date", "status", "email"]
REQUIRED = ["order_id", "customer_id", "amount", "order_date"]
BAD_EMAIL = f"NOT regexp_matches(email, '{EMAIL}')"
BAD_STATUS = "status NOT IN ('pending','completed','cancelled')"

LABEL = f"""CASE WHEN order_id IS NULL THEN 'Missing order_id' WHEN customer_id IS NULL THEN 'Missing customer_id'
  WHEN amount IS NULL THEN 'Missing amount' WHEN amount <= 0 THEN 'Invalid amount (must be positive)'
  WHEN order_date IS NULL THEN 'Missing order_date' WHEN {BAD_STATUS} THEN 'Invalid status'
  WHEN {BAD_EMAIL} THEN 'Invalid email format' ELSE 'Valid' END"""
LABELLED = f"(SELECT *, {LABEL} AS validation_errors FROM {DIRTY})"


def dirty(spark, sf_dir):
    return shapes.dirty_orders(spark, sf_dir)


@query("dq_null_counts", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NULL) AS null_count FROM {DIRTY}" for c in COLUMNS))
def dq_null_counts(spark, sf_dir):
    return profile.null_counts(dirty(spark, sf_dir))


@query("dq_completeness", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(COUNT({c}) * 100.0 / COUNT(*), 4) AS completeness_pct FROM {DIRTY}" for c in COLUMNS))
def dq_completeness(spark, sf_dir):
    return profile.completeness(dirty(spark, sf_dir))


@query("dq_uniqueness", f"""
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT order_id) + 1 AS distinct_values,
  round((COUNT(DISTINCT order_id) + 1) * 100.0 / COUNT(*), 4) AS uniqueness_rate FROM {DIRTY}""")
def dq_uniqueness(spark, sf_dir):
    return q.uniqueness(dirty(spark, sf_dir), "order_id")


@query("dq_validity", f"""
SELECT 'Negative amounts' AS issue, COUNT(*) AS n FROM {DIRTY} WHERE amount < 0
UNION ALL SELECT 'Invalid emails', COUNT(*) FROM {DIRTY} WHERE {BAD_EMAIL}
UNION ALL SELECT 'Invalid status', COUNT(*) FROM {DIRTY} WHERE {BAD_STATUS}
UNION ALL SELECT 'High amounts', COUNT(*) FROM {DIRTY} WHERE amount > 400000""")
def dq_validity(spark, sf_dir):
    return q.condition_counts(
        dirty(spark, sf_dir), {**q.order_conditions(), "High amounts": F.col("amount") > 400000}
    )


@query("dq_issue_summary", "\nUNION ALL\n".join(
    [f"SELECT 'Missing {c}' AS issue, 'Completeness' AS dimension, COUNT(*) AS n FROM {DIRTY} WHERE {c} IS NULL" for c in REQUIRED]
    + [f"SELECT 'Negative amounts', 'Validity', COUNT(*) FROM {DIRTY} WHERE amount < 0",
       f"SELECT 'Invalid emails', 'Validity', COUNT(*) FROM {DIRTY} WHERE {BAD_EMAIL}",
       f"SELECT 'Invalid status', 'Validity', COUNT(*) FROM {DIRTY} WHERE {BAD_STATUS}",
       f"SELECT 'Duplicate order_ids', 'Uniqueness', COUNT(*) FROM (SELECT order_id FROM {DIRTY} GROUP BY 1 HAVING COUNT(*) > 1)"]))
def dq_issue_summary(spark, sf_dir):
    return q.issue_summary(dirty(spark, sf_dir), REQUIRED, "order_id")


@query("dq_rule_labels", f"""
SELECT order_id, customer_id, amount, order_date, status, email, validation_errors, validation_errors = 'Valid' AS is_valid FROM {LABELLED}""")
def dq_rule_labels(spark, sf_dir):
    return q.label_rules(dirty(spark, sf_dir), q.order_rules())


@query("dq_error_histogram", f"SELECT validation_errors, COUNT(*) AS n FROM {LABELLED} GROUP BY 1")
def dq_error_histogram(spark, sf_dir):
    return q.error_histogram(q.label_rules(dirty(spark, sf_dir), q.order_rules()))


@query("dq_split_valid", f"""
SELECT 'valid' AS part, order_id, customer_id, amount, NULL::VARCHAR AS reason FROM {LABELLED} WHERE validation_errors = 'Valid'
UNION ALL SELECT 'rejected', order_id, customer_id, amount, validation_errors FROM {LABELLED} WHERE validation_errors <> 'Valid'""")
def dq_split_valid(spark, sf_dir):
    ok, bad = q.split_valid(q.label_rules(dirty(spark, sf_dir), q.order_rules()))
    cols = ["order_id", "customer_id", "amount"]
    return ok.select(F.lit("valid").alias("part"), *cols, F.lit(None).cast("string").alias("reason")).union(
        bad.select(F.lit("rejected"), *cols, "validation_errors")
    )


@query("dq_grades", f"""
WITH s AS (SELECT order_id, CAST((order_id IS NOT NULL)::INT + (customer_id IS NOT NULL)::INT
  + (amount IS NOT NULL AND amount > 0)::INT + (order_date IS NOT NULL)::INT
  + (status IN ('pending','completed','cancelled'))::INT
  + (email IS NULL OR regexp_matches(email, '{EMAIL}'))::INT AS INTEGER) AS validation_score FROM {DIRTY})
SELECT order_id, validation_score, CASE validation_score WHEN 6 THEN 'A - Excellent' WHEN 5 THEN 'B - Good'
  WHEN 4 THEN 'C - Fair' ELSE 'D - Poor' END AS quality_grade FROM s""")
def dq_grades(spark, sf_dir):
    return q.grade(dirty(spark, sf_dir), q.order_checks()).select("order_id", "validation_score", "quality_grade")


def _found(name, cond, text):
    return f"SELECT '{name}' AS expectation, COUNT(*) = 0 AS success, 'Found ' || COUNT(*) || ' {text}' AS details FROM {DIRTY} WHERE {cond}"


_SUITE = "\nUNION ALL\n".join([
    _found("not_null(order_id)", "order_id IS NULL", "null values"),
    _found("not_null(customer_id)", "customer_id IS NULL", "null values"),
    f"""SELECT 'unique(order_id)', COUNT(*) = COUNT(DISTINCT order_id) + 1,
      'Total: ' || COUNT(*) || ', Unique: ' || (COUNT(DISTINCT order_id) + 1) FROM {DIRTY}""",
    _found("between(amount, 0, 300000)", "amount < 0 OR amount > 300000", "values out of range"),
    _found("in_set(status)", BAD_STATUS, "invalid values"),
    _found("match_regex(email)", BAD_EMAIL, "values not matching"),
])


def _suite():
    return q.order_suite(0, 300000).match_regex("email", EMAIL)


@query("dq_expectations", _SUITE)
def dq_expectations(spark, sf_dir):
    return _suite().evaluate(dirty(spark, sf_dir))


@query("dq_suite_summary", f"""
SELECT bool_and(success) AS success, COUNT(*) AS total_expectations, COUNT(*) FILTER (success) AS successful_expectations,
  COUNT(*) FILTER (NOT success) AS failed_expectations, array_to_string(list(expectation ORDER BY expectation) FILTER (NOT success), '; ') AS failed,
  round(COUNT(*) FILTER (success) * 100.0 / COUNT(*), 4) AS success_rate FROM ({_SUITE})""")
def dq_suite_summary(spark, sf_dir):
    return q.suite_summary(_suite().evaluate(dirty(spark, sf_dir)))


@query("dq_clean_orders", f"""
SELECT order_id, customer_id, amount, order_date, status, email FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_date DESC) AS rn FROM {LABELLED} WHERE validation_errors = 'Valid') WHERE rn = 1""")
def dq_clean_orders(spark, sf_dir):
    from sedimenta.operators.windows import latest_per_key

    ok, _ = q.split_valid(q.label_rules(dirty(spark, sf_dir), q.order_rules()))
    return latest_per_key(ok, ["order_id"], [F.desc("order_date")])


_REPORT = f"""SELECT COUNT(*) AS initial_records, COUNT(*) FILTER (v) AS valid_records, COUNT(*) FILTER (NOT v) AS invalid_records,
  COUNT(*) FILTER (v) - COUNT(DISTINCT order_id) FILTER (v) AS duplicates_removed, COUNT(DISTINCT order_id) FILTER (v) AS final_records,
  round(COUNT(*) FILTER (v) * 100.0 / COUNT(*), 4) AS quality_rate, round(COUNT(DISTINCT order_id) FILTER (v) * 100.0 / COUNT(*), 4) AS retention_rate
  FROM (SELECT *, validation_errors = 'Valid' AS v FROM {LABELLED})"""


@query("dq_run_report", _REPORT)
def dq_run_report(spark, sf_dir):
    return q.quality_report(dirty(spark, sf_dir), q.order_rules(), "order_id")


@query("dq_quality_gate", f"""
SELECT *, quality_rate >= 85 AS passed, CASE WHEN quality_rate >= 85 THEN 'Quality gate passed' ELSE 'Quality gate failed' END AS message FROM ({_REPORT})""")
def dq_quality_gate(spark, sf_dir):
    return q.quality_gate(q.quality_report(dirty(spark, sf_dir), q.order_rules(), "order_id"), 85.0)


@query("dq_metrics", f"""
WITH m AS (SELECT COUNT(*) AS total_records, COUNT(DISTINCT order_id) + 1 AS unique_keys,
  COUNT(*) FILTER (order_id IS NULL) AS null_keys, COUNT(*) FILTER (amount < 0) AS negative_amounts,
  COUNT(order_id) * 100.0 / COUNT(*) AS c1, COUNT(customer_id) * 100.0 / COUNT(*) AS c2,
  (COUNT(DISTINCT order_id) + 1) * 100.0 / COUNT(*) AS u, COUNT(*) FILTER (amount > 0) * 100.0 / COUNT(*) AS a,
  COUNT(*) FILTER (status IN ('pending','completed','cancelled')) * 100.0 / COUNT(*) AS s,
  COUNT(*) FILTER (regexp_matches(email, '{EMAIL}')) * 100.0 / COUNT(email) AS e FROM {DIRTY})
SELECT total_records, unique_keys, null_keys, negative_amounts, round(c1, 4) AS order_id_completeness, round(c2, 4) AS customer_id_completeness,
  round(u, 4) AS uniqueness_rate, round(a, 4) AS amount_validity, round(s, 4) AS status_validity, round(e, 4) AS email_validity,
  round((c1 + c2 + u + a + s + e) / 6, 4) AS overall_quality_score FROM m""")
def dq_metrics(spark, sf_dir):
    return q.quality_metrics(dirty(spark, sf_dir), "order_id", ["order_id", "customer_id"])


@query("quality_trend_summary", f"""
SELECT COUNT(*) AS periods, COUNT(*) FILTER (metric_value < 50) AS alerts, round(avg(metric_value), 4) AS average,
  min(metric_value) AS worst, max(metric_value) AS best, round(max(metric_value) - min(metric_value), 4) AS quality_range FROM {METRICS}""")
def quality_trend_summary(spark, sf_dir):
    return q.trend_summary(shapes.metric_series(spark, sf_dir), "metric_value", 50.0)


def _prof(c, t, number):
    v = c if number else f"length({c})"
    stats = (f"CAST(min({v}) AS DOUBLE) AS min_value, CAST(max({v}) AS DOUBLE) AS max_value, round(avg({v}), 2) AS average, "
             + (f"round(stddev_samp({v}), 2)" if number else "CAST(NULL AS DOUBLE)") + " AS std_deviation")
    d = f"COUNT(DISTINCT {c}) + CASE WHEN COUNT({c}) < COUNT(*) THEN 1 ELSE 0 END"
    return (f"SELECT '{c}' AS \"column\", '{t}' AS data_type, COUNT(*) - COUNT({c}) AS null_count, "
            f"round(COUNT({c}) * 100.0 / COUNT(*), 2) AS completeness_rate, {d} AS distinct_count, "
            f"round(({d}) * 100.0 / COUNT(*), 2) AS uniqueness_rate, '{'value' if number else 'length'}' AS measure, {stats} FROM {DIRTY}")


@query("dq_column_profile", "\nUNION ALL\n".join(
    _prof(c, "double" if c == "amount" else "string", c == "amount") for c in COLUMNS))
def dq_column_profile(spark, sf_dir):
    return profile.column_profile(dirty(spark, sf_dir))


@query("dq_issue_detector", f"""
SELECT 'COMPLETENESS' AS type, 'CRITICAL' AS severity, 'note' AS "column", COUNT(*) AS issue_rows FROM {DIRTY}
UNION ALL SELECT 'COMPLETENESS', 'HIGH', 'note', COUNT(*) FROM {DIRTY}
UNION ALL SELECT 'UNIQUENESS', 'MEDIUM', 'ALL', (SELECT COUNT(*) FROM {DIRTY}) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {DIRTY}))
UNION ALL SELECT 'VALIDITY', 'MEDIUM', 'email', COUNT(*) FROM {DIRTY} WHERE {BAD_EMAIL}
UNION ALL SELECT 'VALIDITY', 'HIGH', 'amount', COUNT(*) FROM {DIRTY} WHERE amount < 0""")
def dq_issue_detector(spark, sf_dir):
    return q.detect_issues(dirty(spark, sf_dir).withColumn("note", F.lit(None).cast("string")))


@query("dq_rule_engine", f"""
SELECT 'positive_amounts' AS rule_name, COUNT(*) = 0 AS is_valid, CASE WHEN COUNT(*) = 0 THEN 'ok' ELSE 'Found ' || COUNT(*) || ' violations' END AS message, 'HIGH' AS severity FROM {DIRTY} WHERE amount <= 0
UNION ALL SELECT 'email_format', COUNT(*) = 0, CASE WHEN COUNT(*) = 0 THEN 'ok' ELSE 'Found ' || COUNT(*) || ' violations' END, 'MEDIUM' FROM {DIRTY} WHERE {BAD_EMAIL}
UNION ALL SELECT 'old_dates', COUNT(*) = 0, CASE WHEN COUNT(*) = 0 THEN 'ok' ELSE 'Found ' || COUNT(*) || ' violations' END, 'HIGH' FROM {DIRTY} WHERE order_date < '1900-01-01'
UNION ALL SELECT 'no_such_column', FALSE, 'Rule execution failed: UNRESOLVED_COLUMN.WITH_SUGGESTION', 'CRITICAL'""")
def dq_rule_engine(spark, sf_dir):
    return q.run_rules(dirty(spark, sf_dir), [
        q.Rule("positive_amounts", "amount <= 0", "HIGH"),
        q.Rule("email_format", f"NOT email RLIKE r'{EMAIL}'", "MEDIUM"),
        q.Rule("old_dates", "order_date < '1900-01-01'", "HIGH"),
        q.Rule("no_such_column", "discount_code IS NULL", "LOW"),
    ])


@query("dq_date_ranges", f"""
SELECT 'future dates' AS issue, COUNT(*) AS n FROM {DIRTY} WHERE TRY_CAST(order_date AS DATE) > DATE '2001-01-01'
UNION ALL SELECT 'dates before 1900', COUNT(*) FROM {DIRTY} WHERE TRY_CAST(order_date AS DATE) < DATE '1900-01-01'""")
def dq_date_ranges(spark, sf_dir):
    """The day of the run is a parameter, not the clock."""
    day = F.col("order_date").try_cast("date")
    today = F.lit("2001-01-01").cast("date")
    return q.condition_counts(dirty(spark, sf_dir), {
        "future dates": day > today, "dates before 1900": day < F.lit("1900-01-01").cast("date"),
    })


@query("dq_daily_metrics", "\nUNION ALL\n".join(
    f"SELECT 'dirty_orders' AS table_name, '{c}_completeness_rate' AS metric_name, round(COUNT({c}) * 1.0 / COUNT(*), 6) AS metric_value, order_date AS partition_date FROM {DIRTY} GROUP BY order_date"
    for c in COLUMNS if c != "order_date"))
def dq_daily_metrics(spark, sf_dir):
    return q.daily_metrics(dirty(spark, sf_dir), "dirty_orders", "order_date")


_CHECKS = {
    "positive_amount": "amount > 0",
    "valid_status": "status IN ('pending', 'completed', 'cancelled')",
    "reasonable_amount": "amount <= 450000",
}
_VIOLATIONS = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS constraint_name, COUNT(*) AS violations FROM {DIRTY} WHERE NOT ({c})" for n, c in _CHECKS.items())


@query("constraint_violations", _VIOLATIONS + "".join(
    f"\nUNION ALL SELECT '{c}_not_null', COUNT(*) FROM {DIRTY} WHERE {c} IS NULL" for c in ("order_id", "customer_id", "order_date")))
def constraint_violations(spark, sf_dir):
    return q.constraint_violations(dirty(spark, sf_dir), _CHECKS, ["order_id", "customer_id", "order_date"])


@query("constraint_precheck", f"SELECT order_id, amount, status FROM {DIRTY} WHERE NOT (amount > 0)")
def constraint_precheck(spark, sf_dir):
    return q.precheck(dirty(spark, sf_dir), "amount > 0").select("order_id", "amount", "status")


@query("constraint_add_list", f"SELECT *, violations = 0 AS added FROM ({_VIOLATIONS})")
def constraint_add_list(spark, sf_dir):
    return q.addable(dirty(spark, sf_dir), _CHECKS)


EXPECTS = [
    q.Expect("valid_order_id", "order_id IS NOT NULL", "drop"),
    q.Expect("positive_amount", "amount > 0", "drop"),
    q.Expect("valid_date", "CAST(order_date AS DATE) <= DATE'2001-01-01'", "drop"),
    q.Expect("known_status", "status IN ('pending', 'completed', 'cancelled')", "warn"),
    q.Expect("amount_bound", "amount IS NULL OR amount < 100000000", "fail"),
]


@query("expectations_drop", f"""
SELECT order_id, customer_id, CAST(CAST(amount AS DECIMAL(10,2)) AS DOUBLE) AS amount, CAST(order_date AS DATE) AS order_date, status FROM {DIRTY}
WHERE order_id IS NOT NULL AND amount > 0 AND CAST(order_date AS DATE) <= DATE '2001-01-01'""")
def expectations_drop(spark, sf_dir):
    return q.apply_expectations(dirty(spark, sf_dir), EXPECTS).select(
        "order_id", "customer_id", F.col("amount").cast("decimal(10,2)").cast("double").alias("amount"),
        F.col("order_date").cast("date").alias("order_date"), "status",
    )


def _exp(name, action, cond):
    return (f"SELECT '{name}' AS expectation, '{action}' AS action, COUNT(*) FILTER ({cond}) AS passed_records, "
            f"COUNT(*) - COUNT(*) FILTER ({cond}) AS failed_records FROM {DIRTY}")


@query("expectations_metrics", "\nUNION ALL\n".join(
    _exp(e.name, e.action, e.condition.replace("DATE'", "DATE '")) for e in EXPECTS))
def expectations_metrics(spark, sf_dir):
    return q.expectation_metrics(dirty(spark, sf_dir), EXPECTS)


@query("metric_anomalies", f"""
WITH r AS (SELECT *, avg(metric_value) OVER w AS rolling_avg, stddev_samp(metric_value) OVER w AS rolling_stddev FROM {METRICS}
  WINDOW w AS (PARTITION BY metric_name ORDER BY metric_date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
SELECT metric_name, metric_date, metric_value, round(rolling_avg, 4) AS rolling_avg, round(rolling_stddev, 4) AS rolling_stddev FROM r
WHERE metric_value > rolling_avg + 2 * rolling_stddev OR metric_value < rolling_avg - 2 * rolling_stddev""")
def metric_anomalies(spark, sf_dir):
    from sedimenta.plans.metrics import rolling_anomalies

    return rolling_anomalies(shapes.metric_series(spark, sf_dir), "metric_name", "metric_date", "metric_value", 10)


@query("silver_orders", f"""
SELECT order_id, customer_id, CAST(amount AS DOUBLE) AS amount, order_date, status, year(order_date)::INT AS order_year, month(order_date)::INT AS order_month
FROM {ORDERS} WHERE order_id IS NOT NULL AND amount > 0 AND order_date <= DATE '2001-01-01'""")
def silver_orders(spark, sf_dir):
    from sedimenta.plans.customers import silver_orders as build

    return build(shapes.orders(spark, sf_dir), F.lit("2001-01-01").cast("date")).select(
        "order_id", "customer_id", F.col("amount").cast("double").alias("amount"), "order_date", "status",
        "order_year", "order_month",
    )


@query("dq_stage_log", f"""
WITH b AS (SELECT COUNT(*) FILTER (NOT (amount > 0)) + COUNT(*) FILTER (customer_id IS NULL) AS bad, COUNT(*) FILTER (amount <= 0) AS r1,
    COUNT(*) FILTER ({BAD_EMAIL}) AS r2 FROM {DIRTY}),
  v AS (SELECT COUNT(*) FILTER (NOT (amount > 0)) + COUNT(*) FILTER (customer_id IS NULL) AS bad, COUNT(*) FILTER (amount <= 0) AS r1,
    COUNT(*) FILTER ({BAD_EMAIL}) AS r2 FROM {LABELLED} WHERE validation_errors = 'Valid'),
  a AS (SELECT 'raw' AS run, * FROM b UNION ALL SELECT 'valid', * FROM v),
  s AS (SELECT unnest(['schema','rules','expectations','profile','write','monitoring']) AS stage)
SELECT run, stage, CASE WHEN stage IN ('write','monitoring') THEN bad = 0 ELSE TRUE END AS success,
  CASE WHEN stage = 'rules' THEN ((r1 = 0)::INT + (r2 = 0)::INT) || ' of 2 rules hold' END AS rules FROM a, s""")
def dq_stage_log(spark, sf_dir):
    """The run over the raw orders ends at the constraints, that over the valid ones does not."""
    from sedimenta.plans.quality_run import run_quality
    from sedimenta.scale import work_path

    raw = dirty(spark, sf_dir)
    valid, _ = q.split_valid(q.label_rules(raw, q.order_rules()))
    rules = [
        q.Rule("positive_amounts", "amount <= 0", "HIGH"),
        q.Rule("email_format", f"NOT email RLIKE r'{EMAIL}'", "MEDIUM"),
    ]

    def log(run, df):
        out = run_quality(
            df, "orders", work_path(spark, "quality-run"), REQUIRED, rules, q.order_suite(0, 300000),
            {"positive_amount": "amount > 0"}, ["customer_id"], "order_date",
        )
        return out.select(
            F.lit(run).alias("run"), "stage", "success", F.when(F.col("stage") == "rules", F.col("detail")).alias("rules")
        )

    return log("raw", raw).union(log("valid", valid))
