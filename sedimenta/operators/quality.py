"""Data-quality rules.  Each report compiles to one aggregation of the table
(two where whole duplicate rows or duplicate keys are counted)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.profile import percent, rows_of
from sedimenta.operators.windows import latest_per_key
from sedimenta.scale import durable

# Fixed values of the order rules: e-mail pattern and allowed states.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
ORDER_STATUSES = ["pending", "completed", "cancelled"]

VALID = "Valid"


# --- counts -----------------------------------------------------------------

def duplicate_rows(df: DataFrame) -> DataFrame:
    """Total, distinct and surplus rows.  Copies are counted map-side."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.count(F.lit(1)).alias("distinct_rows")
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``key``, NULL being one, against the rows."""
    one = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        (F.count_distinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))).alias("distinct_values"),
    )
    return one.withColumn(
        "uniqueness_rate", F.round(percent(F.col("distinct_values"), F.col("total_rows")), 4)
    )


def condition_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """``issue, n`` per condition.  A condition that is NULL does not count."""
    one = df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])
    return one.unpivot([], list(conditions), "issue", "n")


def order_conditions() -> dict[str, Column]:
    """Validity conditions; NULL in, NULL out, so missing values are no issue here."""
    return {
        "Negative amounts": F.col("amount") < 0,
        "Invalid emails": ~F.col("email").rlike(EMAIL_PATTERN),
        "Invalid status": ~F.col("status").isin(ORDER_STATUSES),
    }


def issue_summary(df: DataFrame, required: list[str], key: str) -> DataFrame:
    """``issue, dimension, n``: missing values, repeated keys, invalid values.

    Rows are grouped by key first (counting conditions map-side), so the
    repeated keys and the other counts come from one shuffle.
    """
    missing = {f"Missing {c}": F.col(c).isNull() for c in required}
    conditions = {**missing, **order_conditions()}
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values())],
    )
    one = per_key.agg(
        F.count_if(F.col("_n") > 1).alias("_repeated"),
        *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(conditions))],
    )
    row = lambda issue, dim, n: F.struct(
        F.lit(issue).alias("issue"), F.lit(dim).alias("dimension"), F.col(n).alias("n"))
    rows = [row(n, "Completeness" if n in missing else "Validity", f"c{i}") for i, n in enumerate(conditions)]
    return rows_of(one, [*rows, row(f"Duplicate {key}s", "Uniqueness", "_repeated")])


# --- row labels -------------------------------------------------------------

def order_rules() -> list[tuple[Column, str]]:
    """Ordered rules; the first that fails names the row."""
    return [
        (F.col("order_id").isNull(), "Missing order_id"),
        (F.col("customer_id").isNull(), "Missing customer_id"),
        (F.col("amount").isNull(), "Missing amount"),
        (F.col("amount") <= 0, "Invalid amount (must be positive)"),
        (F.col("order_date").isNull(), "Missing order_date"),
        (~F.col("status").isin(ORDER_STATUSES), "Invalid status"),
        (~F.col("email").rlike(EMAIL_PATTERN), "Invalid email format"),
    ]


def label_rules(df: DataFrame, rules: list[tuple[Column, str]]) -> DataFrame:
    """Add ``validation_errors`` (first failing rule or ``Valid``) and ``is_valid``."""
    label = None
    for bad, message in rules:
        label = F.when(bad, message) if label is None else label.when(bad, message)
    label = label.otherwise(VALID)
    return df.withColumn("validation_errors", label).withColumn(
        "is_valid", F.col("validation_errors") == VALID
    )


def split_valid(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the labels, and the rejected rows with them."""
    valid = labelled.filter("is_valid").drop("validation_errors", "is_valid")
    return valid, labelled.filter(~F.col("is_valid"))


def error_histogram(labelled: DataFrame) -> DataFrame:
    return (
        labelled.groupBy("validation_errors").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "validation_errors")
    )


def order_checks() -> dict[str, Column]:
    return {
        "has_order_id": F.col("order_id").isNotNull(),
        "has_customer_id": F.col("customer_id").isNotNull(),
        "has_valid_amount": F.col("amount").isNotNull() & (F.col("amount") > 0),
        "has_order_date": F.col("order_date").isNotNull(),
        "has_valid_status": F.col("status").isin(ORDER_STATUSES),
        "has_valid_email": F.col("email").isNull() | F.col("email").rlike(EMAIL_PATTERN),
    }


def grade(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Add the checks, their number as ``validation_score`` and a grade.

    A check that is NULL makes the score NULL and the grade D.
    """
    out = df.select("*", *[c.alias(n) for n, c in checks.items()])
    score = sum((F.col(n).cast("int") for n in checks), F.lit(0))
    top = len(checks)
    s = F.col("validation_score")
    letter = (
        F.when(s == top, "A - Excellent").when(s == top - 1, "B - Good").when(s == top - 2, "C - Fair")
        .otherwise("D - Poor")
    )
    return out.withColumn("validation_score", score).withColumn("quality_grade", letter)


# --- expectation suite ------------------------------------------------------

@dataclass(frozen=True)
class Check:
    """``found`` must be 0, or equal ``wanted`` where that is given."""

    name: str
    text: str
    found: Column
    wanted: Column | None = None


@dataclass
class Suite:
    """Expectations on columns, evaluated together in one aggregation."""

    checks: list[Check] = field(default_factory=list)

    def _none(self, name: str, bad: Column, text: str) -> Suite:
        self.checks.append(Check(name, text, F.count_if(bad)))
        return self

    def not_null(self, c: str) -> Suite:
        return self._none(f"not_null({c})", F.col(c).isNull(), "Found %d null values")

    def unique(self, c: str) -> Suite:
        """NULL counts as one value."""
        distinct = F.count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))
        self.checks.append(Check(f"unique({c})", "Total: %d, Unique: %d", F.count(F.lit(1)), distinct))
        return self

    def between(self, c: str, low, high) -> Suite:
        outside = (F.col(c) < low) | (F.col(c) > high)
        return self._none(f"between({c}, {low}, {high})", outside, "Found %d values out of range")

    def in_set(self, c: str, values: list) -> Suite:
        return self._none(f"in_set({c})", ~F.col(c).isin(values), "Found %d invalid values")

    def match_regex(self, c: str, pattern: str) -> Suite:
        return self._none(f"match_regex({c})", ~F.col(c).rlike(pattern), "Found %d values not matching")

    def evaluate(self, df: DataFrame) -> DataFrame:
        """``expectation, success, details`` per expectation."""
        aggs, rows = [], []
        for i, check in enumerate(self.checks):
            aggs.append(check.found.alias(f"a{i}"))
            found, wanted, shown = F.col(f"a{i}"), F.lit(0), [F.col(f"a{i}")]
            if check.wanted is not None:
                aggs.append(check.wanted.alias(f"b{i}"))
                wanted, shown = F.col(f"b{i}"), [F.col(f"a{i}"), F.col(f"b{i}")]
            rows.append(F.struct(
                F.lit(check.name).alias("expectation"), (found == wanted).alias("success"),
                F.format_string(check.text, *shown).alias("details"),
            ))
        return rows_of(df.agg(*aggs), rows)


def order_suite(low: float = 0, high: float = 10000) -> Suite:
    return (
        Suite().not_null("order_id").not_null("customer_id").unique("order_id")
        .between("amount", low, high).in_set("status", ORDER_STATUSES)
    )


def suite_summary(results: DataFrame) -> DataFrame:
    """Passed, failed, success rate and the failed expectations (one per check)."""
    return results.agg(
        F.bool_and("success").alias("success"),
        F.count(F.lit(1)).alias("total_expectations"),
        F.count_if("success").alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("failed_expectations"),
        F.array_join(
            F.array_sort(F.collect_set(F.when(~F.col("success"), F.col("expectation")))), "; "
        ).alias("failed"),
    ).withColumn(
        "success_rate", F.round(percent(F.col("successful_expectations"), F.col("total_expectations")), 4)
    )


# --- reports and gate -------------------------------------------------------

def quality_report(df: DataFrame, rules: list[tuple[Column, str]], key: str) -> DataFrame:
    """Initial, valid, invalid, duplicate and final rows with their rates.

    One shuffle: valid rows are counted per key map-side.
    """
    return labelled_report(label_rules(df, rules), key)


def labelled_report(labelled: DataFrame, key: str) -> DataFrame:
    """``quality_report`` of rows that ``label_rules`` has labelled."""
    per_key = labelled.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("is_valid").alias("_ok")
    )
    one = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("initial_records"),
        F.coalesce(F.sum("_ok"), F.lit(0)).alias("valid_records"),
        F.count_if(F.col("_ok") > 0).alias("final_records"),
    )
    first = F.col("initial_records")
    return one.select(
        "initial_records", "valid_records",
        (first - F.col("valid_records")).alias("invalid_records"),
        (F.col("valid_records") - F.col("final_records")).alias("duplicates_removed"),
        "final_records",
        F.round(percent(F.col("valid_records"), first), 4).alias("quality_rate"),
        F.round(percent(F.col("final_records"), first), 4).alias("retention_rate"),
    )


def quality_gate(report: DataFrame, threshold: float) -> DataFrame:
    """The report with ``passed``: the quality rate reaches the threshold."""
    return report.withColumn("passed", F.col("quality_rate") >= F.lit(threshold)).withColumn(
        "message", F.when(F.col("passed"), "Quality gate passed").otherwise("Quality gate failed")
    )


class QualityGateError(RuntimeError):
    """The share of valid rows is below the threshold."""


def write_if_good(
    df: DataFrame, rules: list[tuple[Column, str]], key: str, order: list[Column], threshold: float, path: str
) -> DataFrame:
    """Write the clean, deduplicated rows, or raise and write nothing.

    The rows are labelled once and kept in the shared folder; the report and
    the result come from there, so ``df`` is run a single time.
    """
    labelled = durable(label_rules(df, rules), "labelled")
    result = quality_gate(labelled_report(labelled, key), threshold)
    row = result.first()
    if not row["passed"]:
        raise QualityGateError(f"quality rate {row['quality_rate']} is below {threshold}")
    valid, _ = split_valid(labelled)
    latest_per_key(valid, [key], order).write.mode("overwrite").parquet(path)
    return result


def quality_metrics(df: DataFrame, key: str, required: list[str]) -> DataFrame:
    """Completeness, uniqueness and validity rates, and their mean as the score."""
    email_ok = F.col("email").rlike(EMAIL_PATTERN)
    one = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        (F.count_distinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))).alias("unique_keys"),
        F.count_if(F.col("amount") > 0).alias("_amount"),
        F.count_if(F.col("status").isin(ORDER_STATUSES)).alias("_status"),
        F.count("email").alias("_emails"),
        F.count_if(email_ok).alias("_email"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count_if(F.col("amount") < 0).alias("negative_amounts"),
        *[F.count(c).alias(f"_c_{c}") for c in required],
    )
    total = F.col("total_records")
    rates = {f"{c}_completeness": percent(F.col(f"_c_{c}"), total) for c in required}
    rates |= {
        "uniqueness_rate": percent(F.col("unique_keys"), total),
        "amount_validity": percent(F.col("_amount"), total),
        "status_validity": percent(F.col("_status"), total),
        "email_validity": F.coalesce(percent(F.col("_email"), F.col("_emails")), F.lit(100.0)),
    }
    score = sum(rates.values(), F.lit(0.0)) / F.lit(len(rates))
    return one.select(
        "total_records", "unique_keys", "null_keys", "negative_amounts",
        *[F.round(r, 4).alias(n) for n, r in rates.items()],
        F.round(score, 4).alias("overall_quality_score"),
    )


def trend_summary(scores: DataFrame, column: str, threshold: float) -> DataFrame:
    """Alerts below the threshold, mean, extremes and range of a score series."""
    c = F.col(column)
    return scores.agg(
        F.count(F.lit(1)).alias("periods"),
        F.count_if(c < threshold).alias("alerts"),
        F.round(F.avg(c), 4).alias("average"),
        F.min(c).alias("worst"),
        F.max(c).alias("best"),
    ).withColumn("quality_range", F.round(F.col("best") - F.col("worst"), 4))


# --- issue detection and rule engine ----------------------------------------

def detect_issues(df: DataFrame) -> DataFrame:
    """Empty columns, many NULLs, copies, bad e-mails and negative amounts."""
    cols = df.columns
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    n = F.col("_n")
    bad_email = ~F.col("email").rlike(EMAIL_PATTERN) if "email" in cols else F.lit(False)
    negative = F.col("amount") < 0 if "amount" in cols else F.lit(False)
    # Every distinct row stands for its copies, so all counts come from one pass.
    weigh = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0))
    one = groups.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("_rows"), F.count(F.lit(1)).alias("_distinct"),
        weigh(bad_email).alias("_email"), weigh(negative).alias("_negative"),
        *[weigh(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(cols)],
    )
    rows = []

    def add(found: Column, kind: str, severity: str, column: str, count: Column):
        rows.append(F.struct(
            F.lit(kind).alias("type"), F.lit(severity).alias("severity"), F.lit(column).alias("column"),
            count.cast("bigint").alias("issue_rows"), found.alias("_found"),
        ))

    for i, c in enumerate(cols):
        nulls = F.col(f"_null{i}")
        add((nulls == F.col("_rows")) & (F.col("_rows") > 0), "COMPLETENESS", "CRITICAL", c, nulls)
        add(percent(nulls, F.col("_rows")) > 50, "COMPLETENESS", "HIGH", c, nulls)
    copies = F.col("_rows") - F.col("_distinct")
    add(copies > 0, "UNIQUENESS", "MEDIUM", "ALL", copies)
    add(F.col("_email") > 0, "VALIDITY", "MEDIUM", "email", F.col("_email"))
    add(F.col("_negative") > 0, "VALIDITY", "HIGH", "amount", F.col("_negative"))
    return rows_of(one, rows).filter("_found").drop("_found")


@dataclass(frozen=True)
class Rule:
    """A named predicate on a row that marks violations."""

    name: str
    violation: str
    severity: str = "MEDIUM"


def run_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rule_name, is_valid, message, severity`` per rule.

    A rule that cannot be resolved on this table, or fails on one of its
    values, is reported as CRITICAL, and the others still run.
    """
    good, _ = resolvable(df, rules)
    counts = [F.count_if(F.expr(r.violation)) for r in good]
    try:
        found = list(df.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)]).first()) if good else []
    except PySparkException:
        found = [_count_alone(df, c) for c in counts]  # one rule fails on a value: find it
    return rule_results(df, rules, found)


def resolvable(df: DataFrame, rules: list[Rule]) -> tuple[list[Rule], list[tuple]]:
    """Rules whose columns and types fit the table, and the results of the others."""
    good, broken = [], []
    for r in rules:
        try:
            df.select(F.expr(r.violation).alias("v")).schema  # noqa: B018
            good.append(r)
        except PySparkException as e:
            broken.append((r.name, False, f"Rule execution failed: {e.getCondition()}", "CRITICAL"))
    return good, broken


def rule_results(df: DataFrame, rules: list[Rule], found: list[int | str]) -> DataFrame:
    """Results from the violations (or the failure) of every resolvable rule."""
    good, broken = resolvable(df, rules)
    broken += [(r.name, False, f"Rule execution failed: {n}", "CRITICAL") for r, n in zip(good, found) if isinstance(n, str)]
    ran = [(r.name, n == 0, "ok" if n == 0 else f"Found {n} violations", r.severity)
           for r, n in zip(good, found) if not isinstance(n, str)]
    return df.sparkSession.createDataFrame(ran + broken, "rule_name string, is_valid boolean, message string, severity string")


def _count_alone(df: DataFrame, violations: Column) -> int | str:
    try:
        return df.agg(violations).first()[0]
    except PySparkException as e:
        return e.getCondition() or type(e).__name__


# --- constraints ------------------------------------------------------------

class ConstraintError(ValueError):
    """Rows violate a table constraint."""


def _violated(checks: dict[str, str], not_null: list[str]) -> dict[str, Column]:
    conditions = {n: ~F.expr(f"({c})") for n, c in checks.items()}
    return conditions | {f"{c}_not_null": F.col(c).isNull() for c in not_null}


def violation_counts(checks: dict[str, str], not_null: list[str]) -> dict[str, Column]:
    """Violations of every constraint as an aggregate; NULL violates no CHECK."""
    return {n: F.count_if(c) for n, c in _violated(checks, list(not_null)).items()}


def constraint_violations(df: DataFrame, checks: dict[str, str], not_null: list[str]) -> DataFrame:
    """``constraint_name, violations``.  As in CHECK, NULL is no violation."""
    return condition_counts(df, _violated(checks, not_null)).select(
        F.col("issue").alias("constraint_name"), F.col("n").alias("violations")
    )


def raise_violations(counts: dict[str, int]) -> None:
    """Raise with the constraints that have violations."""
    bad = {n: v for n, v in counts.items() if v > 0}
    if bad:
        raise ConstraintError(", ".join(f"{n}: {v}" for n, v in bad.items()))


def enforce(df: DataFrame, checks: dict[str, str], not_null: list[str] = ()) -> DataFrame:
    """``df`` if it satisfies all constraints, otherwise raise with the counts."""
    found = constraint_violations(df, checks, list(not_null)).collect()
    raise_violations({r["constraint_name"]: r["violations"] for r in found})
    return df


def precheck(df: DataFrame, constraint: str) -> DataFrame:
    """Rows that would break a constraint that is to be added."""
    return df.filter(~F.expr(f"({constraint})"))


def addable(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """Which constraints could be added; one that fails does not stop the others."""
    return constraint_violations(df, checks, []).withColumn("added", F.col("violations") == 0)


# --- expectations on a layer ------------------------------------------------

@dataclass(frozen=True)
class Expect:
    """``action`` is ``warn`` (count), ``drop`` (leave out) or ``fail`` (stop)."""

    name: str
    condition: str
    action: str = "warn"

    def holds(self) -> Column:
        return F.coalesce(F.expr(f"({self.condition})"), F.lit(False))


def expectation_metrics(df: DataFrame, expects: list[Expect]) -> DataFrame:
    """``expectation, action, passed_records, failed_records``."""
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(e.holds()).alias(f"p{i}") for i, e in enumerate(expects)]
    )
    return rows_of(one, [
        F.struct(
            F.lit(e.name).alias("expectation"), F.lit(e.action).alias("action"),
            F.col(f"p{i}").alias("passed_records"), (F.col("_rows") - F.col(f"p{i}")).alias("failed_records"),
        )
        for i, e in enumerate(expects)
    ])


def apply_expectations(df: DataFrame, expects: list[Expect]) -> DataFrame:
    """Rows that pass all ``drop`` expectations.

    A row that breaks a ``fail`` expectation fails the job that reads it, so
    an update that meets one writes nothing.
    """
    out = df
    for e in expects:
        if e.action == "fail":
            broken = F.raise_error(F.lit(f"expectation failed: {e.name}")).cast("boolean")
            out = out.filter(F.when(e.holds(), F.lit(True)).otherwise(broken))
    for e in expects:
        if e.action == "drop":
            out = out.filter(e.holds())
    return out


class ExpectationError(RuntimeError):
    """Rows break an expectation whose action is ``fail``."""


def observed_expectations(df: DataFrame, expects: list[Expect]) -> tuple[DataFrame, Observation]:
    """The rows that pass every ``drop`` and ``fail`` expectation, and the
    counts of all expectations, which are there once the rows were written."""
    seen = Observation()
    counts = [F.count_if(e.holds()).alias(f"p{i}") for i, e in enumerate(expects)]
    out = df.observe(seen, F.count(F.lit(1)).alias("n"), *counts)
    for e in expects:
        if e.action != "warn":
            out = out.filter(e.holds())
    return out, seen


def observed_metrics(spark: SparkSession, seen: Observation, expects: list[Expect]) -> DataFrame:
    """``expectation_metrics`` from observed counts."""
    got = seen.get
    rows = [(e.name, e.action, got[f"p{i}"], got["n"] - got[f"p{i}"]) for i, e in enumerate(expects)]
    return spark.createDataFrame(rows, "expectation string, action string, passed_records bigint, failed_records bigint")


# --- monitoring series ------------------------------------------------------

def daily_metrics(df: DataFrame, table: str, day: str) -> DataFrame:
    """Completeness per column and day in long format."""
    cols = [c for c in df.columns if c != day]
    per_day = df.groupBy(F.col(day).alias("partition_date")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_c_{c}") for c in cols]
    )
    rates = F.array(*[
        F.struct(F.lit(f"{c}_completeness_rate").alias("metric_name"),
                 F.try_divide(F.col(f"_c_{c}").cast("double"), F.col("_rows")).alias("metric_value"))
        for c in cols
    ])
    return per_day.select("partition_date", F.inline(rates)).select(
        F.lit(table).alias("table_name"), "metric_name", F.round("metric_value", 6).alias("metric_value"),
        "partition_date",
    )
