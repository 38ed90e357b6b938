"""A whole quality run over one table, with a log row per stage."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sedimenta.operators import profile, quality as q
from sedimenta.operators.schema import missing_columns
from sedimenta.operators.stages import run_stages
from sedimenta.scale import durable, work_path


def run_quality(
    df: DataFrame,
    table: str,
    path: str,
    required: list[str],
    rules: list[q.Rule],
    suite: q.Suite,
    checks: dict[str, str],
    not_null: list[str],
    day: str,
) -> DataFrame:
    """Schema, rules, expectations, profile, constrained write, monitoring.

    ``df`` is run once: its rows are kept in the shared folder, and violations
    of rules and constraints are observed while they are written.  The other
    stages read the columns they need from there.

    Rules and expectations report and go on; a missing column or a violated
    constraint ends the run.  Results are below ``path``.  The log is returned
    and written also when the run fails.
    """

    def schema() -> str:
        missing = missing_columns(df, required)
        if missing:
            raise ValueError(f"missing columns {missing}")
        return f"{len(required)} columns"

    kept: dict[str, DataFrame] = {}
    seen = Observation()

    def business_rules() -> str:
        good, _ = q.resolvable(df, rules)
        aggs = [F.count_if(F.expr(r.violation)).alias(f"r{i}") for i, r in enumerate(good)]
        aggs += [c.alias(f"c{i}") for i, c in enumerate(q.violation_counts(checks, not_null).values())]
        rows = work_path(df.sparkSession, "quality-rows")
        try:
            df.observe(seen, F.count(F.lit(1)).alias("n"), *aggs).write.parquet(rows)
            kept["rows"] = df.sparkSession.read.schema(df.schema).parquet(rows)
            results = q.rule_results(df, rules, [seen.get[f"r{i}"] for i in range(len(good))])
        except PySparkException:  # a rule or constraint fails on a value: each is run alone on the kept rows
            kept["rows"] = durable(df, "quality-rows")
            results = q.run_rules(kept["rows"], rules)
            kept["alone"] = kept["rows"]
        results.write.mode("overwrite").parquet(f"{path}/rules")
        good = df.sparkSession.read.parquet(f"{path}/rules").filter("is_valid").count()
        return f"{good} of {len(rules)} rules hold"

    def expectations() -> str:
        r = q.suite_summary(suite.evaluate(kept["rows"])).first()
        return f"{r['successful_expectations']} of {r['total_expectations']} expectations hold"

    def profiling() -> str:
        profile.column_profile(kept["rows"]).write.mode("overwrite").parquet(f"{path}/profile")
        return f"{len(df.columns)} columns"

    def write() -> str:
        if "alone" in kept:
            q.enforce(kept["rows"], checks, not_null)
        else:
            q.raise_violations({name: seen.get[f"c{i}"] for i, name in enumerate(q.violation_counts(checks, not_null))})
        kept["rows"].write.mode("overwrite").parquet(f"{path}/data")
        return "written"

    def monitoring() -> str:
        q.daily_metrics(kept["rows"], table, day).write.mode("append").parquet(f"{path}/metrics")
        return "metrics appended"

    log = run_stages(df.sparkSession, [
        ("schema", schema), ("rules", business_rules), ("expectations", expectations),
        ("profile", profiling), ("write", write), ("monitoring", monitoring),
    ])
    log.write.mode("append").parquet(f"{path}/log")
    return log
