"""Schema comparison.  Works on metadata only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ISSUES = "column string, issue string, expected string, actual string"


def schema_diff(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Missing and extra columns, other types, columns that may not be NULL."""
    have = {f.name: f for f in df.schema.fields}
    want = {f.name: f for f in expected.fields}
    rows = []
    for name, f in want.items():
        got = have.get(name)
        if got is None:
            rows.append((name, "missing", f.dataType.simpleString(), None))
            continue
        if got.dataType != f.dataType:
            rows.append((name, "type", f.dataType.simpleString(), got.dataType.simpleString()))
        if got.nullable and not f.nullable:
            rows.append((name, "nullable", "not null", "nullable"))
    for name in have.keys() - want.keys():
        rows.append((name, "extra", None, have[name].dataType.simpleString()))
    return df.sparkSession.createDataFrame(rows, ISSUES)


def is_compatible(df: DataFrame, expected: T.StructType) -> bool:
    """Extra columns are allowed, everything else in ``schema_diff`` is not."""
    return schema_diff(df, expected).filter("issue <> 'extra'").isEmpty()


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def conform(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Select the expected columns; those the table lacks become NULL."""
    from pyspark.sql import functions as F

    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in expected.fields
    ])
