"""Table and column profiles, each in one pass over the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
# Exact distinct counts repeat each row once per counted column.
COLUMNS_PER_PASS = 8


def rows_of(one_row: DataFrame, rows: list[Column]) -> DataFrame:
    """Turn one aggregated row into several: one struct per output row."""
    return one_row.select(F.inline(F.array(*rows)))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def null_counts(df: DataFrame) -> DataFrame:
    """``column, null_count`` for every column."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column", "null_count")


def completeness(df: DataFrame) -> DataFrame:
    """``column, completeness_pct`` for every column."""
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"_c{i}") for i, c in enumerate(df.columns)],
    )
    return rows_of(one, [
        F.struct(F.lit(c).alias("column"),
                 F.round(percent(F.col(f"_c{i}"), F.col("_rows")), 4).alias("completeness_pct"))
        for i, c in enumerate(df.columns)
    ])


def describe_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, standard deviation, min and max per column."""
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [
            F.count(c).alias(f"n{i}"), F.mean(v).alias(f"m{i}"), F.stddev(v).alias(f"s{i}"),
            F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
        ]
    return rows_of(df.agg(*aggs), [
        F.struct(
            F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.round(f"m{i}", 4).alias("mean"),
            F.round(f"s{i}", 4).alias("stddev"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ])


def column_profile(df: DataFrame) -> DataFrame:
    """Nulls, distinct values and type-dependent statistics per column.

    NULL counts as one distinct value.  Wide tables are profiled in groups of
    columns, so that the distinct counts stay affordable.
    """
    groups = [df.columns[i:i + COLUMNS_PER_PASS] for i in range(0, len(df.columns), COLUMNS_PER_PASS)]
    return reduce(DataFrame.union, [_profile(df.select(*g)) for g in groups])


def _profile(df: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggs += [F.count(c).alias(f"n{i}"), F.count_distinct(c).alias(f"d{i}")]
        if types[c].startswith(NUMERIC):
            v = F.col(c).cast("double")
            aggs += [F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}"),
                     F.avg(v).alias(f"e{i}"), F.stddev(v).alias(f"s{i}")]
        elif types[c] == "string":
            v = F.length(c).cast("double")
            aggs += [F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}"), F.avg(v).alias(f"e{i}")]
    one = df.agg(*aggs)
    none = F.lit(None).cast("double")
    rows = []
    for i, c in enumerate(df.columns):
        nulls = F.col("_rows") - F.col(f"n{i}")
        distinct = F.col(f"d{i}") + (nulls > 0).cast("int")
        number, text = types[c].startswith(NUMERIC), types[c] == "string"
        lo, hi = (F.col(f"a{i}"), F.col(f"b{i}")) if number or text else (none, none)
        mean = F.round(f"e{i}", 2) if number or text else none
        dev = F.round(f"s{i}", 2) if number else none
        rows.append(F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("data_type"),
            nulls.alias("null_count"),
            F.round(percent(F.col(f"n{i}"), F.col("_rows")), 2).alias("completeness_rate"),
            distinct.alias("distinct_count"),
            F.round(percent(distinct, F.col("_rows")), 2).alias("uniqueness_rate"),
            F.lit("length" if text else "value").alias("measure"),
            lo.alias("min_value"), hi.alias("max_value"), mean.alias("average"), dev.alias("std_deviation"),
        ))
    return rows_of(one, rows)
