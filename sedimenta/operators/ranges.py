"""Place of a value among sorted cut points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_range_number(df: DataFrame, name: str, cuts: Column, value: Column, bits: int) -> DataFrame:
    """Add ``name``: how many of the sorted ``cuts`` are at or below ``value``.

    Halving the step gives the answer after ``bits`` comparisons, all in
    generated code; it covers arrays of up to ``2**bits - 1`` cuts.  A NULL
    array or value counts as 0.
    """
    out = df.withColumn(name, F.lit(0))
    for step in (1 << n for n in range(bits - 1, -1, -1)):
        reached = F.get(cuts, F.col(name) + F.lit(step - 1)) <= value
        out = out.withColumn(name, F.col(name) + F.when(reached, F.lit(step)).otherwise(F.lit(0)))
    return out
