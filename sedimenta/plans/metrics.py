"""Monitoring of metric series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rolling_anomalies(series: DataFrame, name: str, day: str, value: str, points: int) -> DataFrame:
    """Points outside mean +- 2 deviations of the ``points`` before them.

    The series has one row per metric and day, so a window group is as long
    as the calendar, not as the data.
    """
    w = Window.partitionBy(name).orderBy(day).rowsBetween(-points, -1)
    rolled = series.withColumn("rolling_avg", F.avg(value).over(w)).withColumn(
        "rolling_stddev", F.stddev(value).over(w)
    )
    far = 2 * F.col("rolling_stddev")
    outside = (F.col(value) > F.col("rolling_avg") + far) | (F.col(value) < F.col("rolling_avg") - far)
    return rolled.filter(outside).select(
        name, day, value, F.round("rolling_avg", 4).alias("rolling_avg"),
        F.round("rolling_stddev", 4).alias("rolling_stddev"),
    )
