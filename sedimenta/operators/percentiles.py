"""Exact percentiles that do not gather a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.windows import BUCKET_ROWS, join_values, sequence_windows
from sedimenta.scale import durable, hot_keys

# Groups and tables up to these sizes are left to the built-in function.
BUFFER_ROWS = 200_000


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probabilities: dict[str, float],
    hot_rows: int | None = None,
    small_bytes: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Interpolated percentiles of ``value`` per key, one column per name.

    The built-in function keeps all values of a group in one buffer, so it is
    used only where every group is small.  Otherwise the values are counted,
    the counts are run up in order, and the one or two values at each position
    are picked.
    """
    group_rows = BUFFER_ROWS if hot_rows is None else hot_rows
    some = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    if hot_keys(some, keys, group_rows, small_bytes) is None:
        return some.groupBy(*keys).agg(
            *[F.percentile("_v", F.lit(p)).alias(n) for n, p in probabilities.items()]
        )
    # As in sequence_windows: one group under a key the optimizer keeps.
    keyed = some if keys else some.withColumn("_all", F.pmod(F.xxhash64("_v"), F.lit(1)))
    by = keys or ["_all"]
    counts = durable(keyed.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c")), "counts")
    sizes = counts.groupBy(*by).agg(F.sum("_c").alias("_size"))
    upto = sequence_windows(
        counts, by, ["_v"], running={"_upto": "_c"},
        hot_rows=hot_rows, small_bytes=0, bucket_rows=bucket_rows,
    )
    placed = join_values(upto, sizes, by, hot_rows, same_keys=counts)
    aggs = []
    for i, p in enumerate(probabilities.values()):
        at = F.lit(p) * (F.col("_size") - 1)
        for part, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (index >= F.col("_upto") - F.col("_c")) & (index < F.col("_upto"))
            aggs.append(F.max(F.when(here, F.col("_v"))).alias(f"_{part}{i}"))
    picked = placed.groupBy(*by, "_size").agg(*aggs)
    out = []
    for i, (name, p) in enumerate(probabilities.items()):
        at = F.lit(p) * (F.col("_size") - 1)
        share = at - F.floor(at)
        between = F.col(f"_lo{i}") * (1 - share) + F.col(f"_hi{i}") * share
        out.append(F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}")).otherwise(between).alias(name))
    return picked.select(*keys, *out)
