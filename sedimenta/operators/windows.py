"""Ordered window operators that split the rows of a hot key.

A plain window puts all rows of a key into one task.  Here the rows of a hot
key are cut into consecutive buckets of the sort order, each bucket is one
window group, and what a bucket needs from the ones before it (row count,
running sum, neighbouring value) comes from a per-bucket summary.

The cuts are values found in a sample of the hot keys' rows, about
``MAX_SPLITS`` of them whatever the table size.  They are written once, so
every reader and every re-run task sees the same cuts.  Rows with equal sort
values stay together; the functions at the end also cope with a single sort
value that is hot itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators.ranges import with_range_number
from sedimenta.scale import durable, hot_keys, null_safe, salted_join

MAX_SPLITS = 32_768
BUCKET_ROWS = 1_000_000
# The search for a row's bucket covers 65,535 cuts per key, twice the number expected.
_CUT_BITS = 16


def order_buckets(
    df: DataFrame, keys: list[str], order: list[str], hot: DataFrame, bucket_rows: int
) -> DataFrame:
    """Add ``_bucket``: consecutive ranges of ``order`` within each hot key.

    Rows of other keys get bucket 0.  Sorting is ascending, NULLs first.
    """
    hot_total = sum(r["_rows"] for r in hot.select("_rows").collect())
    per_bucket = max(bucket_rows, hot_total // MAX_SPLITS, 1)
    place = F.struct(*[F.col(c) for c in order])
    cuts = (
        df.select(*keys, *order)
        .sample(1.0 / per_bucket, seed=29)
        .alias("r")
        .join(F.broadcast(hot).alias("h"), null_safe("r", "h", keys), "left_semi")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set(place)).alias("_cuts"))
    )
    out = (
        df.alias("r")
        .join(F.broadcast(durable(cuts, "cuts")).alias("h"), null_safe("r", "h", keys), "left")
        .select("r.*", "h._cuts")
    )
    return with_range_number(out, "_bucket", F.col("_cuts"), place, _CUT_BITS)


def sequence_windows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    number: str | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    running: dict[str, str] | None = None,
    rank: str | None = None,
    peer_running: dict[str, str] | None = None,
    hot_rows: int | None = None,
    small_bytes: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
    last: dict[str, str] | None = None,
) -> DataFrame:
    """Row number, neighbours, running sums, last values and rank per key in ``order``.

    ``lag``/``lead`` map a new column to the column whose previous/next value
    it takes, ``running`` maps a new column to the column it sums up to and
    including the row, ``last`` to the column whose last value that is not
    NULL it takes; for these ``order`` should be unique within a key.
    Rows that are equal in ``order`` share their ``rank`` and their
    ``peer_running`` sums.  Sorting is ascending, NULLs first.
    """
    lag, lead, running, peer_running, last = lag or {}, lead or {}, running or {}, peer_running or {}, last or {}
    hot = hot_keys(df, keys, hot_rows, small_bytes)
    columns = df.columns
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        new = [F.row_number().over(w).cast("long").alias(number)] if number else []
        new += [F.rank().over(w).cast("long").alias(rank)] if rank else []
        new += [F.lag(c).over(w).alias(n) for n, c in lag.items()]
        new += [F.lead(c).over(w).alias(n) for n, c in lead.items()]
        new += [F.sum(c).over(upto).alias(n) for n, c in running.items()]
        new += [F.sum(c).over(w).alias(n) for n, c in peer_running.items()]
        new += [F.last(c, ignorenulls=True).over(upto).alias(n) for n, c in last.items()]
        return df.select(*columns, *new)

    if not keys:
        # One group: give it a key that is always 0 but that the optimizer does
        # not know to be constant, so that its joins stay hash joins.
        df, keys = df.withColumn("_all", F.pmod(F.xxhash64(*order), F.lit(1))), ["_all"]
        hot = hot.withColumn("_all", F.pmod(F.xxhash64("_rows"), F.lit(1)))
    rows = order_buckets(df, keys, order, hot, bucket_rows)
    sums = {**running, **peer_running}
    carry = _carry(rows, keys, order, lag, lead, sums, last)
    w = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = [F.row_number().over(w).cast("long").alias("_n"),
             F.lead(F.lit(True)).over(w).isNull().alias("_end")]
    local += [F.rank().over(w).cast("long").alias("_rank")] if rank else []
    local += [F.lag(c).over(w).alias(f"_lag_{n}") for n, c in lag.items()]
    local += [F.lead(c).over(w).alias(f"_lead_{n}") for n, c in lead.items()]
    local += [F.sum(c).over(upto).alias(f"_run_{n}") for n, c in running.items()]
    local += [F.sum(c).over(w).alias(f"_run_{n}") for n, c in peer_running.items()]
    local += [F.last(c, ignorenulls=True).over(upto).alias(f"_last_{n}") for n, c in last.items()]
    rows = rows.drop("_cuts").select("*", *local)

    joined = rows.alias("r").join(
        F.broadcast(carry).alias("c"), null_safe("r", "c", [*keys, "_bucket"]), "left"
    )
    before = F.coalesce("_c_rows", F.lit(0))
    new = [(F.col("_n") + before).alias(number)] if number else []
    new += [(F.col("_rank") + before).alias(rank)] if rank else []
    for n in lag:
        new.append(F.when(F.col("_n") == 1, F.col(f"_c_lag_{n}")).otherwise(F.col(f"_lag_{n}")).alias(n))
    for n in lead:
        new.append(F.when(F.col("_end"), F.col(f"_c_lead_{n}")).otherwise(F.col(f"_lead_{n}")).alias(n))
    for n, c in sums.items():
        earlier, here = F.col(f"_c_run_{n}"), F.col(f"_run_{n}")
        total = F.when(earlier.isNull(), here).when(here.isNull(), earlier).otherwise(earlier + here)
        new.append(total.cast(_sum_type(df, c)).alias(n))
    new += [F.coalesce(f"_last_{n}", f"_c_last_{n}").alias(n) for n in last]
    return joined.select(*[F.col(f"r.{c}") for c in columns], *new)


def _sum_type(df: DataFrame, column: str):
    return df.select(F.sum(column)).schema[0].dataType


def _carry(rows, keys, order, lag, lead, sums, last) -> DataFrame:
    """One row per bucket of a hot key: what the buckets around it hold."""
    place = F.struct(*[F.col(c) for c in order])
    aggs = [F.count(F.lit(1)).alias("_rows")]
    # Structs keep a NULL neighbour apart from a missing one.
    aggs += [F.max_by(F.struct(F.col(c).alias("v")), place).alias(f"_lag_{n}") for n, c in lag.items()]
    aggs += [F.min_by(F.struct(F.col(c).alias("v")), place).alias(f"_lead_{n}") for n, c in lead.items()]
    aggs += [F.sum(c).alias(f"_run_{n}") for n, c in sums.items()]
    aggs += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"_last_{n}") for n, c in last.items()]
    parts = rows.filter(F.col("_cuts").isNotNull()).groupBy(*keys, "_bucket").agg(*aggs)
    # About MAX_SPLITS buckets in all: this window is small whatever the data.
    w = Window.partitionBy(*keys).orderBy("_bucket")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    out = [F.sum("_rows").over(before).alias("_c_rows")]
    out += [F.lag(f"_lag_{n}").over(w)["v"].alias(f"_c_lag_{n}") for n in lag]
    out += [F.lead(f"_lead_{n}").over(w)["v"].alias(f"_c_lead_{n}") for n in lead]
    out += [F.sum(f"_run_{n}").over(before).alias(f"_c_run_{n}") for n in sums]
    out += [F.last(f"_last_{n}", ignorenulls=True).over(before).alias(f"_c_last_{n}") for n in last]
    return parts.select(*keys, "_bucket", *out)


def peer_running_total(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    name: str,
    hot_rows: int | None = None,
    small_bytes: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Running sum per key where rows with equal ``order`` share one total.

    Where a single (key, order) is hot, equal rows are summed first, the
    totals are run up over the distinct values, and the rows join their total
    with salt.
    """
    split = {"hot_rows": hot_rows, "bucket_rows": bucket_rows}
    if hot_keys(df, [*keys, order], hot_rows, small_bytes) is None:
        return sequence_windows(
            df, keys, [order], peer_running={name: value}, small_bytes=small_bytes, **split
        )
    peers = durable(df.groupBy(*keys, order).agg(F.sum(value).alias("_peers")), "peers")
    totals = sequence_windows(peers, keys, [order], running={name: "_peers"}, small_bytes=0, **split)
    totals = totals.withColumn(name, F.col(name).cast(_sum_type(df, value))).drop("_peers")
    return join_values(df, totals, [*keys, order], hot_rows)


def global_rank(
    df: DataFrame,
    order: str,
    name: str,
    hot_rows: int | None = None,
    small_bytes: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``rank()`` over the whole table by a number, descending, NULLs last.

    Where a single value is hot, the rank of a value is one more than the
    number of rows with a greater value, run up over the distinct values.
    """
    split = {"hot_rows": hot_rows, "bucket_rows": bucket_rows}
    kind = df.schema[order].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        down = F.when(F.isnan(order), F.lit(0.0)).otherwise(-F.col(order))
        nan = ~F.coalesce(F.isnan(order), F.lit(False))
    else:  # -x - 1 falls as x rises and has no overflow
        down = F.bitwise_not(order) if isinstance(kind, T.IntegralType) else -F.col(order)
        nan = F.lit(True)
    # As Spark sorts downwards: NaN first, NULL last.
    downwards = {"_none": F.col(order).isNull(), "_number": nan, "_down": down}
    if hot_keys(df, [order], hot_rows, small_bytes) is None:
        ranked = sequence_windows(
            df.withColumns(downwards), [], list(downwards), rank=name, small_bytes=small_bytes, **split
        )
        return ranked.drop(*downwards)
    peers = durable(df.groupBy(order).agg(F.count(F.lit(1)).alias("_peers")).withColumns(downwards), "peers")
    ranks = sequence_windows(
        peers, [], list(downwards), running={"_upto": "_peers"}, small_bytes=0, **split
    ).select(order, (F.col("_upto") - F.col("_peers") + 1).cast("long").alias(name))
    return join_values(df, ranks, [order], hot_rows)


def join_values(
    df: DataFrame, values: DataFrame, on: list[str], hot_rows: int | None, same_keys: DataFrame | None = None
) -> DataFrame:
    """Give each row the one row of ``values`` with its key, which may be NULL
    and may be hot.  Rows without a match are left out.

    ``same_keys`` is a frame with the keys of ``df`` that is cheaper to read;
    hot keys are looked for in it.
    """
    cols = [c for c in values.columns if c not in on]
    key = F.xxhash64(*on).alias("_key_hash")
    hot = hot_keys((df if same_keys is None else same_keys).select(key), ["_key_hash"], hot_rows, 0)
    right = values.select(F.struct(*on).alias("_key_of"), *cols, key)
    joined = salted_join(df.select("*", key), right, ["_key_hash"], "inner", hot)
    # The hash only routes rows; equality of the real values decides.
    return joined.filter(F.struct(*on).eqNullSafe(F.col("_key_of"))).select(*df.columns, *cols)


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str) -> DataFrame:
    """First ``n`` rows per key.  The optimizer limits each group before the
    shuffle, so a hot key sends at most ``n`` rows per input task.  It does so
    for ``n`` up to 1000; for more, number the rows with ``sequence_windows``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in ``order``; copies of a key are cut to one per
    input task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
