"""MERGE, slowly changing dimensions and change detection on DataFrames."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators.windows import latest_per_key, sequence_windows

ACTION = "_action"


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their row count."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter((F.col("row_count") > 1) | has_null)
    )


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Raise when ``keys`` is no key of ``df``; otherwise return ``df``."""
    bad = key_violations(df, keys).take(5)
    if bad:
        raise ValueError(f"{keys} is not a unique, non-null key: {bad}")
    return df


def newer(column: str) -> Column:
    """Update rule: the source row is strictly newer."""
    return F.col(f"s.{column}") > F.col(f"t.{column}")


def higher_version(column: str) -> Column:
    """Update rule: the source row has the higher version."""
    return F.col(f"s.{column}") > F.col(f"t.{column}")


def newer_then_priority(ts: str, priority: str) -> Column:
    """Update rule: newer, or equally new with the higher priority."""
    return newer(ts) | (
        (F.col(f"s.{ts}") == F.col(f"t.{ts}")) & (F.col(f"s.{priority}") > F.col(f"t.{priority}"))
    )


def merge_actions(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_when: Column | None = None,
    delete_when: Column | None = None,
    update_cols: list[str] | None = None,
) -> DataFrame:
    """Outcome of a MERGE per row with ``_action``: insert, update, delete, keep.

    Conditions see the target as ``t`` and the source as ``s``; a NULL
    condition counts as false.  ``source`` must be unique on ``keys`` (see
    ``latest_per_key``), so neither side of the join has a hot key.  Rows that
    are deleted stay in the result with their action.
    """
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    both = F.col("_in_t") & F.col("_in_s")
    truth = lambda c: F.coalesce(c, F.lit(False))
    deleted = both & truth(delete_when) if delete_when is not None else F.lit(False)
    updated = both & (truth(update_when) if update_when is not None else F.lit(True))
    # A source row without a target is inserted unless it says delete.
    dropped = F.col("_in_t").isNull() & truth(delete_when) if delete_when is not None else F.lit(False)
    action = (
        F.when(truth(deleted), "delete")
        .when(truth(dropped), "ignore")
        .when(F.col("_in_t").isNull(), "insert")
        .when(truth(updated), "update")
        .otherwise("keep")
    )
    joined = t.join(s, cond, "full_outer").withColumn(ACTION, action)
    update_cols = [c for c in source.columns if c not in keys] if update_cols is None else update_cols
    out = []
    for c in target.columns:
        if c not in source.columns:
            out.append(F.col(f"t.{c}").alias(c))
            continue
        take = F.col(ACTION) == "insert"
        if c in keys:
            take = take | F.col("_in_t").isNull()
        elif c in update_cols:
            take = F.col(ACTION).isin("insert", "update")
        out.append(F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    # Columns only the source has are added (additive schema evolution).
    for c in source.columns:
        if c not in target.columns:
            out.append(F.when(F.col(ACTION).isin("insert", "update"), F.col(f"s.{c}")).alias(c))
    return joined.select(*out, F.col(ACTION)).filter(F.col(ACTION) != "ignore")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_when: Column | None = None,
    delete_when: Column | None = None,
    update_cols: list[str] | None = None,
) -> DataFrame:
    """State of ``target`` after the MERGE (see ``merge_actions``)."""
    out = merge_actions(target, source, keys, update_when, delete_when, update_cols)
    return out.filter(F.col(ACTION) != "delete").drop(ACTION)


BUCKET = "_bucket"


def key_bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _state(spark: SparkSession, path: str) -> dict | None:
    """Current version of a bucketed table: bucket count, keys, schema and the
    version each filled bucket was last written in.  At most one row per bucket
    is collected."""
    try:
        rows = spark.read.parquet(f"{path}/_state")
    except AnalysisException:
        return None
    whole = rows.filter("whole").agg(F.max("version")).first()[0]
    now = rows.filter(F.col("version") >= whole)
    last = now.orderBy(F.desc("version")).first()
    filled = now.groupBy("bucket").agg(F.max_by("filled", "version").alias("filled"), F.max("version").alias("version"))
    folders = {r["bucket"]: r["version"] for r in filled.filter("filled").collect()}
    return {"version": last["version"], "buckets": last["buckets"], "schema": T.StructType.fromJson(json.loads(last["schema"])),
            "folders": folders}


def _commit(df: DataFrame, path: str, buckets: int, version: int, touched: list[int], whole: bool) -> None:
    """Write the buckets to a folder of their own, then the state rows that
    make them current.  Before the state is there, readers see the old version."""
    spark, folder = df.sparkSession, f"{path}/data/version={version}"
    df.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
    schema = df.drop(BUCKET).schema
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    filled = {r[0] for r in spark.read.schema(full).parquet(folder).select(BUCKET).distinct().collect()}
    rows = [(version, b, b in filled, buckets, schema.json(), whole) for b in touched]
    spark.createDataFrame(
        rows, "version bigint, bucket int, filled boolean, buckets int, schema string, whole boolean"
    ).coalesce(1).write.mode("append").parquet(f"{path}/_state")


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> str:
    """Write a table that ``merge_into`` can update: one directory per hash
    bucket of the key.  The number of buckets is kept with the table."""
    state = _state(df.sparkSession, path)
    version = 0 if state is None else state["version"] + 1
    _commit(df.withColumn(BUCKET, key_bucket(keys, buckets)), path, buckets, version, list(range(buckets)), True)
    return path


def _read(spark: SparkSession, path: str, state: dict, only: list[int] | None = None) -> DataFrame:
    folders = [f"{path}/data/version={v}/{BUCKET}={b}" for b, v in sorted(state["folders"].items())
               if only is None or b in only]
    if not folders:
        return spark.createDataFrame([], state["schema"]).withColumn(BUCKET, F.lit(0))
    schema = T.StructType([*state["schema"].fields, T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The current version, with the columns of all merges so far."""
    state = _state(spark, path)
    if state is None:
        raise ValueError(f"no bucketed table at {path}")
    return _read(spark, path, state).drop(BUCKET)


def check_source(source: DataFrame, keys: list[str]) -> None:
    """Raise when a key is NULL or occurs twice: a MERGE would insert a NULL
    key again each time, and has no rule which of two rows wins."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bad = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | missing)
    if not bad.isEmpty():
        raise ValueError("the source of a merge has NULL or repeated keys")


@dataclass(frozen=True)
class MergeResult:
    """Buckets rewritten, and what became of the rows."""

    buckets: int = 0
    inserted: int = 0
    updated: int = 0
    deleted: int = 0


def action_counts() -> list[Column]:
    """Inserts, updates and deletes of ``merge_actions`` as aggregates."""
    return [F.count_if(F.col(ACTION) == a).alias(f"{a}d" if a.endswith("e") else f"{a}ed") for a in ("insert", "update", "delete")]


def merge_into(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], buckets: int, update_when: Column,
    delete_when: Column | None = None,
) -> int:
    """``merge_counted``, returning the number of rewritten buckets."""
    return merge_counted(spark, path, source, keys, buckets, update_when, delete_when).buckets


def merge_counted(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], buckets: int, update_when: Column,
    delete_when: Column | None = None,
) -> MergeResult:
    """MERGE ``source`` into a bucketed table; only buckets with a changed key
    are read and rewritten.  Inserts, updates and deletes are counted while the
    rows are written, not by a second run of the join.

    Rewritten buckets go to a new folder and become current with the state
    rows that are written last.  An interrupted call changes nothing, and the
    repeated one overwrites what it left.  Columns of the source take the
    table's types (a value that does not fit is an error), new columns are
    added.  Folders of older versions may be deleted when no reader needs them.
    """
    state = _state(spark, path)
    if state is None:
        raise ValueError(f"no bucketed table at {path}")
    if state["buckets"] != buckets:
        raise ValueError(f"the table has {state['buckets']} buckets, not {buckets}")
    kinds = {f.name: f.dataType for f in state["schema"].fields}
    changes = source.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in source.columns])
    check_source(changes, keys)
    changes = changes.withColumn(BUCKET, key_bucket(keys, buckets))
    touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]  # at most ``buckets``
    if not touched:
        return MergeResult()
    seen = Observation("merge")
    actions = merge_actions(_read(spark, path, state, touched), changes, [*keys, BUCKET], update_when, delete_when)
    merged = actions.observe(seen, *action_counts()).filter(F.col(ACTION) != "delete").drop(ACTION)
    _commit(merged, path, buckets, state["version"] + 1, touched, False)
    return MergeResult(len(touched), seen.get["inserted"], seen.get["updated"], seen.get["deleted"])


def merge_counts(read: DataFrame, deduplicated_actions: DataFrame) -> DataFrame:
    """Run metrics: rows read, left after dedup, inserted, updated, deleted, total.

    ``deduplicated_actions`` is the result of ``merge_actions``.
    """
    total = read.agg(F.count(F.lit(1)).alias("n")).select(F.lit("records_read").alias("metric"), "n")
    acts = deduplicated_actions.agg(
        F.count_if(F.col(ACTION) == "insert").alias("records_inserted"),
        F.count_if(F.col(ACTION) == "update").alias("records_updated"),
        F.count_if(F.col(ACTION) == "delete").alias("records_deleted"),
        F.count_if(F.col(ACTION) != "delete").alias("records_total"),
    )
    names = ["records_inserted", "records_updated", "records_deleted", "records_total"]
    return total.union(acts.unpivot([], names, "metric", "n"))


def scd2(changes: DataFrame, keys: list[str], effective: str, order: list[str]) -> DataFrame:
    """Type 2 history: ``valid_from, valid_to, is_current`` per version.

    ``order`` is the full sort order of the versions of a key (``effective``
    first, then a unique tie-break).
    """
    out = sequence_windows(changes, keys, order, lead={"valid_to": effective})
    return out.withColumn("valid_from", F.col(effective)).withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def as_of(changes: DataFrame, keys: list[str], ts: str, at: Column, tie: list[str]) -> DataFrame:
    """State of each key at time ``at`` rebuilt from its change log."""
    order = [F.desc(ts), *[F.desc(c) for c in tie]]
    return latest_per_key(changes.filter(F.col(ts) <= at), keys, order)


def change_history(
    changes: DataFrame, keys: list[str], order: list[str], batch: Column, is_delete: Column
) -> DataFrame:
    """Inserts, updates and deletes per batch of a change log."""
    rows = changes.withColumn("_del", is_delete).withColumn("batch", batch)
    rows = sequence_windows(rows, keys, order, lag={"_prev_del": "_del"})
    exists = F.coalesce(~F.col("_prev_del"), F.lit(False))
    return rows.groupBy("batch").agg(
        F.count_if(~F.col("_del") & ~exists).alias("inserts"),
        F.count_if(~F.col("_del") & exists).alias("updates"),
        F.count_if(F.col("_del") & exists).alias("deletes"),
    )


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Change feed between two snapshots: keys and ``change_type``.

    A column that one of them lacks is NULL there."""
    kinds = {f.name: f.dataType for df in (new, old) for f in df.schema.fields if f.name not in keys}

    def values(df: DataFrame) -> Column:
        return F.struct(*[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in kinds.items()])

    o = old.select(*keys, values(old).alias("_old"))
    n = new.select(*keys, values(new).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    return (
        o.join(n, keys, "full_outer")
        .withColumn("change_type", change)
        .filter(F.col("change_type").isNotNull())
        .select(*keys, "change_type")
    )


def multiset_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with both counts.  Empty: equal.

    Copies are counted before the shuffle, so a row with many copies is no
    hot group.
    """
    cols = before.columns
    tagged = before.select(*cols, F.lit(1).alias("_b"), F.lit(0).alias("_a")).union(
        after.select(*cols, F.lit(0).alias("_b"), F.lit(1).alias("_a"))
    )
    return (
        tagged.groupBy(*cols)
        .agg(F.sum("_b").alias("before_count"), F.sum("_a").alias("after_count"))
        .filter(F.col("before_count") != F.col("after_count"))
    )


def checksum(df: DataFrame) -> DataFrame:
    """Order-independent checksum and row count of a table.

    A row's digest is the md5 of its values, each with its length, ``-`` for
    NULL; four 32-bit parts of it are summed over the rows, so copies count and
    any engine can compute it.  Values are taken as text; for floating-point
    columns that text is Spark's.
    """
    fields = []
    for c in df.columns:
        text = F.col(c).cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    rows = df.select(F.md5(F.concat(*fields).cast("binary")).alias("d"))
    part = lambda i: F.sum(F.conv(F.substring("d", 8 * i + 1, 8), 16, 10).cast("decimal(20,0)"))
    # 32 bits a part: sums of up to 2**32 rows fit 20 digits.
    parts = [F.lpad(F.coalesce(part(i), F.lit(0)).cast("string"), 20, "0") for i in range(4)]
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.concat_ws("-", *parts).alias("checksum"))
