"""Size checks, skew handling and the shared work folder.

Every function that could meet a key holding a large share of the rows goes
through this module.  The decisions are made once, while the plan is built:

* ``plan_bytes`` is the optimizer's own size estimate, the number that decides
  automatic broadcasts;
* ``hot_keys`` counts keys in a sample of the rows and returns the few that
  are too large for one task, or ``None``; tables with few rows need no sample;
* ``skew_join`` salts only those keys.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows are looked up in the footers of so many files at most; beyond, the keys are sampled.
MAX_FOOTERS = 10_000
# A key with more rows than this is split over several tasks.
HOT_ROWS = 5_000_000
# A key at the limit is expected this often in the sample that finds it.
SAMPLE_HITS = 1000
# A task of a shuffled join gets about this many rows of the scan, also where the session has few partitions.
TASK_ROWS = 1_000_000
# Only the largest keys are listed: any other key has under 1/32768 of the rows.
MAX_HOT_KEYS = 32_768
# Rows with a NULL key match nothing; they are spread over this many salts.
NULL_SALTS = 65_536


def plan_bytes(df: DataFrame) -> int:
    """Optimizer estimate of the size of ``df``; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only when the estimate is under the session's threshold.

    Beyond it the frame is returned as it is, and the join shuffles.
    """
    if max_bytes is None:
        setting = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
        max_bytes = _parse_bytes(setting)
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df


def _parse_bytes(text: str) -> int:
    units = {"k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}
    text = text.strip().lower().removesuffix("b")
    if text and text[-1] in units:
        return int(float(text[:-1]) * units[text[-1]])
    return int(text)


def hot_keys(
    df: DataFrame,
    keys: list[str],
    hot_rows: int | None = None,
    small_bytes: int | None = None,
) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows as a local frame ``keys + _rows``.

    The keys of a sample of the rows are counted; a key over the limit is
    expected ``SAMPLE_HITS`` times in it, so it is not missed, and the counting
    moves few rows.  The list only steers how work is spread: results do not
    depend on which keys are on it.  It has at most ``MAX_HOT_KEYS`` rows, so
    it can be broadcast.  ``None`` means that no key needs splitting.  Without
    keys the whole table is the one group.

    Rows decide, not bytes: where the files below hold no more than
    ``hot_rows`` rows together, nothing is sampled, nor is any join run.
    ``small_bytes=0`` samples in any case.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    if small_bytes is None:
        rows = rows_in_files(df)
        if rows is not None and rows <= hot_rows:
            return None
    share = min(1.0, SAMPLE_HITS / hot_rows)
    seen = df.select(*keys)
    if share < 1.0:
        seen = seen.sample(share, seed=17)
    counts = (
        seen.groupBy(*keys)
        .agg((F.count(F.lit(1)) / F.lit(share)).cast("bigint").alias("_rows"))
        # Counts of a sample scatter; a little under the limit is over it.
        .filter(F.col("_rows") > (hot_rows if share == 1.0 else int(hot_rows * 0.8)))
        .orderBy(F.desc("_rows"), *keys)
        .limit(MAX_HOT_KEYS)
    )
    rows = counts.collect()
    if not rows:
        return None
    return df.sparkSession.createDataFrame(rows, counts.schema)


_footers: dict[tuple[str, ...], int] = {}


def rows_in_files(df: DataFrame) -> int | None:
    """Rows of all Parquet files a plan reads, from their footers; ``None``
    where it reads anything else or very many files.  Operators here keep or
    drop rows of their inputs, or join a table that is unique on the key, so no
    key can have many more rows than that."""
    files = df._jdf.inputFiles()
    if not 0 < len(files) <= MAX_FOOTERS:
        return None
    files = tuple(sorted(files))
    if not all(f.endswith(".parquet") for f in files):
        return None
    if files not in _footers:
        if len(_footers) > 1000:
            _footers.clear()
        # No column is read: the counts come from the footers.
        _footers[files] = df.sparkSession.read.parquet(*files).count()
    return _footers[files]


def null_safe(left: str, right: str, keys: list[str]) -> Column:
    """Equality of all ``keys`` between two aliases, NULL equal to NULL."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def row_salt(df: DataFrame) -> Column:
    """A number that spreads rows and that a re-run task computes again.

    The partition number spreads identical copies of a row, the hash spreads
    the rows of one partition.
    """
    return F.xxhash64(F.spark_partition_id(), *df.columns)


def spread(df: DataFrame, keys: list[str], scan: DataFrame | None = None) -> DataFrame:
    """Shuffle by ``keys`` into as many tasks as the rows of the files need, where that is more than the session's
    partitions; otherwise ``df`` as it is.  What a task holds then does not grow with the table."""
    rows = rows_in_files(df if scan is None else scan) or 0
    tasks = -(-rows // TASK_ROWS)
    few = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys) if tasks > few else df


def is_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer is expected to broadcast ``df`` in a join."""
    return plan_bytes(df) <= _parse_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    hot_rows: int | None = None,
    small_bytes: int | None = None,
    same_keys: DataFrame | None = None,
    spread_rows: bool = True,
) -> DataFrame:
    """Join a large ``left`` to a ``right`` with few rows per key.

    Rows of a hot key in ``left`` get one of as many salts as the key needs
    tasks, and the matching rows of ``right`` are repeated once per salt; all
    other rows keep salt 0.  No row is lost: each left row meets every right
    row of its key exactly once.

    ``same_keys`` is a frame with at least as many rows of every key that is
    cheaper to read, such as the scan that ``left`` was joined from: hot keys
    are looked for in it, and ``left`` is not run for that.

    ``spread_rows=False`` keeps the partitions that ``left`` has from a join on
    the same keys.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join keeps left rows, {how!r} does not")
    if is_broadcast(right):
        # The optimizer broadcasts it: the left side is not shuffled at all.
        hot = None
    else:
        hot = hot_keys(left if same_keys is None else same_keys, on, hot_rows, small_bytes)
        if hot is None and spread_rows:
            left = spread(left, on, same_keys)
    return salted_join(left, right, on, how, hot)


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, hot: DataFrame | None
) -> DataFrame:
    """``skew_join`` with the hot keys already known (``None``: plain join).

    ``hot`` has the keys and ``_rows``.  A salt stands for ``HOT_ROWS`` rows,
    or for an average hot key where that is smaller, so ``right`` grows by one
    row per ``HOT_ROWS`` hot rows and at most two per hot key.
    """
    if hot is None:
        return left.join(right, on, how)
    sizes = [r["_rows"] for r in hot.select("_rows").collect()]
    rows_per_salt = min(max(1, sum(sizes) // len(sizes)), HOT_ROWS)
    marks = F.broadcast(
        hot.select(*on, F.ceil(F.col("_rows") / F.lit(rows_per_salt)).cast("bigint").alias("_salts"))
    )
    missing = F.lit(False)
    for k in on:
        missing = missing | F.col(k).isNull()
    salts = F.when(missing, F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = (
        left.withColumn("_row_salt", row_salt(left))
        .join(marks, on, "left")
        .withColumn("_salt", F.pmod(F.col("_row_salt"), salts))
        .drop("_salts", "_row_salt")
    )
    salted_right = (
        right.join(marks, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .withColumn("_salt", F.col("_salt").cast("bigint"))
        .drop("_salts")
    )
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach; ``spark.checkpoint.dir`` names it.

    Only where the cluster names none (a local session) a folder is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = known.get() if known.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="sedimenta-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never one that exists."""
    return f"{shared_folder(spark)}/sedimenta/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str = "durable") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short lineage that
    outlives any executor."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
