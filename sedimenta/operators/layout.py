"""File layout: compaction and multi-column clustering."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators.ranges import with_range_number
from sedimenta.scale import row_salt

TARGET_BYTES = 256 * 1024 * 1024
# 256 ranges per column: eight bits of each go into the curve.
BITS = 8


def file_stats(df: DataFrame) -> DataFrame:
    """Rows and bytes per data file of a file-based frame; reads no columns."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("row_count"))


def file_count(df: DataFrame) -> DataFrame:
    return file_stats(df).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("row_count").alias("row_count")
    )


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def packing(target_bytes: int) -> dict[str, str]:
    """Settings under which a scan puts whole files together up to ``target_bytes``."""
    return {
        "spark.sql.files.maxPartitionBytes": str(target_bytes), "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
        # Folder names stay as they are: 01 is no number.
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }


def packed_bins(sizes: list[int], target_bytes: int) -> int:
    """Tasks that a scan packs files of these sizes into: large ones first, the next one when full."""
    bins, filled = 0, None
    for size in sorted(sizes, reverse=True):
        if filled is None or filled + size > target_bytes:
            bins, filled = bins + 1, 0
        filled += size
    return bins


def bytes_per_file(sizes: list[int], files: int) -> int:
    """The smallest target size that packs the files into at most ``files``."""
    low, high = max([1, *sizes, -(-sum(sizes) // files)]), max(1, sum(sizes))
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if packed_bins(sizes, middle) <= files else (middle + 1, high)
    return low


def folder_scans(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """Rows of some partition folders; each folder is a scan of its own, so that
    no task reads two of them."""
    scans = [spark.read.option("basePath", path).parquet(f"{path}/{f}" if f else path) for f in folders]
    return reduce(DataFrame.union, scans)


def compact(
    spark: SparkSession, path: str, new_path: str, target_files: int | None = None, target_bytes: int = TARGET_BYTES,
    folders_per_job: int = 100,
) -> DataFrame:
    """Rewrite a table into files of about ``target_bytes`` per partition folder.

    Small files of a folder are packed by size when they are read, and a task
    writes what it read: nothing is shuffled, and the folders stay.  Larger
    files are cut at their row groups.  With ``target_files`` the size is chosen so that a
    folder gets that many files at most.  Returns the file counts before and
    after as one row.
    """
    # One row per file, as the listing of the table has.
    files = file_stats(spark.read.parquet(path)).select("file", "bytes", "row_count").collect()
    root = path.rstrip("/").removeprefix("file:").lstrip("/")
    folders: dict[str, list[int]] = {}
    for r in files:
        inside = r["file"].removeprefix("file:").lstrip("/").removeprefix(root).lstrip("/")
        folders.setdefault(inside.rpartition("/")[0], []).append(r["bytes"])
    parts = [p.partition("=")[0] for p in next(iter(folders), "").split("/") if "=" in p]
    names = sorted(folders)
    for at in range(0, len(names), folders_per_job):
        some = names[at:at + folders_per_job]
        size = max(bytes_per_file(folders[f], target_files) for f in some) if target_files else target_bytes
        with settings(spark, packing(size)):
            folder_scans(spark, path, [unquote(f) for f in some]).write.mode("append").partitionBy(*parts).parquet(new_path)
    after = file_count(spark.read.parquet(new_path))
    return after.select(
        F.lit(len(files)).cast("bigint").alias("files_before"), F.col("files").alias("files_after"),
        F.lit(sum(r["row_count"] for r in files)).cast("bigint").alias("rows_before"), F.col("row_count").alias("rows_after"),
    )


ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Rank error of a cut: one in so many rows.
ACCURACY = 10_000


def range_cuts(df: DataFrame, columns: list[str], ranges: int) -> list[list]:
    """Per column at most ``ranges - 1`` values that cut its rows evenly.

    Numbers and times: quantile sketches of all columns in one pass, which
    merge across tasks.  Other types have no such sketch: a hash picks about four
    times as many distinct values as are needed, and every fourth is a cut.
    """
    at = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    usable = [isinstance(df.schema[c].dataType, ORDERED) for c in columns]
    found = df.agg(*[
        F.array_distinct(F.percentile_approx(c, at, ACCURACY)).alias(f"c{i}") if ok else F.approx_count_distinct(c).alias(f"c{i}")
        for i, (c, ok) in enumerate(zip(columns, usable))]).first()
    out = []
    for c, ok, value in zip(columns, usable, found):
        if ok:
            out.append(list(value or []))
            continue
        one_in = max(1, value // (4 * ranges))
        values = df.select(c).filter(F.col(c).isNotNull())
        picked = sorted(r[0] for r in values.filter(F.pmod(F.xxhash64(c), F.lit(one_in)) == 0).distinct().collect())
        step = max(1, -(-len(picked) // ranges))
        out.append(picked[step::step][: ranges - 1])
    return out


def interleave(numbers: list[Column], bits: int) -> Column:
    """Bits of the numbers in turn, highest first: the Morton code."""
    parts = []
    for bit in range(bits):
        for i, n in enumerate(numbers):
            one = F.shiftright(n.cast("bigint"), bit).bitwiseAND(F.lit(1))
            parts.append(F.shiftleft(one, bit * len(numbers) + i))
    return reduce(lambda a, b: a + b, parts)


def zorder(df: DataFrame, columns: list[str], files: int, bits: int = BITS) -> DataFrame:
    """Rows clustered on several columns at once, in ``files`` partitions.

    Writing the result gives files with narrow ranges in each of the columns,
    which lets filters on any of them skip files.  Many rows with one code are
    spread over partitions by their salt.
    """
    if bits * len(columns) > 63:
        raise ValueError(f"{len(columns)} columns of {bits} bits exceed the 63 bits of a code")
    coded = df.withColumn("_spread", row_salt(df))
    for i, (c, values) in enumerate(zip(columns, range_cuts(df, columns, 1 << bits))):
        kind = df.schema[c].dataType
        cuts = F.array(*[F.lit(v).cast(kind) for v in values]).cast(T.ArrayType(kind))
        coded = with_range_number(coded, f"_n{i}", cuts, F.col(c), bits)
    numbers = [F.col(f"_n{i}") for i in range(len(columns))]
    return (
        coded.withColumn("_z", interleave(numbers, bits))
        .repartitionByRange(files, "_z", "_spread")
        .sortWithinPartitions("_z", *columns)
        .select(*df.columns)
    )


def matching_files(df: DataFrame, condition: Column) -> DataFrame:
    """Files with a matching row: those a perfect skip would still read."""
    return df.filter(condition).agg(F.count_distinct(F.col("_metadata.file_path")).alias("files"))
