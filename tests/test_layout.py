"""Compaction without a shuffle, cuts by rows."""

import random

from pyspark.sql import functions as F

from sedimenta.operators import layout
from sedimenta.scale import work_path


def listing(spark, path):
    rows = layout.file_stats(spark.read.parquet(path)).collect()
    out = {}
    for r in rows:
        out.setdefault(r["file"].rpartition("/")[0].rpartition(path)[2], []).append(r["bytes"])
    return out


def test_partition_folders_are_packed(spark):
    """Folder names stay, also 01, a NULL and a name with a space; each gets few files of the wanted size."""
    path, new = work_path(spark, "small"), work_path(spark, "new")
    month = F.element_at(F.array(F.lit("01"), F.lit("02"), F.lit("a b"), F.lit(None)), (F.col("id") % 4 + 1).cast("int"))
    df = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), month.alias("m"))
    df.filter("m <> '02' or m is null or id % 8 = 1").repartition(8).write.partitionBy("m").parquet(path)
    before = listing(spark, path)
    target = 3 * max(x for v in before.values() for x in v) + 10
    row = layout.compact(spark, path, new, target_bytes=target, folders_per_job=3).first()
    after = listing(spark, new)
    assert after.keys() == before.keys() and "/m=01" in after
    assert all(len(after[f]) <= layout.packed_bins(before[f], target) for f in after) and len(after["/m=01"]) < 8
    assert tuple(row) == (sum(map(len, before.values())), sum(map(len, after.values())), 3500, 3500)
    with layout.settings(spark, layout.packing(10**9)):
        old, now = (spark.read.parquet(p).select("id", "v", "m") for p in (path, new))
        assert old.exceptAll(now).isEmpty() and now.exceptAll(old).isEmpty()


def test_compaction_shuffles_nothing(spark):
    path = work_path(spark, "small")
    spark.range(100).withColumn("p", F.col("id") % 3).repartition(4).write.partitionBy("p").parquet(path)
    with layout.settings(spark, layout.packing(10**6)):
        scan = layout.folder_scans(spark, path, ["p=0", "p=1"])
        assert "Exchange" not in scan._jdf.queryExecution().executedPlan().toString() and scan.rdd.getNumPartitions() == 2


def test_target_files():
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randrange(1, 1000) for _ in range(rng.randrange(1, 40))]
        files = rng.randrange(1, 12)
        t = layout.bytes_per_file(sizes, files)
        assert layout.packed_bins(sizes, t) <= files


def test_cuts_follow_rows(spark):
    """Half of the rows hold one value: the cuts split the rows, not the distinct values; one pass for all columns."""
    df = spark.range(10_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("a"), (F.col("id") * 1.5).alias("b"),
        F.timestamp_micros(F.col("id") * 10**6).alias("t"), F.col("id").cast("string").alias("s"))
    a, b, t, s = layout.range_cuts(df, ["a", "b", "t", "s"], 16)
    assert a[0] == 0 and len(a) == 8 and abs(a[1] - 1250) < 100
    assert len(b) == 15 and abs(b[7] - 7500) < 50 and len(t) == 15 and 3 < len(s) <= 15
    assert layout.range_cuts(df.limit(0), ["a", "s"], 16) == [[], []]
