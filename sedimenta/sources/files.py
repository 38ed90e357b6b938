"""Readers and writers.  Schemas are given, so no reader scans data twice,
except ``read_csv_inferred`` where inference is the feature."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.scale import durable

CORRUPT = "_corrupt_record"


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """CSV with a header; a field that does not parse becomes NULL."""
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).csv(
        path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )


def read_csv_failfast(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; the job fails on the first field that does not parse."""
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST")


def quarantine(spark: SparkSession, path: str, schema: T.StructType, good_path: str, bad_path: str) -> tuple[DataFrame, DataFrame]:
    """Split a CSV into rows that fit the schema and a quarantine table with the
    raw records of the others, their parsed fields and their file.

    The text is parsed once; both tables are written from the parsed copy.
    """
    parsed = read_csv(spark, path, schema, keep_corrupt=True).withColumn("source_file", F.col("_metadata.file_name"))
    parsed = durable(parsed, "parsed")
    good, bad = parsed.filter(F.col(CORRUPT).isNull()), parsed.filter(F.col(CORRUPT).isNotNull())
    good.drop(CORRUPT, "source_file").write.mode("overwrite").parquet(good_path)
    bad.withColumnRenamed(CORRUPT, "record").write.mode("overwrite").parquet(bad_path)
    return read_parquet(spark, good_path), read_parquet(spark, bad_path)


def failfast_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``failed, bad_records, first_record``: whether a fail-fast read of the
    whole CSV stops, and the records it stops at (the smallest one as text).
    A file that is read to its end is read once."""
    try:
        read_csv_failfast(spark, path, schema).write.format("noop").mode("overwrite").save()
    except (PySparkException, Py4JJavaError):
        bad = durable(read_csv(spark, path, schema, keep_corrupt=True), "parsed").filter(F.col(CORRUPT).isNotNull())
        return bad.agg(F.lit(True).alias("failed"), F.count(F.lit(1)).alias("bad_records"), F.min(CORRUPT).alias("first_record"))
    return spark.range(1).select(F.lit(False).alias("failed"), F.lit(0).cast("bigint").alias("bad_records"), F.lit(None).cast("string").alias("first_record"))


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str],
    column: str | None = None, lower: int | None = None, upper: int | None = None, parts: int = 1,
) -> DataFrame:
    """A database table; with ``column`` it is read in ``parts`` parallel ranges."""
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper,
        numPartitions=parts, properties=properties,
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> str:
    """Partitioned files.  The rebalance hint gives each directory few files
    and still splits a directory that holds most of the rows."""
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)
    return path


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """Managed table; returns it read back."""
    df.write.mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)


def append(df: DataFrame, path: str) -> str:
    df.write.mode("append").parquet(path)
    return path


def ingest(df: DataFrame, run_ts: str, source: str) -> DataFrame:
    """Add ingestion time and source.  The time is that of the run, given by
    the caller, so a repeated run writes the same rows."""
    return df.withColumn("ingestion_time", F.lit(run_ts).cast("timestamp_ntz")).withColumn(
        "source", F.lit(source)
    )


def ingest_files(spark: SparkSession, path: str, schema: T.StructType, run_ts: str) -> DataFrame:
    """JSON lines with ingestion time and the file each row came from."""
    return (
        read_json(spark, path, schema)
        .withColumn("ingestion_time", F.lit(run_ts).cast("timestamp_ntz"))
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def format_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count per named frame, in one job."""
    out = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count")
        out = one if out is None else out.union(one)
    return out
