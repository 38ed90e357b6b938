"""Streaming and file-layout queries."""

from pyspark.sql import functions as F

from sedimenta.operators import layout, merge as mg, quality as q
from sedimenta.registry.base import query
from sedimenta.registry.changes import BUCKETS, COLS, KEY, _newest, load_first
from sedimenta.registry.sqlshapes import DIRTY, ORDERS
from sedimenta.scale import work_path
from sedimenta.sources import shapes
from sedimenta.streaming import ingest

RUN_TS = "2024-02-01 00:00:00"


def arrive(df, fmt, files, spark):
    """The rows as a folder of files, as a source system would leave them."""
    path = work_path(spark, f"landing-{fmt}")
    df.repartition(files).write.format(fmt).save(path)
    return path


@query("stream_bronze", "SELECT event_id, user_id, value, ts, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_time FROM events")
def stream_bronze(spark, sf_dir):
    events = shapes.table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    stream = ingest.read_files(spark, arrive(events, "parquet", 6, spark), events.schema, "parquet", 2)
    out = work_path(spark, "bronze")
    ingest.to_bronze(stream, out, work_path(spark, "progress"), RUN_TS)
    return spark.read.parquet(out).drop("source_file")


@query("stream_orders_json", f"""
SELECT order_id, customer_id, CAST(amount AS DOUBLE) AS amount, order_date, status, TRUE AS has_file, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_time FROM {ORDERS}""")
def stream_orders_json(spark, sf_dir):
    """The stream stops after the first files and continues with later ones."""
    from sedimenta.registry.scans import ORDER_SCHEMA, _orders

    orders = _orders(spark, sf_dir)
    early = F.col("order_date") < F.lit("1998-01-01").cast("date")
    landing, out, progress = (work_path(spark, n) for n in ("landing", "bronze", "progress"))
    for part in (orders.filter(early), orders.filter(~early)):
        part.repartition(4).write.mode("append").json(landing)
        stream = ingest.read_files(spark, landing, ORDER_SCHEMA, "json", 3)
        ingest.to_bronze(stream, out, progress, RUN_TS)
    return spark.read.parquet(out).withColumn("has_file", F.col("source_file").endswith(".json")).drop("source_file")


@query("stream_upsert", f"SELECT {COLS} FROM {_newest('TRUE')}")
def stream_upsert(spark, sf_dir):
    """The change log as a stream, merged batch by batch, in no special order."""
    silver, _ = load_first(spark, sf_dir, "orders")
    log = shapes.change_log(spark, sf_dir)
    stream = ingest.read_files(spark, arrive(log, "parquet", 4, spark), log.schema, "parquet", 2).drop("source_file")
    ingest.upsert(
        stream, silver, work_path(spark, "progress"), KEY, "updated_at", [F.desc("updated_at"), F.desc("seq")], BUCKETS
    )
    return mg.read_bucketed(spark, silver)


EXPECTS = [
    q.Expect("valid_order_id", "order_id IS NOT NULL", "drop"),
    q.Expect("positive_amount", "amount > 0", "drop"),
    q.Expect("known_status", "status IN ('pending', 'completed', 'cancelled')", "warn"),
]


def checked(spark, sf_dir):
    dirty = shapes.dirty_orders(spark, sf_dir)
    stream = ingest.read_files(spark, arrive(dirty, "json", 4, spark), dirty.schema, "json", 2).drop("source_file")
    out, metrics = work_path(spark, "silver"), work_path(spark, "metrics")
    ingest.with_expectations(stream, out, metrics, work_path(spark, "progress"), EXPECTS)
    return spark.read.parquet(out).drop("batch"), spark.read.parquet(metrics)


@query("stream_expectations", f"SELECT * FROM {DIRTY} WHERE order_id IS NOT NULL AND amount > 0")
def stream_expectations(spark, sf_dir):
    return checked(spark, sf_dir)[0].select("order_id", "customer_id", "amount", "order_date", "status", "email")


@query("stream_expectation_metrics", "\nUNION ALL\n".join(
    f"SELECT '{e.name}' AS expectation, '{e.action}' AS action, COUNT(*) FILTER ({e.condition}) AS passed_records, "
    f"COUNT(*) - COUNT(*) FILTER ({e.condition}) AS failed_records FROM {DIRTY}" for e in EXPECTS))
def stream_expectation_metrics(spark, sf_dir):
    return checked(spark, sf_dir)[1].groupBy("expectation", "action").agg(
        F.sum("passed_records").alias("passed_records"), F.sum("failed_records").alias("failed_records")
    )


@query("compact", "SELECT 24::BIGINT AS files_before, 4::BIGINT AS files_after, COUNT(*) AS rows_before, COUNT(*) AS rows_after FROM events")
def compact(spark, sf_dir):
    small = work_path(spark, "small-files")
    shapes.table(spark, sf_dir, "events").repartition(24).write.parquet(small)
    out = layout.compact(spark, small, work_path(spark, "compact"), target_files=4)
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in out.columns])


@query("compact_partitions", f"""
SELECT year(order_date)::INT AS year, 5::BIGINT AS files_before, 1::BIGINT AS files_after, COUNT(*) AS order_count FROM {ORDERS} GROUP BY 1""")
def compact_partitions(spark, sf_dir):
    """Five files in every folder of a year become one each; the folders stay."""
    small, new = work_path(spark, "small-files"), work_path(spark, "compact")
    orders = shapes.orders(spark, sf_dir).withColumn("year", F.year("order_date"))
    orders.repartition(5).write.partitionBy("year").parquet(small)
    layout.compact(spark, small, new)
    files = lambda path, name: spark.read.parquet(path).groupBy("year").agg(
        F.count_distinct(F.col("_metadata.file_path")).alias(name), F.count(F.lit(1)).alias(f"rows_{name}"))
    return files(small, "files_before").join(files(new, "files_after"), "year").select(
        "year", "files_before", "files_after", F.col("rows_files_after").alias("order_count"))


def clustered(spark, sf_dir):
    path = work_path(spark, "zorder")
    lines = shapes.table(spark, sf_dir, "lineitem")
    layout.zorder(lines, ["l_shipdate", "l_partkey"], 16).write.parquet(path)
    return spark.read.parquet(path)


@query("zorder_layout", """
SELECT COUNT(*) AS line_count, SUM(CAST(l_quantity AS BIGINT))::BIGINT AS units, COUNT(*) FILTER (l_shipdate < TIMESTAMP '1996-01-01' AND l_partkey < 100) AS chosen FROM lineitem""")
def zorder_layout(spark, sf_dir):
    """The clustered copy holds the same rows."""
    cond = (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("l_partkey") < 100)
    return clustered(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(F.col("l_quantity").cast("bigint")).alias("units"),
        F.count_if(cond).alias("chosen"),
    )


@query("zorder_file_ranges", """
SELECT COUNT(*) AS line_count, min(l_shipdate) AS first_date, max(l_shipdate) AS last_date, min(l_partkey) AS first_part, max(l_partkey) AS last_part,
  16::BIGINT AS files, TRUE AS narrow_dates, TRUE AS narrow_parts FROM lineitem""")
def zorder_file_ranges(spark, sf_dir):
    """The files together span both columns; a value of either lies in the
    ranges of half of the files at most, on average over the files' own values."""
    per_file = clustered(spark, sf_dir).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"), F.min("l_partkey").alias("c"), F.max("l_partkey").alias("d"),
        F.count(F.lit(1)).alias("n"))
    day = lambda x: F.unix_micros(F.col(x).cast("timestamp"))
    one = per_file.agg(
        F.sum("n").alias("line_count"), F.min("a").alias("first_date"), F.max("b").alias("last_date"), F.min("c").alias("first_part"),
        F.max("d").alias("last_part"), F.count(F.lit(1)).alias("files"), F.avg(day("b") - day("a")).alias("dates"), F.avg(F.col("d") - F.col("c")).alias("parts"))
    return one.select(
        "line_count", "first_date", "last_date", "first_part", "last_part", "files",
        (F.col("dates") <= (day("last_date") - day("first_date")) / 2).alias("narrow_dates"),
        (F.col("parts") <= (F.col("last_part") - F.col("first_part")) / 2).alias("narrow_parts"))
