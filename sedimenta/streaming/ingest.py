"""Streaming ingestion, upserts and expectations.

Every stream reads files as they arrive and runs until the files present at
its start are done (``availableNow``); a scheduler starts it again.  Progress
is in the checkpoint folder, so a run continues where the last one ended.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.cleaning import split_valid
from sedimenta.operators import merge as mg
from sedimenta.operators import quality as q
from sedimenta.operators.windows import latest_per_key
from sedimenta.scale import durable, work_path


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files_per_batch: int = 1000
) -> DataFrame:
    """Stream of a folder with a fixed schema; each row knows its file."""
    return (
        spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(path)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )


def to_bronze(stream: DataFrame, path: str, checkpoint: str, run_ts: str) -> None:
    """Append the stream with its ingestion time.  The file sink commits a
    batch as a whole, so a repeated batch adds nothing."""
    query = (
        stream.withColumn("ingestion_time", F.lit(run_ts).cast("timestamp_ntz"))
        .writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def upsert(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], ts: str, order: list[Column], buckets: int,
    rejects_path: str | None = None, delete_when: Column | None = None,
) -> None:
    """Merge each batch into a table written by ``write_bucketed``.

    The newest row per key of the batch wins if it is newer than the table's.
    A batch that runs twice changes nothing the second time.  Rows with a NULL
    key go to ``rejects_path``, in a folder per batch; without it they are an
    error.  ``delete_when`` names source rows that delete their key.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        # One run of the batch: rows without a key are counted while the slice is written.
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        seen = Observation()
        keyed, _ = split_valid(batch.observe(seen, F.count_if(missing).alias("unkeyed")), keys)
        newest = durable(latest_per_key(keyed, keys, order), "batch")
        if seen.get["unkeyed"]:
            if rejects_path is None:
                raise ValueError("rows without a key and no rejects_path")
            split_valid(batch, keys)[1].write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
        mg.merge_into(batch.sparkSession, path, newest, keys, buckets, mg.newer(ts), delete_when)

    query = (
        stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def with_expectations(
    stream: DataFrame, path: str, metrics_path: str, checkpoint: str, expects: list[q.Expect]
) -> None:
    """Write the rows that pass, and per batch the counts of every expectation.

    The counts are observed while the rows are written, so a batch is run once.
    A batch has its own folder, which a repeated batch replaces.  A row that
    breaks a ``fail`` expectation stops the stream: the counts of that batch are
    written, its rows are not.
    """
    stops = any(e.action == "fail" for e in expects)

    def check_batch(batch: DataFrame, batch_id: int) -> None:
        spark, out = batch.sparkSession, f"{path}/batch={batch_id}"
        rows, seen = q.observed_expectations(batch, expects)
        # Rows of a batch that may yet fail wait where no reader looks.
        pending = work_path(spark, "pending") if stops else out
        rows.write.mode("overwrite").parquet(pending)
        q.observed_metrics(spark, seen, expects).write.mode("overwrite").parquet(f"{metrics_path}/batch={batch_id}")
        broken = [e.name for i, e in enumerate(expects) if e.action == "fail" and seen.get[f"p{i}"] < seen.get["n"]]
        if broken:
            raise q.ExpectationError(f"expectation failed: {', '.join(broken)}")
        if stops:
            spark.read.schema(rows.schema).parquet(pending).write.mode("overwrite").parquet(out)

    query = (
        stream.writeStream.foreachBatch(check_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
