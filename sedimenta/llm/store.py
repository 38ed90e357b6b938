"""Intermediate results in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.scale import shared_folder

# Ids under this number are broadcast: 64 MB at most, whatever the texts.
MAX_BROADCAST_IDS = 2_000_000


# While a step runs: shuffle files of a job are removed when it ends, and texts
# travel to the workers in small batches, which both sides hold in memory.
WHILE_AT_WORK = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


class Store:
    """Tables written once and read again: a lost executor costs no more than
    the step at work.  Nothing in it is ever changed.  The shuffle files of a
    step go when its table is written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_folder(spark)}/sedimenta-llm/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.path}/{self.n}"
        before = {name: self.spark.conf.get(name, None) for name in WHILE_AT_WORK}
        for name, value in WHILE_AT_WORK.items():
            self.spark.conf.set(name, value)
        try:
            df.write.parquet(path)
        finally:
            for name, value in before.items():
                if value is None:
                    self.spark.conf.unset(name)
                else:
                    self.spark.conf.set(name, value)
        return self.spark.read.schema(df.schema).parquet(path)


def column(df: DataFrame, name: str, kind: str):
    """The column of that name with that type; NULL where the table has none."""
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def rows_in(df: DataFrame, ids: DataFrame, key: str = "doc_id", how: str = "left_semi", unique: bool = False) -> DataFrame:
    """Rows of a wide table whose key is in the narrow kept table ``ids``
    (``how="left_anti"``: is not; rows without a key stay).

    The ids are counted first; few are broadcast, so that texts are not
    shuffled, many are joined by a shuffle.  ``unique`` says that ``ids`` holds
    none twice, which saves a shuffle here and in each use of the result.
    """
    ids = ids.select(key) if unique else ids.select(key).distinct()
    few = ids.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, key, how)
