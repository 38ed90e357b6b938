"""Tables by name in the session's catalog.

Plain Spark SQL: ``CREATE TABLE … AS SELECT``, ``INSERT INTO … SELECT`` and
``VALUES``, ``saveAsTable`` and ``insertInto``.  A table is replaced by writing
the new one under another name first and renaming it, so the query may read
the table it replaces, and a job that fails leaves the old one as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sedimenta.scale import work_path

# Which partitions an overwriting insert replaces.
MODE = "spark.sql.sources.partitionOverwriteMode"


def quoted(name: str) -> str:
    """A name of one or more parts, each in back quotes."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def database(spark: SparkSession, name: str | None = None, location: str | None = None) -> str:
    """A database whose tables lie in the shared folder; a new name where none is given."""
    name = name or f"sedimenta_{uuid.uuid4().hex}"
    place = location or work_path(spark, name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)} LOCATION :place", args={"place": place})
    return name


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(quoted(table))


def _swap(spark: SparkSession, new: str, table: str, partitioned: bool) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
    spark.sql(f"ALTER TABLE {quoted(new)} RENAME TO {quoted(table)}")
    if partitioned:  # a catalog may still have the partitions at the old place
        spark.sql(f"MSCK REPAIR TABLE {quoted(table)} SYNC PARTITIONS")


def _beside(table: str) -> str:
    return f"{table}__{uuid.uuid4().hex}"


def overwrite(df: DataFrame, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """``saveAsTable`` in place of what is there, with the schema of ``df``."""
    spark, new = df.sparkSession, _beside(table)
    df.write.mode("errorifexists").partitionBy(*(partition_by or [])).saveAsTable(quoted(new))
    _swap(spark, new, table, bool(partition_by))
    return spark.table(quoted(table))


def append(df: DataFrame, table: str) -> DataFrame:
    """``saveAsTable`` in append mode: columns are matched by name, the table is
    made where there is none."""
    spark = df.sparkSession
    if exists(spark, table):
        have, given = spark.table(quoted(table)).columns, df.columns
        if sorted(map(str.lower, have)) != sorted(map(str.lower, given)):
            raise ValueError(f"{table} has the columns {have}, the rows have {given}")
        df.select(*have).write.insertInto(quoted(table))
    else:
        df.write.saveAsTable(quoted(table))
    return spark.table(quoted(table))


def create_as(spark: SparkSession, table: str, select: str, partition_by: list[str] | None = None) -> DataFrame:
    """``CREATE TABLE … AS SELECT``; fails where the table exists."""
    parts = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE {quoted(table)} USING parquet{parts} AS {select}")
    return spark.table(quoted(table))


def replace_as(spark: SparkSession, table: str, select: str, partition_by: list[str] | None = None) -> DataFrame:
    """Create or replace by a query, which may read the table itself."""
    new = _beside(table)
    create_as(spark, new, select, partition_by)
    _swap(spark, new, table, bool(partition_by))
    return spark.table(quoted(table))


def create(spark: SparkSession, table: str, columns: str, partition_by: list[str] | None = None) -> DataFrame:
    """An empty table of the given column definitions."""
    parts = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE {quoted(table)} ({columns}) USING parquet{parts}")
    return spark.table(quoted(table))


def insert_select(spark: SparkSession, table: str, select: str) -> None:
    """``INSERT INTO … SELECT``; columns are matched by name, missing ones are NULL."""
    spark.sql(f"INSERT INTO {quoted(table)} BY NAME {select}")


def insert_rows(spark: SparkSession, table: str, rows: list[dict]) -> None:
    """``INSERT INTO … VALUES`` for a few rows; values are bound, never pasted
    into the statement, and are cast to the types of the table."""
    if not rows:
        return
    names = list(rows[0])
    if any(list(r) != names for r in rows):
        raise ValueError("all rows need the same columns")
    kinds = {f.name.lower(): f.dataType.simpleString() for f in spark.table(quoted(table)).schema}
    marks = ", ".join("(" + ", ".join(f"CAST(:r{i}c{k} AS {kinds[n.lower()]})" for k, n in enumerate(names)) + ")" for i in range(len(rows)))
    values = {f"r{i}c{k}": v for i, r in enumerate(rows) for k, v in enumerate(r.values())}
    spark.sql(f"INSERT INTO {quoted(table)} ({', '.join(map(quoted, names))}) VALUES {marks}", args=values)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that ``df`` has rows of; all others stay."""
    spark = df.sparkSession
    columns = spark.table(quoted(table)).columns
    before = spark.conf.get(MODE)
    spark.conf.set(MODE, "dynamic")
    try:
        df.select(*columns).write.insertInto(quoted(table), overwrite=True)
    finally:
        spark.conf.set(MODE, before)
