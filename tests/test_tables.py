"""Tables by name: replaced in place, kept on failure, inserts by name and value."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sedimenta.sources import tables


@pytest.fixture(scope="module")
def db(spark):
    return tables.database(spark)


def rows(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


def test_overwrite_reads_its_own_table(spark, db):
    name = f"{db}.numbers"
    tables.overwrite(spark.range(5).toDF("n"), name)
    tables.overwrite(spark.table(name).withColumn("double", F.col("n") * 2), name)
    assert rows(spark, name) == [(i, 2 * i) for i in range(5)]


def test_failed_replacement_keeps_the_table(spark, db):
    name = f"{db}.kept"
    tables.overwrite(spark.range(3).toDF("n"), name)
    with pytest.raises(Exception):
        tables.replace_as(spark, name, f"SELECT n, raise_error('stop') AS x FROM {name}")
    with pytest.raises(Exception):
        tables.overwrite(spark.table(name).withColumn("x", F.raise_error(F.lit("stop"))), name)
    assert rows(spark, name) == [(0,), (1,), (2,)]


def test_create_as_refuses_an_existing_table(spark, db):
    name = f"{db}.once"
    tables.create_as(spark, name, "SELECT 1 AS a")
    with pytest.raises(Exception):
        tables.create_as(spark, name, "SELECT 2 AS a")
    assert rows(spark, tables.replace_as(spark, name, f"SELECT a + 1 AS a, 'x' AS b FROM {name}") and name) == [(2, "x")]


def test_append_by_name(spark, db):
    name = f"{db}.appended"
    tables.append(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    tables.append(spark.createDataFrame([("b", 2)], "v string, k int"), name)
    assert rows(spark, name) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        tables.append(spark.createDataFrame([(3,)], "k int"), name)


def test_insert_values_are_bound(spark, db):
    name = f"{db}.log"
    tables.create(spark, name, "id INT, note STRING, day DATE")
    tables.insert_rows(spark, name, [{"id": 1, "note": "it's '); DROP TABLE x; --", "day": dt.date(2024, 1, 2)}, {"id": 2, "note": "", "day": None}])
    tables.insert_rows(spark, name, [])
    tables.insert_select(spark, name, "SELECT 'by name' AS note, 3 AS id, CAST(NULL AS DATE) AS day")
    assert sorted(rows(spark, name), key=lambda r: r[0]) == [
        (1, "it's '); DROP TABLE x; --", dt.date(2024, 1, 2)), (2, "", None), (3, "by name", None)]
    with pytest.raises(ValueError):
        tables.insert_rows(spark, name, [{"id": 1}, {"note": "x"}])


def test_partitions_are_replaced_alone(spark, db):
    name = f"{db}.parts"
    df = spark.range(30).select("id", (F.col("id") % 3).cast("int").alias("p"))
    tables.overwrite(df, name, ["p"])
    tables.overwrite_partitions(df.filter("p = 1 and id < 5").select("p", "id"), name)
    assert rows(spark, name) == sorted([(i, i % 3) for i in range(30) if i % 3 != 1] + [(1, 1), (4, 1)])
    plan = spark.table(name).filter("p = 2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
