"""Readers, writers, schema checks, stages, streams that fail and restart."""

import inspect

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.cleaning import schema_listing
from sedimenta.operators import quality as q, schema as sc, stages
from sedimenta.operators.merge import assert_unique
from sedimenta.plans.reports import kept
from sedimenta.scale import durable, shared_folder, work_path
from sedimenta.sources import files
from sedimenta.streaming import ingest

ORDERS = T.StructType([
    T.StructField("order_id", T.IntegerType()), T.StructField("product_id", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()), T.StructField("price", T.DoubleType()),
    T.StructField("order_date", T.DateType()),
])
# Orders with one defect each.
BAD_CSV = """order_id,product_id,quantity,price,order_date
2001,201,-1,25.99,2024-02-01
2002,202,2,0,2024-02-01
2003,203,,45.50,2024-02-02
2004,204,1500,15.25,2024-02-02
2005,205,3,-10.50,2024-02-03
2006,206,0,89.99,2024-02-03
2007,207,2,199.99,invalid-date
2008,208,1,75.00,2024-02-04
2009,209,null,125.50,2024-02-05
2010,210,5,0.00,2024-02-05"""


@pytest.fixture
def bad_csv(tmp_path):
    p = tmp_path / "orders.csv"
    p.write_text(BAD_CSV)
    return str(p)


def test_defects_of_the_csv(spark, bad_csv):
    df = files.read_csv(spark, bad_csv, ORDERS, keep_corrupt=True).persist()
    got = df.agg(
        *[F.count_if(F.expr(c)) for c in (
            "quantity < 0", "price <= 0", "quantity > 1000", "quantity is null", "order_date is null",
            f"{files.CORRUPT} is not null")],
    ).first()
    assert tuple(got) == (1, 3, 1, 2, 1, 2)


def test_failfast(spark, bad_csv):
    with pytest.raises(Exception):
        files.read_csv_failfast(spark, bad_csv, ORDERS).collect()


def test_inferred(spark, bad_csv):
    assert dict(files.read_csv_inferred(spark, bad_csv).dtypes)["price"] == "double"


def test_overwrite_with_another_schema(spark):
    path = work_path(spark, "replace")
    files.write_parquet(spark.range(3), path)
    files.write_parquet(spark.createDataFrame([("a",)], "name string"), path)
    assert spark.read.parquet(path).columns == ["name"]


def test_managed_table(spark):
    try:
        df = files.save_table(spark.range(3), "sedimenta_t")
        files.save_table(spark.range(2), "sedimenta_t", "append")
        assert df.sparkSession.table("sedimenta_t").count() == 5
    finally:
        spark.sql("DROP TABLE IF EXISTS sedimenta_t")


def test_jdbc_reader_signature():
    assert list(inspect.signature(files.read_jdbc).parameters)[:4] == ["spark", "url", "table", "properties"]


def test_schema_listing(spark):
    got = [tuple(r) for r in schema_listing(spark.range(1).withColumn("s", F.lit("x"))).collect()]
    assert got == [(0, "id", "bigint", False), (1, "s", "string", False)]


def test_schema_diff(spark):
    want = T.StructType([
        T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType()),
        T.StructField("amount", T.DecimalType(10, 2)), T.StructField("day", T.DateType(), False),
    ])
    df = spark.createDataFrame([(1, "a", 1.0, "x")], "id long, name string, amount double, note string")
    got = {(r["column"], r["issue"]) for r in sc.schema_diff(df, want).collect()}
    assert got == {("id", "nullable"), ("amount", "type"), ("day", "missing"), ("note", "extra")}
    assert not sc.is_compatible(df, want)
    assert sc.is_compatible(df, T.StructType([T.StructField("name", T.StringType())]))
    assert sc.missing_columns(df, ["id", "day"]) == ["day"]
    assert sc.conform(df, want).columns == ["id", "name", "amount", "day"]


def test_unique_guard(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(ValueError, match="not a unique"):
        assert_unique(df, ["k"])
    assert assert_unique(df.distinct(), ["k"]).count() == 2


def test_stage_log(spark):
    df = spark.createDataFrame([(1, -5.0), (2, 3.0)], "id int, amount double")
    done = []
    log = stages.run_stages(spark, [
        ("schema", lambda: str(sc.missing_columns(df, ["id", "amount"]))),
        ("rules", lambda: str(q.run_rules(df, [q.Rule("positive", "amount <= 0")]).count())),
        ("constraints", lambda: str(q.enforce(df, {"positive": "amount > 0"}).count())),
        ("write", lambda: done.append(1) or "written"),
    ])
    assert [(r["stage"], r["success"]) for r in log.collect()] == [
        ("schema", True), ("rules", True), ("constraints", False), ("write", False)]
    assert not done and log.filter("detail = 'skipped'").count() == 1


def test_cache_is_released(spark):
    df = spark.range(10)
    with kept(df) as cached:
        assert cached.count() == 10 and cached.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_work_folder_comes_from_the_session(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": "hdfs://lake/work/"}.get(key, default)

    class Session:
        conf = Conf()

    assert shared_folder(Session()) == "hdfs://lake/work"
    assert work_path(Session(), "x") != work_path(Session(), "x")
    assert durable(spark.range(5)).count() == 5


def test_stream_continues_where_it_ended(spark):
    landing, out, progress = (work_path(spark, n) for n in ("landing", "out", "progress"))
    schema = spark.range(1).schema
    for part in (spark.range(0, 10), spark.range(10, 15)):
        part.write.mode("append").json(landing)
        ingest.to_bronze(ingest.read_files(spark, landing, schema), out, progress, "2024-01-01 00:00:00")
    ingest.to_bronze(ingest.read_files(spark, landing, schema), out, progress, "2024-01-01 00:00:00")
    assert spark.read.parquet(out).count() == 15


def test_stream_stops_at_a_failed_expectation(spark):
    landing, out, metrics, progress = (work_path(spark, n) for n in ("landing", "out", "metrics", "progress"))
    spark.range(5).write.json(landing)
    stream = ingest.read_files(spark, landing, spark.range(1).schema).drop("source_file")
    with pytest.raises(Exception, match="expectation failed: small"):
        ingest.with_expectations(stream, out, metrics, progress, [q.Expect("small", "id < 3", "fail"), q.Expect("even", "id % 2 = 0", "drop")])
    # The counts of the failed batch are there, its rows are not.
    got = {r.expectation: (r.passed_records, r.failed_records) for r in spark.read.parquet(metrics).collect()}
    assert got == {"small": (3, 2), "even": (3, 2)}
    with pytest.raises(Exception):
        spark.read.parquet(out)


def counting(df, name):
    """``df`` whose rows are counted each time they are run."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    @F.udf("long")
    def passed(x):
        seen.add(1)
        return x

    return df.withColumn(name, passed.asNondeterministic()(F.col(name))), seen


def test_stream_runs_a_batch_once(spark):
    landing, progress = work_path(spark, "landing"), work_path(spark, "progress")
    spark.range(40).coalesce(1).write.json(landing)
    stream, seen = counting(ingest.read_files(spark, landing, spark.range(1).schema).drop("source_file"), "id")
    out, metrics = work_path(spark, "out"), work_path(spark, "metrics")
    ingest.with_expectations(stream, out, metrics, progress, [q.Expect("small", "id < 30", "drop"), q.Expect("low", "id < 5", "warn"), q.Expect("known", "id is not null", "fail")])
    assert seen.value == 40 and spark.read.parquet(out).count() == 30
    assert {r.expectation: r.failed_records for r in spark.read.parquet(metrics).collect()} == {"small": 10, "low": 35, "known": 0}


@pytest.mark.parametrize("broken", [None, "cast(name as int) > 3"])
def test_quality_run_reads_its_input_once(spark, broken):
    from sedimenta.plans.quality_run import run_quality

    df, seen = counting(spark.range(50).select("id", F.lit("x").alias("name"), F.lit("2024-01-01").cast("date").alias("day")), "id")
    rules = [q.Rule("positive", "id < 0", "HIGH"), q.Rule("low", "id > 40", "LOW")] + ([q.Rule("broken", broken, "LOW")] if broken else [])
    path = work_path(spark, "run")
    log = {r.stage: (r.success, r.detail) for r in run_quality(
        df, "t", path, ["id"], rules, q.Suite().not_null("id").unique("id"), {"low_ids": "id < 100"}, ["id"], "day").collect()}
    assert all(ok for ok, _ in log.values()), log
    assert log["rules"][1] == f"1 of {len(rules)} rules hold" and log["expectations"][1] == "2 of 2 expectations hold"
    assert spark.read.parquet(f"{path}/data").count() == 50
    # A rule that fails on a value stops the first write; the rows are kept by a second one.
    assert seen.value == 50 if broken is None else seen.value <= 100


def test_constraints_stop_a_run_before_its_data(spark):
    from sedimenta.plans.quality_run import run_quality

    df = spark.range(5).select("id", F.lit("2024-01-01").cast("date").alias("day"))
    path = work_path(spark, "run")
    log = {r.stage: (r.success, r.detail) for r in run_quality(df, "t", path, ["id"], [], q.Suite().not_null("id"), {"low": "id < 3"}, [], "day").collect()}
    assert log["write"] == (False, "ConstraintError: low: 2") and log["monitoring"] == (False, "skipped")
    with pytest.raises(Exception):
        spark.read.parquet(f"{path}/data")


def test_gate_reads_its_input_once(spark):
    df, seen = counting(spark.range(20), "id")
    path = work_path(spark, "gate")
    q.write_if_good(df, [(F.col("id") < 0, "negative")], "id", [F.desc("id")], 85.0, path)
    assert seen.value == 20 and spark.read.parquet(path).count() == 20


def test_stream_upsert_twice_is_the_same(spark):
    from sedimenta.operators import merge as mg

    landing, silver = work_path(spark, "landing"), work_path(spark, "silver")
    cols = "k int, ts int, v string"
    mg.write_bucketed(spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], cols), silver, ["k"], 4)
    spark.createDataFrame([(1, 2, "c"), (2, 4, "old"), (3, 1, "d"), (1, 3, "e")], cols).write.json(landing)
    schema = spark.createDataFrame([], cols).schema
    for _ in range(2):  # a new progress folder replays every batch
        stream = ingest.read_files(spark, landing, schema).drop("source_file")
        ingest.upsert(stream, silver, work_path(spark, "progress"), ["k"], "ts", [F.desc("ts")], 4)
        got = sorted(tuple(r) for r in mg.read_bucketed(spark, silver).select("k", "ts", "v").collect())
        assert got == [(1, 3, "e"), (2, 5, "b"), (3, 1, "d")]


def test_quarantine_of_the_csv(spark, bad_csv):
    good, bad = files.quarantine(spark, bad_csv, ORDERS, work_path(spark, "good"), work_path(spark, "bad"))
    assert good.count() == 8 and good.columns == ORDERS.names
    got = {r.order_id: (r.record, r.order_date) for r in bad.collect()}
    assert got == {2007: ("2007,207,2,199.99,invalid-date", None), 2009: ("2009,209,null,125.50,2024-02-05", got[2009][1])}


def test_failfast_report(spark, bad_csv, tmp_path):
    assert tuple(files.failfast_report(spark, bad_csv, ORDERS).first()) == (True, 2, "2007,207,2,199.99,invalid-date")
    clean = tmp_path / "clean.csv"
    clean.write_text("order_id,product_id,quantity,price,order_date\n1,2,3,4.5,2024-01-01\n")
    assert tuple(files.failfast_report(spark, str(clean), ORDERS).first()) == (False, 0, None)
