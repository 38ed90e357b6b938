"""Operators against brute force on generated rows, with hot keys split."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta.operators import layout, merge as mg, windows as w
from sedimenta.operators.collecting import collect_distinct_pieces, collect_pieces
from sedimenta.operators.percentiles import exact_percentiles
from sedimenta.operators.windows import latest_per_key
from sedimenta.scale import hot_keys, skew_join

FEW = settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
# Everything is large: keys over 5 rows are split into buckets of about 3.
SPLIT = {"hot_rows": 5, "small_bytes": 0, "bucket_rows": 3}

keys = st.one_of(st.none(), st.sampled_from(["a", "a", "a", "b", "c"]))
values = st.one_of(st.none(), st.integers(-50, 50))
table = st.lists(st.tuples(keys, st.integers(0, 12), values), min_size=30, max_size=90)


def frame(spark, data):
    rows = [(k, t, i, v) for i, (k, t, v) in enumerate(data)]
    return spark.createDataFrame(rows, "k string, t int, id int, v long").repartition(3), rows


@given(table)
@FEW
def test_sequence_split(spark, data):
    df, raw = frame(spark, data)
    out = w.sequence_windows(
        df, ["k"], ["t", "id"], number="n", lag={"prev": "v"}, lead={"next": "v"}, running={"total": "v"}, **SPLIT
    )
    groups = defaultdict(list)
    for r in sorted(raw, key=lambda r: (r[1], r[2])):
        groups[r[0]].append(r)
    want = {}
    for g in groups.values():
        for i, r in enumerate(g):
            seen = [x[3] for x in g[: i + 1] if x[3] is not None]
            want[r[2]] = (
                i + 1, g[i - 1][3] if i else None, g[i + 1][3] if i + 1 < len(g) else None, sum(seen) if seen else None,
            )
    got = {r["id"]: (r["n"], r["prev"], r["next"], r["total"]) for r in out.collect()}
    assert got == want


@given(table)
@FEW
def test_sequence_without_keys(spark, data):
    df, raw = frame(spark, data)
    out = w.sequence_windows(df, [], ["t", "id"], number="n", **SPLIT)
    want = {r[2]: i + 1 for i, r in enumerate(sorted(raw, key=lambda r: (r[1], r[2])))}
    assert {r["id"]: r["n"] for r in out.collect()} == want
    assert out.columns == ["k", "t", "id", "v", "n"]


@given(table)
@FEW
def test_peer_running_total(spark, data):
    df, raw = frame(spark, data)
    out = w.peer_running_total(df, ["k"], "t", "v", "total", **SPLIT)
    want = Counter()
    for r in raw:
        seen = [x[3] for x in raw if x[0] == r[0] and x[1] <= r[1] and x[3] is not None]
        want[(r[2], sum(seen) if seen else None)] += 1
    assert Counter((r["id"], r["total"]) for r in out.collect()) == want


@given(table)
@FEW
def test_global_rank(spark, data):
    df, raw = frame(spark, data)
    out = w.global_rank(df, "v", "rank", **SPLIT)
    down = lambda v: -1000 if v is None else v
    want = {r[2]: 1 + sum(down(x[3]) > down(r[3]) for x in raw) for r in raw}
    assert {r["id"]: r["rank"] for r in out.collect()} == want


@given(table)
@FEW
def test_ties_below_the_limit(spark, data):
    """Split keys whose ties are small: no detour over distinct values."""
    df, raw = frame(spark, data)
    calm = {"hot_rows": 14, "small_bytes": 0, "bucket_rows": 3}
    df = df.withColumn("t", F.col("t") * 10 + F.col("id") % 10)
    times = {r[2]: r[1] * 10 + r[2] % 10 for r in raw}
    out = w.sequence_windows(df, ["k"], ["t"], rank="r", peer_running={"total": "v"}, **calm)
    for row in out.collect():
        same = [x for x in raw if x[0] == row["k"]]
        upto = [x[3] for x in same if times[x[2]] <= row["t"] and x[3] is not None]
        assert row["total"] == (sum(upto) if upto else None)
        assert row["r"] == 1 + sum(times[x[2]] < row["t"] for x in same)


@given(table)
@FEW
def test_percentiles_split(spark, data):
    df, raw = frame(spark, data)
    out = exact_percentiles(df, ["k"], "v", {"p10": 0.1, "p50": 0.5, "p95": 0.95}, **SPLIT)
    groups = defaultdict(list)
    for r in raw:
        if r[3] is not None:
            groups[r[0]].append(r[3])
    got = {r["k"]: (r["p10"], r["p50"], r["p95"]) for r in out.collect()}
    assert got.keys() == groups.keys()
    for k, g in groups.items():
        assert got[k] == pytest.approx(tuple(np.percentile(g, [10, 50, 95])))


@given(table, st.sampled_from(["inner", "left", "left_semi", "left_anti"]))
@FEW
def test_skew_join_is_a_join(spark, data, how):
    df, _ = frame(spark, [*data, *[("a", 1, 1)] * 20])
    # Identical copies of a row in the left table, no NULL and one unknown key on the right.
    left = df.select("k", "t", "v")
    right = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("z", 3.0)], "k string, x double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = skew_join(left, right, ["k"], how, hot_rows=5, small_bytes=0)
        want = left.join(right, ["k"], how)
        assert got.columns == want.columns
        assert mg.multiset_diff(got, want).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salts_spread_copies(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit("x").alias("k"))
    from sedimenta.scale import row_salt

    assert df.withColumn("s", row_salt(df)).select("s").distinct().count() > 1


def test_hot_keys_by_sample(spark):
    df = spark.range(400_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    found = hot_keys(df, ["k"], hot_rows=50_000, small_bytes=0).collect()
    assert [r["k"] for r in found] == [-1] and abs(found[0]["_rows"] - 133_334) < 20_000
    assert hot_keys(df.filter("k >= 0"), ["k"], hot_rows=50_000, small_bytes=0) is None
    assert hot_keys(df, ["k"]) is None  # small enough for one task


@given(table)
@FEW
def test_collected_pieces(spark, data):
    df, raw = frame(spark, data)
    got = defaultdict(list)
    out = collect_pieces(df, ["k"], "id", ["t", "id"], piece_rows=4, **SPLIT).orderBy("k", "piece")
    for r in out.collect():
        assert len(r["items"]) <= 4
        got[r["k"]] += r["items"]
    want = defaultdict(list)
    for r in sorted(raw, key=lambda r: (r[1], r[2])):
        want[r[0]].append(r[2])
    assert got == want
    sets = collect_distinct_pieces(df, ["k"], "v", piece_rows=4, **SPLIT).collect()
    for k in {r["k"] for r in sets}:
        all_items = [x for r in sorted(sets, key=lambda r: r["piece"]) if r["k"] == k for x in r["items"]]
        assert all_items == sorted({r[3] for r in raw if r[0] == k and r[3] is not None})


changes = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 20), st.sampled_from("xyz")), min_size=1, max_size=40)
CHANGE = "k int, ts int, v string, seq int"


def log_of(spark, data):
    return spark.createDataFrame([(*c, i) for i, c in enumerate(data)], CHANGE)


def last(df):
    return latest_per_key(df, ["k"], [F.desc("ts"), F.desc("seq")])


@given(changes, changes)
@FEW
def test_merge(spark, old, new):
    t = last(log_of(spark, old))
    s = last(log_of(spark, new))
    once = mg.merge(t, s, ["k"], mg.newer("ts"))
    state = {r["k"]: r for r in t.collect()}
    for r in s.collect():
        if r["k"] not in state or r["ts"] > state[r["k"]]["ts"]:
            state[r["k"]] = r
    assert {r["k"]: r for r in once.collect()} == state
    assert mg.multiset_diff(once, mg.merge(once, s, ["k"], mg.newer("ts"))).isEmpty()


@given(changes, st.integers(0, 20))
@FEW
def test_as_of(spark, data, at):
    got = {r["k"]: (r["ts"], r["seq"]) for r in mg.as_of(log_of(spark, data), ["k"], "ts", F.lit(at), ["seq"]).collect()}
    want = {}
    for i, (k, ts, _) in enumerate(data):
        if ts <= at:
            want[k] = max(want.get(k, (-1, -1)), (ts, i))
    assert got == want


@given(changes)
@FEW
def test_scd2_intervals_meet(spark, data):
    rows = mg.scd2(log_of(spark, data), ["k"], "ts", ["ts", "seq"]).collect()
    assert len(rows) == len(data)
    for k in {r["k"] for r in rows}:
        mine = sorted((r for r in rows if r["k"] == k), key=lambda r: (r["ts"], r["seq"]))
        assert [r["valid_to"] for r in mine] == [r["valid_from"] for r in mine[1:]] + [None]
        assert sum(r["is_current"] for r in mine) == 1


@given(changes, changes)
@FEW
def test_snapshot_diff(spark, old, new):
    a, b = last(log_of(spark, old)).drop("seq"), last(log_of(spark, new)).drop("seq")
    x, y = ({r["k"]: r for r in d.collect()} for d in (a, b))
    want = {k: "insert" for k in y.keys() - x.keys()} | {k: "delete" for k in x.keys() - y.keys()}
    want |= {k: "update" for k in x.keys() & y.keys() if x[k] != y[k]}
    assert {r["k"]: r["change_type"] for r in mg.snapshot_diff(a, b, ["k"]).collect()} == want


@given(st.lists(st.tuples(values, st.sampled_from([None, "p", "q", "r"])), min_size=1, max_size=60))
@FEW
def test_zorder_keeps_rows(spark, data):
    df = spark.createDataFrame(data, "a long, b string")
    assert mg.multiset_diff(df, layout.zorder(df, ["a", "b"], 4)).isEmpty()


def test_zorder_narrows_files(spark):
    n = 40_000
    df = spark.range(n).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("b")
    )
    parts = layout.zorder(df, ["a", "b"], 16).groupBy(F.spark_partition_id()).agg(
        (F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")
    ).agg(F.avg("a"), F.avg("b")).first()
    assert parts[0] < 600 and parts[1] < 600


