"""Secrets that overlap, clashing names, stray quotes in tags, tasks of the near copies."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import credentials, graph, htmltext, jaccard
from sedimenta.llm.store import Store

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("text,kinds", [
    ("account_id = 507f1f77bcf86cd799439011", {"hex"}),
    ("user: Zx9dkQ2mLp48TreWq0Ab1", set()),
    ("user: admin_7 key Zx9dkQ2mLp48TreWq0Ab1", {"ident", "key"})])
def test_one_value_is_not_two_parts(spark, text, kinds):
    spans = credentials.secret_report(spark.createDataFrame([(1, text)], SCHEMA)).first().spans
    assert {s.split(":")[0] for s in spans.split(",") if s} == kinds


def test_redact_keeps_clashing_columns(spark):
    rows = [(1, "password = hunter22 end"), (1, "password = hunter22 end"), (None, "token: abcdef1"), (2, "plain"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("_id", "_h", "_own", "own", "key", "cuts", "start", "row", "spans", "text_hash"):
        df = df.withColumn(c, F.lit("x"))
    got = credentials.redact(df)
    assert got.columns == df.columns
    texts = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert len(texts) == 6 and not any("hunter22" in (t or "") or "abcdef1" in (t or "") for _, t in texts)
    assert {t for i, t in texts if i in (2, 3, 4)} == {"plain", None, ""} and all("[SECRET]" in t for i, t in texts if i in (1, None))
    assert {r._id for r in got.collect()} == {"x"}


@pytest.mark.parametrize("page,want", [
    ("<p title='it's nice'>Main text one. It doesn't end.</p>", "Main text one. It doesn't end."),
    ("<p data-x=don't>First.</p><p>It's second.</p>", "First.|It's second."),
    ('<p>A <b class="x>bold</b> word</p>', "A bold word"),
    ("<p title=\"a > b\" x='c > d'>Kept</p>", "Kept"),
    ("<p a = 'x' b=\"y\" c=z d>Kept</p>", "Kept"),
    ("<p>one</p><p x='>two</p>", "one|two")])
def test_quotes_in_tags(page, want):
    assert "|".join(b[0] for b in htmltext.blocks(page)) == want


def test_many_broken_tags_take_no_longer():
    began = time.time()
    htmltext.blocks("<a " + "x=\"1\" y='" * 20_000)
    htmltext.blocks("<a x='" * 3000)
    assert time.time() - began < 20


def test_components_grow_by_new_edges(spark):
    """Edges found later join components as if all had been there at once; edges inside one change nothing."""
    rng = np.random.default_rng(11)
    first, later = ([(int(a), int(b)) for a, b in rng.integers(0, 400, (150, 2))] for _ in range(2))
    store = Store(spark, "test")
    old, new = (spark.createDataFrame(x, "a long, b long") for x in (first, later))
    known = store.keep(graph.components(old, store))
    assert graph.extended(known, old, store) is known
    found = [tuple(r) for r in graph.extended(known, new, store).collect()]
    whole = [tuple(r) for r in graph.components(old.union(new), store).collect()]
    assert sorted(found) == sorted(whole)


def test_near_copies_take_few_tasks(spark):
    """Each task is an entry in the scheduler and the event log: known components and lists of ids are not dealt out anew."""
    rng = np.random.default_rng(12)
    texts = []
    for i in range(40):
        base = [f"w{x}" for x in rng.integers(0, 5000, 60)]
        texts += [" ".join([*base, f"end{j}"]) for j in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, sc = {k: spark.conf.get(k) for k in held}, spark.sparkContext
    for k, v in held.items():
        spark.conf.set(k, v)
    sc.setJobGroup("few-tasks", "near copies")
    try:
        kept = jaccard.keep_one(docs).count()
        stages = {s for j in sc.statusTracker().getJobIdsForGroup("few-tasks") for s in sc.statusTracker().getJobInfo(j).stageIds}
        tasks = sum(i.numCompletedTasks for i in map(sc.statusTracker().getStageInfo, stages) if i)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert kept == 40 and tasks < 1600
