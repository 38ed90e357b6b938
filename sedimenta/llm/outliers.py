"""Operator 8: quality rules and robust outliers, in DataFrame functions only.

Per text some statistics are counted in the row.  Base rules reject very short
and very repetitive texts.  The others are judged as vectors of transformed
statistics by their Mahalanobis distance from the minimum-covariance-
determinant estimate of their language and source:

* two deterministic starts per group (medians with absolute deviations, and
  plain moments), ``STEPS`` concentration steps each: moments of the ``SHARE``
  of vectors nearest to the last estimate; the smaller determinant wins;
* equal vectors count once, so a group of copies does not become the centre;
* a vector belongs to its (language, source), its language and the whole;
  the finest of the three with ``LEAST`` vectors judges it;
* ``FLOORS`` are added to the variances: a statistic that hardly varies does
  not reject texts for a trifle;
* statistics of short texts are drawn to the language's usual value (for shares: to
  zero) as if ``PRIOR`` more words had been seen.

Quantiles come from counted bins, so partitioning does not change them.  Every
step is an aggregation by group with partial sums.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.native import SPACE, words
from sedimenta.llm.store import Store, column

WINDOW = 5
SHARE = 0.75
STEPS = 3
LEAST = 50
PRIOR = 30
# Chance that a text of a normal group is rejected.
REJECTED = 1e-5
FEATURES = ("f0", "f1", "f2", "f3")
#: smallest standard deviations: letters per word, share of symbols, of repeated lines, of repeated words
FLOORS = (0.35, 0.02, 0.06, 0.06)
DIM = len(FEATURES)


def _chi(x: float, dim: int) -> float:
    """Chance that chi squared with an even number of degrees is below x."""
    term, total = 1.0, 1.0
    for i in range(1, dim // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def _chi_quantile(share: float, dim: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi(mid, dim) < share else (lo, mid)
    return hi


CUT = _chi_quantile(1 - REJECTED, DIM)
# Moments of the nearest share of a normal sample are too small by this factor.
GROWTH = SHARE / _chi(_chi_quantile(SHARE, DIM), DIM + 2)


def statistics(docs: DataFrame) -> DataFrame:
    """Row-wise counts; a NULL text counts as empty."""
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    rows = docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), column(docs, "lang", "string").alias("lang"),
        column(docs, "source", "string").alias("source"), text.alias("text"), words(text).alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("lines"))
    hashes = F.transform("w", lambda x: F.xxhash64(x))
    rows = rows.select(
        "doc_id", "lang", "source", F.size("w").alias("n"), F.char_length(F.array_join("w", "")).alias("word_chars"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).alias("n_symbols"),
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        hashes.alias("h"))
    window = F.transform(
        F.sequence(F.lit(0), F.col("n") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("h"), i + j) for j in range(WINDOW)]))
    rows = rows.withColumn("win", F.when(F.col("n") >= WINDOW, window))
    # Of windows in order of their hash the repeated ones have an equal neighbour.
    ordered = F.array_sort(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    rows = rows.withColumn("ordered", F.when(F.size(F.array_distinct("win")) < F.size("win"), ordered))
    twice = F.filter(F.transform("ordered", lambda e, k: F.when(
        (e["x"] == F.get(F.col("ordered"), k - 1)["x"]) | (e["x"] == F.get(F.col("ordered"), k + 1)["x"]), e["i"])),
        lambda i: i.isNotNull())
    covered = F.aggregate(
        F.sort_array(twice), F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total")),
        lambda a, i: F.struct(i.alias("last"), (a["total"] + F.least(F.lit(WINDOW), i - a["last"])).alias("total")),
        lambda a: a["total"])
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return rows.select(
        "doc_id", "lang", "source", F.col("n").cast("long").alias("n_words"), count(F.col("word_chars")).alias("word_chars"),
        count(F.col("n_symbols")).alias("n_symbols"), count(F.col("n_dup_lines")).alias("n_dup_lines"),
        count(covered).alias("n_repeat_words"), F.col("n_lines").cast("long").alias("n_lines"))


def _quantile(rows: DataFrame, keys: list[str], value: str, share: float, width: float, name: str) -> DataFrame:
    """Per group the middle of the bin of ``value`` that the share falls into."""
    bins = rows.groupBy(*keys, F.floor(F.col(value) / width).alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    up = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumn("up", F.sum("c").over(up)).withColumn("all", F.sum("c").over(Window.partitionBy(*keys)))
    bins = bins.filter(F.col("up") >= F.col("all") * share)
    return bins.groupBy(*keys).agg(((F.min("bin") + 0.5) * width).alias(name))


def _factor(estimates: DataFrame) -> DataFrame:
    """Cholesky factor of the covariances ``c{i}{j}``, and the logarithm of its determinant."""
    for j in range(DIM):
        rest = F.col(f"c{j}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{j}{k}") * F.col(f"l{j}{k}")
        estimates = estimates.withColumn(f"l{j}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))))
        for i in range(j + 1, DIM):
            rest = F.col(f"c{j}{i}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            estimates = estimates.withColumn(f"l{i}{j}", rest / F.col(f"l{j}{j}"))
    logs = sum((F.log(F.col(f"l{j}{j}")) for j in range(1, DIM)), F.log(F.col("l00")))
    return estimates.withColumn("det", logs)


def _distance(rows: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d`` from the means ``m{i}`` and the factor ``l{i}{j}``."""
    for i in range(DIM):
        rest = F.col(FEATURES[i]) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    return rows.withColumn("d", F.round(sum((F.col(f"y{i}") ** 2 for i in range(1, DIM)), F.col("y0") ** 2), 6)).drop(
        *[f"y{i}" for i in range(DIM)])


def _moments(rows: DataFrame, keys: list[str], growth: float) -> DataFrame:
    pairs = [(i, j) for i in range(DIM) for j in range(i, DIM)]
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)],
        *[F.avg(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}{j}") for i, j in pairs])
    cov = [((F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * growth
            + (FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in pairs]
    return _factor(sums.select(*keys, "n", *[f"m{i}" for i in range(DIM)], *cov))


def estimate(vectors: DataFrame, store: Store) -> DataFrame:
    """MCD estimate per ``g`` of rows ``(g, f0 ...)``: ``m{i}``, ``l{i}{j}`` and ``n``."""
    keys = ["g", "start"]
    robust = vectors.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    centred = vectors
    for i, f in enumerate(FEATURES):
        width = FLOORS[i] / 20
        centre = _quantile(vectors, ["g"], f, 0.5, width, f"m{i}")
        centred = centred.join(centre, "g").withColumn(f"a{i}", F.abs(F.col(f) - F.col(f"m{i}")))
    centred = store.keep(centred)
    robust = centred.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(DIM)])
    for i in range(DIM):
        robust = robust.join(_quantile(centred, ["g"], f"a{i}", 0.5, FLOORS[i] / 20, f"s{i}"), "g")
    cov = [((1.4826 * F.col(f"s{i}")) ** 2 + FLOORS[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}")
           for i in range(DIM) for j in range(i, DIM)]
    robust = _factor(robust.select("g", "n", *[f"m{i}" for i in range(DIM)], *cov))
    now = robust.withColumn("start", F.lit(0)).unionByName(_moments(vectors, ["g"], 1.0).withColumn("start", F.lit(1)))
    for _ in range(STEPS):
        now = store.keep(now)
        far = store.keep(_distance(vectors.join(now.drop("n", "det"), "g")).select("g", "start", *FEATURES, "d"))
        far = far.withColumn("root", F.sqrt("d"))
        near = far.join(_quantile(far, keys, "root", SHARE, 0.01, "edge"), keys).filter(F.col("root") < F.col("edge") + 0.005)
        now = _moments(near, keys, GROWTH)
    now = store.keep(now)
    sizes = vectors.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("g").orderBy("det", "start")
    return now.drop("n").withColumn("rank", F.row_number().over(best)).filter("rank = 1").join(sizes, "g")


def _group(level: int) -> Column:
    """Key of the whole (0), of a language (1), of a language and source (2); NULL is a value."""
    return F.to_json(F.struct(F.lit(level).alias("level"), *[F.col(c) for c in ("lang", "source")[:level]]))


def quality_rules(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance)`` per row of ``docs(doc_id, text, lang, source)``.

    NULL and empty texts have zero counts and fail the base rules.  NULL in
    ``lang`` or ``source`` is a group of its own.  ``doc_id`` is passed on;
    equal rows give equal rows, other columns are ignored.  ``distance`` is
    NULL where the base rules decide.
    """
    store = Store(docs.sparkSession, "outliers")
    rows = statistics(docs)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = store.keep(rows.withColumn("base_failed", failed))
    usual = rows.filter("not base_failed").groupBy("lang").agg((F.sum("word_chars") / F.sum("n_words")).alias("usual"))
    rows = rows.join(usual.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    seen = F.col("n_words") + PRIOR
    features = [
        (F.col("word_chars") + PRIOR * F.coalesce("usual", F.lit(5.0))) / seen,
        F.col("n_symbols") / (F.col("word_chars") + PRIOR * 5), F.col("n_dup_lines") / (F.col("n_lines") + 3),
        F.col("n_repeat_words") / seen]
    rows = rows.select("*", *[F.round(c, 6).alias(f) for f, c in zip(FEATURES, features)]).drop("usual")
    rows = rows.select("*", *[_group(level).alias(f"g{level}") for level in range(3)])
    vectors = rows.filter("not base_failed").select(F.explode(F.array("g0", "g1", "g2")).alias("g"), *FEATURES).distinct()
    found = store.keep(estimate(store.keep(vectors), store))
    sizes = found.select("g", "n").filter(F.col("n") >= LEAST)
    for level in (1, 2):
        large = sizes.select(F.col("g").alias(f"g{level}"), F.lit(True).alias(f"has{level}"))
        rows = rows.join(large, f"g{level}", "left")
    rows = rows.withColumn("g", F.when(F.col("has2"), F.col("g2")).when(F.col("has1"), F.col("g1")).otherwise(F.col("g0")))
    judged = _distance(rows.join(found.drop("n", "start", "det", "rank"), "g", "left"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "doc_id", *counts, "base_failed", (~F.col("base_failed") & F.coalesce(F.col("d") <= CUT, F.lit(True))).alias("kept"),
        F.when(~F.col("base_failed"), F.col("d")).alias("distance"))
