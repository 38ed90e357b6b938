"""Operator 9: document quality from a conditional random field over lines.

Every line with a word is good or bad; a linear chain sees features of the
line and of its neighbours.  Labels exist for documents only, so lines start
with their document's label, and in bad documents the lines that the trained
chain finds good change sides before it is trained again (``PASSES`` times).
A document's share of good lines is the mean of the forward-backward marginals
weighted by length; a logistic curve over that share and the worst line gives
the score.

Training takes up to ``SAMPLE`` labelled documents, chosen by a hash of their
id; only line features travel to the driver.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm import crf
from sedimenta.llm import words as wd
from sedimenta.llm.store import Store, column, rows_in

# Labelled documents that the model is fitted on, at most.
SAMPLE = 3000
# Lines of all of them, and of one; longer documents are only scored.
SAMPLE_LINES = 100_000
DOCUMENT_LINES = 10_000
PASSES = 2

_GROUPS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "symbol": b"#*$%&<>=+~^_{}[]\\/@", "bang": b"!?", "bar": b"|", "point": b".,;:"}
_MEMBER = {}
for _name, _chars in _GROUPS.items():
    _MEMBER[_name] = np.zeros(256, dtype=np.int32)
    _MEMBER[_name][list(_chars)] = 1
OWN = 15
# Features of the previous and the next line that a line sees.
SHARED = (0, 3, 4, 5, 9, 10, 14)
WIDTH = OWN + 2 * len(SHARED)


def line_features(w: wd.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines with a word, length of each in bytes, and the
    first line of each text."""
    data, offsets = w.data, w.offsets
    cut = np.flatnonzero(data == 10) + 1
    edges = np.unique(np.concatenate((offsets, cut)))
    lines = wd.Words(data, edges)
    n = lines.counts()
    full = np.flatnonzero(n > 0)
    begin, end, n = edges[:-1][full], edges[1:][full], n[full].astype(float)
    size = (end - begin).astype(float)
    share = {}
    for name, table in _MEMBER.items():
        total = np.concatenate(([0], np.cumsum(table[data])))
        share[name] = (total[end] - total[begin]) / size
    letters = share["upper"] + share["lower"] + 1e-6
    first_word, last_word = lines.first[:-1][full], lines.first[1:][full]
    head, tail = data[lines.start[first_word]], data[lines.end[last_word - 1] - 1]
    doc = np.searchsorted(offsets, begin, side="right") - 1
    h = lines.hashes(lower=True)
    # Three-word shingles that occur again in the same text.
    again = np.zeros(len(h) + 1, dtype=np.int64)
    if len(h) >= 3:
        grams = wd.window_hashes(h, 3)
        owner = np.searchsorted(offsets, lines.start, side="right") - 1
        inside = owner[:-2] == owner[2:]
        key = grams ^ wd.mix(owner[:-2].astype(np.uint64) + np.uint64(1))
        _, back, times = np.unique(key, return_inverse=True, return_counts=True)
        again[1:len(key) + 1] = (times[back] > 1) & inside
    again = np.cumsum(again)
    twins = np.cumsum(np.concatenate(([0], h[:1] != h[:1], h[1:] == h[:-1])))
    repeated = (again[last_word] - again[first_word]) / n
    length = (size - (tail == 10)) / n
    order = np.arange(len(full)) - np.searchsorted(doc, doc)
    own = np.stack([
        share["upper"] / letters, np.log1p(n), length, share["symbol"], share["bang"], share["bar"], share["digit"],
        share["point"], np.isin(tail, list(b".!?\"'")).astype(float), repeated, share["symbol"] * n / (n + 3),
        ((head >= 65) & (head <= 90)).astype(float), (n < 4).astype(float), (order == 0).astype(float),
        (twins[last_word] - twins[first_word]) / n], axis=1)
    first = np.searchsorted(doc, np.arange(len(offsets)))
    before, after = np.zeros((len(own), len(SHARED))), np.zeros((len(own), len(SHARED)))
    if len(own) > 1:
        same = (doc[1:] == doc[:-1])[:, None]
        before[1:] = own[:-1, SHARED] * same
        after[:-1] = own[1:, SHARED] * same
    return np.hstack([own, before, after]), size, first


def _summaries(good: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text the weighted share of good lines and the share of its worst
    lines, as log odds; texts without lines get zeros."""
    weight = np.concatenate(([0.0], np.cumsum(size)))
    total = np.concatenate(([0.0], np.cumsum(good * size)))
    low = np.concatenate(([0.0], np.cumsum((good < 0.5) * size)))
    a, b = first[:-1], first[1:]
    full = b > a
    out = np.zeros((len(a), 2))
    mean = (total[b] - total[a])[full] / (weight[b] - weight[a])[full]
    out[full, 0] = np.log((mean + 1e-4) / (1 - mean + 1e-4))
    out[full, 1] = -np.sqrt((low[b] - low[a])[full] / (weight[b] - weight[a])[full])
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w)), x.T @ (y - p) - 1e-2 * w)
        w = w + step
    return w


def fit(x: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray):
    """Chain, logistic weights and the share of label 1."""
    count = np.diff(first)
    y = np.repeat(label, count)
    chain = crf.train(x, y, first)
    for _ in range(PASSES):
        good = chain.marginals(x, first)[:, 1]
        y = np.where(np.repeat(label, count) == 1, 1, (good >= 0.5).astype(np.int64))
        for a, b, own in zip(first[:-1], first[1:], label):
            if own == 0 and b > a and y[a:b].all():
                y[a + int(good[a:b].argmin())] = 0
        chain = crf.train(x, y, first)
    good = chain.marginals(x, first)[:, 1]
    full = count > 0
    return chain, _logistic(_summaries(good, size, first)[full], label[full]), float(label.mean())


def _features(batches):
    for batch in batches:
        for part, w in wd.slices(batch):
            x, size, first = line_features(w)
            rows, sizes = [], []
            for a, b in zip(first[:-1], first[1:]):
                rows.append(x[a:b].astype(np.float32).ravel())
                sizes.append(size[a:b].astype(np.float32))
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(2), wd.lists(np.concatenate(rows), np.cumsum([len(r) for r in rows]), pa.float32()),
                wd.lists(np.concatenate(sizes), np.cumsum([len(r) for r in sizes]), pa.float32())],
                ["doc_id", "label", "x", "size"])


def _score(batches, shared):
    chain, curve, share = shared.value
    for batch in batches:
        for part, w in wd.slices(batch):
            x, size, first = line_features(w)
            good = chain.marginals(x, first)[:, 1] if len(x) else np.zeros(0)
            z = _summaries(good, size, first) @ curve[:-1] + curve[-1]
            p = np.where(np.diff(first) > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), share)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(p), pa.array(np.diff(first).astype(np.int64))], ["doc_id", "score", "n_lines"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """Model from at most ``sample`` labelled documents that are not held out.

    Whole documents are taken in hash order as long as their lines are no more
    than ``SAMPLE_LINES``; of rows that repeat an id the text with the smallest
    hash is used.  Without a labelled document of
    both kinds every score is the share of label 1 (0.5 without any).
    """
    known = labels.select(column(labels, "doc_id", "long").alias("doc_id"), column(labels, "quality", "int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    texts = texts.join(F.broadcast(known), "doc_id").withColumn("hash", F.xxhash64("text"))
    lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1, F.lit(0))
    # At most ``sample`` rows from here on.
    one = texts.groupBy("doc_id").agg(F.min(F.struct("hash", lines.alias("lines"))).alias("one")).select("doc_id", "one.*")
    upto = F.sum("lines").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    one = one.filter(F.col("lines") <= DOCUMENT_LINES).withColumn("upto", upto).filter(F.col("upto") <= SAMPLE_LINES)
    rows = texts.join(F.broadcast(one.select("doc_id", "hash")), ["doc_id", "hash"]).dropDuplicates(["doc_id"])
    rows = rows.select("doc_id", "text", "label").mapInArrow(
        _features, "doc_id long, label int, x array<float>, size array<float>")
    rows = rows.toPandas().sort_values("doc_id")
    label = rows["label"].to_numpy(dtype=np.int64)
    if len(set(label)) < 2:
        return None, None, float(label.mean()) if len(label) else 0.5
    size = [np.asarray(s, dtype=float) for s in rows["size"]]
    first = np.concatenate(([0], np.cumsum([len(s) for s in size])))
    x = np.concatenate([np.asarray(r, dtype=float) for r in rows["x"]]).reshape(-1, WIDTH)
    return fit(x, np.concatenate(size), first, label)


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted, n_lines)`` per row of ``docs(doc_id, text)``.

    Texts without a word (also NULL) get the training share of label 1.  Rows
    are scored one by one: repeated rows, NULL ids (never held out) and any
    length are fine; other columns are ignored.
    """
    model = train(docs, labels, sample)
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    if model[0] is None:
        scored = texts.select("doc_id", F.lit(model[2]).alias("score"), F.lit(0).cast("long").alias("n_lines"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        scored = texts.mapInArrow(partial(_score, shared=shared), "doc_id long, score double, n_lines long")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "n_lines")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents predicted good; rows sharing a ``doc_id`` go only together."""
    bad = quality_scores(docs, labels).groupBy("doc_id").agg(F.max("predicted").alias("p")).filter("p = 0").select("doc_id")
    return rows_in(docs, Store(docs.sparkSession, "lines").keep(bad), how="left_anti")
