"""Operator 2: repeated word windows, with a count-min prefilter.

A window is ``WIDTH`` consecutive words of one text.  A word goes when a
window over it has a word sequence that also starts in a document with a
smaller ``doc_id``.

1. Every window is keyed by its rarest-looking piece: the smallest hash among
   its ``GRAM``-word grams.  Equal windows have equal keys, and neighbouring
   windows mostly share the key's place, so a text has some 22 times fewer
   keys than windows.
2. *Sketch.*  Each partition counts its documents' keys in the cells of a
   count-min sketch (``ROWS`` rows; only cells that are hit exist), and the
   partial sketches are added by cell.  An estimate is never below the count.
3. *Second pass.*  Only windows whose key is estimated at two or more in every
   row are hashed and grouped exactly, by key and window hash (128 bits).  A
   window that occurs twice has a key that does, so none is lost; a false
   estimate costs work only.
4. Texts with removed words are read again, and words under the windows go.

Whole copies are settled by their fingerprint before: all but the smallest
``doc_id`` of a group lose every word, and the smallest stands for the group.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import words as wd
from sedimenta.scale import plan_bytes
from sedimenta.llm.store import Store, column, rows_in

WIDTH = 50
GRAM = 8
ROWS = 2
# Cells per row for each byte of the stored table: some two per expected key.
CELLS_PER_BYTE = 1 / 32


def _smallest(g: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest value in each run of ``span`` values, the last of equal ones."""
    at = np.arange(len(g))
    done = 1
    while done < span:
        step = min(done, span - done)
        a, b = at[:len(at) - step], at[step:]
        at = np.where(g[b] <= g[a], b, a)
        done += step
    return at


def _runs(h: np.ndarray, width: int, gram: int):
    """Of one text: key hash, first window and number of windows of each run
    of windows that share the place of their key."""
    grams = wd.window_hashes(h, gram)
    place = _smallest(grams, width - gram + 1)
    begin = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
    return grams[place[begin]], begin, np.diff(np.append(begin, len(place)))


def _keys(batches, width: int, gram: int):
    for batch in batches:
        for part, w in wd.slices(batch):
            h = w.hashes()
            n, sha, one, two, keys = [], [], [], [], []
            for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
                own = h[a:b]
                n.append(b - a)
                # b"".split() would also cut at other characters in str, in bytes it cuts at these six.
                sha.append(hashlib.sha256(b" ".join(w.text_of(i).split())).hexdigest())
                one.append(int(sha[-1][:16], 16))
                two.append(int(sha[-1][16:32], 16))
                keys.append(np.unique(_runs(own, width, gram)[0]) if b - a >= width else own[:0])
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(n, pa.int64()), pa.array(sha),
                pa.array(wd.signed(np.array(one, np.uint64))), pa.array(wd.signed(np.array(two, np.uint64))),
                wd.lists(wd.signed(np.concatenate(keys)), np.cumsum([len(x) for x in keys]), pa.int64()),
            ], ["doc_id", "n", "sha", "h1", "h2", "keys"])


def _fingerprint(words: bytes) -> int:
    return int(np.array([int(hashlib.sha256(words).hexdigest()[:16], 16)], np.uint64).view(np.int64)[0])


def _windows(batches, width: int, gram: int):
    """Windows of the texts whose key is in the list of the third column."""
    for batch in batches:
        for part, w in wd.slices(batch):
            h = w.hashes()
            key, win, start, doc, own = [], [], [], [], []
            for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
                if b - a < width:
                    continue
                found, begin, size = _runs(h[a:b], width, gram)
                keep = np.isin(found, wd.unsigned(part.column(2)[i].values.to_numpy()))
                size = size[keep]
                places = np.repeat(begin[keep], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                key.append(np.repeat(found[keep], size))
                win.append(wd.window_hashes(h[a:b], width)[places])
                start.append(places.astype(np.int32))
                doc.append(np.full(len(places), i))
                own.append(np.full(len(places), _fingerprint(b" ".join(w.text_of(i).split()))))
            if key:
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.concatenate(doc))), pa.array(np.concatenate(own)),
                    pa.array(wd.signed(np.concatenate(key))), pa.array(wd.signed(np.concatenate(win))),
                    pa.array(np.concatenate(start)),
                ], ["doc_id", "h1", "key", "win", "start"])


def _cut(batches, width: int):
    """Texts without the words under the windows of the fourth column."""
    for batch in batches:
        for part, w in wd.slices(batch):
            rows, gone, sha, kept = [], [], [], []
            for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
                own = w.text_of(i).split()
                if _fingerprint(b" ".join(own)) != part.column(2)[i].as_py():
                    continue  # windows of another row with this doc_id
                starts = np.unique(part.column(3)[i].values.to_numpy())
                cover = np.zeros(b - a + 1, dtype=np.int64)
                cover[starts] += 1
                cover[starts + width] -= 1
                stay = np.cumsum(cover)[:-1] == 0
                text = b" ".join([x for x, s in zip(own, stay) if s])
                rows.append(i)
                gone.append(int(len(stay) - stay.sum()))
                sha.append(hashlib.sha256(text).hexdigest())
                kept.append(text.decode("utf-8"))
            rows = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(rows), part.column(2).take(rows), pa.array(gone, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                ["doc_id", "h1", "n_removed", "cut_sha", "kept"])


def _removals(docs: DataFrame, width: int, gram: int, cells: int | None) -> tuple[DataFrame, DataFrame]:
    """Facts of every row, and the cut texts of the rows that lose some words."""
    store = Store(docs.sparkSession, "substring")
    if cells is None:
        cells = int(plan_bytes(docs) * CELLS_PER_BYTE)
    cells = 1 << max(16, min(40, cells.bit_length()))
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    found = store.keep(texts.mapInArrow(
        partial(_keys, width=width, gram=gram),
        "doc_id long, n long, sha string, h1 long, h2 long, keys array<long>"))
    long = found.filter(F.col("doc_id").isNotNull() & (F.col("n") >= width))
    copies = long.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"))
    base = store.keep(found.drop("keys").join(copies, ["h1", "h2"], "left").withColumn(
        "whole", F.coalesce((F.col("n") >= width) & (F.col("doc_id") > F.col("low")), F.lit(False))))
    keys = store.keep(long.join(copies, ["h1", "h2"]).filter("doc_id = low").select("doc_id", F.explode("keys").alias("key")))

    cell = [F.pmod(F.xxhash64(F.lit(r), "key"), F.lit(cells)) for r in range(ROWS)]
    hits = keys.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("r"), c.alias("cell")) for r, c in enumerate(cell)])).alias("s"))
    sketch = store.keep(hits.groupBy("s.r", "s.cell").count().filter("count > 1").select("r", "cell"))
    likely = keys
    for r, c in enumerate(cell):
        many = sketch.filter(F.col("r") == r).select("cell")
        likely = likely.withColumn("cell", c).join(many, "cell", "left_semi").drop("cell")
    likely = store.keep(likely)
    exact = likely.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    wanted = store.keep(likely.join(exact.filter("lo < hi").select("key"), "key", "left_semi")
                        .groupBy("doc_id").agg(F.collect_set("key").alias("keys")))
    windows = store.keep(rows_in(texts, wanted).join(wanted, "doc_id").select("doc_id", "text", "keys").mapInArrow(
        partial(_windows, width=width, gram=gram), "doc_id long, h1 long, key long, win long, start int"))
    first = windows.groupBy("key", "win").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    later = windows.join(first.filter("lo < hi").drop("hi"), ["key", "win"]).filter("doc_id > lo")
    starts = store.keep(later.groupBy("doc_id", "h1").agg(F.collect_set("start").alias("starts")))
    cut = rows_in(texts, starts).join(starts, "doc_id").select("doc_id", "text", "h1", "starts").mapInArrow(
        partial(_cut, width=width), "doc_id long, h1 long, n_removed long, cut_sha string, kept string")
    # Equal rows are cut alike; one of them answers for all.
    return base, cut.dropDuplicates(["doc_id", "h1"])


def repeated_windows(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, cells: int | None = None) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` per row of ``docs(doc_id, text)``.

    NULL and empty texts have no words; a text of fewer than ``width`` words
    has no window and is kept, also when it is a copy.  Rows with the same
    ``doc_id`` are parts of one document and never remove each other's words.
    A row without a ``doc_id`` is kept whole and removes nothing.  Equal rows
    give equal rows; other columns are ignored.  ``cells`` is the number of
    cells in a row of the sketch (default: in proportion to the stored table).
    """
    base, cut = _removals(docs, width, gram, cells)
    joined = base.join(cut.drop("kept"), ["doc_id", "h1"], "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_words"),
        F.when(F.col("whole"), F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("whole"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"))


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, cells: int | None = None) -> DataFrame:
    """``(doc_id, text)`` of the documents with removed words, with the kept
    words joined by one space (empty for whole copies)."""
    base, cut = _removals(docs, width, gram, cells)
    return cut.select("doc_id", F.col("kept").alias("text")).union(
        base.filter("whole").select("doc_id", F.lit("").alias("text")).distinct())
