"""Operator 10: benchmark decontamination by latent semantic retrieval.

The benchmark is the query set: its items, their words (``Lexicon``) and their
latent vectors are sent to every task, in size a matter of the benchmark alone.
An item longer than a passage is a query per passage of its own.
Documents are only ever read in partitions.

1. *Words.*  Every text is cut into blocks of ``BLOCK`` words; two neighbouring
   blocks are a passage.  Places of words of the lexicon are written to the
   shared folder (``tokens``).  Words in more than ``STOP`` of the items say
   nothing about an item and are left out, unless an item has no others.
2. *TF-IDF.*  A word weighs ``1 / sqrt(number of blocks that have it)``, counted
   over all documents.
3. *Randomised SVD.*  ``A`` has a row per block.  Each partition adds its part
   of ``A.T @ (A @ omega)`` for a random ``omega``; the parts are summed by word.
   From this sketch of the Gram matrix come its leading singular vectors (one
   pass, Nystrom form).
4. *Candidates.*  Passages and queries are projected; a passage is a candidate
   for an item at cosine ``COSINE`` with at least ``ENERGY`` of the length of one
   of its queries.
5. *Checks.*  Around a candidate passage the longest common subsequence of
   words with the item must cover ``COPIED`` of the item; from ``PARAPHRASED``
   on it does if the item's answer (its last sentence) is mostly there too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import words as wd
from sedimenta.llm.store import Store, column, rows_in

BLOCK = 24
STOP = 0.05
# Singular vectors for each query, and at most.
RANK = 1.0
MOST_RANK = 512
SPARE = 16
COSINE = 0.3
ENERGY = 0.25
COPIED = 0.8
PARAPHRASED = 0.6
ANSWERED = 0.5
# Queries are compared in groups of so many.
ITEMS = 4096
# Rows of tokens looked at together.
ROWS = 1024


class Lexicon:
    """Words of the benchmark that tell items apart.

    ``known`` are the sorted hashes, ``queries`` the word numbers of each query
    and ``item`` the item it is cut from.  Queries of an item have the length of
    a passage, start a block apart and reach its end.
    """

    def __init__(self, texts: list[str]):
        hashed = []
        for t in texts:
            data = np.frombuffer(t.encode("utf-8"), dtype=np.uint8)
            hashed.append(wd.Words(data, np.array([0, len(data)])).hashes(lower=True))
        seen = np.concatenate([np.unique(h) for h in hashed] or [np.zeros(0, np.uint64)])
        word, times = np.unique(seen, return_counts=True)
        common = word[times > max(2, STOP * len(texts))]
        rare = [~np.isin(h, common) for h in hashed]
        rare = [r if r.any() else ~r for r in rare]
        self.known = np.unique(np.concatenate([h[r] for h, r in zip(hashed, rare)] or [np.zeros(0, np.uint64)]))
        self.queries, self.item = [], []
        for i, (h, r) in enumerate(zip(hashed, rare)):
            last = max(0, len(h) - 2 * BLOCK)
            for at in [*range(0, last, BLOCK), last]:
                own = slice(at, at + 2 * BLOCK)
                if r[own].any():
                    self.queries.append(np.unique(np.searchsorted(self.known, h[own][r[own]])))
                    self.item.append(i)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for words outside."""
        if not len(self.known):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, at, -1)


def _tokens(batches, shared):
    lexicon = shared.value
    for batch in batches:
        for part, w in wd.slices(batch):
            number = lexicon.find(w.hashes(lower=True))
            hit = np.flatnonzero(number >= 0)
            doc = np.searchsorted(w.first, hit, side="right") - 1
            ends = np.searchsorted(doc, np.arange(len(w)), side="right")
            yield pa.RecordBatch.from_arrays([
                part.column(0), wd.lists((hit - w.first[doc]).astype(np.int32), ends, pa.int32()),
                wd.lists(number[hit].astype(np.int32), ends, pa.int32())], ["doc_id", "place", "word"])


def _by_block(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, block and word of every place of a batch in order, and the first
    place of each block."""
    places, numbers = batch.column(1), batch.column(2)
    size = np.diff(places.offsets.to_numpy())
    row = np.repeat(np.arange(batch.num_rows), size)
    block = places.flatten().to_numpy() // BLOCK
    word = numbers.flatten().to_numpy()
    if not len(row):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    fresh = np.concatenate(([True], (row[1:] != row[:-1]) | (block[1:] != block[:-1])))
    return row, block, word, np.flatnonzero(fresh)


def _lags(block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs within a block, by their distance; ``block`` are the
    sorted block numbers of the places."""
    far, lag = np.arange(len(block)), 0
    while len(far):
        lag += 1
        far = far[far >= lag]
        far = far[block[far] == block[far - lag]]
        yield far, far - lag


def _document_frequency(batches, n_words):
    total = np.zeros(n_words, dtype=np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            _, _, word, first = _by_block(batch.slice(at, ROWS))
            if len(word):
                again = np.zeros(len(word), dtype=bool)
                for here, there in _lags(np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))):
                    again[here] |= word[here] == word[there]
                total += np.bincount(word[~again], minlength=n_words)
    own = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(total[own])], ["word", "df"])


# Words whose rows of the sketch travel together.
CHUNK = 256
# Words whose pairs are counted in a table of 32 MB.
OFTEN = 2048
# Places multiplied at a time.
PLACES = 8192


def _runs(number: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PLACES`` places that cut no block."""
    low = 0
    while low < len(number):
        last = number[min(low + PLACES, len(number)) - 1]
        high = int(np.searchsorted(number, last, side="right"))
        yield low, high
        low = high


def _sums(rows: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of rows with equal numbers (sorted), and the numbers."""
    first = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
    return np.add.reduceat(rows, first, axis=0), number[first]


def _add_rows(total, scaled, word, place, number) -> None:
    all_words, blocks = _sums(scaled[word], number)
    other = place < 0
    seldom, _ = _sums(scaled[word[other]], number[other])
    at = np.searchsorted(blocks, number)
    rows = np.where(other[:, None], all_words[at], seldom[at])
    order = np.argsort(word, kind="stable")
    added, own = _sums(rows[order], word[order])
    total[own] += added


def _sketch(batches, shared):
    """This partition's part of A.T @ (A @ omega), in chunks of words.

    Pairs of the ``OFTEN`` most frequent words are counted and multiplied once
    at the end; only blocks with another word are multiplied one by one.
    """
    weight, omega = shared.value
    total = np.zeros(omega.shape, dtype=np.float64)
    scaled = (omega * weight[:, None]).astype(np.float32)
    often = np.argsort(weight, kind="stable")[:OFTEN]
    rank = np.full(len(weight), -1)
    rank[often] = np.arange(len(often))
    pairs = np.zeros(len(often) ** 2, dtype=np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            _, _, word, first = _by_block(batch.slice(at, ROWS))
            if not len(word):
                continue
            # A word counts as often as it stands in the block; the second weight comes last.
            number = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))
            place = rank[word]
            own, block = place[place >= 0], number[place >= 0]
            np.add.at(pairs, own * len(often) + own, 1)
            for here, there in _lags(block):
                np.add.at(pairs, own[here] * len(often) + own[there], 1)
                np.add.at(pairs, own[there] * len(often) + own[here], 1)
            seldom = np.zeros(len(first), dtype=bool)
            seldom[number[place < 0]] = True
            # In blocks with a seldom word: that word with all words, the others with it.
            word, place, number = word[seldom[number]], place[seldom[number]], number[seldom[number]]
            for low, high in _runs(number):
                _add_rows(total, scaled, word[low:high], place[low:high], number[low:high])
    total[often] += pairs.reshape(len(often), len(often)).astype(np.float32) @ scaled[often]
    total *= weight[:, None]
    chunks = [c for c in range(0, len(total), CHUNK) if total[c:c + CHUNK].any()]
    yield pa.RecordBatch.from_arrays([
        pa.array([c // CHUNK for c in chunks], pa.int32()), pa.array(range(len(chunks)), pa.int32()),
        pa.array([total[c:c + CHUNK].astype(np.float32).tobytes() for c in chunks], pa.binary())], ["chunk", "part", "z"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the chunks of one group, a batch at a time."""
    total = chunk = None
    for batch in batches:
        for c, z in zip(batch.column(0).to_pylist(), batch.column(2)):
            z = np.frombuffer(z.as_buffer(), dtype=np.float32).astype(np.float64)
            total, chunk = z if total is None else total + z, c
    yield pa.RecordBatch.from_arrays([
        pa.array([chunk], pa.int32()), pa.array([0], pa.int32()),
        pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["chunk", "part", "z"])


def _candidates(batches, shared):
    basis, most, queries, length, item_of = shared.value
    for batch in batches:
        doc, start, item, cosine = [], [], [], []
        for at in range(0, batch.num_rows, ROWS):
            row, block, word, first = _by_block(batch.slice(at, ROWS))
            if not len(word):
                continue
            r, b = row[first], block[first]
            # Passage i is block i and, where it follows, the next one.
            joined = np.zeros(len(first), dtype=bool)
            joined[:-1] = (r[1:] == r[:-1]) & (b[1:] == b[:-1] + 1)
            # No query can take a passage whose words add up to less; the others are projected.
            bound = np.add.reduceat(most[word], first)
            bound[:-1] += np.where(joined[:-1], bound[1:], 0)
            may = np.flatnonzero(bound >= ENERGY * 0.999)
            if not len(may):
                continue
            needed = np.zeros(len(first), dtype=bool)
            needed[may] = True
            needed[may[joined[may]] + 1] = True
            number = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))
            chosen = needed[number]
            own, blocks = _sums(basis[word[chosen]], number[chosen])
            passage = own[np.searchsorted(blocks, may)]
            passage[joined[may]] += own[np.searchsorted(blocks, may[joined[may]] + 1)]
            norm = np.sqrt((passage**2).sum(1))
            for low in range(0, len(queries), ITEMS):
                q, size = queries[low:low + ITEMS], length[low:low + ITEMS]
                dot = passage @ q.T
                fits = (dot >= COSINE * norm[:, None] * size) & (dot >= ENERGY * size**2) & (size > 0)
                p, i = np.nonzero(fits)
                doc.append(at + r[may[p]])
                start.append(b[may[p]] * BLOCK)
                item.append(item_of[low + i])
                cosine.append(dot[p, i] / (norm[p] * size[i]))
        if doc:
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.concatenate(doc))), pa.array(np.concatenate(item).astype(np.int32)),
                pa.array(np.concatenate(start).astype(np.int32)), pa.array(np.concatenate(cosine).astype(np.float64))],
                ["doc_id", "item", "start", "cosine"])


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def split_words(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_UPPER).split()


def answer(text: str) -> list[bytes]:
    """The last sentence or line of an item."""
    parts = [p for p in re.split(r"(?<=[.!?:])\s+|\n", text) if p.strip()]
    return split_words(parts[-1]) if parts else []


def _checked(batches, shared):
    items = [(split_words(t), answer(t)) for t in shared.value]
    for batch in batches:
        doc, item, share, told = [], [], [], []
        for i in range(batch.num_rows):
            words = split_words(batch.column(1)[i].as_py() or "")
            best: dict = {}
            for c in batch.column(2)[i].as_py():
                own, last = items[c["item"]]
                reach = max(BLOCK, len(own))
                context = words[max(0, c["start"] - reach):c["start"] + 2 * BLOCK + reach]
                value = common_subsequence(own, context) / len(own)
                if value < PARAPHRASED or value < best.get(c["item"], (0, 0))[0]:
                    continue
                answered = common_subsequence(last, context) / max(1, len(last))
                if value >= COPIED or answered >= ANSWERED:
                    best[c["item"]] = max(best.get(c["item"], (0, 0)), (value, answered))
            for k, (value, answered) in sorted(best.items()):
                doc.append(i)
                item.append(k)
                share.append(round(value, 6))
                told.append(round(answered, 6))
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(pa.array(doc, pa.int32())), pa.array(item, pa.int32()), pa.array(share, pa.float64()),
            pa.array(told, pa.float64())], ["doc_id", "item", "lcs_share", "answer_share"])


def _basis(tokens: DataFrame, lexicon: Lexicon, store: Store) -> tuple[np.ndarray, np.ndarray]:
    """Word weights times singular vectors, and the projected queries."""
    spark, n = tokens.sparkSession, len(lexicon.known)
    counted = tokens.mapInArrow(partial(_document_frequency, n_words=n), "word int, df long")
    counted = counted.groupBy("word").agg(F.sum("df").alias("df")).toPandas()
    df = np.ones(n)
    df[counted["word"].to_numpy()] = counted["df"].to_numpy()
    weight = 1 / np.sqrt(df)
    rank = min(n, MOST_RANK, int(RANK * len(lexicon.queries)) + SPARE)
    omega = np.random.Generator(np.random.PCG64(7)).standard_normal((n, min(n, rank + SPARE)))
    parts = tokens.mapInArrow(
        partial(_sketch, shared=spark.sparkContext.broadcast((weight, omega))), "chunk int, part int, z binary")
    parts = store.keep(parts.withColumn("part", F.pmod(F.xxhash64("z"), F.lit(64)).cast("int")))
    for keys in (["chunk", "part"], ["chunk"]):
        parts = parts.groupBy(*keys).applyInArrow(_add, "chunk int, part int, z binary")
    z = np.zeros(omega.shape)
    # One row per word of the benchmark.
    for row in parts.collect():
        block = np.frombuffer(bytes(row.z), dtype=np.float32).reshape(-1, omega.shape[1])
        z[row.chunk * CHUNK:row.chunk * CHUNK + len(block)] = block
    # G ~ Z (omega' Z)^-1 Z'; with a shift for stability.  Chunk by chunk: no second array of this size at a time.
    shift = 1e-6 * np.linalg.norm(z) + 1e-12
    for low in range(0, n, CHUNK):
        z[low:low + CHUNK] += shift * omega[low:low + CHUNK]
    core = omega.T @ z
    del omega
    value, side = np.linalg.eigh((core + core.T) / 2)
    good = value > value.max() * 1e-6
    turn = side[:, good] / np.sqrt(value[good])
    # Singular vectors of Z turn.  Its singular values span three decades at most, so their squares are exact enough.
    gram = turn.T @ (z.T @ z) @ turn
    value, side = np.linalg.eigh((gram + gram.T) / 2)
    value, side = value[::-1][:rank], side[:, ::-1][:, :rank]
    good = value > value[0] * 1e-12
    turn = turn @ (side[:, good] / np.sqrt(value[good]))
    basis = np.empty((n, turn.shape[1]), np.float32)
    for low in range(0, n, CHUNK):
        basis[low:low + CHUNK] = (z[low:low + CHUNK] @ turn) * weight[low:low + CHUNK, None]
    queries = np.stack([basis[q].sum(0) for q in lexicon.queries])
    return basis, queries


def _most(basis: np.ndarray, queries: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The largest part of its energy that a word can give to any query.

    A query takes a passage only with ``ENERGY`` of its squared length, and a
    passage is the sum of its words.
    """
    out = np.zeros(len(basis))
    own = length > 0
    queries = queries[own] / length[own][:, None] ** 2
    for low in range(0, len(queries), ITEMS):
        out = np.maximum(out, (basis @ queries[low:low + ITEMS].T).max(1))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, lcs_share, answer_share)`` for each document with an item.

    NULL and empty texts hold no item; items without words or ids are left
    out, equal ids with other texts are items of their own.  Rows without a
    ``doc_id`` are not reported; rows sharing one are reported together with
    the shares of the best passage.  Other columns are ignored.
    """
    spark = docs.sparkSession
    store = Store(spark, "latent")
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    texts = texts.filter("doc_id is not null")
    queries = benchmark.select(column(benchmark, "item_id", "long").alias("item_id"), column(benchmark, "text", "string").alias("text"))
    queries = queries.filter("item_id is not null and text is not null").distinct().orderBy("item_id", "text")
    queries = [(r.item_id, r.text) for r in queries.collect() if r.text.encode("utf-8").split()]
    out = "doc_id long, item_id long, lcs_share double, answer_share double"
    if not queries:
        return spark.createDataFrame([], out)
    lexicon = Lexicon([t for _, t in queries])
    tokens = store.keep(texts.mapInArrow(
        partial(_tokens, shared=spark.sparkContext.broadcast(lexicon)), "doc_id long, place array<int>, word array<int>"))
    basis, projected = _basis(tokens, lexicon, store)
    length = np.sqrt((projected**2).sum(1))
    shared = spark.sparkContext.broadcast((basis, _most(basis, projected, length), projected, length, np.array(lexicon.item)))
    found = store.keep(tokens.mapInArrow(
        partial(_candidates, shared=shared), "doc_id long, item int, start int, cosine double"))
    per_doc = store.keep(found.select("doc_id", "item", "start").distinct().groupBy("doc_id").agg(
        F.collect_list(F.struct("item", "start")).alias("found")))
    checked = rows_in(texts, per_doc).join(per_doc, "doc_id").select("doc_id", "text", "found").mapInArrow(
        partial(_checked, shared=spark.sparkContext.broadcast([t for _, t in queries])),
        "doc_id long, item int, lcs_share double, answer_share double")
    ids = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(queries)], "item int, item_id long")
    return checked.join(ids, "item").groupBy("doc_id", "item_id").agg(
        F.max(F.struct("lcs_share", "answer_share")).alias("best")).select("doc_id", "item_id", "best.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    found = leaks(docs, benchmark).select("doc_id").distinct()
    return rows_in(docs, Store(docs.sparkSession, "latent").keep(found), how="left_anti")
