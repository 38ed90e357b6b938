"""Operator 13: alignment of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes.  Every token points to the overlapping
token of the other side that reaches furthest right; the pointers of all tokens
at hand are doubled (``p = p[p]``) until they stand still, which takes as many
rounds as the logarithm of the longest chain.  A pointer then names the last
token of its group, the first place where both sides end together.

Both sides start a new token at a single space between two other characters:
the byte-level pattern begins a word there, and no piece has the space mark
behind another character.  So a text is a sequence of segments that no group
crosses; a worker encodes and aligns many different segments at once and
remembers what they hold.

Counts of linked id pairs over the corpus take two more passes over the stored
links, not over texts.  Frequent pairs, at most ``KNOWN``, are sent to the
workers; the links of all other pairs meet their counts in a join, where no
key is frequent.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import partial
from itertools import accumulate
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import Store, column
from sedimenta.llm.words import lists

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Text that a worker encodes and aligns at a time; one longer text is taken alone.
SLICE_BYTES = 1 << 20
# Different segments a worker remembers, and their links; beyond either it starts over.
REMEMBERED = 500_000
REMEMBERED_LINKS = 8_000_000
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Pairs whose counts are sent to every worker (17 bytes each).
KNOWN = 500_000


def byte_of() -> dict[str, int]:
    """The byte that a character stands for in a byte-level vocabulary: visible
    Latin-1 characters stand for themselves, the other bytes for U+0100 and up."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, byte_level: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        of = byte_of()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace(MARK, " ").encode() for i in range(self.b.get_piece_size())]
        size = lambda known: np.array([len(x) for x in known], np.int64)
        text = lambda known, *ends: [np.array([b"%d" % i + e for i in range(len(known))], object) for e in ends]
        self.a_size, self.b_size = size(self.a_bytes), size(self.b_bytes)
        self.a_text, self.b_text = text(self.a_bytes, b",", b"|"), text(self.b_bytes, b",", b";", b"")

        self.cuts = not any(MARK in self.b.id_to_piece(i).lstrip(MARK) for i in range(len(self.b_bytes)))
        self._forget()

    def _forget(self):
        self.number: dict[str, int] = {}  # of a segment
        self.text: list[bytes] = []  # its groups
        # Per segment: tokens of A and B, groups, links, and whether both sides give back its bytes.
        self.counts = np.zeros((0, 5), np.int64)
        self.pairs = np.zeros(0, np.int64)  # links of all segments as codes of id pairs

    def segments(self, text: str | None) -> list[str]:
        """The text with a space in front, cut before single spaces; the space
        that every segment begins with is left out."""
        if not text:
            return []
        first, *rest = _CUT.split(" " + text) if self.cuts else [" " + text]
        return [first[1:], *rest]

    def learn(self, new: list[str]) -> None:
        """Encode and align different segments."""
        one = [e.ids for e in self.a.encode_batch([" " + s for s in new], add_special_tokens=False)]
        two = self.b.encode(new, num_threads=1)
        whole = [b" " + s.encode() for s in new]
        ok = np.ones(len(new), bool)
        if not all(b"".join([of[i] for ids in side for i in ids]) == b"".join(whole) for side, of in ((one, self.a_bytes), (two, self.b_bytes))):
            ok[:] = [b"".join(map(self.a_bytes.__getitem__, a)) == w == b"".join(map(self.b_bytes.__getitem__, b)) for a, b, w in zip(one, two, whole)]
        size = np.array([len(w) for w in whole])
        for ids, of in ((one, self.a_size), (two, self.b_size)):  # equal as a whole, but not segment by segment
            flat, many = np.array([i for x in ids for i in x], np.int64), np.array([len(x) for x in ids])
            ends = np.concatenate(([0], np.cumsum(of[flat])))[np.cumsum(many)]
            ok &= np.diff(ends, prepend=0) == size
        one, two = ([x if k else [] for x, k in zip(side, ok)] for side in (one, two))
        n_a, n_b = np.array([len(x) for x in one]), np.array([len(x) for x in two])
        a, b = (np.array([i for x in side for i in x], np.int64) for side in (one, two))
        n_groups, n_links, text = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64), [b""] * len(new)
        if len(a):
            a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            label = groups(a_end, b_end)
            x, y = links(a_end, b_end)
            own = np.repeat(np.arange(len(new)), n_a)
            n_links = np.bincount(own[x], minlength=len(new))
            last = np.flatnonzero(label[:len(a)] == np.arange(len(a)))
            n_groups = np.bincount(own[last], minlength=len(new))
            text = _written(self, a, b, label, last, n_a, n_b)
            self.pairs = np.concatenate((self.pairs, a[x] * len(self.b_size) + b[y]))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.text += text
        self.counts = np.concatenate((self.counts, np.stack((n_a, n_b, n_groups, n_links, ok), 1)))

    def look_up(self, texts: list[str | None]) -> list[np.ndarray]:
        """Numbers of the segments of every text; none where a side's bytes differ from the text."""
        if len(self.number) > REMEMBERED or len(self.pairs) > REMEMBERED_LINKS:
            self._forget()
        parts = [self.segments(t) for t in texts]
        new = list(dict.fromkeys(s for p in parts for s in p if s not in self.number))
        if new:
            self.learn(new)
        out = [np.array([self.number[s] for s in p], np.int64) for p in parts]
        for i, at in enumerate(out):
            if not self.counts[at, 4].all():
                # A piece that differs: the text as a whole decides.
                if texts[i] not in self.number:
                    self.learn([texts[i]])
                at = np.array([self.number[texts[i]]])
                out[i] = at if self.counts[at[0], 4] else at[:0]
        return out


def groups(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Per token (all of A, then all of B) the last A token of its group.

    ``a_end`` and ``b_end`` are the rising byte ends of two cuts of the same bytes.
    """
    n = len(a_end)
    right = np.searchsorted(b_end, a_end)
    p = np.where(b_end[right] > a_end, n + right, np.arange(n))
    p = np.concatenate((p, np.searchsorted(a_end, b_end)))
    while True:
        further = p[p]
        if np.array_equal(further, p):
            return p
        p = further


def links(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping token pairs, as places in A and in B."""
    start = np.concatenate(([0], a_end[:-1]))
    first = np.searchsorted(b_end, start, side="right")
    many = np.searchsorted(b_end, a_end) - first + 1
    a = np.repeat(np.arange(len(a_end)), many)
    within = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)
    return a, first[a] + within


def _written(pair: Pair, a: np.ndarray, b: np.ndarray, label: np.ndarray, last: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> list[bytes]:
    """The groups of every segment, as ``a1,a2|b1;a3|b2``."""
    group = np.searchsorted(last, label)
    a_in, b_in = np.bincount(group[:len(a)], minlength=len(last)), np.bincount(group[len(a):], minlength=len(last))
    b_before, a_upto = np.cumsum(b_in) - b_in, np.cumsum(a_in)
    out = np.empty(len(label), object)
    text = pair.a_text[0][a]
    text[last] = pair.a_text[1][a[last]]
    out[np.arange(len(a)) + b_before[group[:len(a)]]] = text
    text, ends = pair.b_text[0][b], np.cumsum(b_in) - 1
    text[ends] = pair.b_text[1][b[ends]]
    stop = np.cumsum(n_b)[n_b > 0] - 1  # last tokens of segments
    text[stop] = pair.b_text[2][b[stop]]
    out[np.arange(len(b)) + a_upto[group[len(a):]]] = text
    out, at = out.tolist(), [0, *accumulate((n_a + n_b).tolist())]
    return [b"".join(out[x:y]) for x, y in zip(at, at[1:])]


def aligned(pair: Pair, ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    """One row per text with its digest columns and its distinct linked id pairs."""
    found = pair.look_up(texts)
    many = np.array([len(f) for f in found], np.int64)
    at, doc = np.concatenate(found), np.repeat(np.arange(len(texts)), many)
    digests = [hashlib.sha256(b";".join([pair.text[i] for i in f.tolist()])).hexdigest() if len(f) else "" for f in found]
    sums = [np.bincount(doc, weights=pair.counts[at, k], minlength=len(texts)).astype(np.int64) for k in range(4)]
    size = pair.counts[at, 3]
    start = (np.cumsum(pair.counts[:, 3]) - pair.counts[:, 3])[at]
    code = pair.pairs[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
    all_pairs = len(pair.a_size) * len(pair.b_size)
    key = np.sort(np.repeat(doc, size) * all_pairs + code)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    times, key = np.diff(first, append=len(key)), key[first]
    code, ends = key % all_pairs, np.cumsum(np.bincount(key // all_pairs, minlength=len(texts)))
    return pa.RecordBatch.from_arrays(
        [ids, *map(pa.array, sums), pa.array(digests, pa.string()),
         lists((code // len(pair.b_size)).astype(np.int32), ends, pa.int32()), lists((code % len(pair.b_size)).astype(np.int32), ends, pa.int32()),
         lists(times.astype(np.int32), ends, pa.int32())],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "times"])


_pairs: dict = {}


def _align(batches, shared):
    byte_level, pieces, mark = shared.value
    pair = _pairs.get(mark)
    if pair is None:
        pair = _pairs[mark] = Pair(byte_level, pieces)
    for batch in batches:
        texts = batch.column(1).fill_null("").to_pylist()
        at = 0
        while at < len(texts):
            upto, total = at, 0
            while upto < len(texts) and (upto == at or total + len(texts[upto]) <= SLICE_BYTES):
                total += len(texts[upto])
                upto += 1
            yield aligned(pair, batch.column(0).slice(at, upto - at), texts[at:upto])
            at = upto


def _flat(batch: pa.RecordBatch, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair codes and times of a batch of links, and how many pairs every row has."""
    a, b, times = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "times"))
    value = lambda c: c.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    many = np.diff(a.offsets.to_numpy()) if len(a) else np.zeros(0, np.int64)
    return value(a) * b_size + value(b), value(times), many


def _sums(batches, b_size):
    """Times per pair, summed over a batch before Spark sums over all."""
    for batch in batches:
        code, times, _ = _flat(batch, b_size)
        found, inverse = np.unique(code, return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, inverse, times)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total)], ["code", "n"])


def _score(batches, shared, b_size):
    """Sums over links of known pairs; the other pairs stay as lists."""
    known, n, best = shared.value
    for batch in batches:
        code, times, many = _flat(batch, b_size)
        row = np.repeat(np.arange(len(many)), many)
        at = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
        hit = known[at] == code if len(known) else np.zeros(len(code), bool)
        sums = []
        for value in (best, n):
            total = np.zeros(len(many), np.int64)
            np.add.at(total, row[hit], times[hit] * value[at[hit]])
            sums.append(pa.array(total))
        ends = np.cumsum(np.bincount(row[~hit], minlength=len(many)))
        rest = [lists(code[~hit], ends, pa.int64()), lists(times[~hit], ends, pa.int64())]
        kept = [batch.column(batch.schema.get_field_index(c)) for c in ("row", *HEAD)]
        yield pa.RecordBatch.from_arrays([*kept, *sums, *rest], ["row", *HEAD, "n_best", "count_sum", "code", "times"])


HEAD = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
HEAD_TYPES = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def alignment(docs: DataFrame, byte_level: str = BYTE_BPE, pieces: str = PIECE_BPE, known: int = KNOWN) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``
    per row of ``docs(doc_id, text)``.

    A text that is NULL, empty or not given back byte by byte by both sides has
    zeros and an empty digest.  Every row counts, repeated rows and NULL ids
    too; other columns are ignored.  The files are read by the driver and sent
    to the workers.  A worker holds ``SLICE_BYTES`` of text with its tokens, or
    one longer text; some 400 bytes of memory go per token of it.
    """
    spark = docs.sparkSession
    store = Store(spark, "alignment")
    data = Path(byte_level).read_text(encoding="utf-8"), Path(pieces).read_bytes()
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_proto=data[1]).get_piece_size()
    shared = spark.sparkContext.broadcast((*data, hashlib.sha256(data[0].encode() + data[1]).hexdigest()))
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    linked = texts.mapInArrow(partial(_align, shared=shared), HEAD_TYPES + ", a array<int>, b array<int>, times array<int>")
    linked = store.keep(linked.withColumn("row", F.monotonically_increasing_id()))
    shared.unpersist()

    sums = linked.select("a", "b", "times").mapInArrow(partial(_sums, b_size=b_size), "code long, n long")
    counts = store.keep(sums.groupBy("code").agg(F.sum("n").alias("n")))
    # One row per id of B at most.
    top = counts.groupBy(F.pmod("code", F.lit(b_size)).alias("b")).agg(F.max("n").alias("top"))
    counts = store.keep(counts.join(F.broadcast(top), F.pmod("code", F.lit(b_size)) == F.col("b")).select(
        "code", "n", (F.col("n") == F.col("top")).alias("best")))
    floor = _frequent(counts, known)
    often = counts.filter(F.col("n") >= floor).toArrow()
    order = np.argsort(code := often.column("code").to_numpy())
    value = [often.column(c).to_numpy(zero_copy_only=False)[order].astype(np.int64) for c in ("n", "best")]
    shared = spark.sparkContext.broadcast((code[order], *value))
    scored = store.keep(linked.mapInArrow(
        partial(_score, shared=shared, b_size=b_size), f"row long, {HEAD_TYPES}, n_best long, count_sum long, code array<long>, times array<long>"))
    shared.unpersist()

    rest = scored.filter("size(code) > 0").select("row", F.explode(F.arrays_zip("code", "times")).alias("x")).select("row", "x.code", "x.times")
    rest = rest.join(counts.filter(F.col("n") < floor), "code").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    out = scored.select("row", *HEAD, "n_best", "count_sum").join(rest, "row", "left")
    return out.select(
        *HEAD[:-1], (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")


def _frequent(counts: DataFrame, most: int) -> int:
    """The smallest power of two that at most ``most`` pairs reach."""
    level = F.floor(F.log2("n")).cast("int").alias("level")
    sizes = counts.groupBy(level).agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.agg(F.map_from_entries(F.collect_list(F.struct("level", "size")))).first()[0]  # one entry per power of two
    floor, total = max(sizes, default=0) + 1, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        floor = at
    return 1 << floor
