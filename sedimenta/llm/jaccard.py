"""Operator 1: exact Jaccard join of word n-grams in a metric space.

Texts are the sets of their distinct ``k``-word shingles; two link when the
Jaccard similarity reaches ``num / den``.  On sets Jaccard distance and the
symmetric difference order partners alike: with ``d = |x ^ y|``, similarity t
is reached exactly when ``d * (1 + t) <= (1 - t) * (|x| + |y|)``, and then
``d <= D(x) = floor(|x| * (1 - t) / t)``.

1. *Copies* (equal sets) become one point.
2. *First regions.*  Unrelated texts are at distance 1 from every document, so
   the first pivot is the empty set.  Shingle space is cut by hash into more
   fragments than D allows changed shingles; linked points agree on a whole
   fragment, and a fragment's content is a region.  Points whose size window
   reaches into the next size class are replicated there.  At similarities
   below ``FRAGMENTS_FROM`` a region is a single shingle instead, and a point
   is replicated to its first ``|x| - ceil(t * |x|) + 1`` in an order that is
   the same for all points: a linked point lacks fewer of its shingles.  The
   order is that of the hashes, after ``ROUNDS`` corrections: shingles whose
   regions got more than ``OFTEN`` points (shared passages) go last, and the
   points that had them are replicated anew.  Regions of up to ``PAIRS``
   points are compared pairwise.
3. *Pivots.*  A larger region gets as pivot its most central member, the one
   that shares most regions with others.  All regions of one pivot form its
   cell; members that may be linked to it are compared with it.  Regions of at
   most ``leaf`` points whose members are still in several components are
   compared pairwise; in the cells of larger ones the exact distance of each
   member to the pivot is computed.
4. *Windows.*  Seen from its pivot p a point is the difference ``e = x ^ p``,
   and ``|e_x ^ e_y| = |x ^ y|``.  By the triangle inequality linked members
   whose differences are disjoint are both linked to p.  All others share one
   of the first ``D + 1`` elements of e in any order that is fixed for the
   cell: strange shingles before missing ones, those of most members last.
   Each member is replicated to the regions of these elements.
5. *Recursion.*  These regions get pivots in turn.  Cells whose members are
   all in one component are done; regions of at most ``leaf`` points are
   compared pairwise within the window ``|d(x,p) - d(y,p)| <= 1 - t``.

Sets are read for candidates only.  Two bounds of ``|x ^ y|`` come first: the
parities of the counts in 64 * ``PARITIES`` parts of shingle space, and these
counts in a number of parts that grows with the set.

Every level shortens a region at least by its pivot; after ``levels`` levels
the rest is compared pairwise, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm import words as wd
from sedimenta.llm.graph import components, extended
from sedimenta.llm.store import Store, column, rows_in

# Below this similarity fragments get short and many: single shingles name the first regions.
FRAGMENTS_FROM = (85, 100)
# Shingles of larger regions go last in the order, in so many rounds.  The order steers work, never the
# result: of more than MAX_LATE such shingles (8 MB) those of the largest regions go last.
OFTEN, ROUNDS, MAX_LATE = 64, 3, 1_000_000
# Regions of so many points are compared pairwise at once.
PAIRS = 8
# Frequent elements of a cell that are put last, at most.
SLACK = 4
# Parities of counts in parts of shingle space, in words of 64 bits.
PARITIES = 8
# Counts are kept of a power of two of parts, at least so many, with at most PER_PART shingles each in the mean.
COUNTED, PER_PART = 64, 8
# Broadcast up to so many pairs, and sets of so many elements in all (32 MB each).
MAX_BROADCAST_PAIRS, MAX_BROADCAST_ELEMENTS = 1_000_000, 4_000_000
_SALT = np.uint64(0x8CB92BA72F3D8DD7)


def size_classes(num: int, den: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower bounds of the size classes up to ``upto`` and the fragments of each."""
    first = next(n for n in range(1, 10**9) if n * (den - num) // num >= 1) if num < den else upto + 1
    bounds, parts = [1], []
    while bounds[-1] <= upto:
        top = first if bounds[-1] < first else max(bounds[-1] + 1, bounds[-1] * 3 // 2)
        most = (top - 1) * (den - num) // num
        parts.append(most + most // 20 + (3 if most else 1))
        bounds.append(top)
    return np.array(bounds[:-1]), np.array(parts)


def _document_sets(w: wd.Words, k: int) -> Iterator[np.ndarray]:
    h = w.hashes(lower=True)
    grams = wd.window_hashes(h, k)
    for a, b in zip(w.first[:-1], w.first[1:]):
        if b - a >= k:
            yield np.unique(grams[a:b - k + 1])
        elif b > a:
            own = h[a:b] * wd.powers(_SALT, k + 1)[:b - a]
            yield wd.mix(np.array([own.sum(dtype=np.uint64) + np.uint64(b - a)]))
        else:
            yield np.zeros(0, np.uint64)


def _first(s: np.ndarray, num: int, den: int, late: np.ndarray) -> np.ndarray:
    """The first shingles of a set: by hash, those in the sorted ``late`` last."""
    if len(late):
        is_late = late[np.minimum(np.searchsorted(late, s), len(late) - 1)] == s
        s = np.concatenate((s[~is_late], s[is_late]))
    return s[:len(s) + 1 - -(-len(s) * num // den)]


def _by_shingles(num: int, den: int) -> bool:
    return num * FRAGMENTS_FROM[1] < den * FRAGMENTS_FROM[0]


def _signatures(s: np.ndarray, num: int, den: int, known: dict) -> np.ndarray:
    """Region keys of one set: a hash of each fragment that holds shingles, or
    its first shingles."""
    n = len(s)
    if n == 0:
        return s
    if _by_shingles(num, den):
        return _first(s, num, den, s[:0])
    most = n * (den - num) // num
    if known.get("upto", 0) < n:
        known["upto"] = 2 * n
        known["bounds"], known["parts"] = size_classes(num, den, 2 * n)
    low = np.searchsorted(known["bounds"], [-(-n * num // den), n], side="right") - 1
    out, spread = [], wd.mix(s)
    for c in range(low[0], low[1] + 1):
        parts = known["parts"][c]
        which = (s % np.uint64(parts)).astype(np.int64)
        order = np.argsort(which, kind="stable")
        which = which[order]
        begin = np.concatenate(([0], np.flatnonzero(which[1:] != which[:-1]) + 1))
        total = np.add.reduceat(spread[order], begin)
        label = which[begin].astype(np.uint64) * _SALT + np.uint64(parts)
        out.append(wd.mix(total ^ wd.mix(label)))
        if len(begin) <= most:
            # So few fragments hold shingles that only empty ones may agree: then these are regions too.
            empty = np.setdiff1d(np.arange(parts), which).astype(np.uint64)
            out.append(wd.mix(wd.mix(empty * _SALT + np.uint64(parts))))
    return np.concatenate(out)


def _parities(s: np.ndarray) -> np.ndarray:
    odd = np.bincount((s >> np.uint64(40)).astype(np.int64) % (64 * PARITIES), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _counts(s: np.ndarray) -> np.ndarray:
    parts = COUNTED
    while parts * PER_PART < len(s):
        parts *= 2
    return np.bincount((s >> np.uint64(20)).astype(np.int64) % parts, minlength=parts).astype(np.int32)


def _fingerprints(batches, k: int, num: int, den: int):
    known: dict = {}
    for batch in batches:
        for part, w in wd.slices(batch):
            size, one, two, sigs, odd, counts = [], [], [], [], [], []
            for s in _document_sets(w, k):
                size.append(len(s))
                one.append(wd.mix(s).sum(dtype=np.uint64))
                two.append(wd.mix(s ^ _SALT).sum(dtype=np.uint64))
                sigs.append(_signatures(s, num, den, known))
                odd.append(_parities(s))
                counts.append(_counts(s))
            ends = np.cumsum([len(x) for x in sigs])
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(size, pa.int64()),
                pa.array(wd.signed(np.array(one, np.uint64))), pa.array(wd.signed(np.array(two, np.uint64))),
                wd.lists(wd.signed(np.concatenate(sigs)), ends, pa.int64()),
                wd.lists(np.concatenate(odd), PARITIES * np.arange(1, len(odd) + 1), pa.int64()),
                wd.lists(np.concatenate(counts), np.cumsum([len(x) for x in counts]), pa.int32()),
            ], ["doc_id", "n", "h1", "h2", "sigs", "b", "v"])


def _later(batches, k: int, num: int, den: int, late: np.ndarray):
    """Region keys in the order that has ``late`` last."""
    for batch in batches:
        for part, w in wd.slices(batch):
            found = list(_document_sets(w, k))
            sigs = [_first(s, num, den, late) if len(s) else s for s in found]
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([len(s) for s in found], pa.int64()),
                pa.array(wd.signed(np.array([wd.mix(s).sum(dtype=np.uint64) for s in found], np.uint64))),
                wd.lists(wd.signed(np.concatenate(sigs)), np.cumsum([len(x) for x in sigs]), pa.int64()),
            ], ["doc_id", "n", "h1", "sigs"])


def _sets(batches, k: int):
    for batch in batches:
        for part, w in wd.slices(batch):
            found = list(_document_sets(w, k))
            ends = np.cumsum([len(x) for x in found])
            one = np.array([wd.mix(s).sum(dtype=np.uint64) for s in found], np.uint64)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(wd.signed(one)), wd.lists(wd.signed(np.concatenate(found)), ends, pa.int64()),
                pa.array([len(s) for s in found], pa.int64())], ["id", "h1", "s", "m"])


def _measure(pairs: DataFrame, sets: DataFrame, store: Store, num: int, den: int, differences: bool = False) -> DataFrame:
    """Whether ``(p, x)`` link, their exact distance and, if asked for, the first
    elements of the difference."""
    # Few pairs go to the sets of x and few small sets of p to both; otherwise these are shuffled.
    few = pairs.limit(MAX_BROADCAST_PAIRS + 1).count() <= MAX_BROADCAST_PAIRS
    both = sets.select(F.col("id").alias("x"), F.col("s").alias("sx")).join(F.broadcast(pairs) if few else pairs, "x")
    heads = store.keep(pairs.select("p").distinct())
    other = rows_in(sets.select(F.col("id").alias("p"), F.col("s").alias("sp"), "m"), heads, "p", unique=True)
    small = (other.agg(F.sum("m")).first()[0] or 0) <= MAX_BROADCAST_ELEMENTS
    both = both.join(F.broadcast(other.drop("m")) if small else other.drop("m"), "p")
    total = F.size("sx") + F.size("sp")
    if differences:
        both = both.withColumn("e", F.concat(F.array_except("sx", "sp"), F.array_except("sp", "sx")))
        d = F.size("e")
    else:
        d = total - 2 * F.size(F.array_intersect("sx", "sp"))
    return both.select(
        "p", "x", (d * F.lit(den + num) <= total * F.lit(den - num)).alias("linked"),
        (2.0 * d / (total + d)).alias("far"), *([F.slice("e", F.lit(1), _most(F.size("sx"), num, den) + SLACK).alias("e")] if differences else []))


def _most(n, num: int, den: int):
    """Elements of a difference that name regions."""
    return F.floor(n * F.lit(den - num) / F.lit(num)).cast("int") + 1


def _near(n, m, num: int, den: int):
    return F.least(n, m) * F.lit(den) >= F.greatest(n, m) * F.lit(num)


def _odd(b, c, n, m, num: int, den: int):
    """Not ruled out by the parities: an odd difference of counts is a difference."""
    apart = sum(F.bit_count(b[i].bitwiseXOR(c[i])) for i in range(PARITIES))
    return apart * F.lit(den + num) <= (n + m) * F.lit(den - num)


def _may(v, w, n, m, num: int, den: int):
    """Not ruled out by the counts: a point's distances to the parts of shingle
    space, taken as pivots, differ in all by no more than the points do."""
    def halved(a, b):
        half = F.size(b)
        twice = F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda p, q: p + q)
        return F.when(F.size(a) == 2 * half, twice).otherwise(a)

    apart = F.aggregate(F.zip_with(halved(v, w), halved(w, v), lambda p, q: F.abs(p - q)), F.lit(0), lambda t, a: t + a)
    # Other numbers of parts leave the sum without value: then nothing is ruled out.
    return F.coalesce(apart * F.lit(den + num) <= (n + m) * F.lit(den - num), F.lit(True))


def _candidates(pairs: DataFrame, counts: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``(p, x)`` that the counts do not rule out."""
    # The second test begins where the first ends: pairs that lie by x are not dealt anew for it.
    for name, test, first, then in (("b", _odd, "p", "x"), ("v", _may, "x", "p")):
        one = counts.select(F.col("x").alias(first), F.col(name).alias("one"), F.col("m").alias("o"))
        both = pairs.join(one, first).join(counts.select(F.col("x").alias(then), F.col(name).alias("two"), "m"), then)
        pairs = both.filter(_near(F.col("o"), F.col("m"), num, den)).filter(
            test(F.col("one"), F.col("two"), F.col("o"), F.col("m"), num, den)).select("p", "x")
    return pairs


def _links(measured: DataFrame) -> DataFrame:
    return measured.filter("linked").select(F.col("p").alias("a"), F.col("x").alias("b"))


def near_components(
    docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, leaf: int = 512, levels: int = 4
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs(doc_id, text)``.

    Words are ``[^\\x20\\x09-\\x0D]+`` after folding A-Z.  A text with fewer than
    ``k`` words is one shingle; one without words (or NULL) has none and links
    to nothing, not even to other empty texts.  A ``doc_id`` stands for one
    text: where rows repeat it with other texts, the one with the fewest
    shingles speaks for it (of these the one with the smallest hash).  A row without a ``doc_id`` keeps its count, has no
    component and links nothing.  Equal rows give equal rows.  Columns other
    than the two are ignored.  Shingles are 64-bit hashes; copies are told by
    128 bits and the size.
    """
    store = Store(docs.sparkSession, "jaccard")
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    base = store.keep(texts.mapInArrow(
        partial(_fingerprints, k=k, num=num, den=den), "doc_id long, n long, h1 long, h2 long, sigs array<long>, b array<long>, v array<int>"))
    points = base.filter("n > 0 and doc_id is not null")
    own = points.groupBy("doc_id").agg(F.min(F.struct("n", "h1", "h2")).alias("f"))
    copies = own.groupBy("f").agg(F.min("doc_id").alias("rep"))
    classes = store.keep(own.join(copies, "f").select("doc_id", "rep", "f.n", "f.h1", "f.h2"))
    reps = classes.filter("doc_id = rep").select("doc_id", "n", "h1", "h2")
    # Kept: each round and the regions read it several times.
    signed = [store.keep(points.join(reps, ["doc_id", "n", "h1", "h2"], "left_semi").select("doc_id", "n", "sigs"))]
    late = np.zeros(0, np.int64)

    def keyed_rows() -> DataFrame:
        return reduce(DataFrame.union, signed).select(F.explode("sigs").alias("key"), F.col("doc_id").alias("x"), "n")

    for _ in range(ROUNDS if _by_shingles(num, den) else 0):
        # Points none of whose keys moved have the same first shingles in the new order.
        often = keyed_rows().groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > OFTEN)
        known = docs.sparkSession.createDataFrame(pa.table({"key": late}))
        often = store.keep(often.join(F.broadcast(known), "key", "left_anti").select("key", F.floor(F.log2("size")).alias("level")))
        sizes = often.groupBy("level").agg(F.count(F.lit(1)).alias("keys"))
        # One entry per power of two.
        levels_found = sizes.agg(F.map_from_entries(F.collect_list(F.struct("level", "keys")))).first()[0]
        fitting = [v for v in levels_found if sum(c for u, c in levels_found.items() if u >= v) <= MAX_LATE - len(late)]
        if not fitting:
            break
        often = often.filter(F.col("level") >= min(fitting)).select("key")
        late = np.concatenate((late, often.toArrow().column("key").to_numpy()))
        moved = store.keep(keyed_rows().join(F.broadcast(often), "key").select(F.col("x").alias("doc_id")).distinct())
        again = rows_in(texts, moved, unique=True).mapInArrow(
            partial(_later, k=k, num=num, den=den, late=np.sort(wd.unsigned(late))), "doc_id long, n long, h1 long, sigs array<long>")
        again = store.keep(again.join(reps, ["doc_id", "n", "h1"], "left_semi").select("doc_id", "n", "sigs"))
        signed = [*(rows_in(part, moved, how="left_anti", unique=True) for part in signed), again]
    rows = keyed_rows()
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    regions = store.keep(rows.join(shared, "key").select("key", "x", "n", "size"))
    score = store.keep(regions.groupBy("x").agg(F.sum("size").alias("score")))
    counts = store.keep(points.join(score.select(F.col("x").alias("doc_id")), "doc_id", "left_semi").join(
        reps, ["doc_id", "n", "h1", "h2"], "left_semi").dropDuplicates(["doc_id"]).select(
        F.col("doc_id").alias("x"), F.col("n").alias("m"), "b", "v"))

    def sets_of(*ids) -> DataFrame:
        wanted = store.keep(reduce(DataFrame.union, [d.select(F.col(c).alias("doc_id")) for d, c in ids]).distinct())
        found = store.keep(rows_in(texts, wanted, unique=True).mapInArrow(partial(_sets, k=k), "id long, h1 long, s array<long>, m long"))
        if found.groupBy("id").count().filter("count > 1").isEmpty():
            return found
        return found.join(reps.select(F.col("doc_id").alias("id"), "h1"), ["id", "h1"], "left_semi").dropDuplicates(["id"])

    # Small regions pairwise, larger ones from their pivots.
    wide = regions.filter(F.col("size") > PAIRS)
    pivots = store.keep(wide.join(score, "x").groupBy("key").agg(F.max(F.struct("score", "x")).alias("m")).select(
        "key", F.col("m.x").alias("p")))
    small = regions.filter(F.col("size") <= PAIRS).drop("size")
    pairs = small.alias("l").join(small.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.x") < F.col("r.x"))
                                  & _near(F.col("l.n"), F.col("r.n"), num, den))
    pairs = pairs.select(F.col("l.x").alias("p"), F.col("r.x").alias("x")).union(
        wide.join(pivots, "key").filter("x <> p").select("p", "x")).distinct()
    pairs = store.keep(_candidates(pairs, counts, num, den))
    done = store.keep(_measure(pairs, sets_of((pairs, "p"), (pairs, "x")), store, num, den))
    comp, done = store.keep(components(_links(done), store)), done.select("p", "x")

    # Regions whose members are not all in one component go on: up to ``leaf`` points pairwise, others as cells.
    placed = wide.join(comp.withColumnRenamed("node", "x"), "x", "left").withColumn("c", F.coalesce("component", "x"))
    split = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key")
    placed = store.keep(placed.join(split, "key").select("key", "x", "n", "size", "c"))
    middle = placed.filter(F.col("size") <= leaf).join(counts.select("x", "b"), "x")
    pairs = middle.alias("l").join(
        middle.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.x") < F.col("r.x")) & (F.col("l.c") != F.col("r.c"))
        & _near(F.col("l.n"), F.col("r.n"), num, den)
        & _odd(F.col("l.b"), F.col("r.b"), F.col("l.n"), F.col("r.n"), num, den))
    pairs = pairs.select(F.col("l.x").alias("p"), F.col("r.x").alias("x")).distinct().join(done, ["p", "x"], "left_anti")
    pairs = store.keep(_candidates(pairs, counts, num, den))
    leaves = store.keep(_measure(pairs, sets_of((pairs, "p"), (pairs, "x")), store, num, den))
    links, done = _links(leaves), done.union(leaves.select("p", "x"))
    cells = store.keep(placed.filter(F.col("size") > leaf).join(pivots, "key").select("p", "x", "n").distinct())
    sets = sets_of((cells, "p"), (cells, "x"))
    for level in range(levels + 1):
        if cells.isEmpty():
            break
        stars = store.keep(_measure(cells.filter("x <> p").select("p", "x"), sets, store, num, den, differences=True))
        comp, done = extended(comp, links.union(_links(stars)), store), done.union(stars.select("p", "x"))
        # Cells with more than one component among their members go on.
        members = stars.join(cells, ["p", "x"]).join(comp.withColumnRenamed("node", "x"), "x", "left").select(
            "p", "x", "n", "far", "e", F.coalesce("component", "x").alias("c"))
        split = members.groupBy("p").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("p")
        most = _most(F.col("n"), num, den)
        seen = store.keep(members.join(split, "p").select(
            "p", "x", "n", "far", "c", F.posexplode("e").alias("at", "e")))
        # Elements of most members are strange to the pivot, not to them: up to SLACK of a cell go last.
        often = seen.groupBy("p", "e").agg(F.count(F.lit(1)).alias("f"))
        whole = seen.groupBy("p").agg(F.countDistinct("x").alias("size"))
        often = often.filter(F.col("f") > PAIRS).join(whole, "p").filter("2 * f > size").select("p", "e")
        short = often.groupBy("p").count().filter(F.col("count") <= SLACK).select("p")
        often = often.join(short, "p").withColumn("last", F.lit(1))
        rank = F.row_number().over(Window.partitionBy("p", "x").orderBy(F.coalesce("last", F.lit(0)), "at"))
        keyed = store.keep(seen.join(often, ["p", "e"], "left").withColumn("rank", rank).filter(
            F.col("rank") <= most).select("p", "e", "x", "n", "far", "c"))
        found = keyed.join(score, "x").groupBy("p", "e").agg(
            F.max(F.struct("score", "x")).alias("m"), F.count(F.lit(1)).alias("size"), F.min("c").alias("lo"), F.max("c").alias("hi"))
        inside = store.keep(keyed.join(
            found.filter("lo < hi").select("p", "e", F.col("m.x").alias("q"), "size"), ["p", "e"]))
        small = (inside if level == levels else inside.filter(F.col("size") <= leaf)).join(counts.select("x", "b"), "x")
        pairs = small.alias("l").join(
            small.alias("r"),
            (F.col("l.p") == F.col("r.p")) & (F.col("l.e") == F.col("r.e")) & (F.col("l.x") < F.col("r.x"))
            & (F.col("l.c") != F.col("r.c")) & _near(F.col("l.n"), F.col("r.n"), num, den)
            & _odd(F.col("l.b"), F.col("r.b"), F.col("l.n"), F.col("r.n"), num, den)
            & (F.abs(F.col("l.far") - F.col("r.far")) <= F.lit((den - num) / den + 1e-9)))
        pairs = pairs.select(F.col("l.x").alias("p"), F.col("r.x").alias("x")).distinct().join(done, ["p", "x"], "left_anti")
        pairs = store.keep(_candidates(pairs, counts, num, den))
        leaves = store.keep(_measure(pairs, sets, store, num, den))
        links, done = _links(leaves), done.union(leaves.select("p", "x"))
        if level == levels:
            break
        cells = store.keep(inside.filter(F.col("size") > leaf).select(F.col("q").alias("p"), "x", "n").distinct())
    comp = extended(comp, links, store)
    labels = classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", F.coalesce("component", "rep").alias("component_id"))
    return base.select("doc_id", "n").join(labels, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Documents without near copies: of each component the smallest doc_id stays.

    Texts without words and rows without a ``doc_id`` stay.
    """
    found = near_components(docs, k, num, den).select("doc_id", "component_id").distinct()
    found = found.filter("doc_id <> component_id").select("doc_id")
    return rows_in(docs, Store(docs.sparkSession, "jaccard").keep(found), how="left_anti")


