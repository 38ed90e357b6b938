"""Operator 12: embedding near-duplicates by an inverted multi-index.

Vectors are cut in two halves, each with its own codebook; the pairs of
codewords are the cells of a grid, and every vector lives in one.  A vector is
compared with the cells where a neighbour can be: to reach another codeword's
cell it must cross the plane between the codewords, so the sum of the squared
distances to both planes orders the cells.  They are visited in that order (the
corner of the two sorted sequences) up to a bound that is measured so that a
pair exactly at the threshold is met at the target recall; closer pairs are met
more often.  Every met pair is verified.

*Dense regions.*  Where many vectors lie within half the threshold's angle of one
centre, all of them are linked with each other by the triangle inequality.  Such
balls are found in the sample, and their inner links are counted, not listed.
What is outside a ball but within one and a half angles of its centre is
compared with its members.

*Skew.*  Exact copies are one point with a count.  A cell or ball is cut into
tiles of bounded residents times bounded visitors.  A tile returns link counts
per point and a spanning forest, never its pairs.
"""

from __future__ import annotations

import hashlib
import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import graph
from sedimenta.llm.store import Store, column
from sedimenta.llm.words import lists

# Points that codebooks, balls and the bound are fitted on, and their size in bytes at most.
SAMPLE = 16_000
SAMPLE_BYTES = 64 << 20
MOST_WORDS = 512
CELL_POINTS = 256
# A ball holds at least this share of the sample, so there are 1000 at most.
BALL_SHARE = 0.001
BALL_LEAST = 8
# Residents and visitors of a tile.
TILE = 2048
# Points with more than this share of all rows are joined back by broadcast; there are 1000 at most.
HOT_SHARE = 0.001


def codebook(points: np.ndarray, n: int, rng, rounds: int = 8) -> np.ndarray:
    """``n`` centres of Lloyd's iteration."""
    centres = points[rng.choice(len(points), n, replace=False)]
    for _ in range(rounds):
        near = ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        count = np.bincount(near, minlength=n)[:, None]
        centres = np.where(count > 0, total / np.maximum(count, 1), centres)
    return centres


class Index:
    """Codebooks, bound and balls, all of bounded size."""

    def __init__(self, sample: np.ndarray, rows: int, cosine: float, recall: float, seed: int = 12):
        rng = np.random.default_rng(seed)
        self.half, self.angle, self.cosine = sample.shape[1] // 2, math.acos(cosine), cosine
        n = 2 ** round(math.log2(max(4.0, rows / CELL_POINTS)) / 2)
        self.n = int(min(MOST_WORDS, n, max(1, len(sample))))
        self.books = [codebook(x, self.n, rng) for x in (sample[:, :self.half], sample[:, self.half:])] if len(sample) else []
        self.balls = self._dense(sample)
        self.bound = self._measured(sample[:4096], recall, rng) if len(sample) else 0.0

    def crossing(self, half: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest codeword, and squared distances to the planes before the others."""
        book = self.books[half]
        far = (x**2).sum(1)[:, None] + (book**2).sum(1) - 2 * x @ book.T
        own = far.argmin(1)
        apart = np.sqrt(((book[:, None] - book[None]) ** 2).sum(2))[own]
        plane = np.maximum(far - far[np.arange(len(x)), own][:, None], 0) / np.maximum(2 * apart, 1e-300)
        plane[np.arange(len(x)), own] = 0
        return own, plane**2

    def _halves(self, x):
        return self.crossing(0, x[:, :self.half]), self.crossing(1, x[:, self.half:])

    def _measured(self, x: np.ndarray, recall: float, rng) -> float:
        """The bound under which the share ``recall`` of vectors meet a random neighbour at the threshold."""
        side = rng.normal(size=x.shape)
        side -= (side * x).sum(1)[:, None] * x
        side /= np.maximum(np.linalg.norm(side, axis=1), 1e-300)[:, None]
        near = self.cosine * x + math.sin(self.angle) * side
        (_, first), (_, second) = self._halves(x)
        (a, _), (b, _) = self._halves(near)
        at = np.arange(len(x))
        return float(np.quantile(first[at, a] + second[at, b], recall, method="higher"))

    def _dense(self, sample: np.ndarray) -> np.ndarray:
        inner, found, left = math.cos(self.angle / 2) + 1e-9, [], sample
        least = max(BALL_LEAST, math.ceil(BALL_SHARE * len(sample)))
        while len(left) >= least:
            size = np.concatenate([(left[i:i + 1024] @ left.T >= inner).sum(1) for i in range(0, len(left), 1024)])
            if size.max() < least:
                break
            left, size = left[size >= least], size[size >= least]
            while len(left) and size.max() >= least:
                centre = left[left @ left[size.argmax()] >= inner].mean(0)
                centre /= np.linalg.norm(centre)
                inside = left @ centre >= inner
                if inside.sum() < least:  # not around the mean: this point starts no ball
                    inside = np.arange(len(left)) == size.argmax()
                else:
                    found.append(centre)
                left, size = left[~inside], size[~inside]
            break
        return np.array(found).reshape(-1, sample.shape[1])

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Per vector its home (a cell, or ``-1 - ball``), whether in a ball,
        and the homes it visits as ``(vector, home)`` pairs."""
        (a, first), (b, second) = self._halves(x)
        home, rows, homes = a * self.n + b, [], []
        core = np.zeros(len(x), bool)
        if len(self.balls):
            away = np.arccos(np.clip(x @ self.balls.T, -1, 1))
            near = away.argmin(1)
            core = away[np.arange(len(x)), near] <= self.angle / 2 - 1e-7
            home = np.where(core, -1 - near, home)
            # Members of two balls meet once: the later ball's visit the earlier.
            i, ball = np.nonzero(away <= 1.5 * self.angle + 1e-7)
            ok = ~core[i] | (ball < near[i])
            rows.append(i[ok])
            homes.append(-1 - ball[ok])
        order = np.argsort(second, axis=1)
        second, rank = np.take_along_axis(second, order, 1), np.argsort(first, axis=1)
        for t in range(self.n):
            word = rank[:, t]
            left = self.bound - first[np.arange(len(x)), word]
            many = np.where(core, 0, (second <= left[:, None]).sum(1))
            if not many.any():
                break
            i = np.repeat(np.arange(len(x)), many)
            cell = word[i] * self.n + order[i, np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)]
            ok = cell >= home[i]  # of two cells the lower one's vectors visit
            rows.append(i[ok])
            homes.append(cell[ok])
        return home, core, [np.concatenate(v) if v else np.zeros(0, np.int64) for v in (rows, homes)]


def _matrix(values: pa.Array, dim: int) -> np.ndarray:
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(values), dim))
    size = np.diff(values.offsets.to_numpy())
    row = np.repeat(np.arange(len(values)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _prepare(batches, dim):
    """Unit vectors of the usable rows, and a digest that equal vectors share."""
    for batch in batches:
        ids, given = batch.column(0), batch.column(1)
        null = given.is_null().to_numpy(zero_copy_only=False)
        given = pa.array([None if v is None else [math.nan if c is None else c for c in v] for v in given.to_pylist()], pa.list_(pa.float64())) \
            if given.flatten().null_count else given
        x = _matrix(given.fill_null([]) if null.any() else given, dim) + 0.0
        with np.errstate(all="ignore"):
            big = np.abs(x).max(1)
            scaled = x / big[:, None]  # squares of very large or small numbers stay finite
            ok = ~null & np.isfinite(x).all(1) & (big > 0)
            unit = scaled / np.linalg.norm(scaled, axis=1)[:, None]
        ok &= np.isfinite(unit).all(1)
        digests = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() if k else None for v, k in zip(x, ok)]
        ends = np.cumsum(np.where(ok, dim, 0))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(digests, pa.binary()), lists(unit[ok].ravel(), ends, pa.float64())], ["vec_id", "digest", "unit"])


def _place(batches, shared):
    index, dim = shared.value
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            home, core, (rows, homes) = index.place(_matrix(part.column(part.schema.get_field_index("unit")), dim))
            order = np.argsort(rows, kind="stable")
            ends = np.cumsum(np.bincount(rows, minlength=len(home)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(home), pa.array(core), lists(homes[order], ends, pa.int64())],
                [*part.schema.names, "home", "core", "visits"])


def _forest(met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``(node, root)`` that connect what ``met`` connects; columns count after rows."""
    rows, cols = np.flatnonzero(met.any(1)), np.flatnonzero(met.any(0))
    met = met[np.ix_(rows, cols)]
    nodes = np.concatenate((rows, cols))
    low, high = np.arange(len(rows)), len(rows) + np.arange(len(cols))
    most = len(rows) + len(cols)
    while True:
        new = np.minimum(low, np.where(met, high[None], most).min(1))
        other = np.minimum(high, np.where(met, new[:, None], most).min(0))
        if np.array_equal(new, low) and np.array_equal(other, high):
            break
        low, high = new, other
    label = np.concatenate((low, high))
    is_col = np.arange(most) >= len(rows)
    moved = np.flatnonzero(label != np.arange(most))
    return np.stack((is_col[moved], nodes[moved]), 1), np.stack((is_col[label[moved]], nodes[label[moved]]), 1)


def _tile(table: pa.Table, cosine: float, dim: int) -> pa.Table:
    """Link counts per point and connecting edges of residents and visitors."""
    table = table.combine_chunks()
    value = lambda c: table.column(c).to_numpy()
    x, pid, copies, home, cell = _matrix(table.column("unit").combine_chunks(), dim), value("pid"), value("copies"), value("home"), value("cell")
    visitor = value("visitor").astype(bool)
    r, v = np.flatnonzero(~visitor), np.flatnonzero(visitor)
    total, edges = np.zeros(len(pid), np.int64), []
    for at in range(0, len(v), 512):
        q = v[at:at + 512]
        met = x[q] @ x[r].T >= cosine
        inside = home[q] == cell[q]
        met &= ~inside[:, None] | (pid[q][:, None] < pid[r][None])
        if met.any():
            total[q] += met @ copies[r]
            total[r] += met.T @ copies[q]
            a, b = _forest(met)
            both = lambda e: np.where(e[:, 0] == 1, r[np.minimum(e[:, 1], len(r) - 1)], q[np.minimum(e[:, 1], len(q) - 1)])
            edges.append((both(a), both(b)))
    seen = np.flatnonzero(total)
    a, b = (np.concatenate([e[k] for e in edges]) if edges else np.zeros(0, np.int64) for k in (0, 1))
    none = pa.nulls(len(a), pa.int64())
    anchor = table.column("anchor").combine_chunks()
    return pa.table({
        "pid": pa.concat_arrays([pa.array(pid[seen]), none]), "links": pa.concat_arrays([pa.array(total[seen]), none]),
        "a": pa.concat_arrays([pa.nulls(len(seen), anchor.type), anchor.take(pa.array(a))]),
        "b": pa.concat_arrays([pa.nulls(len(seen), anchor.type), anchor.take(pa.array(b))])})


ANCHOR = "struct<none:boolean,id:bigint,pid:bigint>"


def near_vectors(vectors: DataFrame, cosine: float = 0.95, recall: float = 0.995, sample: int = SAMPLE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors(vec_id, embedding)``.

    Vectors that are NULL, empty, zero, or hold NULL or non-finite components
    link with nothing; shorter vectors count as padded with zeros.  Every row
    is a vector of its own, also with a repeated or NULL id; exact copies link.
    ``component_id`` is the smallest id reached (NULL if none has one), ``kept``
    is false for NULL ids.  Only the fit takes a sample: ``sample`` distinct
    vectors by hash, 64 MB at most; every row is indexed.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    store = Store(spark, "vectors")
    given = vectors.select(column(vectors, "vec_id", "long").alias("vec_id"), column(vectors, "embedding", "array<double>").alias("embedding"))
    dim = max(2, given.agg(F.max(F.size("embedding"))).first()[0] or 0)
    rows = store.keep(given.mapInArrow(partial(_prepare, dim=dim), "vec_id long, digest binary, unit array<double>"))
    rows_n = rows.count()
    points = rows.filter("digest is not null").groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("id"), F.first("unit").alias("unit"))
    points = store.keep(points.withColumn("pid", F.monotonically_increasing_id()))

    n = points.count()
    most = min(sample, SAMPLE_BYTES // (8 * dim))
    chosen = points.filter(F.pmod(F.xxhash64("digest"), F.lit(1 << 40)) < F.lit(int((1 << 40) * min(1.0, most / max(n, 1)))))
    fitted = _matrix(chosen.select("unit").limit(2 * most).toArrow().column("unit").combine_chunks(), dim) if n else np.zeros((0, dim))
    if not len(fitted):
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    shared = spark.sparkContext.broadcast((Index(fitted, n, cosine, recall), dim))
    placed = store.keep(points.select("pid", "id", "copies", "digest", "unit").mapInArrow(
        partial(_place, shared=shared),
        "pid long, id long, copies long, digest binary, unit array<double>, home long, core boolean, visits array<long>"))
    shared.unpersist()

    own = F.struct(F.col("id").isNull().alias("none"), "id", "pid")
    balls = store.keep(placed.filter("core").groupBy("home").agg(F.min(own).alias("ball"), F.sum("copies").alias("inside")))
    placed = placed.join(F.broadcast(balls), "home", "left").withColumn("anchor", F.coalesce(F.when(F.col("core"), F.col("ball")), own))
    # One row per cell of the bounded grid and per ball.
    tiles = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias(name))
    cells = tiles(placed.select(F.col("home").alias("cell")), "wide").join(
        tiles(placed.select(F.explode("visits").alias("cell")), "high"), "cell")
    cells = store.keep(cells)
    deal = lambda n: F.pmod(F.xxhash64("pid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    what = ["pid", "copies", "unit", "home", "anchor", "cell"]
    at_home = placed.withColumn("cell", F.col("home")).join(F.broadcast(cells), "cell").withColumn("x", deal("wide")).withColumn("y", every("high"))
    away = placed.withColumn("cell", F.explode("visits")).join(F.broadcast(cells), "cell").withColumn("y", deal("high")).withColumn("x", every("wide"))
    both = at_home.select(*what, "x", "y", F.lit(False).alias("visitor")).union(away.select(*what, "x", "y", F.lit(True).alias("visitor")))
    found = store.keep(both.groupBy("cell", "x", "y").applyInArrow(
        lambda table: _tile(table, cosine, dim), f"pid long, links long, a {ANCHOR}, b {ANCHOR}"))

    links = found.filter("pid is not null").groupBy("pid").agg(F.sum("links").alias("links"))
    parts = graph.components(found.filter("a is not null").select("a", "b"), store)
    balls = balls.join(parts, F.col("ball") == F.col("node"), "left").select("home", F.coalesce("component", "ball").alias("part"))
    balls = store.keep(balls)
    placed = placed.drop("unit", "visits").join(links, "pid", "left").withColumn(
        "n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0)) + F.when(F.col("core"), F.col("inside") - F.col("copies")).otherwise(0))
    core = placed.filter("core").join(F.broadcast(balls), "home")
    other = placed.filter("not core").join(parts, F.col("anchor") == F.col("node"), "left").withColumn("part", F.coalesce("component", "anchor"))
    shape = ["digest", "copies", "n_links", F.col("part.id").alias("component_id")]
    done = store.keep(core.select(*shape).union(other.select(*shape)))

    # Copies meet their point: frequent points by broadcast, the rest by a shuffle in which no key is frequent.
    hot = F.col("copies") > max(1.0, HOT_SHARE * rows_n)
    rows = rows.select("vec_id", "digest")
    often = F.broadcast(done.filter(hot).select("digest", *[F.col(c).alias(f"hot_{c}") for c in ("n_links", "component_id", "copies")]))
    rows = rows.join(often, "digest", "left")
    rest = rows.filter("hot_copies is null").join(done.filter(~hot), "digest", "left")
    rest = rest.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                       F.when(F.col("copies").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    out = rows.filter("hot_copies is not null").select(
        "vec_id", F.col("hot_n_links").alias("n_links"), F.col("hot_component_id").alias("component_id")).union(rest)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
