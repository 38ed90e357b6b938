"""Operator 7: mixing sources to target weights, in DataFrame functions only.

The size of a document is its number of words.  Each source has a weight and
a target; documents get a hash-random key, are sorted by it within their
source, and a running sum of sizes is cut at the source's budget.

The running sum is distributed: the key's leading bits cut a source into
ranges of some ``RANGE_ROWS`` documents, range totals are summed up per
source, and within a range a window adds the rest.  A source of any size is
spread over its ranges.  A budget above the source's size repeats whole epochs
first and cuts in the last one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.native import words
from sedimenta.llm.store import MAX_BROADCAST_IDS, Store, column, free_name

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
RANGE_ROWS = 1000
# Hexadecimal digits of the key that ranges are cut by.
DIGITS = 7


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` for rows ``(source, size)``.

    Sources in code-point order, NULL last, take the weights in turn.  All
    sizes together are shared by weight; a target stops at ``most`` times its
    source's size and the excess is shared again.  In closed form: a target is
    the smaller of that cap and ``level * weight``, and the level is the
    largest of ``(total - caps before) / weights from here`` over the sources
    sorted by cap per weight.  One row per source goes through the windows.
    """
    by = Window.orderBy(F.asc_nulls_last("source"))
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(by) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = rows.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    ratio = F.col("cap") / F.col("weight")
    order = Window.orderBy(ratio, F.asc_nulls_last("source"))
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    whole = Window.partitionBy(F.lit(1))
    rows = rows.withColumn("level", (F.sum("source_size").over(whole) - before) / ahead)
    level = F.max("level").over(whole)
    return rows.select("source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = "mix") -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per row of ``docs``.

    ``taken`` counts the words the mix takes of the row, repeats included: so
    many whole epochs of its source, and in the last epoch all words of the
    documents before the cut, and of the document at the cut as many as the
    budget still allows.  A source's taken words are its target, rounded down.
    NULL and empty texts have size 0 and are never taken; NULL is a source of
    its own.  The order follows ``md5(doc_id:seed)`` (NULL ids as ``null``), so
    reruns agree; rows with equal ids follow by size, and equal rows are
    interchangeable.  Other columns are ignored.
    """
    store = Store(docs.sparkSession, "mixing")
    key = F.md5(F.concat(F.coalesce(column(docs, "doc_id", "long").cast("string"), F.lit("null")), F.lit(":" + seed)))
    sizes = store.keep(docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), column(docs, "source", "string").alias("source"),
        F.size(words(column(docs, "text", "string"))).cast("long").alias("size"), key.alias("key")))
    aims = store.keep(targets(sizes, weights, most).withColumn("budget", F.floor("target"))
                      .withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))))
    bits = max(0, min(4 * DIGITS, math.ceil(math.log2(max(1, sizes.count() / RANGE_ROWS)))))
    part = F.floor(F.conv(F.substring("key", 1, DIGITS), 16, 10).cast("long") / F.lit(1 << (4 * DIGITS - bits)))
    rows = sizes.withColumnRenamed("source", "s").withColumn("part", part)
    rows = rows.join(aims, F.col("s").eqNullSafe(F.col("source"))).drop("s", "source")
    ranges = rows.groupBy("sid", "part").agg(F.sum("size").alias("sum"))
    ahead = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("sid", "part", F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("sid", "part").orderBy("key", "size", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("ahead") + F.sum("size").over(inside) - F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("budget") - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return rows.join(ranges, ["sid", "part"]).withColumn("start", start).select(
        "doc_id", "size", "source_size", "target", (epochs * F.col("size") + last).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents the mix takes with ``size`` and ``taken`` words, and the
    whole ``epochs`` they repeat for; documents that are not taken go.  Rows
    that share a ``doc_id`` and size get the larger share.

    Columns of the documents stay as they are; where one already has the name
    of an added column, that one gets an underscore at its end.
    """
    size, share, epochs, key = (free_name(docs, n) for n in ("size", "taken", "epochs", "mix_id"))
    taken = mix(docs).filter("taken > 0").groupBy(F.col("doc_id").alias(key), F.col("size").alias(size)).agg(F.max("taken").alias(share))
    taken = Store(docs.sparkSession, "mixing").keep(taken)
    # Three numbers a document: below the bound texts are not shuffled.
    few = taken.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.size(words(F.col("text"))) == F.col(size))
    mixed = docs.join(F.broadcast(taken) if few else taken, same)
    return mixed.drop(key).withColumn(epochs, F.floor(F.col(share) / F.col(size)))


ORACLE = r"""
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, 'null') || ':mix') AS key
    FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighted AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM sums),
leveled AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
                   ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
               / (sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
    FROM weighted),
aims AS (
    SELECT source, source_size, least((3 * source_size)::DOUBLE, max(level) OVER () * weight) AS target FROM leveled),
runs AS (
    SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
           coalesce(sum(size) OVER (PARTITION BY sizes.source ORDER BY key, size, doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM sizes JOIN aims ON sizes.source IS NOT DISTINCT FROM aims.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - start)) END)::BIGINT AS taken
FROM runs
"""
