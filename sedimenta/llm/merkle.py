"""Operator 11: a Merkle manifest of a dataset, proved by a recursive query.

A row's leaf is the digest of its columns.  The leaves of one language, by
``doc_id``, are halved level by level to a subroot, the subroots by language
likewise to the root.

*Order.*  Rows are range-sorted by language, id and digest; a row's place is
its place in its range plus the rows before, so no language of any size goes
through one task.  *Levels.*  ``2 ** SPAN`` consecutive nodes are one bounded
group, whose ``SPAN`` levels are built together: one small shuffle per
``SPAN`` levels.  A stored node row holds its digest, the siblings on the way
up to the node it is linked to, and that parent's place.  *Climb.*  ``WITH
RECURSIVE`` starts from the leaves and joins the parent rows until the root,
appending siblings and folding the (tampered) digest.  Nodes further up are
shared by many leaves; their rows are repeated under up to ``SALTS`` salts, so
that no join key stands for a whole language.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.store import Store, column

# Binary levels built by one group and climbed by one step.
SPAN = 12
# Copies of a node row that many leaves climb to.
SALTS = 4096
# Spark stops a recursive query at a million rows unless told otherwise.
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
# The tree whose leaves are the subroots.
ROOT = -1


def digest(*inputs: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the concatenated inputs."""
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else the length in bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """``(lang, doc_id, leaf, folded)``: the digest of a row, and of the row
    with one added to ``n_chars`` where ``tampered`` holds (else the same)."""
    have = docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), column(docs, "source", "string").alias("source"),
        column(docs, "lang", "string").alias("lang"), column(docs, "n_chars", "long").alias("n_chars"),
        column(docs, "text", "string").alias("text"))
    hashed = lambda n: digest(*[field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))])
    changed = F.coalesce(tampered, F.lit(False)) & F.col("n_chars").isNotNull()
    return have.select("lang", "doc_id", hashed(F.col("n_chars")).alias("leaf"),
                       F.when(changed, hashed(F.col("n_chars") + 1)).alias("other")).select(
        "lang", "doc_id", "leaf", F.coalesce("other", "leaf").alias("folded"))


def numbered(df: DataFrame, keys: list[str], store: Store) -> DataFrame:
    """``df`` with ``place``, 0 and up in the order of ``keys`` (ties by no rule:
    give keys that leave only equal rows tied)."""
    rows = df.withColumn("tie", F.monotonically_increasing_id())
    rows = store.keep(rows.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie")
                      .withColumn("at", F.monotonically_increasing_id()).drop("tie"))
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per task of the sort.
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return (rows.withColumn("part", part).join(F.broadcast(sizes), "part")
            .withColumn("place", F.col("before") + inside).drop("part", "at", "before"))


def _up(nodes: str) -> str:
    """The next level of a list of digests: pairs become one, a last lone one too."""
    return (f"transform(sequence(0, (size({nodes}) - 1) div 2), k -> sha2(cast(concat({nodes}[2 * k],"
            f" coalesce(get({nodes}, 2 * k + 1), '')) as binary), 256))")


def built(nodes: DataFrame, level: int, span: int, store: Store) -> tuple[DataFrame, DataFrame]:
    """Node rows of ``level`` and the nodes ``span`` levels up.

    ``nodes(tree, n, pos, hash)``: ``n`` nodes in this tree on this level, and
    columns that go with them.  A tree with at most ``2 ** span`` nodes ends
    here.  A group has at most ``2 ** span`` of them.
    """
    more = [c for c in nodes.columns if c not in ("tree", "n", "pos", "hash")]
    groups = nodes.groupBy("tree", F.shiftright("pos", span).alias("block")).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "hash", *more))).alias("own"))
    groups = groups.withColumn("steps", F.expr(f"least({span}, if(n <= 1, 0, length(bin(n - 1))))")).withColumn("levels", F.expr(
        f"aggregate(sequence(1, steps + 1), array(own.hash), (a, i) -> if(i > steps, a, concat(a, array({_up('element_at(a, -1)')}))))"))
    groups = store.keep(groups.withColumn("done", F.expr(f"n <= {1 << span}")))
    way = ("transform(slice(levels, 1, steps), (row, j) -> struct("
           "get(row, shiftright(k, j) ^ 1) as hash, (shiftright(k, j) & 1) = 1 as before))")
    rows = groups.select("tree", "block", "done", F.explode(F.expr(f"transform(own, (x, k) -> struct(x as own, {way} as way))")).alias("x"))
    rows = rows.select("tree", F.lit(level).alias("level"), *[F.col(f"x.own.{c}") for c in ("pos", "hash", *more)], "x.way", "done", "block")
    above = groups.select("tree", F.expr(f"(n + {(1 << span) - 1}) div {1 << span}").alias("n"), F.col("block").alias("pos"),
                          F.expr("element_at(levels, -1)[0]").alias("hash"), "done")
    return rows, above


def forest(nodes: DataFrame, span: int, store: Store) -> tuple[list[DataFrame], DataFrame]:
    """Node rows by level, and ``(tree, top)`` for every tree."""
    levels, tops = [], []
    while True:
        rows, above = built(nodes, span * len(levels), span, store)
        levels.append(rows)
        above = store.keep(above)
        tops.append(above.filter("done").select("tree", F.col("hash").alias("top")))
        nodes = above.filter("not done").drop("done")
        if nodes.isEmpty():
            break
    top = tops[0]
    for t in tops[1:]:
        top = top.union(t)
    return levels, top


FOLD = ("aggregate({way}, {start}, (h, s) -> if(s.hash is null, sha2(cast(h as binary), 256),"
        " sha2(cast(if(s.before, concat(s.hash, h), concat(h, s.hash)) as binary), 256)))")
CLIMB = """
WITH RECURSIVE climb AS (
    SELECT doc_id, leaf, tree, level, pos, salt, folded, siblings, CAST(NULL AS BINARY) AS subroot FROM {start}
    UNION ALL
    SELECT c.doc_id, c.leaf, n.up_tree, n.up_level, n.up_pos, c.salt, unhex({fold}),
           concat(c.siblings, unhex(concat_ws('', n.way.hash))), coalesce(c.subroot, n.subroot)
    FROM climb c JOIN {nodes} n ON n.tree = c.tree AND n.level = c.level AND n.pos = c.pos AND n.salt = c.salt)
SELECT doc_id, leaf, subroot, siblings, folded FROM climb WHERE tree IS NULL
"""


def manifest(docs: DataFrame, tampered: Column | None = None, span: int = SPAN, salts: int = SALTS) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``
    per row of ``docs(doc_id, source, lang, n_chars, text)``.

    ``tampered`` is a condition on these columns; by default rows whose
    ``crc32`` of the decimal ``doc_id`` is divisible by 7.  NULL ids come first
    in their language and are never tampered by default; equal ids follow by
    leaf, equal rows are interchangeable.  NULL is a language of its own and
    comes first; a missing column counts as NULL, other columns are ignored.
    The proof of the only row of the only language has no siblings.  An empty
    table gives no rows.  A task holds one text at a time and at most ``2 ** span`` digests.
    """
    spark = docs.sparkSession
    store = Store(spark, "merkle")
    if tampered is None:
        tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = numbered(store.keep(leaves(docs, tampered)), ["lang", "doc_id", "leaf"], store)
    langs = rows.groupBy("lang").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    langs = store.keep(numbered(store.keep(langs), ["lang"], store).withColumnRenamed("place", "tree"))
    small = langs.withColumnRenamed("lang", "l")
    if langs.count() <= 100_000:
        small = F.broadcast(small)
    rows = store.keep(rows.join(small, F.col("lang").eqNullSafe(F.col("l"))).select(
        "doc_id", "leaf", "folded", "tree", "n", (F.col("place") - F.col("first")).alias("pos")))
    if rows.isEmpty():
        return rows.select("doc_id", "leaf", *[F.lit(None).cast("string").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")],
                           F.lit(None).cast("boolean").alias("verified"))
    levels, tops = forest(rows.select("tree", "n", "pos", F.col("leaf").alias("hash"), "doc_id", "folded"), span, store)
    tops = store.keep(tops)
    upper, root = forest(tops.select(F.lit(ROOT).cast("long").alias("tree"), F.lit(langs.count()).alias("n"),
                                     F.col("tree").alias("pos"), F.col("top").alias("hash")), span, store)
    root = root.first().top

    # Salts of a tree: as many as it has first blocks, at most SALTS.
    of = langs.select("tree", F.least(F.lit(salts), F.expr(f"(n + {(1 << span) - 1}) div {1 << span}")).alias("salts"))
    most = of.agg(F.max("salts")).first()[0]
    spread = lambda n: F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("salt")
    parent = [F.when(~F.col("done"), F.col("tree")).otherwise(F.lit(ROOT)).cast("long").alias("up_tree"),
              F.when(~F.col("done"), F.col("level") + span).otherwise(F.lit(0)).alias("up_level"),
              F.when(~F.col("done"), F.col("block")).otherwise(F.col("tree")).alias("up_pos")]
    nodes = []
    for i, level in enumerate(levels[1:], 1):
        here = level.join(F.broadcast(of), "tree") if langs.count() <= 100_000 else level.join(of, "tree")
        salt = F.pmod("pos", "salts").cast("int").alias("salt") if i == 1 else spread(F.col("salts"))
        nodes.append(here.select("tree", "level", "pos", salt, "way", *parent, F.lit(None).cast("binary").alias("subroot")))
    for i, level in enumerate(upper):
        here = level.join(of.withColumnRenamed("tree", "pos"), "pos") if i == 0 else level.withColumn("salts", F.lit(most))
        nodes.append(here.select(
            "tree", "level", "pos", spread(F.col("salts")), "way",
            F.when(~F.col("done"), F.col("tree")).alias("up_tree"), F.when(~F.col("done"), F.col("level") + span).alias("up_level"),
            F.when(~F.col("done"), F.col("block")).alias("up_pos"), F.when(F.lit(i == 0), F.unhex("hash")).alias("subroot")))
    table = nodes[0]
    for n in nodes[1:]:
        table = table.union(n)
    table = store.keep(table)

    start = levels[0].join(F.broadcast(of) if langs.count() <= 100_000 else of, "tree").select("*", *parent)
    start = start.select(
        "doc_id", F.unhex("hash").alias("leaf"), F.col("up_tree").alias("tree"), F.col("up_level").alias("level"),
        F.col("up_pos").alias("pos"), F.pmod("block", "salts").cast("int").alias("salt"),
        F.unhex(F.expr(FOLD.format(way="way", start="folded"))).alias("folded"), F.unhex(F.concat_ws("", "way.hash")).alias("siblings"))
    found = _climb(store.keep(start), table, store)
    text = lambda c: F.lower(F.hex(c))
    return found.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), F.lit(root).alias("root"),
        F.sha2(text("siblings").cast("binary"), 256).alias("proof_sha256"), text("folded").alias("folded_root"),
        (text("folded") == root).alias("verified"))


def _climb(start: DataFrame, nodes: DataFrame, store: Store) -> DataFrame:
    """From every leaf to the root, one linked parent a step."""
    spark, mark = store.spark, uuid.uuid4().hex
    before = spark.conf.get(ROW_LIMIT, None)
    start.createOrReplaceTempView(f"start_{mark}")
    nodes.createOrReplaceTempView(f"nodes_{mark}")
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return store.keep(spark.sql(CLIMB.format(
            start=f"start_{mark}", nodes=f"nodes_{mark}", fold=FOLD.format(way="n.way", start="lower(hex(c.folded))"))))
    finally:
        if before is None:
            spark.conf.unset(ROW_LIMIT)
        else:
            spark.conf.set(ROW_LIMIT, before)
        spark.catalog.dropTempView(f"start_{mark}")
        spark.catalog.dropTempView(f"nodes_{mark}")


ORACLE = r"""
WITH RECURSIVE
crc AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY i) AS step
    FROM range(256) t(i)),
given AS (
    SELECT doc_id, lang, n_chars,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') AS head,
           coalesce(strlen(text) || ':' || text, '-') AS tail,
           xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
               lambda c, b: xor(step[(xor(c, b) & 255) + 1], c >> 8))) % 7 = 0 AS tampered
    FROM documents, crc),
leaves AS (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
           CASE WHEN tampered AND n_chars IS NOT NULL
                THEN sha256(head || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) || tail) END AS other
    FROM given),
placed AS (
    SELECT doc_id, leaf, coalesce(other, leaf) AS folded, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
    FROM leaves),
levels AS (
    SELECT tree, 0 AS level, pos, leaf AS h, n FROM placed
    UNION ALL
    SELECT tree, any_value(level) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value(n + 1) // 2
    FROM levels WHERE n > 1 GROUP BY tree, pos // 2),
tops AS (SELECT tree, level, h FROM levels WHERE n = 1),
upper AS (
    SELECT 0 AS level, tree AS pos, h, (SELECT count(*) FROM tops) AS n FROM tops
    UNION ALL
    SELECT any_value(level) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value(n + 1) // 2
    FROM upper WHERE n > 1 GROUP BY pos // 2),
linked AS (
    SELECT a.tree, a.level, a.pos, s.h AS sibling, s.pos < a.pos AS before
    FROM levels a LEFT JOIN levels s ON s.tree = a.tree AND s.level = a.level AND s.pos = xor(a.pos, 1) WHERE a.n > 1
    UNION ALL
    SELECT -1, a.level, a.pos, s.h, s.pos < a.pos FROM upper a LEFT JOIN upper s ON s.level = a.level AND s.pos = xor(a.pos, 1) WHERE a.n > 1),
climb AS (
    SELECT doc_id, leaf, folded, '' AS siblings, p.tree AS own, CASE WHEN t.level = 0 THEN -1 ELSE p.tree END AS tree, 0 AS level,
           CASE WHEN t.level = 0 THEN p.tree ELSE pos END AS pos, h AS subroot, t.level AS depth
    FROM placed p JOIN tops t ON t.tree = p.tree
    UNION ALL
    SELECT c.doc_id, c.leaf, sha256(CASE WHEN sibling IS NULL THEN folded WHEN before THEN sibling || folded ELSE folded || sibling END),
           siblings || coalesce(sibling, ''), own, CASE WHEN c.tree >= 0 AND c.level + 1 = depth THEN -1 ELSE c.tree END,
           CASE WHEN c.tree >= 0 AND c.level + 1 = depth THEN 0 ELSE c.level + 1 END,
           CASE WHEN c.tree >= 0 AND c.level + 1 = depth THEN own ELSE c.pos // 2 END, subroot, depth
    FROM climb c JOIN linked l ON l.tree = c.tree AND l.level = c.level AND l.pos = c.pos),
root AS (SELECT level AS high, h AS root FROM upper WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM climb, root WHERE tree = -1 AND level = high
"""
