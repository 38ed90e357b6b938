"""Operator 3: secret scans with linked parts, in DataFrame functions only.

Patterns run in the JVM over whole texts.  Three kinds are reported wherever
they match (``assign``, ``access``, ``hex``).  Three weak kinds say little
alone: an ``ident`` (a user or client name given a value), a ``key`` (a long
word of mixed letters and digits) and an ``endpoint`` (an address).  A weak
candidate is reported when the parts that complete it lie in its scope, the
``REACH`` code points before and after it:

* a ``key`` with an identifier (``ident`` or ``access``),
* an ``ident`` with a secret (``assign``, ``hex`` or ``key``),
* an ``endpoint`` with an identifier and a secret.

This interval join is a pair of windows over the parts of a text in order:
the nearest end of each role before a part, and the nearest start behind it.
It is linear, however many parts a text has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.store import Store, column, free_name, rows_in

REACH = 200

#: kind, pattern, value group, shortest value, cheap test that every match passes, role
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
     ("passw", "secret", "token", "key"), "secret"),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, ("akia",), "ident"),
    ("hex", r"[0-9a-f]{24,}", 0, 24, None, "secret"),
    ("ident", r"""\b((?i:user(?:name)?|login|client_?id|account_?id|key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]+)""", 2, 3,
     ("user", "login", "id"), "ident"),
    ("key", r"""(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])[A-Za-z0-9+/_=-]{20,}""", 0, 20,
     None, "secret"),
    ("endpoint", r"""(?:[a-z]+://|\b(?=[0-9.]+:[0-9]))[A-Za-z0-9._-]+(?::[0-9]+)?""", 0, 8, ("://", ":"), "endpoint"),
)
BASE = ("assign", "access", "hex")


def _found(text: Column, low: Column, kind: str, pattern: str, group: int, hints) -> Column:
    """Array of (kind, number, gap before, length, value length) of all matches.

    Splitting at the matches gives the gaps between them; places follow from
    a running sum of gaps and lengths.
    """
    size = lambda a: F.transform(a, F.char_length)
    re = F.lit(pattern)
    parts = F.arrays_zip(
        size(F.split(text, pattern, -1)).alias("gap"), size(F.regexp_extract_all(text, re, F.lit(0))).alias("len"),
        size(F.regexp_extract_all(text, re, F.lit(group))).alias("value"))
    parts = F.transform(parts, lambda p, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), p["gap"], p["len"], p["value"]))
    if hints is None:
        may = text.rlike(pattern)
    else:
        may = F.lit(False)
        for h in hints:
            may = may | low.contains(h)
    # The last gap has no match behind it.
    return F.when(may, F.filter(parts, lambda p: p["len"].isNotNull()))


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``(row, doc_id, spans)`` per row of ``docs(doc_id, text)``; ``spans`` is an
    array of (start, order, kind, end) in code points, sorted.

    Parts whose spans overlap never complete each other: one value is not two.
    NULL and empty texts have no spans; a text of any length is one row whose
    parts are one window.  ``doc_id`` is passed on, NULL and
    repeated ones too; other columns are ignored.
    """
    store = Store(docs.sparkSession, "secrets")
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    source = docs.select(column(docs, "doc_id", "long").alias("doc_id"), text.alias("text"))
    source = source.withColumn("low", F.lower("text"))
    arrays = [_found(F.col("text"), F.col("low"), k, p, g, h) for k, p, g, _, h, _ in KINDS]
    rows = store.keep(source.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"),
        F.filter(F.array(*arrays), lambda a: a.isNotNull()).alias("found")))
    parts = rows.select("row", F.explode(F.flatten("found")).alias("p")).select("row", "p.*")
    behind = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(behind))
    parts = parts.withColumn("start", F.col("end") - F.col("len"))
    least, role, order = F.lit(0), F.lit(None).cast("string"), F.lit(0)
    for n, (kind, _, _, shortest, _, r) in enumerate(KINDS):
        least = F.when(F.col("kind") == kind, F.lit(shortest)).otherwise(least)
        role = F.when(F.col("kind") == kind, F.lit(r)).otherwise(role)
        order = F.when(F.col("kind") == kind, F.lit(n)).otherwise(order)
    parts = parts.filter(F.col("value") >= least).withColumn("role", role).withColumn("n", order)
    # Starts and ends in order, ends first: what ended before a start, and what starts after an end.
    ends = F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(True).alias("opens")),
                             F.struct(F.col("end").alias("pos"), F.lit(False).alias("opens"))))
    events = parts.withColumn("event", ends).select("row", "start", "n", "kind", "end", "role", "event.*")
    by = Window.partitionBy("row").orderBy("pos", "opens")
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)

    def in_scope(role: str) -> Column:
        own = F.col("role") == role
        last = F.max(F.when(own & ~F.col("opens"), F.col("pos"))).over(before)
        following = F.min(F.when(own & F.col("opens"), F.col("pos"))).over(after)
        return F.coalesce(F.when(F.col("opens"), F.col("pos") - last).otherwise(following - F.col("pos")) <= reach, F.lit(False))

    parts = events.withColumn("by_ident", in_scope("ident")).withColumn("by_secret", in_scope("secret")).groupBy(
        "row", "start", "n", "kind", "end").agg(F.bool_or("by_ident").alias("by_ident"), F.bool_or("by_secret").alias("by_secret"))
    has = {"ident": F.col("by_ident"), "secret": F.col("by_secret")}
    linked = (
        F.when(F.col("kind").isin(*BASE), F.lit(True)).when(F.col("kind") == "key", has["ident"])
        .when(F.col("kind") == "ident", has["secret"]).otherwise(has["ident"] & has["secret"]))
    spans = parts.withColumn("linked", linked).filter("linked").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "n", "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,n:int,kind:string,end:bigint>>")
    return rows.select("row", "doc_id", "text_hash").join(spans, "row", "left").withColumn("spans", F.coalesce("spans", none))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` per row."""
    found = find_secrets(docs, reach).withColumn("base", F.filter("spans", lambda s: s["n"] < len(BASE)))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias("n_" + kind)

    return found.select("doc_id", *map(number, BASE), F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                        _written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """The documents with every reported span replaced by ``mark``.

    Overlapping spans are one.  All columns stay, whatever their names; ``n_chars``, where there is
    one, follows the new text.
    """
    found = find_secrets(docs, reach).filter(F.size("spans") > 0).select("row", "doc_id", "text_hash", F.explode("spans").alias("s"))
    found = found.dropDuplicates(["doc_id", "text_hash", "s"]).select("doc_id", "text_hash", "s.start", "s.end")
    by = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end")
    reached = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reached.isNull() | (F.col("start") > reached), 1).otherwise(0)
    found = found.withColumn("fresh", fresh).withColumn("block", F.sum("fresh").over(by))
    found = found.groupBy("doc_id", "text_hash", "block").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    own, key, cut = (free_name(docs, n) for n in ("own", "key", "cuts"))
    cuts = Store(docs.sparkSession, "secrets").keep(found.groupBy(F.col("text_hash").alias(own), F.col("doc_id").alias(key)).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cut)))
    # Texts without a secret are not shuffled.
    marked = docs.withColumn(own, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    some = rows_in(marked, cuts, own).join(cuts, [own]).filter(F.col("doc_id").eqNullSafe(F.col(key)))
    others = rows_in(marked, cuts, own).join(cuts.select(own, key), (marked[own] == cuts[own]) & marked["doc_id"].eqNullSafe(cuts[key]), "left_anti")
    rest = rows_in(marked, cuts, own, "left_anti").unionByName(others).select(*docs.columns)
    built = F.aggregate(
        cut, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda a, c: F.struct(c["end"].alias("at"), F.concat(
            a["out"], F.substring(F.col("text"), (a["at"] + 1).cast("int"), (c["start"] - a["at"]).cast("int")), F.lit(mark)).alias("out")),
        lambda a: F.concat(a["out"], F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    some = some.withColumn("text", built)
    if "n_chars" in docs.columns:
        some = some.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return some.select(*docs.columns).union(rest)
