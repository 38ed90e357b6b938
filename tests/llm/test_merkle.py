"""The Merkle manifest against a plain tree, on all spans, and its odd rows."""

import hashlib
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import merkle
from sedimenta.llm.queries import ORACLES

sys.path.insert(0, str(Path(__file__).parents[1]))
import oracle  # noqa: E402

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, more=0):
    values = (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The top, and per node its siblings ``(digest, whether before it)``, None for a lone node."""
    ways, own = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        pairs = [range(i, min(i + 2, len(nodes))) for i in range(0, len(nodes), 2)]
        for pair in pairs:
            for j in pair:
                other = [(nodes[k], k < j) for k in pair if k != j] or [None]
                for i in own[j]:
                    ways[i] += other
        nodes, own = [h("".join(nodes[k] for k in p)) for p in pairs], [[i for k in p for i in own[k]] for p in pairs]
    return nodes[0], ways


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r), r))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in order:
        langs[lang].sort(key=lambda t: t[:3])
        trees.append(tree([t[2] for t in langs[lang]]))
    root, upper = tree([t[0] for t in trees])
    out = []
    for lang, (subroot, ways), up in zip(order, trees, upper):
        for (_, _, own, r), way in zip(langs[lang], ways):
            wrong = r.doc_id is not None and r.n_chars is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            folded = leaf(r, 1) if wrong else own
            for s in way + up:
                folded = h(folded) if s is None else h(s[0] + folded if s[1] else folded + s[0])
            proof = h("".join(s[0] for s in way + up if s))
            out.append((r.doc_id, own, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("span,salts", [(12, 4096), (2, 3)])
def test_manifest(spark, span, salts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute(docs.collect())
    assert rows_of(merkle.manifest(docs, span=span, salts=salts)) == want
    assert 0 < sum(not r[-1] for r in want) < len(want)


def test_manifest_sql(spark):
    want = brute(spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert sorted(oracle.connect(SF).execute(ORACLES["op11_merkle_manifest"]).fetchall(), key=str) == want


@pytest.mark.parametrize("n", [1, 8, 9, 33])
def test_manifest_of_odd_rows(spark, n):
    """NULLs in any column, empty and long texts, repeated rows and ids, columns with names used inside."""
    rows = [(25, "a", "zz", "b", None), (None, "x", None, "s", None), (1, None, "en", None, 3), (1, None, "en", None, 3), (1, "y", "en", None, 3),
            (7, "", "", None, 0), (2, "\u00e9\n" * 500_000, "fr", "q", 1), (None, None, None, None, None)] * 5
    df = spark.createDataFrame(rows[:n], SCHEMA)
    for c in ("tie", "place", "pos", "level", "way", "n", "tree", "leaf", "salt"):
        df = df.withColumn(c, F.lit(1))
    assert rows_of(merkle.manifest(df, span=1, salts=2)) == brute(df.collect())


def test_manifest_of_nothing(spark):
    empty = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[0] == "doc_id" and empty.columns[-1] == "verified"


def test_manifest_of_other_tampering(spark):
    df = spark.createDataFrame([(i, f"t{i}", "en", "s", i) for i in range(20)], SCHEMA)
    got = {r.doc_id: r.verified for r in merkle.manifest(df, F.col("doc_id") == 5).collect()}
    assert [i for i, v in got.items() if not v] == [5]
