"""Tokenizer alignment against plain loops over tokens."""

import hashlib
import random
from collections import Counter
from functools import cache
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import alignment

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


@cache
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(alignment.BYTE_BPE)
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)


def tokens_of(text):
    """Ids with their bytes, by the tokenizers' own decoding."""
    (one, two), of = tokenizers(), alignment.byte_of()
    a = [(i, bytes(of[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(two.id_to_piece(i)[1:-1], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode())
         for i in two.encode(text)]
    return a, b


def spans(tokens):
    at = 0
    for i, data in tokens:
        yield i, at, at + len(data)
        at += len(data)


def brute(rows):
    found, total = [], Counter()
    for i, text in rows:
        a, b = tokens_of(text) if text else ([], [])
        whole = b" " + (text or "").encode()
        if not text or b"".join(x[1] for x in a) != whole or b"".join(x[1] for x in b) != whole:
            found.append((i, 0, 0, 0, [], ""))
            continue
        a, b = list(spans(a)), list(spans(b))
        both = sorted({x[2] for x in a} & {x[2] for x in b})
        inside = lambda side, lo, hi: ",".join(str(t) for t, s, e in side if lo <= s and e <= hi)
        text = ";".join(f"{inside(a, lo, hi)}|{inside(b, lo, hi)}" for lo, hi in zip([0, *both], both))
        pairs = [(x, y) for x, s, e in a for y, u, v in b if s < v and u < e]
        total.update(pairs)
        found.append((i, len(a), len(b), len(both), pairs, hashlib.sha256(text.encode()).hexdigest()))
    best = {}
    for (_, y), n in total.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(((i, n, m, g, len(p), sum(total[x] == best[x[1]] for x in p), sum(total[x] for x in p), d) for i, n, m, g, p, d in found), key=str)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(5)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text) < 700][:150]
    odd = [None, "", " ", "  a  b\n\n c ", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ mark", "a\x00b", "日本語 のテキスト", "é é 🙂🏽 ﬁ",
           "\r\n\t", " a b", "it 's a' s", "a\u00a0b c\u2003d \u200be \x1c f\x1c g", "▁ ▁a b▁ c", "w" * 60 + " " + "w" * 60, "x" * 3000, "same", "same"]
    rows += [(10**6 + i, t) for i, t in enumerate(odd)] + [(None, "same"), (10**6, "again"), (10**6, "again")]
    rows += [(2 * 10**6 + i, "".join(rng.choice("ab \n.é字🙂'1") for _ in range(60))) for i in range(60)]
    return rows


@pytest.mark.parametrize("known", [500_000, 40, 0])
def test_alignment(spark, mixed, known):
    """All pairs sent to the workers, only frequent ones, none."""
    got = rows_of(alignment.alignment(spark.createDataFrame(mixed, SCHEMA), known=known))
    assert got == brute(mixed)
    assert sum(r[1] == 0 for r in got) >= 3


def test_small_slices(spark, mixed, monkeypatch):
    pair = alignment.Pair(Path(alignment.BYTE_BPE).read_text(), Path(alignment.PIECE_BPE).read_bytes())
    texts = [t for _, t in mixed if t][:40]
    import pyarrow as pa

    whole = alignment.aligned(pair, pa.array(range(40)), texts).to_pylist()
    assert whole == [alignment.aligned(pair, pa.array([i]), [t]).to_pylist()[0] for i, t in enumerate(texts)]


def test_long_chain():
    """Ends that meet only after thousands of tokens are one group."""
    n = 5000
    a, b = np.append(np.arange(1, n) * 2, 2 * n), np.append(np.arange(n) * 2 + 1, 2 * n)
    p = alignment.groups(a, b)
    assert set(p.tolist()) == {n - 1}
    x, y = alignment.links(a, b)
    assert len(x) == len(a) + len(b) - 1


def test_nothing_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "one text")], SCHEMA)
    for c in ("row", "a", "b", "times", "code", "n", "best", "n_a"):
        df = df.withColumn(c, F.lit("x"))
    assert rows_of(alignment.alignment(df)) == brute([(1, "one text")])
    assert alignment.alignment(df.limit(0)).count() == 0
    assert rows_of(alignment.alignment(spark.createDataFrame([(1, None)], SCHEMA))) == [(1, 0, 0, 0, 0, 0, 0, "")]
