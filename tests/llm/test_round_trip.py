"""Rows, names and training sets that the given tables do not hold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import latent, linequality, mixing
from sedimenta.llm import words as wd


def test_sketch_equals_dense_product():
    """Counted pairs and single blocks together give A'(A omega), also with few frequent words."""
    rng = np.random.default_rng(3)
    texts = [np.sort(rng.choice(400, 90, replace=False)) for _ in range(300)]
    words = [rng.integers(0, 60, 90) ** 2 % 50 for _ in texts]
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(300)), pa.array([t.tolist() for t in texts], pa.list_(pa.int32())),
        pa.array([w.tolist() for w in words], pa.list_(pa.int32()))], ["doc_id", "place", "word"])
    weight, omega = rng.random(50) + 0.1, rng.standard_normal((50, 7))
    a = np.zeros((300 * 20, 50))
    for i, (t, w) in enumerate(zip(texts, words)):
        np.add.at(a, (i * 20 + t // latent.BLOCK, w), 1)
    df = (a > 0).sum(0)
    a *= weight

    class Shared:
        value = (weight, omega)

    got = next(latent._document_frequency([batch], 50)).to_pydict()
    assert dict(zip(got["word"], got["df"])) == {i: n for i, n in enumerate(df) if n}
    for often in (0, 5, 2048):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(latent, "OFTEN", often)
            z = next(latent._sketch([batch], Shared())).column(2)[0].as_py()
        assert np.allclose(np.frombuffer(z, np.float32).reshape(50, 7), a.T @ (a @ omega), rtol=1e-3, atol=1e-3)


def test_long_text_is_hashed_in_parts(monkeypatch):
    data = " ".join(f"w{i}" for i in range(5000)).encode() + b" " + b"x" * 3000 + b" end"
    w = wd.Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    whole = w.hashes()
    monkeypatch.setattr(wd, "SLICE_BYTES", 100)
    assert (w.hashes() == whole).all() and len(set(whole.tolist())) == 5002


def test_mixed_documents_with_clashing_names(spark):
    df = spark.range(40).select(
        F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.repeat(F.lit("w "), F.col("id").cast("int")).alias("text"),
        *[F.lit(n).alias(n) for n in ("_id", "size", "taken", "mix_id", "epochs")])
    out = mixing.mixed_documents(df)
    assert out.columns == [*df.columns, "size_", "taken_", "epochs_"]
    rows = out.collect()
    assert rows and all(r.size == "size" and r.taken == "taken" and r.size_ == r.doc_id for r in rows)
    assert sum(r.taken_ for r in rows) == sum(range(40))


def test_training_takes_whole_documents_once(spark, monkeypatch):
    """Bad lines behind line 200 count; copies of an id come once; too long documents are only scored."""
    monkeypatch.setattr(linequality, "DOCUMENT_LINES", 900)
    good = "The river runs slowly through the old town.\n"
    bad = "$$$ CLICK ||| BUY >>> ### !!!\n"
    texts = [(i, good * 300) if i % 2 else (i, good * 210 + bad * 600) for i in range(40)] + [(0, good * 210 + bad * 600)] * 50
    texts.append((41, bad * 5000))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(41, 1)], "doc_id long, quality int")
    got = {r.doc_id: r.predicted for r in linequality.quality_scores(docs, labels).collect()}
    assert all(got[i] == i % 2 for i in range(40)) and got[41] == 0
    empty = linequality.quality_scores(docs.limit(0), labels)
    assert empty.count() == 0
