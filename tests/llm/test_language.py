import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import language as L


def test_held_out_accuracy(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    model = L.train(docs.where(~L.held_out()))
    got = (L.identify(docs, model).join(docs.select("doc_id", "lang", "text"), "doc_id")
           .withColumn("out", L.held_out()).collect())
    assert len(got) == docs.count()
    for r in got:
        assert r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or ""))
    out = [r for r in got if r.out and r.lang]
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.95


def grams(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    return {raw[i:i + n] for n in range(1, 4) for i in range(len(raw) - n + 1)}


def test_kernel_counts_shared_ngrams():
    texts = ["abcabc", "ABX", "", "é"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(r) for r in raw])
    p = L.presence(np.frombuffer(b"".join(raw), np.uint8), offsets)
    sets = [grams(t) for t in texts]
    want = [[len(a & b) for b in sets] for a in sets]
    assert (p @ p.T == want).all()
    k = L.kernel(p, p)
    assert np.allclose(np.diag(k)[[0, 1, 3]], 1) and k[0, 3] == 0


def test_one_matrix_equals_kernel_regression():
    rng = np.random.default_rng(0)
    x = (rng.random((40, L.CELLS)) < 0.01).astype(np.float32)
    y = np.arange(40) % 2
    x[:, :200] = np.where(y[:, None] == 1, 1, x[:, :200])
    model = L.Model(["a", "b"], x, y)
    # All texts are landmarks here, so this is kernel ridge regression itself.
    k = L.kernel(x, x).astype(float)
    want = k @ np.linalg.solve(k + L.RIDGE * 40 * np.eye(40), np.eye(2)[y])
    got = x @ model.matrix / np.sqrt(x.sum(1))[:, None]
    assert np.allclose(got, want, atol=1e-3)


def test_edge_cases(spark):
    docs = [(1, None, "en"), (2, "", "en"), (3, "123 !", "fr"), (4, "the of and", "en"), (4, "the of and", "en"),
            (5, "le la les été", "fr"), (None, "the", None), (6, "x" * 300_000, None)]
    df = (spark.createDataFrame(docs, "doc_id long, text string, lang string")
          .withColumn("score", F.lit("z")))
    model = L.train(df)
    assert model.labels == ["en", "fr"]
    got = {(r.doc_id, r.lang_pred) for r in L.identify(df, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "fr"), (None, "en")} <= got
    none = L.train(df.limit(0))
    assert {r.lang_pred for r in L.identify(df, none).collect()} == {"und"}
    assert L.identify(df.limit(0), model).count() == 0
    assert L.identified(df, model).columns == df.columns
    assert L.identified(df, model).count() == 5


def test_copies_count_once_in_the_training_draw(spark, monkeypatch):
    monkeypatch.setattr(L, "FIT_PER_LABEL", 20)
    seen = []
    monkeypatch.setattr(L, "Model", lambda labels, x, y: seen.append((labels, x, y)))
    few = [f"{w} of the {i} words" for i in range(5) for w in ("one", "two")]
    rows = ([("aa", few[i % 10]) for i in range(20_000)] + [("bb", f"mot {i}") for i in range(3000)]
            + [("cc", "seul")] + [("dd", "viele Male")] * 20_000 + [("dd", f"ein Text {i}") for i in range(100)])
    L.train(spark.createDataFrame(rows, "lang string, text string"))
    labels, x, y = seen[0]
    assert labels == ["aa", "bb", "cc", "dd"]
    assert np.bincount(y).tolist() == [10, 20, 1, 20]
    for c in range(4):
        assert len(np.unique(x[y == c], axis=0)) == (y == c).sum()
