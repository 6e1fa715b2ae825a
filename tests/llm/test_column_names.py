"""Documents may have columns of any name, the operators' own internal ones too."""

import pytest
from pyspark.sql import functions as F

from wayfarer.llm import embedding_dedup, minhash, mixing, sharding

NAMES = """_key _shard _bucket _first _rows _copies _time _rank _times _doc_key _kept_key _kept_id _id _mix_id _mix_key row id key
kept_id kept_key mix_id mix_key copies rows rank times time bucket first n before doc_key size taken target part at place""".split()


@pytest.mark.parametrize("operator", [
    lambda d: sharding.shuffle(d, shards=3), mixing.materialise, lambda d: minhash.deduplicate(d, k=2)],
    ids=["shuffle", "materialise", "deduplicate"])
def test_own_columns_come_back_unchanged(spark, operator):
    rows = [(i, f"some words of text number {i} and {i * i}", "en", f"s{i % 2}") for i in range(20)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = plain
    for name in NAMES:
        docs = docs.withColumn(name, F.concat(F.lit(f"own {name} "), F.col("doc_id").cast("string")))
    got = operator(docs)
    assert [c for c in got.columns if c not in ("shard", "slot")] == docs.columns
    out = got.collect()
    assert out and all(r[name] == f"own {name} {r.doc_id}" for r in out for name in NAMES)
    assert sorted((r.doc_id, r.text) for r in out) == sorted((r.doc_id, r.text) for r in operator(plain).collect())


def test_vectors_whose_squares_overflow(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1e200]), (3, [1e-200, 1.01e-200]), (4, [1.0, 1.0]), (5, [-1e300, 1e-300]),
            (6, [0.0, 0.0]), (7, [float("inf"), 1.0])]
    got = embedding_dedup.find_near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), least=0.9)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == {
        1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (0, 6), 7: (0, 7)}
