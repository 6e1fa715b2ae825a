import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import mixing as M


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water(sizes):
    """Targets by sharing again and again, as the contract words it."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level > 2 * sizes[s]]
        if not over:
            return out | {s: w[s] * level for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def check(docs, got):
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += words(text)
    want = water(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(d), words(t)) for d, t, _ in docs)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6


def test_whole_table(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    got = M.mix(docs).collect()
    check([(r.doc_id, r.text, r.source) for r in docs.collect()], got)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = sorted(con.execute(M.oracle()).fetchall())
    assert want == sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got)


def test_order_is_random_within_a_source_and_stable(spark):
    docs = [(i, "w " * (1 + i % 7), "b") for i in range(2000)] + [(i, "w " * 3, "a") for i in range(5000, 5100)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    one = sorted(tuple(r) for r in M.mix(df).collect())
    check(docs, M.mix(df).collect())
    assert one == sorted(tuple(r) for r in M.mix(df.repartition(5)).collect())
    assert one != sorted(tuple(r) for r in M.mix(df, seed=1).collect())


def test_edge_cases(spark):
    docs = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (3, "x y", None), (None, "p q r", "b"),
            (4, "é", "empty"), (5, " \n", "none"), (6, "w " * 50, "é"), (7, "w " * 40, "z"), (8, "w " * 9, "z")]
    df = (spark.createDataFrame(docs, "doc_id long, text string, source string")
          .withColumn("part", F.lit(1)).withColumn("size", F.lit("x")))
    got = M.mix(df).collect()
    check(docs, got)
    assert M.mix(df.limit(0)).count() == 0
    mixed = M.materialise(df)
    assert mixed.columns == df.columns
    copies = Counter((r.doc_id, r.text) for r in mixed.collect())
    want = Counter()
    for r in got:
        if r.size:
            want[r.doc_id] += int(r.taken / r.size + 0.5)
    assert {k: v for k, v in want.items() if v} == {
        k: sum(v for (d, _), v in copies.items() if d == k) for k in {d for d, _ in copies}}
