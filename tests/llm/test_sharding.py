import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import sharding as S


def test_whole_table(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = S.digest(S.shuffle(docs)).collect()
    assert Counter(r.doc_id for r in got) == Counter(list(text))
    slots = defaultdict(list)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(16))


def test_records_are_whole_and_reruns_agree(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents").withColumn("shard", F.lit("x")).withColumn("n", F.lit(1))
    many = S.shuffle(docs, shards=3, bucket_bytes=20_000)        # dozens of buckets
    assert set(many.columns) == set(docs.columns) | {"slot"}
    one = sorted((r.shard, r.slot, r.doc_id, r.text) for r in many.collect())
    assert one == sorted((r.shard, r.slot, r.doc_id, r.text) for r in
                         S.shuffle(docs.repartition(7), shards=3, bucket_bytes=20_000).collect())
    assert Counter(d for _, _, d, _ in one) == Counter(r.doc_id for r in docs.collect())
    other = S.shuffle(docs, shards=3, bucket_bytes=20_000, seed=1)
    assert one != sorted((r.shard, r.slot, r.doc_id, r.text) for r in other.collect())
    first = [d for s, _, d, _ in one if s == 0]
    assert abs(np.corrcoef(first, range(len(first)))[0, 1]) < 0.5


def test_shards_are_even_and_grow_into_the_new_one(spark):
    ids = spark.range(20_000)
    rows = ids.select(S.shard_of(F.col("id"), 16).alias("a"), S.shard_of(F.col("id"), 17).alias("b")).collect()
    n = Counter(r.a for r in rows)
    assert len(n) == 16 and max(n.values()) < 1.2 * min(n.values())
    assert all(r.b in (r.a, 16) for r in rows)


def test_written_shards(spark, sf_dir, tmp_path):
    docs = C.table(spark, sf_dir, "documents")
    S.write(S.shuffle(docs, shards=4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    want = sorted((r.shard, r.slot, r.doc_id) for r in S.shuffle(docs, shards=4).collect())
    assert sorted((r.shard, r.slot, r.doc_id) for r in back.collect()) == want


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "a"), (3, "a"), (3, "b"), (None, "n"), (None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_bucket_", F.lit(1))
    got = S.shuffle(df, bucket_bytes=1)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(docs, key=str)
    assert {r.text_crc32 for r in S.digest(got).where("text_crc32 = 0").collect()} == {0}
    assert S.shuffle(df.limit(0)).count() == 0


def test_a_bucket_leaves_in_pieces(monkeypatch):
    monkeypatch.setattr(S, "PIECE_BYTES", 2_000)
    rows = pa.table({"row": [{"doc_id": i, "text": "x" * 100} for i in range(300)], "id": range(300),
                     "key": [0] * 300, "shard": [2] * 300, "bucket": [0] * 300, "first": [50] * 300})
    out = list(S._shuffle(iter(rows.to_batches(max_chunksize=70)), 0))
    assert len(out) > 10 and max(b.nbytes for b in out) < 4_000
    assert [s for b in out for s in b.column("slot").to_pylist()] == list(range(50, 350))
    assert sorted(r["doc_id"] for b in out for r in b.column("row").to_pylist()) == list(range(300))
