import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import token_output as T
from wayfarer.llm.queries import VOCABULARY


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    for key in (0, 9):
        assert sorted(T.permute(np.arange(n), n, key)) == list(range(n))
    if n > 60:
        assert (T.permute(np.arange(n), n, 0) != T.permute(np.arange(n), n, 1)).any()


def ids_of(text):
    with open(VOCABULARY, "rb") as f:
        return [*T._encoding(f.read()).encode_ordinary(text or ""), 50256]


def test_round_trip(spark, sf_dir, tmp_path):
    docs = C.table(spark, sf_dir, "documents")
    made = C.stored(T.materialise(docs, VOCABULARY, length=64, shard_records=100), "records")
    rows = sorted(made.collect(), key=lambda r: r.seq)
    n = len(rows)
    assert [r.seq for r in rows] == list(range(n)) and sorted(r.slot for r in rows) == list(range(n))
    assert all(r.shard == r.slot // 100 and len(r.ids) == 128 for r in rows)
    assert all(r.n_tokens == 64 for r in rows[:-1])
    stream = np.concatenate([np.frombuffer(r.ids, "<u2")[:r.n_tokens] for r in rows]).tolist()
    parts, at = [], 0
    for i in np.flatnonzero(np.array(stream) == 50256):
        parts.append(tuple(stream[at:i + 1]))
        at = i + 1
    assert at == len(stream)
    assert sorted(parts) == sorted(tuple(ids_of(r.text)) for r in docs.collect())
    # Files: fixed stride, sequential from any slot on.
    uri = f"file://{tmp_path}/shards"
    sizes = {r.shard: r.bytes for r in T.write(made, uri, shard_records=100).collect()}
    assert sizes == {s: 128 * min(100, n - 100 * s) for s in range(-(-n // 100))}
    by_slot = [r.ids for r in sorted(rows, key=lambda r: r.slot)]
    for slot in (0, 99, 100, n - 1, 137):
        assert [x.tobytes() for x in T.read(uri, slot, length=64, shard_records=100)] == by_slot[slot:]


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "Aé\n  b 12"), (3, "Aé\n  b 12"), (None, "x" * 5000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("slot", F.lit(1)).coalesce(1)
    rows = sorted(T.materialise(df, VOCABULARY, length=16).collect(), key=lambda r: r.seq)
    stream = [x for r in rows for x in np.frombuffer(r.ids, "<u2")[:r.n_tokens].tolist()]
    assert sorted(stream) == sorted(i for _, t in docs for i in ids_of(t))
    assert T.materialise(df.limit(0), VOCABULARY).count() == 0


def test_order_does_not_depend_on_the_split(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    some = docs.where("doc_id < 40")
    docs = docs.union(some).union(some)          # repeated rows
    wanted = None
    for given in (docs, docs.repartition(3), docs.orderBy(F.col("doc_id").desc()).coalesce(1)):
        made = T.materialise(given, VOCABULARY, length=64, shard_records=50)
        rows = sorted(tuple(r) for r in made.collect())
        assert wanted is None or rows == wanted
        wanted = rows
    parts = made.select("shard", F.spark_partition_id().alias("task")).distinct().collect()
    assert sorted((r.shard, r.task) for r in parts) == [(i, i) for i in range(len(parts))]


def test_rows_equal_in_id_and_text_fall_into_several_ranges(spark):
    same = spark.range(6000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three").alias("text"))
    rows = T.materialise(same.repartition(8), VOCABULARY, length=16).collect()
    one = ids_of("one two three")
    stream = [x for r in sorted(rows, key=lambda r: r.seq) for x in np.frombuffer(r.ids, "<u2")[:r.n_tokens].tolist()]
    assert stream == one * 6000
