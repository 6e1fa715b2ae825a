"""Shuffled shards by a two-pass external shuffle.

First pass: every record gets a shard by rendezvous hashing of its id, and a bucket of the
shard by another seeded hash; buckets are as many as make each fit in memory. Second
pass: each bucket is put in a fixed order, then shuffled by Fisher and Yates, and its
records get the slots after those of the buckets before it.

A record's shard depends on its id and the number of shards alone, and one more shard
takes records only into itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.llm import common as C

BUCKET_BYTES = 16 << 20
PIECE_BYTES = 1 << 20   # records that leave a task's Python at once


def shard_of(doc_id: Column, shards: int, seed: int = 0) -> Column:
    """The shard whose hash with the id is the largest."""
    best = F.array_max(F.array(*(F.struct(F.xxhash64(F.lit(seed), doc_id, F.lit(i)).alias("h"),
                                          F.lit(i).alias("shard")) for i in range(shards))))
    return best.shard


def _shuffle(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Fisher-Yates over one bucket, from a fixed order. Only places are sorted and shuffled; records
    are taken and handed on in pieces of some PIECE_BYTES, so the bucket is held once."""
    table = pa.Table.from_batches(batches)
    shard, bucket, first = (table.column(c)[0].as_py() for c in ("shard", "bucket", "first"))
    order = pc.sort_indices(table.select(["id", "key"]), sort_keys=[("id", "ascending"), ("key", "ascending")])
    rows = table.select(["row"]).combine_chunks()
    del table
    rng = np.random.default_rng([seed, shard, bucket])
    at = np.arange(len(rows))
    for i, j in zip(range(len(at) - 1, 0, -1), rng.integers(0, np.arange(len(at), 1, -1)), strict=True):
        at[i], at[j] = at[j], at[i]
    order = order.take(pa.array(at))
    step = max(1, len(rows) * PIECE_BYTES // max(1, rows.nbytes))
    for lo in range(0, len(rows), step):
        piece = rows.take(order.slice(lo, step))
        piece = piece.append_column("shard", pa.array(np.full(len(piece), shard, np.int32)))
        yield from piece.append_column("slot", pa.array(first + lo + np.arange(len(piece)))).combine_chunks().to_batches()
    del rows
    pa.default_memory_pool().release_unused()


def shuffle(docs: DataFrame, *, shards: int = 16, doc_id: str = "doc_id", text: str = "text",
            seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The documents (all columns) with ``shard`` and ``slot``, their place in it from 0 without gaps.

    Columns of these two names in the input give way; any other name may occur. Null ids are one key.
    Records that agree in id and text are interchangeable; a null text counts no bytes.
    """
    docs = docs.drop("shard", "slot")
    rows = C.packed(docs)
    doc, body = F.col("row")[doc_id], F.col("row")[text]
    size = F.coalesce(F.octet_length(body), F.lit(0)).cast("long") + 1
    total = rows.agg(F.sum(size)).first()[0] or 0
    buckets = -(-total // (shards * bucket_bytes)) or 1
    keyed = (rows.select("row", doc.alias("id"), C.text_key(body).alias("key"), shard_of(doc, shards, seed).alias("shard"))
             .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "id", "key"), F.lit(buckets)).cast("int")))
    counts = keyed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    first = C.stored(C.before(counts, "bucket", "n", "shard")
                     .select("shard", "bucket", F.col("before").alias("first")), "buckets")
    # One small row per bucket of memory size; Spark decides how to join them by their bytes.
    placed = keyed.join(first, ["shard", "bucket"])
    schema = rows.limit(0).withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).schema

    def _shuffled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _shuffle(batches, seed)

    shuffled = placed.groupBy("shard", "bucket").applyInArrow(_shuffled, schema)
    return shuffled.select(*(F.col("row")[c].alias(c) for c in docs.columns), "shard", "slot")


def write(shuffled: DataFrame, path: str) -> None:
    """Write ``shuffle``'s records as one folder per shard, in files sorted by slot."""
    (shuffled.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def digest(shuffled: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """The columns of query op2 from ``shuffle`` of documents."""
    more = F.when(shard_of(F.col("doc_id"), shards + 1, seed) == shards, shards)
    return shuffled.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.coalesce(more, F.col("shard")).cast("int").alias("grown_shard"))
