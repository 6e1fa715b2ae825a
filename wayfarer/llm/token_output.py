"""Token ids as fixed-stride binary shards in training order.

Documents are put in the order of a hash of id and text, whatever files or partitions they come
from, and tokenised once; their ids, each document closed by an end mark, are one
long stream, cut into sequences of equal length. A keyed Feistel permutation, walked until it
lands among the sequences, gives every sequence its global slot in training order. Slots
are cut into ranges, one per shard; a shard is a file of records of one size, so a reader
finds slot s at a known byte and can stop and go on anywhere.

Only token counts per range of that order come together, for the prefix sums. Sequences that several
documents share are put together by slot after the one shuffle of the ids, a task for each shard.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm import common as C

# The public pre-tokenisation pattern of the byte-level BPE vocabularies.
PATTERN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LENGTH = 1024        # ids of a sequence
SHARD_RECORDS = 8192
ROUNDS = 6


@functools.lru_cache(maxsize=2)
def _encoding(ranks: bytes):
    import tiktoken
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines() if ranks else [])}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1 at the points ``x``: a balanced Feistel network on the
    smallest even number of bits, repeated for points outside (cycle-walking)."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = C.mix(np.uint64(key) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = x.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> shift, x[todo] & mask
        for k in keys:
            left, right = right, left ^ (C.mix(right ^ k) & mask)
        x[todo] = left << shift | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


_TOKENS = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start", pa.int64()), ("n", pa.int64()),
                     ("ids", pa.binary())])


def _tokenise(batches: Iterator[pa.RecordBatch], ranks: bytes, end: int, dtype: str) -> Iterator[pa.RecordBatch]:
    """Ids of each document with the end mark; ``start`` counts ids of the range."""
    encode = _encoding(ranks).encode_ordinary
    done = 0
    for part in C.slices(batches, "text"):
        ids = [np.array([*encode(t or ""), end], dtype) for t in part.column("text").to_pylist()]
        n = np.array([len(x) for x in ids])
        yield C.arrow_rows({"doc_id": part.column("doc_id"), "part": part.column("part"),
                            "start": done + np.cumsum(n) - n, "n": n, "ids": [x.tobytes() for x in ids]}, _TOKENS)
        done += int(n.sum())


_PIECES = pa.schema([("shard", pa.int32()), ("slot", pa.int64()), ("seq", pa.int64()), ("off", pa.int32()),
                     ("n", pa.int32()), ("ids", pa.binary())])
CODEC = "zstd"       # of the ids while they are moved


def _cut(batches: Iterator[pa.RecordBatch], length: int, count: int, key: int, per_shard: int,
         width: int) -> Iterator[pa.RecordBatch]:
    """Each document's ids, cut where the sequences of the whole stream begin, and compressed."""
    pack = pa.Codec(CODEC).compress
    for part in C.slices(batches, "ids"):
        start = part.column("start").to_numpy() + part.column("before").to_numpy()
        n = part.column("n").to_numpy()
        first, last = start // length, (start + n - 1) // length
        doc = np.repeat(np.arange(len(n)), last - first + 1)
        seq = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1)
        lo = np.maximum(seq * length, start[doc]) - start[doc]
        hi = np.minimum((seq + 1) * length, (start + n)[doc]) - start[doc]
        slot = permute(seq, count, key)
        raw = part.column("ids").to_pylist()
        yield C.arrow_rows({
            "shard": (slot // per_shard).astype(np.int32), "slot": slot, "seq": seq,
            "off": (lo + start[doc] - seq * length).astype(np.int32), "n": (hi - lo).astype(np.int32),
            "ids": [pack(raw[d][a * width:b * width], asbytes=True) for d, a, b in zip(doc.tolist(), lo.tolist(), hi.tolist(), strict=True)],
        }, _PIECES)


_RECORDS = pa.schema([("shard", pa.int32()), ("slot", pa.int64()), ("seq", pa.int64()), ("n_tokens", pa.int32()),
                      ("ids", pa.binary())])
_RECORDS_DDL = "shard int, slot long, seq long, n_tokens int, ids binary"


def _assemble(batches: Iterator[pa.RecordBatch], length: int, pad: bytes) -> Iterator[pa.RecordBatch]:
    """Records from pieces sorted by slot and offset; the last sequence is padded."""
    width = len(pad)
    unpack = pa.Codec(CODEC).decompress
    held: list = []      # shard, slot, seq, pieces

    def records(rows):
        ids = [b"".join(r[3]) for r in rows]
        return C.arrow_rows({
            "shard": [r[0] for r in rows], "slot": [r[1] for r in rows], "seq": [r[2] for r in rows],
            "n_tokens": [len(x) // width for x in ids],
            "ids": [x + pad * (length - len(x) // width) for x in ids]}, _RECORDS)

    for part in batches:
        rows = []
        for shard, slot, seq, n, ids in zip(
                *(part.column(c).to_pylist() for c in ("shard", "slot", "seq", "n", "ids")), strict=True):
            if not held or held[-1][1] != slot:
                rows += held
                held = [[shard, slot, seq, []]]
            held[-1][3].append(unpack(ids, n * width, asbytes=True))
        if rows:
            yield records(rows)
    if held:
        yield records(held)


def materialise(docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text",
                end: int = 50256, length: int = LENGTH, key: int = 0,
                shard_records: int = SHARD_RECORDS) -> DataFrame:
    """One row per sequence: shard, slot (its place in training order), seq (its place in the
    stream), n_tokens, ids (``length`` little-endian ids; the last sequence is
    padded with ``end``).

    ``vocabulary`` is a file of BPE ranks, read on the driver (below 2 MB) and sent to the tasks.
    Ids take two bytes if ``end`` and all ranks do, else four. The stream is in the order of a hash of id
    and text, so the records depend on the rows and not on how they are split or ordered. A null or
    empty text is its end mark alone; repeated rows are repeated and may lie in several ranges; an
    empty table gives no sequences; other columns are not read.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        ranks = f.read()
    top = max([end, *(int(line.split()[1]) for line in ranks.splitlines())])
    dtype = "<u2" if top < 1 << 16 else "<u4"
    width = np.dtype(dtype).itemsize
    shared = spark.sparkContext.broadcast(ranks)
    # Rows equal in id and text give the same ids, so any order among them (``tie``) gives the same
    # stream; it only lets the ranges split them.
    order = ["place", "doc_id", "key", "tie"]
    rows = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .withColumns({"place": F.xxhash64("doc_id", "text"), "key": C.text_key(F.col("text")),
                          "tie": F.monotonically_increasing_id()})
            .repartitionByRange(*order).sortWithinPartitions(*order))
    tokens = C.stored(
        rows.select("doc_id", "text", F.spark_partition_id().alias("part"))
        .mapInArrow(lambda it: _tokenise(it, shared.value, end, dtype),
                    "doc_id long, part int, start long, n long, ids binary"), "tokens", compression=CODEC)
    sums = tokens.groupBy("part").agg(F.sum("n").alias("n"))
    total = sums.agg(F.sum("n")).first()[0] or 0
    count = -(-total // length)
    starts = C.stored(C.before(sums, "part", "n").select("part", "before"), "starts")
    # One row for each range.
    pieces = (tokens.join(F.broadcast(starts), "part").select("start", "before", "n", "ids")
              .mapInArrow(lambda it: _cut(it, length, count, key, shard_records, width),
                          "shard int, slot long, seq long, off int, n int, ids binary"))
    shards = max(1, -(-count // shard_records))
    pad = np.array([end], dtype).tobytes()
    return (pieces.repartitionById(shards, "shard").sortWithinPartitions("slot", "off")
            .mapInArrow(lambda it: _assemble(it, length, pad), _RECORDS_DDL))


def write(records: DataFrame, uri: str, *, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """Write ``materialise``'s records as ``shard-NNNNNN.bin`` under a folder that all executors see.

    Returns shard and bytes. A shard is written under the task's own name, then renamed, so a
    repeated or lost task leaves whole files only."""
    schema = pa.schema([("shard", pa.int32()), ("bytes", pa.int64())])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        store, folder = fs.FileSystem.from_uri(uri)
        store.create_dir(folder, recursive=True)
        mark = TaskContext.get().taskAttemptId()
        done: dict[int, int] = {}
        out, now = None, None

        def close():
            if out is not None:
                out.close()
                store.move(f"{folder}/_{now}-{mark}", f"{folder}/shard-{now:06d}.bin")

        for part in batches:
            for shard, ids in zip(part.column("shard").to_pylist(), part.column("ids").to_pylist(), strict=True):
                if shard != now:
                    close()
                    out, now = store.open_output_stream(f"{folder}/_{shard}-{mark}"), shard
                    done[shard] = 0
                out.write(ids)
                done[shard] += len(ids)
        close()
        yield C.arrow_rows({"shard": list(done), "bytes": list(done.values())}, schema)

    shards = records.select("shard", "slot", "ids").repartition("shard").sortWithinPartitions("shard", "slot")
    return C.stored(shards.mapInArrow(put, "shard int, bytes long"), "written")


def read(uri: str, slot: int, *, length: int = LENGTH, dtype: str = "<u2",
         shard_records: int = SHARD_RECORDS) -> Iterator[np.ndarray]:
    """The sequences from ``slot`` on, in training order."""
    store, folder = fs.FileSystem.from_uri(uri)
    size = length * np.dtype(dtype).itemsize
    shard, skip = divmod(slot, shard_records)
    while (info := store.get_file_info(f"{folder}/shard-{shard:06d}.bin")).type == fs.FileType.File:
        with store.open_input_file(info.path) as f:
            f.seek(skip * size)
            while raw := f.read(size):
                yield np.frombuffer(raw, dtype)
        shard, skip = shard + 1, 0
