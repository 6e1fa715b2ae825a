"""Helpers the llm operators share: tables, shared-folder writes, word hashing.

Word hashing works on the UTF-8 bytes of a whole Arrow batch with numpy: no
Python object is made per word. Texts are handled in slices of some megabytes
(one long text is one slice), so memory follows the longest text, not a batch.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfarer.session import ensure_checkpoint_dir

SLICE_BYTES = 2 << 20   # text handled at once in a task
CHUNK_BYTES = 1 << 20   # bytes hashed at once; cut between words
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15           # odd: invertible modulo 2**64
ODD = np.uint64(_BASE)
_BASE_INV = pow(_BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Cut lineage: write ``df`` to the shared checkpoint folder and read it back
    (``compression``: that of the files, else Spark's setting)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


_AT_BITS = 33      # as in monotonically_increasing_id()


def ranged(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` sorted as a whole and stored, with ``part`` (its range) and ``at`` (its
    place there): together the global order, from which prefix sums are taken."""
    place = F.monotonically_increasing_id()
    return stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("place", place)
                  .withColumn("part", F.shiftright("place", _AT_BITS).cast("int"))
                  .withColumn("at", F.col("place").bitwiseAND((1 << _AT_BITS) - 1)).drop("place"), name)


def before(sums: DataFrame, order: str, value: str, *group: str) -> DataFrame:
    """Adds ``before``, the sum of ``value`` over the rows earlier by ``order`` in the
    group. For a few sums per range or bucket, not for rows: a group is one task."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("before", F.coalesce(F.sum(value).over(w), F.lit(0)))


def packed(df: DataFrame) -> DataFrame:
    """``df`` as one struct column, ``row``: names added beside it cannot clash with its own."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def text_key(text: Column) -> Column:
    """64-bit hash of a text; with the id it names one document (null: a fixed value)."""
    return F.xxhash64(text)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (splitmix finaliser), on a copy."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, n a power of two."""
    out = np.ones(n, np.uint64)
    size, step = 1, base
    while size < n:
        out[size:2 * size] = out[:size] * np.uint64(step)
        step = step * step % (1 << 64)
        size *= 2
    return out


def powers(n: int, base: int) -> np.ndarray:
    return _powers(1 << max(4, int(n).bit_length()), base)


@functools.cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@functools.cache
def byte_tables(kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, folded byte) for ``spaces`` (words between ASCII white
    space, unchanged), ``spaces_lower`` (the same, A-Z lowered), ``phrases`` (between
    spaces, tabs and the ends of pieces, A-Z lowered) or ``alnum_lower`` (runs of 0-9,
    a-z and non-ASCII bytes, A-Z lowered)."""
    word, fold = np.ones(256, bool), np.arange(256, dtype=np.uint8)
    if kind != "spaces":
        fold[65:91] += 32
    if kind.startswith("spaces"):
        word[np.frombuffer(SPACE_BYTES, np.uint8)] = False
    elif kind == "phrases":
        word[np.frombuffer(b"\x20\x09" + PIECE_ENDS, np.uint8)] = False
    else:
        word[:128] = False
        for lo, hi in ((48, 58), (65, 91), (97, 123)):
            word[lo:hi] = True
    return word, fold


@functools.cache
def piece_ends() -> np.ndarray:
    """Whether a byte ends a piece of text."""
    out = np.zeros(256, bool)
    out[np.frombuffer(PIECE_ENDS, np.uint8)] = True
    return out


class Words:
    """The words of some texts: 64-bit hashes, byte spans, and where each text begins.

    ``first[d]:first[d + 1]`` are the words of text d; ``data`` the bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: str):
        self.data, self.kind = data, kind
        is_word, fold = byte_tables(kind)
        lo, end = int(offsets[0]), int(offsets[-1])
        starts, stops, hashes = [], [], []
        while lo < end:
            hi = min(end, lo + CHUNK_BYTES)
            while hi < end and is_word[data[hi]] and is_word[data[hi - 1]]:
                step = np.flatnonzero(~is_word[data[hi:hi + CHUNK_BYTES]])
                hi = hi + int(step[0]) if len(step) else min(end, hi + CHUNK_BYTES)
            part = data[lo:hi]
            flag = is_word[part]
            begin = flag.copy()
            begin[1:] &= ~flag[:-1]
            cut = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi)] - lo
            begin[cut] = flag[cut]            # a text's first byte never continues a word
            s = np.flatnonzero(begin)
            if len(s):
                stop = np.zeros(len(part) + 1, bool)
                stop[1:-1] = flag[:-1] & ~flag[1:]
                stop[-1] = flag[-1]
                cut = cut[cut > 0]
                stop[cut] = flag[cut - 1]
                e = np.flatnonzero(stop)
                value = _byte_values()[fold[part]]
                value *= powers(len(part), _BASE)[:len(part)]
                total = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(value, out=total[1:])
                h = (total[e] - total[s]) * powers(len(part), _BASE_INV)[s]
                hashes.append(mix(h ^ (e - s).astype(np.uint64)))
                starts.append(s + lo)
                stops.append(e + lo)
            lo = hi
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.stop = np.concatenate(stops) if stops else np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.hash)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def left(self) -> np.ndarray:
        """For each word, the number of words of its text from it on."""
        return np.repeat(self.first[1:], self.count) - np.arange(len(self))

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n words from each position (meaningful where left() >= n)."""
        size = max(0, len(self) - n + 1)
        out = np.zeros(size, np.uint64)
        for j in range(n):
            out *= np.uint64(_BASE)
            out += self.hash[j:j + size]
        return mix(out)

    def sums(self) -> "Spans":
        return Spans(self.hash)

    def word(self, i: int) -> bytes:
        raw = self.data[self.start[i]:self.stop[i]].tobytes()
        return raw.lower() if self.kind != "spaces" else raw


class Spans:
    """Hashes of any run of consecutive word hashes, from one prefix sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(n, _BASE)[:n], out=self.total[1:])
        self.inverse = powers(n, _BASE_INV)

    def hash(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.total[hi] - self.total[lo]) * self.inverse[lo]
                   ^ (hi - lo).astype(np.uint64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as the empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches in row slices of about SLICE_BYTES of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, side="right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi


def words_of(batch: pa.RecordBatch, column: str, kind: str) -> Words:
    return Words(*text_bytes(batch.column(column)), kind)


def arrow_rows(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
         for f, c in zip(schema, columns.values(), strict=True)], schema=schema)
