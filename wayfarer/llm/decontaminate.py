"""Benchmark decontamination by winnowing.

Of every window of ``span`` words, winnowing keeps the smallest hash among its
k-grams, so two texts that share ``span`` words always share a kept fingerprint.
The fingerprints of the corpus are joined with those of the benchmark inside the
scan; each hit is then extended to the windows around it and confirmed word by
word. The corpus is read once and never shuffled.

The benchmark side is looked up from memory, so it is cut into blocks of at
most ``block_bytes`` of text: one block for an ordinary benchmark, one scan per
block for one that grows beyond it. A corpus of any size gives the same rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm import common as C

WORDS = "alnum_lower"
BLOCK_BYTES = 16 << 20


class Windows:
    """The windows of some benchmark items, by hash, with their fingerprints."""

    def __init__(self, items: list[tuple[str, str]], span: int, k: int):
        self.span, self.k = span, k
        self.of: dict[int, dict[bytes, list[int]]] = {}
        self.ids = [i for i, _ in items]
        found: list[np.ndarray] = []
        lengths: dict[int, list[np.ndarray]] = {}
        for at, (_, text) in enumerate(items):
            raw = (text or "").encode()
            w = C.Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), WORDS)
            if not len(w):
                continue
            n = min(span, len(w))
            tokens = [w.word(i) for i in range(len(w))]
            hashes = w.grams(n)
            for i, h in enumerate(hashes.tolist()):
                owners = self.of.setdefault(h, {}).setdefault(b" ".join(tokens[i:i + n]), [])
                if not owners or owners[-1] != at:
                    owners.append(at)
            if n == span:
                grams = w.grams(k)
                found.append(grams[winnow(grams, span - k + 1)])
            else:
                lengths.setdefault(n, []).append(hashes)
        none = [np.zeros(0, np.uint64)]
        self.prints = np.unique(np.concatenate(found or none))
        self.full = bool(found)
        self.short = {n: np.unique(np.concatenate(v)) for n, v in sorted(lengths.items())}
        self.hashes = np.array(sorted(self.of), np.uint64)


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the minimum of some ``width`` consecutive hashes (all ties)."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = grams[:n].copy()
    for j in range(1, width):
        np.minimum(low, grams[j:j + n], out=low)
    keep = np.zeros(len(grams), bool)
    for j in range(width):
        keep[j:j + n] |= grams[j:j + n] == low
    return np.flatnonzero(keep)


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def hits(w: C.Words, index: Windows) -> list[tuple[int, int, list[int]]]:
    """(first word, words, items) of each benchmark window in the texts of ``w``."""
    out: list[tuple[int, int, list[int]]] = []
    left = w.left()

    def confirm(starts: np.ndarray, n: int) -> None:
        grams = w.grams(n)
        starts = starts[among(grams[starts], index.hashes)]
        for s in starts.tolist():
            items = index.of[int(grams[s])].get(b" ".join(w.word(i) for i in range(s, s + n)))
            if items:
                out.append((s, n, items))

    if index.full and len(w) >= index.span:
        grams = w.grams(index.k)
        kept = winnow(grams, index.span - index.k + 1)
        kept = kept[among(grams[kept], index.prints)]
        around = kept[:, None] - np.arange(index.span - index.k + 1)[None, :]
        around = np.unique(around[around >= 0])
        around = around[around <= len(w) - index.span]
        confirm(around[left[around] >= index.span], index.span)
    for n, hashes in index.short.items():
        if len(w) >= n:
            grams = w.grams(n)
            starts = np.flatnonzero(among(grams, hashes))
            confirm(starts[left[starts] >= n], n)
    return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("doc_key", pa.int64()), ("n_words", pa.int64()),
                     ("starts", pa.list_(pa.int64())), ("stops", pa.list_(pa.int64())),
                     ("items", pa.list_(pa.string()))])
_DDL = ("doc_id long, doc_key long, n_words long, starts array<long>, stops array<long>, "
        "items array<string>")


def scan(batches: Iterator[pa.RecordBatch], index: Windows) -> Iterator[pa.RecordBatch]:
    for part in C.slices(batches, "text"):
        w = C.words_of(part, "text", WORDS)
        spans: list[list] = [[] for _ in range(part.num_rows)]
        items: list[set] = [set() for _ in range(part.num_rows)]
        first = w.first.tolist()
        for s, n, owners in sorted(hits(w, index)):
            d = bisect.bisect_right(first, s) - 1
            s -= first[d]
            if spans[d] and s <= spans[d][-1][1]:
                spans[d][-1][1] = max(spans[d][-1][1], s + n)
            else:
                spans[d].append([s, s + n])
            items[d].update(index.ids[i] for i in owners)
        yield C.arrow_rows({
            "doc_id": part.column("doc_id"), "doc_key": part.column("doc_key"),
            "n_words": w.count,
            "starts": [[a for a, _ in x] for x in spans], "stops": [[b for _, b in x] for x in spans],
            "items": [sorted(x) for x in items]}, _SCHEMA)


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id",
                       text: str = "text", item_id: str = "item_id", item_text: str = "text",
                       span: int = 10, k: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, doc_key (hash of its text), n_words, ``starts``
    and ``stops`` (merged word spans inside benchmark windows) and ``items`` (ids,
    as strings in code-point order, of the items with a window in the document).

    A window is ``span`` words of an item, or all of a shorter one. Null or empty
    texts and items have no words and no windows; an item without an id counts as
    item "null". Repeated rows give repeated results; an empty benchmark gives no
    hits; other columns of either table are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"),
                             F.col(item_text).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       C.text_key(F.col(text)).alias("doc_key"))
    found = None
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        shared = spark.sparkContext.broadcast(Windows([(r.id, r.text) for r in rows], span, k))
        part = slim.mapInArrow(lambda it, s=shared: scan(it, s.value), _DDL)
        found = part if found is None else found.unionByName(part)
    if blocks == 1:
        return found
    # Each block saw every document once: repeated rows agree, so any `blocks` of
    # them stand for one row; their number is kept.
    return (found.groupBy("doc_id", "doc_key", "n_words")
            .agg(F.flatten(F.collect_set(F.arrays_zip("starts", "stops"))).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                 (F.count(F.lit(1)) / blocks).cast("int").alias("n"))
            .withColumn("words", F.array_sort(F.array_distinct(F.flatten(F.transform(
                "spans", lambda x: F.sequence(x.starts, x.stops - 1))))))
            .withColumn("starts", F.filter("words", lambda x: ~F.array_contains("words", x - 1)))
            .withColumn("stops", F.transform(F.filter(
                "words", lambda x: ~F.array_contains("words", x + 1)), lambda x: x + 1))
            .withColumn("again", F.explode(F.sequence(F.lit(1), F.col("n"))))
            .select("doc_id", "doc_key", "n_words", "starts", "stops", "items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id",
                  **options) -> DataFrame:
    """The documents (all columns) that hold no benchmark window; null ids are kept
    or dropped by the same rule."""
    text = options.get("text", "text")
    bad = (find_contamination(docs, benchmark, doc_id=doc_id, **options)
           .where(F.size("items") > 0).select("doc_id", "doc_key").distinct())
    return docs.alias("d").join(
        bad.alias("b"), F.col(f"d.{doc_id}").eqNullSafe(F.col("b.doc_id"))
        & (C.text_key(F.col(f"d.{text}")) == F.col("b.doc_key")), "left_anti")


def digest(found: DataFrame) -> DataFrame:
    """The columns of query op10 from ``find_contamination``."""
    covered = F.aggregate(F.zip_with("starts", "stops", lambda a, b: b - a), F.lit(0).cast("long"),
                          lambda x, y: x + y)
    return found.select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (covered > 0).alias("contaminated"))
