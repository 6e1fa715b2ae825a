"""Substring dedup by content-defined phrases and window counts over the whole corpus.

This stands in place of relative Lempel-Ziv parsing: no reference blocks, no greedy factors.
The smallest k-gram hash of a window is its anchor, a choice that depends on the
window's words alone, so all copies of a passage are cut alike: a *phrase* is a
maximal run of windows with one anchor. The phrases, grouped by anchor, are the
index.

Of a phrase that occurs again in whole, all windows are
repeats. Where copies part, the windows of a phrase that shares its
anchor but not its words are checked one by one, against the same index, so the
result is exact: a word goes if and only if a window of ``span`` words that covers
it occurs anywhere else.

Hashes of anchor and words together (128 bits) stand for the words. Groups are
counted before rows move, one copy of each phrase speaks for all of them, and
rows meet their counts in joins that Spark can split, so a passage that a third
of all documents hold is no special case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm import common as C

WORDS = "spaces"
_POSITION_BITS = 24
_BLOCK = 1 << 22        # windows cut at once; a cut inside a document is only one more boundary


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if size < width else x


def cut(w: C.Words, span: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor position) of each phrase in ``w``."""
    empty = np.zeros(0, np.int64)
    if len(w) < span:
        return empty, empty, empty
    grams, left = w.grams(k), w.left()
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lo in range(0, len(w) - span + 1, _BLOCK):
        hi = min(lo + _BLOCK, len(w) - span + 1)
        part = grams[lo:hi + span - k]
        key = part >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)
        key |= np.arange(len(part), dtype=np.uint64)
        low = sliding_min(key, span - k + 1)
        at = np.flatnonzero(left[lo:hi] >= span)
        if not len(at):
            continue
        anchor = (low[at] & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        head = np.flatnonzero(np.diff(anchor, prepend=-1))
        out.append((at[head] + lo, np.diff(head, append=len(at)), anchor[head] + lo))
    if not out:
        return empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


_PHRASES = pa.schema([("doc_id", pa.int64()), ("doc_key", pa.int64()), ("anchor", pa.int64()),
                      ("phrase", pa.int64()), ("lo", pa.int32()), ("n", pa.int32())])
_PHRASES_DDL = "doc_id long, doc_key long, anchor long, phrase long, lo int, n int"


def phrases(batches: Iterator[pa.RecordBatch], span: int, k: int) -> Iterator[pa.RecordBatch]:
    for part in C.slices(batches, "text"):
        w = C.words_of(part, "text", WORDS)
        lo, n, anchor = cut(w, span, k)
        if not len(lo):
            continue
        doc = np.searchsorted(w.first, lo, side="right") - 1
        body = w.sums().hash(lo, lo + n + span - 1) + (anchor - lo).astype(np.uint64)
        yield C.arrow_rows({
            "doc_id": part.column("doc_id").take(pa.array(doc)),
            "doc_key": part.column("doc_key").take(pa.array(doc)),
            "anchor": w.grams(k)[anchor].view(np.int64), "phrase": C.mix(body).view(np.int64),
            "lo": (lo - w.first[doc]).astype(np.int32), "n": n.astype(np.int32)}, _PHRASES)


_WINDOWS = pa.schema([("anchor", pa.int64()), ("window", pa.int64()), ("pid", pa.int64()),
                      ("off", pa.int8())])
_WINDOWS_DDL = "anchor long, window long, pid long, off byte"


def windows(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """One row per window of the phrases listed with each document."""
    for part in C.slices(batches, "text"):
        w = C.words_of(part, "text", WORDS)
        asked = part.column("asked")
        size = np.diff(asked.offsets.to_numpy())
        rows = asked.flatten()
        anchor, pid, lo, n = (rows.field(x).to_numpy(zero_copy_only=False)
                              for x in ("anchor", "pid", "lo", "n"))
        lo = lo + np.repeat(w.first[:-1], size)
        which = np.repeat(np.arange(len(n)), n)
        off = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        start = lo[which] + off
        yield C.arrow_rows({"anchor": anchor[which],
                            "window": w.sums().hash(start, start + span).view(np.int64),
                            "pid": pid[which], "off": off.astype(np.int8)}, _WINDOWS)


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                   ("kept", pa.string()), ("starts", pa.list_(pa.int64())),
                   ("stops", pa.list_(pa.int64()))])
_KEPT_DDL = ("doc_id long, n_words long, n_removed long, kept string, starts array<long>, "
             "stops array<long>")


def keep(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """The words of each document outside its repeated windows, joined by one space."""
    for part in C.slices(batches, "text"):
        w = C.words_of(part, "text", WORDS)
        change = np.zeros(len(w) + 1, np.int64)
        rows = part.column("repeats")
        size = np.diff(rows.offsets.to_numpy())
        rows = rows.flatten()
        if len(rows):
            base = np.repeat(w.first[:-1], size)
            lo, n, mask = (rows.field(x).to_numpy(zero_copy_only=False) for x in ("lo", "n", "mask"))
            lo = lo + base
            whole = mask == -1
            np.add.at(change, lo[whole], 1)
            np.add.at(change, lo[whole] + n[whole] + span - 1, -1)
            lo, mask = lo[~whole], mask[~whole]
            for bit in range(span):
                at = lo[mask >> bit & 1 == 1] + bit
                np.add.at(change, at, 1)
                np.add.at(change, at + span, -1)
        gone = np.cumsum(change[:-1]) > 0
        data, texts, starts, stops = w.data, [], [], []
        first = w.first.tolist()
        for d in range(part.num_rows):
            a, b = first[d], first[d + 1]
            g = gone[a:b]
            edge = np.flatnonzero(np.diff(g, prepend=False, append=False))
            starts.append(edge[::2])
            stops.append(edge[1::2])
            if a == b:
                texts.append("")
                continue
            raw = data[w.start[a]:w.stop[b - 1]].tobytes()
            if len(edge):
                inside = np.flatnonzero(np.diff(~g, prepend=False, append=False))
                shift = w.start[a]
                raw = b" ".join(raw[w.start[a + x] - shift:w.stop[a + y - 1] - shift]
                                for x, y in zip(inside[::2], inside[1::2], strict=True))
            texts.append(b" ".join(raw.split()).decode())
        yield C.arrow_rows({
            "doc_id": part.column("doc_id"), "n_words": w.count,
            "n_removed": np.add.reduceat(np.append(gone, False), w.first[:-1]) * (w.count > 0),
            "kept": texts, "starts": starts, "stops": stops}, _KEPT)


def find_repeats(docs: DataFrame, span: int, k: int) -> DataFrame:
    """doc_id, doc_key and the repeated windows: ``n`` from word ``lo`` on, all of
    them (mask -1) or those whose bit of ``mask`` is set."""
    found = docs.mapInArrow(lambda it: phrases(it, span, k), _PHRASES_DDL)
    # Stored, as are the counts below: a join against a fresh exchange on either
    # side lets Spark split the rows of one hot anchor over many tasks.
    groups = C.stored(
        found.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("phrase").alias("a"), F.max("phrase").alias("b"))
        .where("rows > 1").select("anchor", (F.col("a") == F.col("b")).alias("uniform")), "anchors")
    near = C.stored(found.join(groups, "anchor"), "phrases")
    mixed = near.where("not uniform")
    kinds = C.stored(mixed.groupBy("anchor", "phrase")
                     .agg(F.count(F.lit(1)).alias("rows"),
                          F.min(F.struct("doc_id", "doc_key", "lo", "n")).alias("at")), "kinds")
    whole = (near.where("uniform").select("doc_id", "doc_key", "lo", "n")
             .unionByName(mixed.join(kinds.where("rows > 1").select("anchor", "phrase"),
                                     ["anchor", "phrase"], "left_semi")
                          .select("doc_id", "doc_key", "lo", "n"))
             .withColumn("mask", F.lit(-1).cast("long")))
    asked = (kinds.select("anchor", "at.*", F.xxhash64("anchor", "phrase").alias("pid"))
             .groupBy("doc_id", "doc_key")
             .agg(F.collect_list(F.struct("anchor", "pid", "lo", "n")).alias("asked")))
    rows = C.stored(_with(docs, asked, "inner", "asked")
                    .mapInArrow(lambda it: windows(it, span), _WINDOWS_DDL), "windows")
    again = C.stored(rows.groupBy("anchor", "window").count().where("count > 1")
                     .select("anchor", "window"), "again")
    masks = (rows.join(again, ["anchor", "window"], "left_semi")
             .groupBy("anchor", "pid").agg(F.bit_or(F.expr("shiftleft(1L, off)")).alias("mask")))
    parts = (kinds.where("rows = 1")
             .select("anchor", "at.*", F.xxhash64("anchor", "phrase").alias("pid"))
             .join(masks, ["anchor", "pid"]).select("doc_id", "doc_key", "lo", "n", "mask"))
    return whole.unionByName(parts)


def _with(docs: DataFrame, lists: DataFrame, how: str, column: str) -> DataFrame:
    lists = lists.withColumnsRenamed({"doc_id": "_id", "doc_key": "_key"})
    return (docs.join(lists, F.col("doc_id").eqNullSafe(F.col("_id"))
                      & (F.col("doc_key") == F.col("_key")), how)
            .select("doc_id", "doc_key", "text", column))


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                   span: int = 35, k: int = 8) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, ``kept`` (the words left,
    joined by one space) and ``starts``, ``stops`` (the removed word spans).

    Words are runs without ASCII white space. Every word inside a run of ``span``
    words whose sequence also starts elsewhere goes, all copies alike, judged on the
    input. Texts shorter than ``span`` words keep all their words; a null or empty
    text has none. Repeated rows repeat each other's windows. Null ids are ids like
    any other; other columns are not read.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       C.text_key(F.col(text)).alias("doc_key"))
    repeats = (find_repeats(docs, span, k).groupBy("doc_id", "doc_key")
               .agg(F.collect_list(F.struct("lo", "n", "mask")).alias("repeats")))
    none = F.array().cast("array<struct<lo:int,n:int,mask:bigint>>")
    return (_with(docs, repeats, "left", "repeats")
            .withColumn("repeats", F.coalesce("repeats", none))
            .mapInArrow(lambda it: keep(it, span), _KEPT_DDL))


def digest(kept: DataFrame) -> DataFrame:
    """The columns of query op3 from ``remove_repeats``."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
