"""Language identification with a string kernel.

Blended-spectrum presence kernel: two texts are compared by how many byte n-grams (1
to 3, lower case) both contain, normalised by the number each contains. N-grams are
hashed into a fixed number of cells. A Nyström map from landmark texts turns the kernel
into features; one-versus-rest ridge regression on them scores the languages. For
prediction landmarks, map and weights multiply to one matrix, so a batch of texts
is scored by one matrix product of its presence matrix.

The model is fitted on a bounded sample of labelled texts; predictions read whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm import common as C

CELLS = 1 << 15
ORDERS = 3
FIT_PER_LABEL = 300      # labelled texts used per language, at most
LANDMARKS = 200          # of them, over all languages
LABELS = 1000            # languages, at most
RIDGE = 1e-3
UNKNOWN = "und"
_BATCH = 64


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts x CELLS) 0/1 matrix of the n-grams that each text contains."""
    out = np.zeros((len(offsets) - 1, CELLS), np.float32)
    flat = out.reshape(-1)
    for lo in range(int(offsets[0]), int(offsets[-1]), C.CHUNK_BYTES):
        hi = min(lo + C.CHUNK_BYTES, int(offsets[-1]))
        tail = min(hi + ORDERS - 1, int(offsets[-1]))
        part = data[lo:tail].astype(np.uint32)
        part[(part >= 65) & (part <= 90)] += 32
        row = np.searchsorted(offsets, np.arange(lo, tail), side="right") - 1
        code = np.zeros(hi - lo, np.uint32)
        for n in range(ORDERS):
            size = min(hi - lo, len(part) - n)
            code = code[:size] * np.uint32(257) + part[n:n + size] + np.uint32(1)
            cell = (code * np.uint32(2654435761)) >> np.uint32(32 - CELLS.bit_length() + 1)
            same = row[:size] == row[n:n + size]
            flat[(row[:size] * CELLS + cell)[same]] = 1
    return out


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(1, a.sum(1))[:, None] * np.maximum(1, b.sum(1))[None, :])
    return a @ b.T / size


class Model:
    """``labels`` and the matrix that takes a normalised presence row to its scores."""

    def __init__(self, labels: list[str], x: np.ndarray, y: np.ndarray, seed: int = 7):
        self.labels = labels
        rng = np.random.default_rng(seed)
        share = [rng.permutation(np.flatnonzero(y == c))[:max(1, LANDMARKS // max(1, len(labels)))]
                 for c in range(len(labels))]
        marks = x[np.sort(np.concatenate(share))] if labels else x[:0]
        if not labels:
            self.matrix = np.zeros((CELLS, 0), np.float32)
            return
        value, vector = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
        keep = value > 1e-8
        nystrom = vector[:, keep] / np.sqrt(value[keep])
        phi = kernel(x, marks) @ nystrom
        target = np.eye(len(labels))[y]
        weights = np.linalg.solve(phi.T @ phi + RIDGE * len(x) * np.eye(phi.shape[1]), phi.T @ target)
        marks = marks / np.sqrt(np.maximum(1, marks.sum(1)))[:, None]
        self.matrix = (marks.T @ (nystrom @ weights)).astype(np.float32)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.zeros((len(offsets) - 1, len(self.labels)))
        for lo in range(0, len(out), _BATCH):
            p = presence(data, offsets[lo:lo + _BATCH + 1])
            out[lo:lo + _BATCH] = (p @ self.matrix) / np.sqrt(np.maximum(1, p.sum(1)))[:, None]
        return out


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("cells", pa.binary())])
    for part in C.slices(batches, "text"):
        data, offsets = C.text_bytes(part.column("text"))
        for lo in range(0, part.num_rows, _BATCH):
            p = presence(data, offsets[lo:lo + _BATCH + 1])
            rows = [np.packbits(r > 0).tobytes() for r in p]
            yield C.arrow_rows({"lang": part.column("lang").slice(lo, _BATCH), "cells": rows}, schema)


def train(labelled: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """Fit on at most FIT_PER_LABEL different texts of each language, drawn by a hash of the text.

    The driver receives 4 KB for each drawn text, however long it is. Rows without text or
    language are not used; no labelled row gives a model that knows no language. Of more than
    LABELS languages those with the most different texts are learnt."""
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"),
                           F.xxhash64(F.col(text)).alias("draw")).where("lang is not null and text <> ''")
    # Hashes are counted and drawn, copies once, before any text moves.
    draws = C.stored(rows.select("lang", "draw").distinct(), "draws")
    sizes = draws.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LABELS)
    wide = {r["lang"]: r["count"] for r in sizes.collect()}
    cuts = dict.fromkeys(wide, 0.0)
    factor = 4.0
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    unit = (F.col("draw") / F.lit(2.0 ** 64)) + 0.5
    while wide:      # a language whose draw came out short is drawn again from a wider cut
        cuts |= {k: factor * FIT_PER_LABEL / n for k, n in wide.items()}
        share = F.create_map(*[F.lit(v) for pair in cuts.items() for v in pair])
        few = draws.where(unit <= F.element_at(share, F.col("lang")))
        got = {r["lang"]: r["count"] for r in few.groupBy("lang").count().collect()}
        wide = {k: n for k, n in wide.items() if got.get(k, 0) < min(FIT_PER_LABEL, n)}
        factor *= 4
    if not cuts:
        return Model([], np.zeros((0, CELLS), np.float32), np.zeros(0, int))
    last = (few.withColumn("rank", rank).where(F.col("rank") <= FIT_PER_LABEL)
            .groupBy("lang").agg(F.max("draw").alias("last")).collect())
    ends = F.create_map(*[F.lit(v) for r in last for v in (r["lang"], r["last"])])
    drawn = (rows.where(F.col("draw") <= F.element_at(ends, F.col("lang")))
             .groupBy("lang", "draw").agg(F.first("text").alias("text"))
             .select("lang", "text").mapInArrow(_cells, "lang string, cells binary").collect())
    drawn.sort(key=lambda r: (r.lang, bytes(r.cells)))
    labels = sorted({r.lang for r in drawn})
    x = np.array([np.unpackbits(np.frombuffer(r.cells, np.uint8)) for r in drawn], np.float32)
    return Model(labels, x.reshape(-1, CELLS), np.array([labels.index(r.lang) for r in drawn], int))


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("doc_key", pa.int64()), ("lang_pred", pa.string()),
                     ("score", pa.float64())])
_DDL = "doc_id long, doc_key long, lang_pred string, score double"


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for part in C.slices(batches, "text"):
        found = model.score(*C.text_bytes(part.column("text")))
        known = part.column("letters").to_numpy(zero_copy_only=False).astype(bool)
        if not model.labels:
            known[:] = False
            found = np.zeros((part.num_rows, 1))
        best = found.argmax(1)
        score = np.where(known, np.clip(found[np.arange(len(best)), best], 0, 1), 0.0)
        names = [model.labels[b] if k else UNKNOWN for b, k in zip(best.tolist(), known, strict=True)]
        yield C.arrow_rows({"doc_id": part.column("doc_id"), "doc_key": part.column("doc_key"),
                            "lang_pred": names, "score": score}, _SCHEMA)


def identify(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, doc_key (hash of its text), lang_pred, score (0 to 1).

    ``und`` with score 0 where the text is null or has no letter, or the model knows
    no language; ties go to the first language by code point. Equal texts get equal
    rows; other columns are not read."""
    t = F.col(text)
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), t.alias("text"),
                        C.text_key(t).alias("doc_key"),
                        F.coalesce(t.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
            .mapInArrow(lambda it: _predict(it, model), _DDL))


def held_out(doc_id: str = "doc_id"):
    """Whether crc32(doc_id as text) mod 5 is 0; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identified(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The documents (all columns) whose language the model can tell; ``und`` goes."""
    t = F.col(text)
    return docs.where(t.rlike(r"\p{L}")) if model.labels else docs.limit(0)
