"""Near-duplicate documents by SetSketch registers.

A document is its set of distinct k-word shingles. A SetSketch holds, for each of m
registers, the smallest of exponentially distributed hash values of the set on a
logarithmic scale, ``floor(1 - log_b(x))`` truncated to 16 bits; sketches of parts
merge by the maximum of each register. Registers of similar sets are often equal,
so bands of them are the buckets of the candidate search. Members and hubs of buckets are
screened by the likelihood of the register comparison, given both set sizes, and
confirmed on their full sets.

No bucket is expanded into its pairs. Equal sets are one class from the start, and
the members of a bucket are compared with one of them, its hub, drawn anew for
every eighth of the bands. Where a bucket still holds several components, its
members are compared across components by prefix filtering, which is exact: two
sets that are similar enough share one of the rarest few shingles of either, and
copies that differ too much have nothing but their own changes among those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm.components import components

WORDS = "spaces_lower"
# SetSketch parameters: registers, base, rate, largest value; registers in a band;
# draws of a hub among the bands; shingles that prefix filtering asks for.
REGISTERS, B, RATE, TOP, BAND, HUBS, DEPTH = 128, 1.001, 20.0, 65535, 4, 8, 8


def shingle_sets(w: C.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes sorted within each text, offsets of the texts).

    A text of 1 to k-1 words is one shingle."""
    grams, spans = w.grams(k), w.sums()
    first = w.first.tolist()
    sets = []
    for a, b in zip(first, first[1:]):
        if b - a >= k:
            sets.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            sets.append(spans.hash(np.array([a]), np.array([b])) ^ np.uint64(k))
        else:
            sets.append(np.zeros(0, np.uint64))
    offsets = np.cumsum([0] + [len(s) for s in sets])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), offsets


def registers(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SetSketch registers (sets x m, uint16) of the non-empty runs of ``values``."""
    seeds = C.mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)
    low = np.empty((len(starts), REGISTERS), np.uint64)
    work = np.empty_like(values)
    step = np.empty_like(values)
    for i in range(REGISTERS):
        np.multiply(values, seeds[2 * i], out=work)
        np.right_shift(work, np.uint64(32), out=step)
        np.bitwise_xor(work, step, out=work)
        np.multiply(work, seeds[2 * i + 1], out=work)
        low[:, i] = np.minimum.reduceat(work, starts)
    uniform = ((low >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
    level = np.floor(1.0 - np.log(-np.log1p(-uniform) / RATE) / math.log(B))
    return np.clip(level, 0, TOP).astype("<u2")


_SKETCH = pa.schema([("doc_id", pa.int64()), ("doc_key", pa.int64()), ("n", pa.int64()),
                     ("v", pa.binary()), ("regs", pa.binary())])
_SKETCH_DDL = "doc_id long, doc_key long, n long, v binary, regs binary"


def sketch(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for part in C.slices(batches, "text"):
        values, offsets = shingle_sets(C.words_of(part, "text", WORDS), k)
        n = np.diff(offsets)
        full = np.flatnonzero(n)
        regs: list = [None] * part.num_rows
        names: list = [None] * part.num_rows
        if len(full):
            starts = offsets[:-1][full]
            name = np.stack([np.add.reduceat(values, starts),
                             np.add.reduceat(C.mix(values), starts)], axis=1)
            found = registers(values, starts)
            for d, a, r in zip(full.tolist(), name, found, strict=True):
                names[d], regs[d] = a.tobytes(), r.tobytes()
        yield C.arrow_rows({"doc_id": part.column("doc_id"), "doc_key": part.column("doc_key"),
                            "n": n, "v": names, "regs": regs}, _SKETCH)


def likely_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketch rows, the set sizes known."""
    up, down = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - up - down
    u = na / (na + nb)
    v = 1 - u

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (B - 1) / B) / math.log(B)

    def score(j):
        pu, pd = p(u - v * j), p(v - u * j)
        return (up * np.log(pu) + down * np.log(pd)
                + same * np.log(np.clip(1 - pu - pd, 1e-12, 1)))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):        # the likelihood has one peak
        x, y = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = score(x) >= score(y)
        hi, lo = np.where(left, y, hi), np.where(left, lo, x)
    return (lo + hi) / 2


_SCREEN = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("j", pa.float32())])


def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        if part.num_rows:
            regs = [np.frombuffer(b"".join(part.column(x).to_pylist()), "<u2")
                    .reshape(-1, REGISTERS) for x in ("regs_a", "regs_b")]
            sizes = [part.column(x).to_numpy().astype(float) for x in ("n_a", "n_b")]
            yield C.arrow_rows({"a": part.column("a"), "b": part.column("b"),
                                "j": likely_similarity(*regs, *sizes).astype(np.float32)}, _SCREEN)


_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def confirm(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are similar enough."""
    for part in C.slices(batches, "text_a"):
        x, xo = shingle_sets(C.words_of(part, "text_a", WORDS), k)
        y, yo = shingle_sets(C.words_of(part, "text_b", WORDS), k)
        keep = []
        for d in range(part.num_rows):
            s, t = x[xo[d]:xo[d + 1]], y[yo[d]:yo[d + 1]]
            both = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(100 * both >= percent * (len(s) + len(t) - both))
        part = part.filter(pa.array(keep, pa.bool_()))
        yield C.arrow_rows({"a": part.column("a"), "b": part.column("b")}, _LINKS)


def _screened(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    side = classes.select("v", "n", "regs")
    joined = pairs
    for x in ("a", "b"):
        joined = joined.join(side.toDF(x, f"n_{x}", f"regs_{x}"), x)
    return joined.mapInArrow(screen, "a binary, b binary, j float")


def _texts(names: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(v, text) for each class named in ``names`` (column v, distinct)."""
    asked = (classes.join(names, "v", "left_semi")
             .select("v", F.col("doc_id").alias("_id"), F.col("doc_key").alias("_key")))
    return (docs.join(asked, (F.col("doc_id") == F.col("_id")) & (F.col("doc_key") == F.col("_key")))
            .select("v", "text"))


_ITEMS = pa.schema([("who", pa.int64()), ("item", pa.int64())])


def shingle_rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for part in C.slices(batches, "text"):
        values, offsets = shingle_sets(C.words_of(part, "text", WORDS), k)
        yield C.arrow_rows({"who": np.repeat(part.column("who").to_numpy(), np.diff(offsets)),
                            "item": values.view(np.int64)}, _ITEMS)


def _across(named: DataFrame, classes: DataFrame, docs: DataFrame, k: int,
            percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different roots among ``named`` (v, n, root).

    Shingles are ordered by the number of these sets that hold them. Two sets of n
    and m shingles with enough in common share a shingle that is neither among the
    last need - 1 of the one nor of the other, need being the common part that the
    threshold asks for. A pair has an end outside the commonest root of that shingle,
    so only those ends are matched with all others. By the same argument such sets share
    DEPTH shingles that aren't among the last need - DEPTH of either: the second test."""
    named = C.stored(named.withColumn("who", F.xxhash64("v")), "named")
    items = C.stored(_texts(named.select("v"), classes, docs).select(F.xxhash64("v").alias("who"), "text")
                     .mapInArrow(lambda it: shingle_rows(it, k), "who long, item long"), "items")
    held = C.stored(items.groupBy("item").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "held")
    shared = items.join(held, "item")
    rank = Window.partitionBy("who").orderBy(F.col("df").desc(), F.col("item").desc())
    # rest: how many shingles of the set follow in the order.
    ranked = C.stored(shared.withColumn("rest", F.row_number().over(rank) - 1).join(named, "who")
                      .where((F.col("rest") + 1 + DEPTH) * 100 >= percent * F.col("n"))
                      .select("item", "who", "v", "n", "root", "rest"), "ranked")
    heads = C.stored(ranked.groupBy("who").agg(
        F.sort_array(F.collect_list(F.struct("rest", "item")), asc=False).alias("head"))
        .select("who", (F.col("head")[0].rest + 1).alias("common"), F.col("head.item").alias("head")), "heads")
    prefix = ranked.where((F.col("rest") + 1) * 100 >= percent * F.col("n"))
    roots = prefix.groupBy("item", "root").agg(F.count(F.lit(1)).alias("c"))
    main = C.stored(roots.groupBy("item").agg(F.max(F.struct("c", "root")).alias("top"),
                                              F.count(F.lit(1)).alias("roots"))
                    .where("roots > 1").select("item", F.col("top.root").alias("main")), "main")
    y = prefix.join(main, "item")
    x = y.where("root <> main")
    x, y = (t.select("item", *(F.col(c).alias(f"{c}_{e}") for c in ("v", "n", "root", "rest", "who")),
                     *([F.col("main")] if e == "b" else [])) for t, e in ((x, "a"), (y, "b")))
    x, y = C.stored(x, "minor"), C.stored(y, "split")

    def fits(end: str):
        return (F.col(f"rest_{end}") + 1) * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))

    found = (x.join(y.withColumnRenamed("item", "item_b"),
                    (F.col("item") == F.col("item_b")) & (F.col("root_a") != F.col("root_b"))
                    & ((F.col("root_b") == F.col("main")) | (F.col("v_a") < F.col("v_b")))
                    & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
                    & fits("a") & fits("b"))
             .select("who_a", "who_b", "v_a", "v_b", "n_a", "n_b").distinct())
    need = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent)).cast("int")

    def head(end: str):
        return F.slice(f"head_{end}", F.lit(1), F.greatest(F.lit(0), F.col(f"common_{end}") - need + DEPTH))

    return (found.join(heads.toDF("who_a", "common_a", "head_a"), "who_a")
            .join(heads.toDF("who", "common_b", "head_b"), (F.col("who_b") == F.col("who"))
                  & (F.size(F.array_intersect(head("a"), head("b"))) >= F.least(F.lit(DEPTH), need)))
            .select(F.col("v_a").alias("a"), F.col("v_b").alias("b")))


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int,
               percent: int) -> DataFrame:
    pairs = C.stored(pairs, "pairs")
    ends = pairs.select(F.col("a").alias("v")).unionByName(pairs.select(F.col("b").alias("v")))
    texts = C.stored(_texts(ends.distinct(), classes, docs).dropDuplicates(["v"]), "texts")
    return (pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
            .mapInArrow(lambda it: confirm(it, k, percent), "a binary, b binary"))


def find_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                         k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, doc_key (hash of its text), n_shingles,
    component_id (the smallest doc_id reachable over links) and kept.

    Words are runs without ASCII white space, A-Z lowered; two documents are linked
    if their shingle sets share at least ``percent`` of their union. Null, empty and
    blank texts have no shingles and no links; rows without a doc_id have a null
    component, no links, and are kept. Rows that repeat a doc_id with other text are
    documents of their own. Other columns are not read.

    A link of exactly ``percent`` = 80 is missed by all 32 bands of 4 registers with
    probability 5e-8, a linked pair screened out (estimate more than 5 standard
    deviations too low) with 3e-7.
    """
    level = percent / 100
    margin = 5 * math.sqrt(level * (1 - level) / REGISTERS)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       C.text_key(F.col(text)).alias("doc_key"))
    rows = C.stored(docs.mapInArrow(lambda it: sketch(it, k), _SKETCH_DDL), "sketches")
    classes = C.stored(rows.where("doc_id is not null and n > 0").groupBy("v", "n")
                       .agg(F.min(F.struct("doc_id", "doc_key")).alias("at"),
                            F.min("regs").alias("regs"))
                       .select("v", "n", "at.*", "regs"), "classes")
    bands = (classes.select("v", "n", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)), lambda i: F.struct(
            F.xxhash64(i, F.substring("regs", i * (2 * BAND) + 1, F.lit(2 * BAND))).alias("band"),
            F.pmod(i, F.lit(HUBS)).alias("draw")))).alias("at"))
        .select("v", "n", "at.*"))
    hubs = C.stored(bands.groupBy("band")
                    .agg(F.min(F.struct(F.xxhash64("v", "draw"), "v")).alias("hub"),
                         F.count(F.lit(1)).alias("size"))
                    .where("size > 1").select("band", F.col("hub.v").alias("hub"), "size"), "hubs")
    members = C.stored(bands.join(hubs, "band").where("v <> hub")
                       .select("band", "v", "n", "hub", "size"), "members")
    first = members.select(F.col("v").alias("a"), F.col("hub").alias("b")).distinct()
    ok = _screened(first, classes).where(F.col("j") >= level - margin).select("a", "b")
    links = C.stored(_confirmed(ok, classes, docs, k, percent), "links")
    # Buckets that still hold several components.
    roots = C.stored(components(links), "roots")
    rest = C.stored(members.where("size > 2").select("band", "v", "n")
                    .join(roots.toDF("v", "root"), "v", "left")
                    .withColumn("root", F.coalesce("root", "v")), "rest")
    split = C.stored(rest.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y"))
                     .where("x <> y").select("band"), "contested")
    named = rest.join(split, "band", "left_semi").select("v", "n", "root").distinct()
    later = _across(named, classes, docs, k, percent)
    links = C.stored(links.unionByName(_confirmed(later, classes, docs, k, percent)), "links")
    roots = components(links).toDF("v", "root")
    groups = C.stored(classes.select("v", "doc_id").join(roots, "v", "left")
                      .select("v", "doc_id", F.coalesce("root", "v").alias("root")), "groups")
    low = C.stored(groups.groupBy("root").agg(F.min("doc_id").alias("component_id")), "lowest")
    named = C.stored(groups.join(low, "root").select("v", "component_id"), "named")
    out = (rows.select("doc_id", "doc_key", F.col("n").alias("n_shingles"),
                       F.when(F.col("doc_id").isNotNull(), F.col("v")).alias("v"))
           .join(named, "v", "left")
           .withColumn("component_id", F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", "doc_key", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                **options) -> DataFrame:
    """The documents (all columns) with one of each group of near-duplicates; of rows
    that repeat id and text one stays. Rows without an id all stay."""
    found = find_near_duplicates(docs, doc_id=doc_id, text=text, **options)
    kept = (found.where("kept and doc_id is not null")
            .select(F.col("doc_id").alias("kept_id"), F.col("doc_key").alias("kept_key")).distinct())
    keyed = C.packed(docs).select("row", F.col("row")[doc_id].alias("id"), C.text_key(F.col("row")[text]).alias("key"))
    named = (keyed.where(F.col("id").isNotNull())
             .join(kept, (F.col("id") == F.col("kept_id")) & (F.col("key") == F.col("kept_key")), "left_semi")
             .dropDuplicates(["id", "key"]))
    return (named.unionByName(keyed.where(F.col("id").isNull()))
            .select(*(F.col("row")[c].alias(c) for c in docs.columns)))
