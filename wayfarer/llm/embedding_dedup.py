"""Near-duplicate embeddings by an epsilon grid order join.

Vectors of length one with cosine c are at distance sqrt(2 - 2c). Their leading
principal coordinates are cut into cells of that width, and the vectors are
sorted by cell: the epsilon grid order. The sorted sequence is cut into intervals;
two intervals are joined if their bounding boxes allow a link, and within a task the
join recurses into halves and skips those that are provably too far apart. What
is left is compared by blocked matrix products in double precision, so the join
is exact.

Equal vectors are one class from the start. A joined interval pair returns counts
and a spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm.components import components

AXES = 8             # principal dimensions of the grid and of the boxes
FIT_VECTORS = 4096   # vectors the axes are fitted on, at most; they only steer the pruning
INTERVAL = 2048      # vectors of an interval of the sequence
SAFE_POWER = 400     # vectors beyond 2 ** 400 or below 2 ** -400 are scaled by a power of two
LEAF = 256           # vectors compared by one matrix product


def _pack(batches: Iterator[pa.RecordBatch], dtype: str) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes; null where they can have no cosine."""
    schema = pa.schema([("vec_id", pa.int64()), ("vec", pa.binary())])
    for part in batches:
        out = []
        for v in part.column("vec"):
            x = None
            if v.is_valid and not v.values.null_count:
                x = v.values.to_numpy(zero_copy_only=False).astype(dtype) + 0.0   # -0 becomes 0
                d = x.astype(np.float64)
                power = int(np.frexp(np.abs(d).max(initial=0))[1]) if np.isfinite(d).all() else 0
                if abs(power) > SAFE_POWER:      # squares would leave the range of doubles
                    d = np.ldexp(d, -power)
                    x = d.astype(dtype)
                if not np.isfinite(d).all() or not (norm := math.sqrt(d @ d)) or not math.isfinite(norm):
                    x = None
            out.append(None if x is None else x.tobytes())
        yield C.arrow_rows({"vec_id": part.column("vec_id"), "vec": out}, schema)


def unpack(rows: list[bytes], dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, norms) in double precision."""
    x = np.frombuffer(b"".join(rows), dtype).astype(np.float64).reshape(len(rows), -1)
    return x, np.sqrt(np.einsum("ij,ij->i", x, x))


def fit_axes(rows: list[bytes], dtype: str) -> dict[int, np.ndarray]:
    """Leading principal axes (orthonormal columns) of the sampled directions, by dimension."""
    by_size: dict[int, list[bytes]] = {}
    for r in rows:
        by_size.setdefault(len(r), []).append(r)
    axes = {}
    for size, some in by_size.items():
        x, norm = unpack(some, dtype)
        x = x / norm[:, None]
        axes[size] = np.linalg.svd(x - x.mean(0), full_matrices=True)[2][:AXES].T
    return axes


def project(x: np.ndarray, norm: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    unit = x / norm[:, None]
    out = np.zeros((len(x), AXES))
    p = unit @ axes if axes is not None else unit[:, :AXES]
    out[:, :p.shape[1]] = p
    return out


def _grid(batches: Iterator[pa.RecordBatch], axes, eps: float, dtype: str) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("cell", pa.list_(pa.int32())), ("box", pa.list_(pa.float64()))])
    for part in batches:
        rows = part.column("vec").to_pylist()
        p = np.zeros((len(rows), AXES))
        size = np.array([len(r) for r in rows])
        for s in np.unique(size):
            at = np.flatnonzero(size == s)
            p[at] = project(*unpack([rows[i] for i in at], dtype), axes.get(int(s)))
        cells = np.floor(p / eps).astype(np.int32)
        extra = C.arrow_rows({"cell": list(cells), "box": list(p)}, schema)
        yield pa.RecordBatch.from_arrays([*part.columns, *extra.columns],
                                         names=[*part.schema.names, "cell", "box"])


def local_forest(found: np.ndarray) -> list[tuple[int, int]]:
    """Edges (row, column), or (row, -1 - row) as below, that connect what the links of a block do.

    ``found`` is a boolean rows x columns matrix; the result pairs node numbers, columns
    numbered after rows."""
    n, m = found.shape
    label = np.arange(n + m)
    while True:
        low = np.minimum(label[:n], np.where(found, label[None, n:], n + m).min(1, initial=n + m))
        high = np.minimum(label[n:], np.where(found, low[:, None], n + m).min(0, initial=n + m))
        new = np.concatenate([low, high])
        if (new == label).all():
            break
        label = new
    return [(i, int(r)) for i, r in enumerate(label) if r != i]


def join_intervals(xa, na, pa_, xb, nb, pb, eps: float, least: float, same: bool):
    """Yield (a0, b0, links) for the leaves of two intervals (or of one with itself)
    that hold links: a boolean matrix for rows from a0, columns from b0."""
    stack = [(0, len(xa), 0, len(xb))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        if same and b1 <= a0:
            continue       # the mirror image of another part
        gap = np.maximum(0, np.maximum(pa_[a0:a1].min(0) - pb[b0:b1].max(0),
                                       pb[b0:b1].min(0) - pa_[a0:a1].max(0)))
        if gap @ gap > eps * eps:
            continue
        if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
            found = (xa[a0:a1] @ xb[b0:b1].T) / (na[a0:a1, None] * nb[None, b0:b1]) >= least
            if same and a0 == b0:
                np.fill_diagonal(found, False)
            if found.any():
                yield a0, b0, found
        else:
            am = (a0 + a1) // 2 if a1 - a0 > LEAF else a1
            bm = (b0 + b1) // 2 if b1 - b0 > LEAF else b1
            stack += [(x0, x1, y0, y1) for x0, x1 in ((a0, am), (am, a1)) for y0, y1 in ((b0, bm), (bm, b1))
                      if x0 < x1 and y0 < y1]


_FOUND = pa.schema([("seq", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])


def _join(table: pa.Table, eps: float, least: float, dtype: str) -> pa.Table:
    """Links of an interval pair: per vector the weight linked, and forest edges (to)."""
    table = table.sort_by([("right", "ascending"), ("seq", "ascending")])
    right = table.column("right").to_numpy(zero_copy_only=False).astype(bool)
    seq, weight = table.column("seq").to_numpy(), table.column("weight").to_numpy()
    x, norm = unpack(table.column("vec").to_pylist(), dtype)
    box = np.array(table.column("box").to_pylist()).reshape(-1, AXES)
    cut = int((~right).sum())
    same = cut == len(seq)
    a = slice(0, cut)
    b = a if same else slice(cut, None)
    base = 0 if same else cut
    links = np.zeros(len(seq), np.int64)
    edges = []
    for a0, b0, found in join_intervals(x[a], norm[a], box[a], x[b], norm[b], box[b], eps, least, same):
        n, m = found.shape
        rows, cols = np.arange(a0, a0 + n), np.arange(base + b0, base + b0 + m)
        links[rows] += found @ weight[cols]
        if not (same and a0 == b0):
            links[cols] += found.T @ weight[rows]
        names = np.concatenate([rows, cols])
        edges += [(names[i], names[r]) for i, r in local_forest(found) if names[i] != names[r]]
    at = np.flatnonzero(links)
    e = np.array(edges, np.int64).reshape(-1, 2)
    return pa.Table.from_arrays([
        pa.array(np.concatenate([seq[at], seq[e[:, 0]]])),
        pa.array(np.concatenate([links[at], np.zeros(len(e), np.int64)])),
        pa.array([None] * len(at) + seq[e[:, 1]].tolist(), pa.int64())], schema=_FOUND)


def _interval_pairs(intervals: DataFrame, eps: float) -> DataFrame:
    """Pairs i <= j of intervals whose boxes are not too far apart.

    An equi-join on cells of the first axis, which every possible pair shares."""
    first = intervals.withColumn("c", F.explode(F.sequence(
        F.floor(F.col("low")[0] / eps), F.floor(F.col("high")[0] / eps))))
    second = intervals.withColumn("c", F.explode(F.sequence(
        F.floor(F.col("low")[0] / eps) - 1, F.floor(F.col("high")[0] / eps) + 1)))
    gap = F.aggregate(
        F.transform(F.sequence(F.lit(0), F.lit(AXES - 1)), lambda k: F.greatest(
            F.lit(0.0), F.col("a.low")[k] - F.col("b.high")[k], F.col("b.low")[k] - F.col("a.high")[k])),
        F.lit(0.0), lambda s, g: s + g * g)
    return (first.alias("a").join(second.alias("b"), (F.col("a.c") == F.col("b.c"))
                                  & (F.col("a.dim") == F.col("b.dim"))
                                  & (F.col("a.interval") <= F.col("b.interval")) & (gap <= eps * eps))
            .select(F.col("a.interval").alias("i"), F.col("b.interval").alias("j")).distinct())


def find_near_duplicates(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding",
                         least: float = 0.9) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors with cosine >= ``least``),
    component_id (smallest vec_id reachable over links), kept.

    Cosines are taken in double precision between vectors of one dimension. A vector
    that is null, empty, zero, or has a null or non-finite component, and a row without
    a vec_id, has no links and is its own component. Rows that repeat vec_id and vector are
    vectors linked with each other. Other columns are not read.
    """
    eps = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-9
    kind = vectors.schema[embedding].dataType.elementType.simpleString()
    dtype = "<f4" if kind == "float" else "<f8"
    rows = C.stored(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vec"))
                    .mapInArrow(lambda it: _pack(it, dtype), "vec_id long, vec binary"), "vectors")
    able = (F.col("vec_id").isNotNull()) & F.col("vec").isNotNull()
    classes = rows.where(able).groupBy("vec").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
    classes = C.stored(classes, "classes")
    count = max(1, classes.count())
    sample = [bytes(r.vec) for r in classes.where(
        F.xxhash64("vec") / F.lit(2.0 ** 64) + 0.5 < 0.5 * FIT_VECTORS / count).select("vec").limit(FIT_VECTORS).collect()]
    axes = fit_axes(sorted(sample), dtype)
    grid = classes.withColumn("dim", F.octet_length("vec")).mapInArrow(
        lambda it: _grid(it, axes, eps, dtype),
        "vec binary, id long, weight long, dim int, cell array<int>, box array<double>")
    order = ["dim", *(f"c{k}" for k in range(AXES)), "id", "vec"]
    seq = C.ranged(grid.select("*", *(F.col("cell")[k].alias(f"c{k}") for k in range(AXES))), order, "grid")
    starts = C.before(seq.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "part", "n")
    # One row per range: its number of rows is that of the partitions.
    seq = C.stored(seq.join(F.broadcast(starts.select("part", "before")), "part")
                   .withColumn("seq", F.col("before") + F.col("at"))
                   .withColumn("interval", F.floor(F.col("seq") / INTERVAL))
                   .select("seq", "interval", "dim", "vec", "id", "weight", "box"), "sequence")
    sides = [F.array(*(f(F.col("box")[k]) for k in range(AXES))).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))]
    intervals = C.stored(seq.groupBy("interval", "dim").agg(*sides), "intervals")
    pairs = C.stored(_interval_pairs(intervals, eps).join(intervals.select("interval", "dim"),
                                                           F.col("i") == F.col("interval"))
                     .select("i", "j", "dim"), "pairs")
    load = seq.select("seq", "interval", "dim", "vec", "weight", "box")
    left = load.join(pairs, (load.interval == pairs.i) & (load["dim"] == pairs["dim"])).select(
        "i", "j", load["dim"], "seq", "weight", "vec", "box", F.lit(False).alias("right"))
    right = load.join(pairs, (load.interval == pairs.j) & (pairs.i < pairs.j) & (load["dim"] == pairs["dim"])).select(
        "i", "j", load["dim"], "seq", "weight", "vec", "box", F.lit(True).alias("right"))
    found = C.stored(left.unionByName(right).groupBy("i", "j", "dim")
                     .applyInArrow(lambda t: _join(t, eps, least, dtype), "seq long, links long, to long"), "links")
    links = found.where("to is null").groupBy("seq").agg(F.sum("links").alias("links"))
    roots = components(found.where("to is not null").select(F.col("seq").alias("a"), F.col("to").alias("b")))
    named = C.stored(seq.select("seq", "vec", "id", "weight").join(links, "seq", "left")
                     .join(roots.toDF("seq", "root"), "seq", "left")
                     .select("vec", "id", "weight", F.coalesce("links", F.lit(0)).alias("links"),
                             F.coalesce("root", "seq").alias("root")), "named")
    low = C.stored(named.groupBy("root").agg(F.min("id").alias("component_id")), "lowest")
    names = C.stored(named.join(low, "root").select(
        "vec", (F.col("links") + F.col("weight") - 1).alias("n_links"), "component_id"), "names")
    alone = rows.where(~able).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                     F.col("vec_id").alias("component_id"))
    out = rows.where(able).join(names, "vec").select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
