"""K-means of many cluster counts and restarts in one scan per step, and the exact silhouette.

A fit is a (k, restart). The centres of all fits, a few hundred short rows whatever the
table's size, go to every task; a task finds each row's nearest centre in every fit with
one block of distances and adds up its rows per centre; the sums of the tasks meet in one
aggregate by centre. So a step of all fits is one scan of the matrix, and a fit that has
settled leaves the next one.

The silhouette needs all distances of a sample. The sample is cut into tiles, pairs of
tiles are rows, and what a task keeps of a pair are sums per customer and cluster.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import np_round

ROWS_AT_ONCE = 4096     # rows whose distances to all centres a task holds
TILES = 4               # tiles of a silhouette sample: TILES squared pairs
INERTIA_DIGITS = 6      # restarts whose inertia agrees this far are equal; the first wins


@dataclass(frozen=True)
class Fit:
    """One settled K-means fit; ``inertia`` is the sum of squared distances to its centres."""
    k: int
    restart: int
    centres: np.ndarray
    inertia: float
    steps: int


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of every row to every centre, summed feature by feature."""
    out = np.zeros((len(x), len(centres)))
    for i in range(x.shape[1]):
        out += (x[:, i, None] - centres[None, :, i]) ** 2
    return out


def _columns(batch: pa.RecordBatch, cols: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols])


def _sums(batches: Iterator[pa.RecordBatch], cols: Sequence[str], fits: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A task's rows per centre (numbered through all fits): their number, cost and sums."""
    centres = np.vstack(fits)
    first = np.cumsum([0] + [len(f) for f in fits])
    total = np.zeros((len(centres), 2 + len(cols)))
    for batch in batches:
        rows = _columns(batch, cols)
        for lo in range(0, len(rows), ROWS_AT_ONCE):
            x = rows[lo:lo + ROWS_AT_ONCE]
            away = _distances(x, centres)
            for a, b in zip(first[:-1], first[1:]):
                nearest = away[:, a:b].argmin(axis=1)
                weights = [None, away[np.arange(len(x)), a + nearest], *x.T]
                for j, w in enumerate(weights):
                    total[a:b, j] += np.bincount(nearest, weights=w, minlength=b - a)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(centres), dtype=np.int32)), *(pa.array(t) for t in total.T.copy())],
        ["centre", "n", "cost", *(f"s{i}" for i in range(len(cols)))])


def _step(matrix: DataFrame, cols: Sequence[str], fits: list[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """(centres after one step, cost before it) of every fit. A centre without rows stays."""
    names = ["n", "cost", *(f"s{i}" for i in range(len(cols)))]
    schema = "centre int, " + ", ".join(f"{n} double" for n in names)
    sums = (matrix.select(*cols).mapInArrow(lambda b: _sums(b, cols, fits), schema)
            .groupBy("centre").agg(*(F.sum(n).alias(n) for n in names)).toArrow().sort_by("centre"))
    total = np.column_stack([sums.column(n).to_numpy() for n in names])
    out, lo = [], 0
    for centres in fits:
        part = total[lo:lo + len(centres)]
        lo += len(centres)
        seen = part[:, 0] > 0
        moved = centres.copy()
        moved[seen] = part[seen, 2:] / part[seen, :1]
        out.append((moved, float(part[:, 1].sum())))
    return out


def start_centres(matrix: DataFrame, cols: Sequence[str], key: str, most: int, restarts: int) -> list[np.ndarray]:
    """For every restart the rows of the ``most`` smallest md5(restart:key): the first k of
    them are the start centres of every k, the same on every run and engine."""
    order = lambda r: F.md5(F.concat(F.lit(f"{r}:"), F.col(key).cast("string")))
    picks = [matrix.select(F.lit(r).alias("restart"), order(r).alias("place"), F.col(key).alias("key"), *cols)
             .orderBy("place", "key").limit(most) for r in range(restarts)]
    found = picks[0]
    for more in picks[1:]:
        found = found.unionByName(more)
    rows = found.toArrow().sort_by([("restart", "ascending"), ("place", "ascending"), ("key", "ascending")])
    data, restart = _columns(rows.combine_chunks().to_batches()[0], cols), rows.column("restart").to_numpy()
    return [data[restart == r] for r in range(restarts)]


def fit(matrix: DataFrame, cols: Sequence[str], ks: Sequence[int], *, key: str = "customer_id", restarts: int = 10,
        max_steps: int = 300, tolerance: float = 1e-4) -> dict[int, Fit]:
    """For every k the restart of the lowest inertia (rounded to INERTIA_DIGITS; ties: the first).

    Lloyd steps from ``start_centres`` until the centres' squared moves add up to ``tolerance`` or
    less. ``matrix`` is read once per step, so it should be stored or cached; it has at least
    max(ks) rows and no nulls in ``cols``."""
    starts = start_centres(matrix, cols, key, max(ks), restarts)
    current = {(k, r): starts[r][:k] for k in ks for r in range(restarts)}
    steps = dict.fromkeys(current, 0)
    moving = list(current)
    for _ in range(max_steps):
        if not moving:
            break
        after = _step(matrix, cols, [current[f] for f in moving])
        still = []
        for f, (centres, _) in zip(moving, after):
            shift = ((centres - current[f]) ** 2).sum()
            current[f], steps[f] = centres, steps[f] + 1
            if shift > tolerance:
                still.append(f)
        moving = still
    costs = dict(zip(current, (cost for _, cost in _step(matrix, cols, list(current.values())))))
    best = {}
    for k in ks:
        r = min(range(restarts), key=lambda r: (round(costs[k, r], INERTIA_DIGITS), r))
        centres = current[k, r]
        # cluster numbers follow the centres' coordinates, not the start
        best[k] = Fit(k, r, centres[np.lexsort(centres.T[::-1])], costs[k, r], steps[k, r])
    return best


def nearest(cols: Sequence[str], centres: np.ndarray) -> Column:
    """The number of the nearest centre (ties: the first)."""
    away = ", ".join(" + ".join(f"(`{c}` - ({float(v)!r}D)) * (`{c}` - ({float(v)!r}D))" for c, v in zip(cols, centre))
                     for centre in centres)
    return F.expr(f"cast(array_position(array({away}), array_min(array({away}))) - 1 as int)")


def _labelled(batches: Iterator[pa.RecordBatch], cols: Sequence[str], fits: list[Fit]) -> Iterator[pa.RecordBatch]:
    """Rows (tile, key, features) to rows (tile, key, x, labels), a label per fit."""
    for batch in batches:
        x = _columns(batch, cols)
        labels = np.column_stack([_distances(x, f.centres).argmin(axis=1) for f in fits]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("tile"), batch.column("key"), pa.array(list(x), pa.list_(pa.float64())),
             pa.array(list(labels), pa.list_(pa.int32()))], ["tile", "key", "x", "labels"])


def _tile_sums(batches: Iterator[pa.RecordBatch], ks: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """Rows (mine, other), two tiles, to rows (key, labels, sums of distances to every cluster of every k)."""
    def unpack(tile: list[dict]):
        return (np.array([r["x"] for r in tile]), np.array([r["labels"] for r in tile]))

    for batch in batches:
        for mine, other in zip(batch.column("mine"), batch.column("other")):
            mine = mine.as_py()
            x, own = unpack(mine)
            y, labels = unpack(other.as_py())
            member = np.hstack([labels[:, [j]] == np.arange(k) for j, k in enumerate(ks)]).astype(float)
            sums = np.sqrt(_distances(x, y)) @ member
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["key"] for r in mine]), pa.array(list(own.astype(np.int32)), pa.list_(pa.int32())),
                 pa.array(list(sums), pa.list_(pa.float64()))], ["key", "labels", "sums"])


def _scores(batches: Iterator[pa.RecordBatch], ks: Sequence[int], sizes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows (labels, sums) to (k, total, n): the silhouettes of a task's rows added up per k."""
    first = np.cumsum([0, *ks])
    for batch in batches:
        labels, sums = np.array(batch.column("labels").to_pylist()), np.array(batch.column("sums").to_pylist())
        if not len(labels):
            continue
        totals, at = [], np.arange(len(labels))
        for j, k in enumerate(ks):
            own, part, n = labels[:, j], sums[:, first[j]:first[j] + k], sizes[j].astype(float)
            with np.errstate(divide="ignore", invalid="ignore"):
                a = part[at, own] / (n[own] - 1)
                other = part / n
                other[:, n == 0] = np.inf
                other[at, own] = np.inf
                b = other.min(axis=1)
                value = (b - a) / np.maximum(a, b)
            totals.append(float(np.where((n[own] == 1) | (a == b), 0.0, value).sum()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ks, pa.int32()), pa.array(totals), pa.array([len(labels)] * len(ks), pa.int64())], ["k", "total", "n"])


def silhouettes(sample: DataFrame, cols: Sequence[str], fits: dict[int, Fit], *, key: str = "customer_id") -> DataFrame:
    """k, silhouette: the mean of (b - a) / max(a, b) over the sample, Euclidean and exact. a is a row's mean
    distance to the others of its cluster, b the least mean distance to another cluster; a row alone
    in its cluster counts 0. NULL where the sample has one cluster, or as many as rows."""
    ks = sorted(fits)
    ordered = [fits[k] for k in ks]
    rows = sample.select(F.pmod(F.xxhash64(key), F.lit(TILES)).cast("int").alias("tile"),
                         F.col(key).cast("string").alias("key"), *cols).mapInArrow(
        lambda b: _labelled(b, cols, ordered),
        "tile int, key string, x array<double>, labels array<int>").checkpoint(eager=True)
    sizes = [np.zeros(k, np.int64) for k in ks]     # as many numbers as there are centres
    for r in rows.select(F.posexplode("labels").alias("fit", "label")).groupBy("fit", "label").count().collect():
        sizes[r["fit"]][r["label"]] = r["count"]
    tiles = rows.groupBy("tile").agg(F.collect_list(F.struct("key", "x", "labels")).alias("rows"))
    mine = tiles.select(F.col("rows").alias("mine"), F.explode(F.sequence(F.lit(0), F.lit(TILES - 1))).alias("tile"))
    pairs = mine.join(tiles.withColumnRenamed("rows", "other"), "tile").select("mine", "other")
    added = (pairs.repartition(TILES * TILES).mapInArrow(
                lambda b: _tile_sums(b, ks), "key string, labels array<int>, sums array<double>")
             .groupBy("key", "labels").agg(F.expr(
                 f"aggregate(collect_list(sums), array_repeat(0D, {sum(ks)}), "
                 "(total, part) -> zip_with(total, part, (a, b) -> a + b))").alias("sums")))
    valid = [k for k, n in zip(ks, sizes) if 1 < (n > 0).sum() < n.sum()]
    means = (added.mapInArrow(lambda b: _scores(b, ks, sizes), "k int, total double, n long")
             .groupBy("k").agg((F.sum("total") / F.sum("n")).alias("mean")))
    return means.select("k", F.when(F.col("k").isin(valid), F.col("mean")).alias("silhouette")).orderBy("k")


def elbow(fits: dict[int, Fit], scores: DataFrame) -> DataFrame:
    """k, inertia (6 dp) and silhouette (3 dp) of every fit."""
    costs = F.create_map(*(F.lit(v) for k, f in fits.items() for v in (k, f.inertia)))
    return scores.select("k", np_round(costs[F.col("k")], INERTIA_DIGITS).alias("inertia"),
                         np_round("silhouette", 3).alias("silhouette"))
