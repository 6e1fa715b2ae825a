"""Batched K-means and the exact silhouette against plain numpy."""

import hashlib

import numpy as np
import pytest

from wayfarer.operators import clustering as K

COLS = ["a", "b"]


def numpy_fit(ids, x, k, restart, max_steps=300, tolerance=1e-4):
    order = sorted(range(len(ids)), key=lambda i: (hashlib.md5(f"{restart}:{ids[i]}".encode()).hexdigest(), ids[i]))
    centres = x[order[:k]].copy()
    for _ in range(max_steps):
        label = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        after = np.array([x[label == c].mean(0) if (label == c).any() else centres[c] for c in range(k)])
        shift = ((after - centres) ** 2).sum()
        centres = after
        if shift <= tolerance:
            break
    return ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum(), centres


def numpy_silhouette(x, label):
    if not 1 < len(set(label)) < len(x):
        return None
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i in range(len(x)):
        same = (label == label[i]) & (np.arange(len(x)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a = away[i, same].mean()
        b = min(away[i, label == c].mean() for c in set(label) - {label[i]})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


def data(spark, x):
    rows = [(f"c{i}", *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "customer_id string, a double, b double").repartition(3).cache()


def test_all_fits_at_once_equal_single_fits(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(m, 0.6, (60, 2)) for m in ((0, 0), (4, 0), (0, 5), (6, 6))])
    ids = [f"c{i}" for i in range(len(x))]
    fits = K.fit(data(spark, x), COLS, [2, 4, 5], restarts=4)
    for k, fit in fits.items():
        cost, centres = min((numpy_fit(ids, x, k, r) for r in range(4)), key=lambda f: round(f[0], 6))
        assert fit.inertia == pytest.approx(cost)
        assert np.allclose(fit.centres, centres[np.lexsort(centres.T[::-1])])
    got = {r.k: r.silhouette for r in K.silhouettes(data(spark, x), COLS, fits).collect()}
    for k, fit in fits.items():
        label = ((x[:, None] - fit.centres[None]) ** 2).sum(2).argmin(1)
        assert got[k] == pytest.approx(numpy_silhouette(x, label))


def test_equal_rows_and_lonely_rows(spark):
    """Rows that agree leave centres without rows, which stay; a row alone in its cluster counts 0."""
    x = np.array([[0.0, 0.0]] * 30 + [[9.0, 9.0]] * 2 + [[50.0, -50.0]])
    df = data(spark, x)
    fits = K.fit(df, COLS, [2, 3], restarts=6)
    assert fits[3].inertia == pytest.approx(0.0) or len({tuple(c) for c in fits[3].centres}) < 3
    got = {r.k: r.silhouette for r in K.silhouettes(df, COLS, fits).collect()}
    for k, fit in fits.items():
        label = ((x[:, None] - fit.centres[None]) ** 2).sum(2).argmin(1)
        want = numpy_silhouette(x, label)
        assert got[k] == (want if want is None else pytest.approx(want))


def test_one_cluster_has_no_silhouette(spark):
    same = np.zeros((8, 2))
    fits = K.fit(data(spark, same), COLS, [2], restarts=1)
    assert [r.silhouette for r in K.silhouettes(data(spark, same), COLS, fits).collect()] == [None]
