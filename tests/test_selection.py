"""Exact quantiles by selection against Spark's percentile and numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfarer.functions import selection as S

ASKED = {"lowest": ("x", 0.0), "q1": ("x", 0.25), "mid": ("x", 0.5), "p99": ("x", 0.99), "top": ("x", 1.0), "other": ("y", 0.5)}


def percentiles(df, by=()):
    return df.groupBy(*by).agg(*(F.percentile(c, p).alias(n) for n, (c, p) in ASKED.items()))


def same(got, want):
    key = lambda r: tuple(str(v) for v in r[:1])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(map(tuple, want), key=key), strict=True):
        for u, v in zip(a, b, strict=True):
            assert u == v or u == pytest.approx(v, rel=1e-12), (a, b)


@pytest.mark.parametrize("buckets", [32, 2048])
def test_smooth_and_uneven_columns(spark, monkeypatch, buckets):
    monkeypatch.setattr(S, "BUCKETS", buckets)
    rng = np.random.default_rng(buckets)
    x = np.concatenate([rng.normal(size=400), np.exp(rng.normal(0, 2, 300)), np.zeros(50), -rng.integers(0, 9, 60)])
    rows = [(None if i % 11 == 0 else f"g{i % 3}", float(v), float(i) if i % 2 else None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(4).cache()
    same(S.exact_quantiles(df, ASKED).collect(), percentiles(df).collect())
    same(S.exact_quantiles(df, ASKED, by=("g",)).collect(), percentiles(df, ("g",)).collect())


def test_ranges_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_RANGES", 0)
    df = spark.range(500).select((F.col("id") % 7).alias("g"), F.rand(3).alias("x"), F.col("id").alias("y"))
    same(S.exact_quantiles(df, ASKED, by=("g",)).collect(), percentiles(df, ("g",)).collect())


def test_edge_cases(spark):
    schema = "g string, x double, y double"
    one = lambda rows: [tuple(r) for r in S.exact_quantiles(spark.createDataFrame(rows, schema), ASKED).collect()]
    assert one([]) == [(None,) * 6]
    assert one([("a", None, None), ("b", float("nan"), None)]) == [(None,) * 6]
    assert one([("a", 3.0, None)] * 5) == [(3.0,) * 5 + (None,)]
    assert one([("a", -1.7e308, 1.0), ("a", 1.7e308, 2.0)])[0][0] == -1.7e308
    assert one([("a", 5e-324, 1.0), ("a", 0.0, 2.0)])[0][4] == 5e-324
    empty = S.exact_quantiles(spark.createDataFrame([], schema), ASKED, by=("g",))
    assert empty.columns == ["g", *ASKED] and empty.count() == 0
