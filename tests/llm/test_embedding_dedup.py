import numpy as np
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import embedding_dedup as E


def brute(rows, least=0.9):
    vec = {}
    for i, (v, x) in enumerate(rows):
        if v is not None and x and None not in x:
            x = np.array(x, np.float64)
            if np.isfinite(x).all() and x.any():
                vec[i] = x
    links = {i: set() for i in range(len(rows))}
    for i, x in vec.items():
        for j, y in vec.items():
            if i != j and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                links[i].add(j)
    out = []
    for i, (v, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min(rows[j][0] for j in seen) if v is not None else None
        out.append((v, len(links[i]), low, v is None or v == low))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table_matches_brute_force(spark, sf_dir):
    df = C.table(spark, sf_dir, "embeddings")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    assert rows(E.find_near_duplicates(df)) == want


def test_intervals_and_chains(spark, monkeypatch):
    """Many small intervals, and chains of links whose ends are far apart."""
    monkeypatch.setattr(E, "INTERVAL", 40)
    monkeypatch.setattr(E, "LEAF", 8)
    rng = np.random.default_rng(2)
    data = []
    for a in np.linspace(0, 2.5, 60):
        data.append([float(np.cos(a)), float(np.sin(a)), 0.0, 0.02])
    data += rng.normal(size=(120, 4)).tolist()
    ids = rng.permutation(len(data)).tolist()
    data = list(zip(ids, data, strict=True)) + [(500, data[0]), (501, data[0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert rows(E.find_near_duplicates(df)) == brute(data)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [-0.0, 1.0]), (11, [0.0, 1.0]),
            (None, [1.0, 0.0]), (12, [1.0]), (13, [-1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("seq", F.lit(1))
    assert rows(E.find_near_duplicates(df)) == brute(data)
    assert E.find_near_duplicates(df.limit(0)).count() == 0


def test_forest_keeps_what_is_connected():
    rng = np.random.default_rng(0)
    for _ in range(200):
        found = rng.random((7, 6)) < 0.15
        nodes = list(range(13))

        def label(edges):
            lab = list(nodes)
            for _ in nodes:
                for a, b in edges:
                    lab[a] = lab[b] = min(lab[a], lab[b])
            return lab

        assert label(E.local_forest(found)) == label([(i, 7 + j) for i, j in zip(*found.nonzero(), strict=True)])
