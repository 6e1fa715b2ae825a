import re

import numpy as np
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import minhash as M
from wayfarer.llm.components import components


def shingles(text, k):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) >= k:
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def brute(docs, k, percent=80):
    sets = [(d, shingles(t, k)) for d, t in docs]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_item = {}
    for i, (d, s) in enumerate(sets):
        if d is not None:
            for x in s:
                by_item.setdefault(x, []).append(i)
    pairs = {}
    for owners in by_item.values():
        for n, i in enumerate(owners):
            for j in owners[n + 1:]:
                pairs[i, j] = pairs.get((i, j), 0) + 1
    for (i, j), both in pairs.items():
        if 100 * both >= percent * (len(sets[i][1]) + len(sets[j][1]) - both):
            parent[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, len(s), low.get(find(i)), d is None or d == low[find(i)])
                   for i, (d, s) in enumerate(sets)), key=str)


def rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def test_whole_table_matches_brute_force(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    got = rows(M.find_near_duplicates(docs, k=2))
    assert got == brute(docs.select("doc_id", "text").collect(), 2)
    assert any(not r[3] for r in got)


def test_links_that_only_chains_show(spark):
    """Copies drift away from the first, so most pairs of a group aren't linked."""
    rng = np.random.default_rng(3)
    docs, d = [], 0
    for _ in range(12):
        w = [f"t{x}" for x in rng.integers(0, 10**6, 60)]
        for _ in range(15):
            docs.append((d, " ".join(w)))
            d += 1
            for at in rng.integers(0, 60, rng.integers(0, 4)):
                w[at] = f"t{rng.integers(0, 10**6)}"
    rng.shuffle(docs)
    docs = [(int(a), str(b)) for a, b in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for k in (2, 5):
        assert rows(M.find_near_duplicates(df, k=k)) == brute(docs, k)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, " \t"), (4, "One"), (5, "one"), (9, "A b c"), (8, "a B c"),
            (8, "a B c"), (None, "a b c"), (None, None), (10, "é È"), (11, "É È"), (12, "a b")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("v", F.lit(1))
    for k in (2, 5):
        assert rows(M.find_near_duplicates(df, k=k)) == brute(docs, k)
    assert M.find_near_duplicates(df.limit(0)).count() == 0
    kept = M.deduplicate(df, k=2)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, None), (2, ""), (3, " \t"), (4, "One"), (8, "a B c"), (None, "a b c"), (None, None),
         (10, "é È"), (11, "É È"), (12, "a b")], key=str)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = x[:2000], x[500:]
    ra, rb, both = (M.registers(s, np.array([0])) for s in (a, b, x))
    assert (np.maximum(ra, rb) == both).all()
    j = M.likely_similarity(ra, rb, np.array([2000.0]), np.array([2500.0]))[0]
    assert abs(j - 0.5) < 0.2


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(500, 540)]
    label = {v: v for e in edges for v in e}
    for _ in range(600):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.a: r.root for r in got} == {v: r for v, r in label.items() if r != v}
    assert len(got) == len({r.a for r in got})
