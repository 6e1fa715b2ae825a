import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    values = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """The root of a list of digests, and for each its siblings' levels: (slot, run)."""
    ways, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for way, i in zip(ways, where):
            way.append((i % 16, runs[i // 16]))
        where = [i // 16 for i in where]
        nodes = [h(*run) for run in runs]
    return nodes[0], ways


def brute(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees, out = {}, []
    for s in sources:
        members = sorted(by_source[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = (members, *climb([leaf(r, r["text"]) for r in members]))
    root, top_ways = climb([trees[s][1] for s in sources])
    for s, top in zip(sources, top_ways):
        members, subroot, ways = trees[s]
        for r, way in zip(members, ways):
            way = way + top
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            node = leaf(r, lowered(r["text"]) if bad else r["text"])
            for slot, run in way:
                node = h(*run[:slot], node, *run[slot + 1:])
            siblings = [d for slot, run in way for i, d in enumerate(run) if i != slot]
            out.append((r["doc_id"], leaf(r, r["text"]), subroot, root, h(*siblings), node, node == root))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r) for r in M.digest(df).collect()), key=str)


def test_whole_table_and_sql(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    want = brute([r.asDict() for r in docs.collect()])
    got = run(docs)
    assert got == want
    assert 0 < sum(not r[-1] for r in got) < len(got) / 2
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    assert sorted(con.execute(M.oracle()).fetchall(), key=str) == want


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [256, 1, 257], [3, 16, 5000], [1] * 300, [1] * 17 + [40]])
def test_runs_of_every_shape(spark, sizes):
    rows = [(s * 10_000 + i * 7, f"Text {i}", None, f"s{s}", i) for s, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert run(df.repartition(5, "n_chars")) == brute([r.asDict() for r in df.collect()])


def test_edge_cases(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "", 0), (2, "", "en", "", 0), (2, "B", "en", "", 0),
            (None, "no id", "en", "é", 5), (None, "No id", "en", "é", 5), (20, "É É", "fr", "z", 3),
            (21, "Long " * 200_000, "en", "z", None), (-4, "-", "-", "-", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for n in ("tree", "idx", "n", "digest", "run", "way", "part", "at", "place", "id", "also", "tampered", "leaf"):
        df = df.withColumn(n, F.lit("x"))
    assert run(df) == brute([r.asDict() for r in df.collect()])
    assert run(df.limit(0)) == []


def test_manifest_of_other_columns(spark):
    df = spark.createDataFrame([(i, f"u{i}", i % 3) for i in range(50)], "key int, url string, shard int")
    got = M.manifest(df, fields=("key", "url"), tree="shard", order="key", also={"url": F.col("url")})
    checked = got.select("id", (M.fold(F.col("leaf"), F.col("way")) == F.col("root")).alias("ok"),
                         (M.fold(F.lit("0"), F.col("way")) == F.col("root")).alias("other"), "url").collect()
    assert len(checked) == 50 and all(r.ok and not r.other and r.url == f"u{r.id}" for r in checked)
