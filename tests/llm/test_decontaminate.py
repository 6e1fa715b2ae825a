import hashlib
import re

from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("null" if item is None else str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                owners = windows.get(tuple(w[i:i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        out.append((doc, len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table_matches_brute_force(spark, sf_dir):
    docs, bench = C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark")
    got = rows(D.digest(D.find_contamination(docs, bench)))
    want = brute(docs.select("doc_id", "text").collect(), bench.select("item_id", "text").collect())
    assert got == want
    assert any(r[-1] for r in got)


def test_blocks_of_a_large_benchmark_give_the_same_rows(spark, sf_dir):
    docs, bench = C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark")
    docs = docs.unionByName(docs.where("doc_id < 20"))
    one = rows(D.digest(D.find_contamination(docs, bench)))
    many = rows(D.digest(D.find_contamination(docs, bench, block_bytes=3000)))
    assert one == many


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(12))
    docs = [(1, None), (2, ""), (3, "..."), (4, long.upper()), (4, long.upper()), (None, "x " + long),
            (5, "w1 w2 w3"), (6, "Éa, short_item!"), (7, "éa short item")]
    items = [(1, long), (2, None), (3, ""), (4, "short item"), (None, "w1 w2 w3"), (10, long)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    assert rows(D.digest(D.find_contamination(d, b))) == brute(docs, items)
    assert D.find_contamination(d.limit(0), b).count() == 0
    assert rows(D.digest(D.find_contamination(d, b.limit(0)))) == brute(docs, [])
    kept = D.decontaminate(d, b)
    assert kept.columns == ["doc_id", "text", "items"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]
