import hashlib
from collections import Counter

from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import substring_dedup as S


def brute(docs, span=35):
    words = [(d, (t or "").encode().split()) for d, t in docs]
    seen = Counter(tuple(w[i:i + span]) for _, w in words for i in range(len(w) - span + 1))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - span + 1):
            if seen[tuple(w[i:i + span])] > 1:
                gone.update(range(i, i + span))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table_matches_brute_force(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    got = rows(S.digest(S.remove_repeats(docs)))
    assert got == brute(docs.select("doc_id", "text").collect())
    assert 0 < sum(r[2] for r in got) < sum(r[1] for r in got)


def test_windows_that_part_at_every_offset(spark):
    base = [f"w{i}" for i in range(120)]
    docs = [(0, " ".join(base))]
    for i in range(40):      # copies that part from the first at another place each
        docs.append((i + 1, " ".join(f"x{i}.{j}" for j in range(5)) + " "
                     + "　\t\n".join(base[i:i + 36 + i % 5]) + f" y{i}"))
    docs.append((90, "a b " * 60))                       # overlapping repeats of itself
    docs.append((91, " ".join(["z"] * 35)))              # one window, once
    docs.append((92, " ".join(["z"] * 36)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(S.digest(S.remove_repeats(df))) == brute(docs)


def test_edge_cases(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(50))
    docs = [(1, None), (2, ""), (3, " \n "), (4, text), (4, text), (None, "é " + text), (None, None),
            (5, "short"), (6, " ".join(f"v{i}" for i in range(34)))]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("lo", F.lit("x"))
    got = S.remove_repeats(df)
    assert rows(S.digest(got)) == brute(docs)
    assert {r.kept for r in got.collect() if r.doc_id is None} == {"é", ""}
    assert got.where("doc_id = 4").first().starts == [0]
    assert S.remove_repeats(df.limit(0)).count() == 0
