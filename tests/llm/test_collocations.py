import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfarer.llm import collocations as P
from wayfarer.llm import common as C


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, longest=5, least=100, percent=100, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + m])) for i in range(len(words) - m + 1))
    frequent = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    inside = Counter()
    for (lang, words), a in frequent.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                k = (lang, words[i:i + m])
                inside[k] = max(inside[k], a)
    out = []
    for lang in {k[0] for k in frequent}:
        found = []
        for (la, words), a in frequent.items():
            if la != lang or 100 * inside[(la, words)] >= percent * a:
                continue
            cuts = [(1000 * a * n[la] // (f[la, words[:k]] * f[la, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(words).encode(), f[la, words[:k]], f[la, words[k:]]))
        for rank, (score, a, phrase, le, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, le, r, n[lang], -score))
    return sorted(out)


def run(df, **options):
    return sorted(tuple(r) for r in P.find_collocations(df, **options).collect())


def test_whole_table_and_sql(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    for least in (100, 12):
        got = run(docs, least=least)
        assert got == brute(rows, least=least)
        con = duckdb.connect()
        con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
        assert sorted(con.execute(P.oracle(least=least)).fetchall()) == got
    assert any(len(r[2].split()) > 2 for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed):
    """Short chunks, and many phrases in one bucket."""
    rng = random.Random(seed)
    words = ["a", "B", "b", "É", "é", "c-d", "x y", "\tz", "e.", "f,", "?", "g\n", "\x1c"]
    rows = [(rng.choice([None, "und", "en", "de"]), " ".join(rng.choice(words) for _ in range(rng.randrange(60))))
            for _ in range(200)] * 2
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for options in ({"least": 4}, {"least": 2, "longest": 3, "percent": 60, "top": 7}):
        assert run(df, **options, period=3 * seed, buckets=256) == brute(rows, **options)


def test_edge_cases(spark):
    rows = [(None, None), ("en", ""), ("en", " .\n"), ("fr", "tout le monde " * 300), ("fr", "Tout  le\tmonde. " * 200),
            ("xx", "one " * 150_000), ("de", "nur einmal"), ("longer-language-name", "p q. " * 150)]
    df = spark.createDataFrame(rows, "lang string, text string")
    for n in ("chunk", "core", "times", "phrase", "size", "f", "n", "k", "l", "r", "words", "rank"):
        df = df.withColumn(n, F.lit("x"))
    got = run(df)
    assert got == brute(rows)
    assert {r[0] for r in got} == {"fr", "xx", "longer-language-name"}
    assert run(df.limit(0)) == []


def test_weights_and_scores_beyond_64_bits(spark):
    big = 4_000_000_000
    chunks = [(0, "en", "big data", 1, big), (1, "en", "data x", 1, big), (1 << 33, "en", "x", 1, big + 1),
              (5 << 33, "en", "rare", 1, 99)]
    counted = P.count_phrases(spark.createDataFrame(chunks, "at long, lang string, chunk string, core int, times long"))
    assert {r.phrase: r.f for r in counted.collect()} == {
        "big": big, "data": big, "x": big + 1, "big data": big, "data x": big}
    rng = random.Random(5)
    rows = [(rng.randrange(100, 10 ** 13), rng.randrange(10 ** 13, 10 ** 15)) for _ in range(200)]
    rows = [(a, n, rng.randrange(a, 3 * a), rng.randrange(a, 3 * a)) for a, n in rows]
    rows = [r for r in rows if 1000 * r[0] * r[1] // (r[2] * r[3]) < 2 ** 63]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").select("*", F.expr(P.SCORE).alias("s")).collect()
    assert len(got) > 100 and all(r.s == 1000 * r.a * r.n // (r.l * r.r) for r in got)


def test_every_phrase_begins_in_one_chunk():
    """A chunk's core words add up to the text's, and copies are cut alike."""
    import pyarrow as pa
    rng = np.random.default_rng(3)
    text = " ".join(f"w{i}" + ("." if i % 7 == 0 else "") for i in rng.integers(0, 500, 5000))
    batch = pa.record_batch({"lang": pa.array(["en", "en"]), "text": pa.array([text, "lead in words. " + text])})
    rows = [r for b in P._chunks(iter([batch]), 5, 32) for r in b.to_pylist()]
    assert sum(r["core"] for r in rows) == 5000 + 5003
    assert max(Counter(r["chunk"] for r in rows).values()) >= 2
    assert len({r["chunk"] for r in rows}) < 0.6 * len(rows)
