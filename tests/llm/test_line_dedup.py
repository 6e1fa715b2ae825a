import hashlib
import random
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import line_dedup as L


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip("\x20\x09\x0a\x0b\x0c\x0d"))


def brute(rows, least=10):
    """(id, lines before, lines dropped, hash) of every (id, text); null ids come last and are one document."""
    after = lambda i: (i is None, i or 0)
    first = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= least and (k not in first or after(i) < after(first[k])):
                first[k] = i
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(df, **options):
    return sorted((tuple(r) for r in L.digest(df, L.find_repeated_lines(df, **options)).collect()), key=str)


def test_whole_table_and_sql(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    got = run(docs)
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert got == want
    assert sum(r[2] for r in got) > 0
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    assert sorted(con.execute(L.oracle()).fetchall(), key=str) == want


@pytest.mark.parametrize("frequent", [0, 3, 1000])
def test_random_lines_whichever_way_they_take(spark, monkeypatch, frequent):
    """Results do not depend on which hashes are decided without the shuffle."""
    if frequent:
        monkeypatch.setattr(L, "FREQUENT", frequent)
    else:
        monkeypatch.setattr(L, "_frequent", lambda rows: rows.select("h1").limit(0))
    rng = random.Random(frequent)
    pool = [" " * rng.randrange(3) + "".join(rng.choice("aAbBéÉ ") for _ in range(rng.randrange(14))) for _ in range(60)]
    rows = [(rng.choice([None, *range(80)]), "\n".join(rng.choice(pool) for _ in range(rng.randrange(200))))
            for _ in range(120)]
    rows += [(500 + i, "the one very common line\n" + "x" * i) for i in range(300)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == brute(rows)


def test_edge_cases(spark):
    rows = [(3, "Some Header Line\nbody of three\n"), (1, None), (2, ""), (4, "\t some header line\x0c\nsome header line"),
            (4, "\t some header line\x0c\nsome header line"), (None, "some header line"), (None, "body of three\nunique to it"),
            (5, "123456789\n1234567890"), (6, "123456789\n1234567890"), (7, "ÄÖÜÄÖÜÄÖÜÄ\näöüäöüäöüä"), (8, "äöüäöüäöüä\n\n\n"),
            (9, "a line that comes again\n" * 3 + "a line that comes again"), (10, "a line that comes again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df) == brute(rows)
    assert run(df.limit(0)) == []
    empty = spark.createDataFrame([(1, None), (None, None)], "doc_id long, text string")
    assert run(empty) == brute([(1, None), (None, None)])


def test_very_long_text_and_its_bitmap(spark):
    """Only the blocks that lose lines are listed; the others stay whole."""
    long = "\n".join(f"line number {i}" for i in range(100_000))
    rows = [(1, "line number 99999\nline number 70"), (2, long), (3, "another line 3")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df) == brute(rows)
    found = L.find_repeated_lines(df).collect()
    assert [(r.doc_id, r.n_dropped) for r in found] == [(2, 2)]
    assert [(b.block, b.bits) for b in found[0].keep] == [(1, ~(1 << 6)), (99999 // 64, ~(1 << 99999 % 64))]


def test_columns_of_any_name(spark):
    names = ["doc", "doc_key", "pos", "line", "h1", "h2", "first", "row", "keep", "key", "id", "lines", "kept", "n_dropped", "block"]
    rows = [(1, "a line of ten\nand more", None), (2, "A line of ten\nrest", None), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for n in names:
        df = df.withColumn(n, F.lit(f"own {n}"))
    out = L.drop_lines(df, L.find_repeated_lines(df))
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i].text for i in (1, 2, 3)] == ["a line of ten\nand more", "rest", None]
    assert all(got[i][n] == f"own {n}" for i in got for n in names)


def test_no_python_on_the_path(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    plan = L.digest(docs, L.find_repeated_lines(docs))._jdf.queryExecution().toString()
    assert not re.search(r"Python|Pandas|Arrow|ExternalRDD", plan)
