import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import pii as P

PATTERNS = {   # the contract's patterns, as they are written there
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def check(kind, match):
    digits = re.sub(r"\D", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum((d * 2 - 9 if d > 4 else d * 2) if i % 2 else d
                    for i, d in enumerate(int(c) for c in reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(doc, text):
    kinds = list(PATTERNS)
    found = [(m.start(), kinds.index(k), m.end()) for k, p in PATTERNS.items()
             for m in re.finditer(p, text or "") if check(k, m[0])]
    joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found))
    return (doc, *(sum(x[1] == i for x in found) for i in range(4)),
            hashlib.sha256(joined.encode()).hexdigest()), joined


def test_base_spans_of_the_whole_table(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents").withColumn("base", F.lit(1))
    got = sorted(tuple(r) for r in P.digest(P.find_pii(docs)).collect())
    want = sorted((brute(r.doc_id, r.text) for r in docs.collect()))
    assert [g[:6] for g in got] == [w[0] for w in want]
    for g, (_, joined) in zip(got, want, strict=True):    # base spans all stay
        assert set(joined.split(",")) - {""} <= set(g[6].split(","))
    assert sum(sum(g[1:5]) for g in got) > 0


def test_patterns_on_awkward_texts():
    rng = np.random.default_rng(5)
    parts = ["a.b", "@", "x@y.z", "-", ".", "1.2.3.4", "999.1.1.1", "é", " ", "4111 1111 1111 1111", "+1 ",
             "(555) 010-9999", "12", "%", "\n", "٣", "0", "+49.30.123.4567", "a@b.c@d.e", "4111-1111"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(1, 9)))
        want = brute(0, text)[1]
        got = ",".join(f"{P.KINDS[k - 1]}:{a}:{b}" for a, k, b in P.base_spans(text))
        assert got == want, text
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1 " * 70_000, "a@" * 100_000):
        P.base_spans(text)     # linear, so it ends


def weights(spark):
    docs = [f"filler {i} words, write to user{i}@mail.example.com or call +1 (555) 010-{1000 + i} now, "
            f"+1 (555) 010-{1000 + i} again or {10 + i}.{i}.7.{i} at room {i} in {1900 + i}."
            for i in range(100)]
    df = spark.createDataFrame([(d,) for d in docs], "text string")
    return P.train(df)


def test_skip_edges_find_repeats_in_another_form(spark):
    text = "Call +1 (743) 555-3824 today. " + "Long words between. " * 30 + "The short form is 743-555-3824, ok."
    w = weights(spark)
    base = P.base_spans(text)
    assert [k for _, k, _ in base] == [4]
    assert [(text[a:b], k) for a, k, b in P.added(text, base, w)] == [("743-555-3824", 4)]
    other = text.replace("The short form is 743-555-3824", "The year is 1984")
    assert P.added(other, P.base_spans(other), w) == []
    # Exact marginals of a two-node graph agree with message passing.
    g = P.Graph(text, base)
    assert len(g.nodes) == 2
    score = g.features @ w["unary"]
    exact = np.exp(score[1] + w["pair"][1][4])
    assert np.allclose(P.posterior(g, w)[1], exact / exact.sum())


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "a@b.co"), (3, "a@b.co"), (None, "é 1.2.3.4")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit("x"))
    got = sorted((tuple(r) for r in P.digest(P.find_pii(df)).collect()), key=str)
    assert [g[:6] for g in got] == sorted((brute(*d)[0] for d in docs), key=str)
    assert {g[6] for g in got} == {"", "email:0:6", "ip:2:9"}
    assert P.find_pii(df.limit(0)).count() == 0


def test_labels_reach_repeats_far_away(spark):
    w = weights(spark)
    repeat = ("Long words between. " * 3 + "The short form is 743-555-3824, ok. ") * 50
    for text in ("Call +1 (743) 555-3824 today. " + repeat, repeat + "Call +1 (743) 555-3824 today. "):
        base = P.base_spans(text)
        assert [k for _, k, _ in base] == [4]
        assert [(text[a:b], k) for a, k, b in P.added(text, base, w)] == [("743-555-3824", 4)] * 50
        g = P.Graph(text, base)
        assert len(g.edges) <= 3 * len(g.nodes)
    # Repeats that none of the observed tokens resembles stay out.
    other = text.replace("743-555-3824,", "1984,")
    assert P.added(other, P.base_spans(other), w) == []
