from collections import Counter, defaultdict

import corpus_pipeline as P
from .test_decontaminate import brute as contaminated
from .test_mixing import water, words
from .test_minhash import brute as near

from wayfarer.llm import common as C


def test_stages_by_brute_force(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    bench = [(r.item_id, r.text) for r in C.table(spark, sf_dir, "benchmark").collect()]
    kept = {}
    for name, stage in P.STAGES:
        out = C.stored(stage(spark, docs, sf_dir), name)
        assert set(docs.columns) <= set(out.columns)
        kept[name] = (docs.collect(), out.collect())
        docs = out
    before, after = kept["language"]
    assert Counter(r.doc_id for r in after) == Counter(
        r.doc_id for r in before if any(c.isalpha() for c in r.text or ""))
    before, after = kept["dedup"]
    want = [d for d, _, _, k in near([(r.doc_id, r.text) for r in before], 5) if k]
    assert sorted(r.doc_id for r in after) == sorted(want) and len(after) < len(before)
    before, after = kept["benchmark"]
    hit = {r[0] for r in contaminated([(r.doc_id, r.text) for r in before], bench) if r[-1]}
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in hit)
    assert hit
    before, after = kept["mix"]
    sizes, longest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r.source] += words(r.text)
        longest[r.source] = max(longest[r.source], words(r.text))
    for r in after:
        taken[r.source] += words(r.text)
    for s, t in water(sizes).items():
        assert abs(taken[s] - t) <= longest[s]
    texts = {r.doc_id: r for r in before}
    assert all(texts[r.doc_id] == r for r in after) and max(Counter(r.doc_id for r in after).values()) <= 2
    before, after = kept["shard"]
    assert Counter((r.doc_id, r.text) for r in after) == Counter((r.doc_id, r.text) for r in before)
    for s in {r.shard for r in after}:
        assert sorted(r.slot for r in after if r.shard == s) == list(range(sum(r.shard == s for r in after)))


def test_run_and_empty_documents(spark, sf_dir):
    from __spark_entry__ import oracle_sql, queries
    assert queries()["pipeline"] is P.run and "pipeline" not in oracle_sql()
    out = P.run(spark, sf_dir)
    assert out.columns[-2:] == ["shard", "slot"] and out.count() > 0
    docs = C.table(spark, sf_dir, "documents").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
