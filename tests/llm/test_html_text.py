import re

import numpy as np
from pyspark.sql import functions as F

from wayfarer.llm import common as C
from wayfarer.llm import html_text as H


def test_articles_of_the_whole_table(spark, sf_dir):
    """Brute force for these pages: the part between the article tags, block by block."""
    import html
    pages = C.table(spark, sf_dir, "pages")
    want = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)
        body = re.sub(r"<[^>]*$", "", body[1]) if body else ""
        parts = re.split(r"</?(?:p|h1)>", body)
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in x else "", x)).split()) for x in parts]
        want[r.page_id] = "\n".join(x for x in lines if x)
    got = {r.page_id: (r.text, r.n_chars) for r in H.digest(H.extract_text(pages)).collect()}
    assert len(got) == pages.count()
    assert {k: (v, len(v)) for k, v in want.items()} == got


def test_differencing_deletes_what_neighbours_share(spark):
    def page(n, extra=""):
        return (f"<body><div>Site name</div><div>Menu one</div><div>Story {n} begins.</div><p>It goes on {n}"
                f" &amp; on.</p>{extra}<div>All rights</div></body>")

    rows = [(1, "http://h.x/a/1", page(1)), (2, "http://h.x/a/2", page(2)), (3, "http://h.x/a/3", page(3)),
            (4, "http://h.x/a/3", page(3)), (5, "http://h.x/a/30", page(3)), (6, "http://h.x/b/9", page(6)),
            (7, "http://alone.x/a/1", page(7)), (8, "http://h.x/c", page(8, "<p>Menu one</p>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n") for r in H.extract_text(df.repartition(3)).collect()}
    for i in (1, 2, 6):
        assert got[i] == [f"Story {i} begins.", f"It goes on {i} & on."]
    assert got[7] == ["Site name", "Menu one", "Story 7 begins.", "It goes on 7 & on.", "All rights"]
    assert got[8][0] == "Story 8 begins."
    assert {len(got[i]) for i in (3, 4, 5)} <= {2, 5}


def test_longest_common_subsequence_against_a_table():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = (rng.integers(0, 5, rng.integers(0, 14)).tolist() for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (a[i] == b[j]))
        found = H.common_lines(a, b)
        assert len(found) == best[-1, -1] and found == sorted(set(found))
        it = iter(b)
        assert all(a[i] in it for i in found)


def test_markup():
    def text(x):
        return [t for _, t in H.lines_of(x)]

    assert text("<p>a <b>b</b>c<p>d<br>e</p>\n f") == ["a bc", "d e", "f"]
    assert text("<header>x</header><article><header><h1>T</h1></header>y<aside>z</aside></article>w") == ["T", "y"]
    assert text("<div class='post ads'>x<div>y</div></div><div class='leader'>z</div>") == ["z"]
    assert text("a<script>var t='</p>';</script>b<style>p{}</style><!-- c <p> -->d") == ["abd"]
    assert text("&lt;p&gt;&nbsp;&#233;&eacute; &amp;amp; &bogus;") == ["<p> éé &amp; &bogus;"]
    assert text("<p>x</p><div id=comments><p>y</p></div><form>f<input>g</form>z") == ["x", "z"]
    assert text('<p title="a > b">x</p><p title="cut') == ["x"]
    assert text("1 < 2 <3 and a<b>c</b>") == ["1 < 2 <3 and ac"]
    assert text("<nav>menu</nav><p class=notice>n<p>t") == ["t"]
    for bad in ("<" * 100_000, "<a " * 50_000, '<a href="' * 30_000, "<!--" * 50_000, "<div>" * 50_000):
        H.lines_of(bad)


def test_edge_cases(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no url", "<p>x</p>"), (3, "no url", "<p>x</p>"),
            (None, "http://h/é", "é"), (4, "http://h/", "<article></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lines", F.lit(1))
    got = sorted((tuple(r) for r in H.digest(H.extract_text(df)).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (2, "", "", 0), (3, "no url", "x", 1), (3, "no url", "x", 1),
                          (None, "http://h/é", "é", 1), (4, "http://h/", "", 0)], key=str)
    assert H.extract_text(df.limit(0)).count() == 0


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text.split("\n") for r in H.extract_text(df.repartition(3)).collect()}


def test_copies_and_short_stories_lose_their_boilerplate(spark):
    top = "".join(f"<div>Template line {i}</div>" for i in range(12))

    def page(n, extra=""):
        return top + "".join(f"<p>Story {n}, part {i}.</p>" for i in range(3)) + extra

    def story(n):
        return [f"Story {n}, part {i}." for i in range(3)]

    # A run of copies at adjacent URLs, a run of versions, and other pages: 12 of 15 lines are the template's.
    rows = ([(n, f"http://h.x/a/{n}", page(n)) for n in range(8)]
            + [(n, f"http://h.x/b/{n}", page(99)) for n in range(10, 16)]
            + [(n, f"http://h.x/c/{n}", page(77, f"<p>Version {n}</p>")) for n in range(20, 24)])
    got = texts(spark, rows)
    assert all(got[n] == story(n) for n in range(8))
    assert all(got[n] == story(99) for n in range(10, 16))
    assert all(got[n] == story(77) + [f"Version {n}"] for n in range(20, 24))
    # Two pages, one of which lies in the other: nothing tells a template.
    got = texts(spark, [(1, "http://h.x/1", page(1)), (2, "http://h.x/2", page(1, "<p>More.</p>"))])
    assert len(got[1]) == 15


def test_articles_are_evidence_only(spark):
    def page(n):
        return (f"<div>Site</div><div class='sidebar-left post'><p>Story {n}.</p><p>It goes on {n}.</p></div>"
                f"<article class='teaser'><p>Teaser {n}</p></article><article class='comment'>Comment {n}</article>"
                f"<article><p>More stories</p><p>Read {n}</p></article><article><p>Same {n // 2}</p></article>")

    got = texts(spark, [(n, f"http://h.x/a/{n}", page(n)) for n in range(6)])
    # An article's line goes only where it is on half of the host's pages.
    assert got == {n: [f"Story {n}.", f"It goes on {n}.", f"Read {n}", f"Same {n // 2}"] for n in range(6)}


def test_articles_that_are_not_declared(spark, sf_dir):
    """The given pages without their article and ad markup, under a template."""
    pages = C.table(spark, sf_dir, "pages")
    want = {r.page_id: r.text for r in H.extract_text(pages).collect()}
    top = "".join(f"<div>Template line {i}</div>" for i in range(4))
    bare = pages.withColumn("html", F.regexp_replace(F.regexp_replace("html", "</?article>", "<hr>"), "<body>",
                                                     f"<body>{top}"))
    many = [r.host for r in bare.groupBy(F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"))
            .agg(F.countDistinct("html").alias("n")).where("n > 2").collect()]
    assert many
    kept = 0
    for r in H.extract_text(bare).collect():
        kept += len(r.text.split("\n"))
        if re.search("://([^/?#]*)", r.url)[1] in many:
            assert "Template line" not in r.text
        assert set(r.text.split("\n")) - {f"Template line {i}" for i in range(4)} <= set(want[r.page_id].split("\n"))
    assert kept > 0.9 * sum(len(x.split("\n")) for x in want.values())
