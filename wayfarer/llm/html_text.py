"""Main text of web pages by nearest-URL page differencing.

A page is read into text lines, one per block. Pages of a host with equal lines are one
class. The classes are put in the order of their URL paths; each is compared with its neighbour
there, the nearer of the two. Lines that the longest common subsequence of the two aligns are
the site's, not the page's, and are deleted. Where it aligns nearly all lines, the two may be versions of
one story or short stories under one big template: the other neighbour is asked, and if it is as
alike, an aligned line goes only if at least half of the host's classes hold it.

Differencing decides about all lines. It cannot see boilerplate that changes from page to page,
nor should it delete an article's line because another article has it too. So markup that names a part
(``nav``, ``footer``, class "ad" and the like) deletes that part in any case, and a line in a declared
``article`` or ``main`` element goes only if three classes and half of the host's hold it.

Only line hashes travel for the comparison: neighbours are found in a table of URL
paths cut into ranges, so a host with a third of all pages is many ranges.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm import common as C

# Element names of HTML, and names that mark a part as not the article.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl
dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main
menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE_TAGS = frozenset("""aside button datalist dialog footer form head iframe menu nav noscript object
select svg template textarea title video audio canvas map math""".split())
NOISE_NAMES = frozenset("""ad ads adsense advert advertisement advertising adverts banner breadcrumb
breadcrumbs byline-share comment comments consent cookie cookies disqus footer gdpr masthead menu modal
nav navbar navigation newsletter notice notices overlay pager pagination paywall popup promo promoted
recommended related replies reply share sharing sidebar signup skip social sponsor sponsored subscribe
teaser teasers toolbar widget widgets""".split())
NOISE_ROLES = frozenset("alert banner complementary contentinfo dialog menu navigation search".split())
CLOSED_BY_BLOCK = frozenset("p dt dd li option tr td th".split())
ALIKE = 0.8      # of two pages that share this part of the shorter one, lines are counted on the host

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style)\b(?>[^>]*)(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?>[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<cut>/?[a-z][^>]*)(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
KEEP, ASK = 1, 0


def _is_noise(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in NOISE_TAGS or tag == "header" and not in_article:
        return True
    if not attrs or "=" not in attrs:
        return False
    for name, *values in _ATTR.findall(attrs):
        value, name = "".join(values).lower(), name.lower()
        if name == "role" and value.strip() in NOISE_ROLES:
            return True
        if name in ("class", "id") and tag not in ("body", "html", "main"):
            words = set(value.split())
            if words & NOISE_NAMES or "header" in words and not in_article:
                return True
    return False


def lines_of(page: str, whole: bool = False) -> list[tuple[int, str]]:
    """(KEEP or ASK, text) of each block with text, in page order.

    KEEP lines lie in an ``article`` or ``main`` element; of a page that has one, only the ``whole``
    has others. A part cut off by the end of the page ends there."""
    out: list[tuple[int, str]] = []
    piece: list[str] = []
    article, dropped, depth = 0, "", 0        # open article elements; the noise element we are in
    seen_article = False

    def flush() -> None:
        if piece:
            line = " ".join(html.unescape("".join(piece)).split())
            piece.clear()
            if line:
                out.append((KEEP if article else ASK, line))

    at = 0
    for m in _MARKUP.finditer(page):
        if not dropped and m.start() > at:
            piece.append(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            if dropped:
                if tag == dropped:
                    depth -= 1
                elif dropped in CLOSED_BY_BLOCK and tag in BLOCKS and tag not in CLOSED_BY_BLOCK:
                    depth = 0
                if depth <= 0:
                    if tag in ("article", "main") and tag != dropped:
                        article = max(0, article - 1)
                    dropped = ""
            elif tag in BLOCKS:
                flush()
                if tag in ("article", "main"):
                    article = max(0, article - 1)
            continue
        if dropped and dropped in CLOSED_BY_BLOCK and tag in BLOCKS:
            dropped = ""
        if dropped:
            if tag == dropped and tag not in VOID:
                depth += 1
            continue
        attrs = m["attrs"] or ""
        if tag == "br":
            piece.append(" ")
        elif tag in VOID and tag != "hr":
            continue
        elif _is_noise(tag, attrs, article > 0):
            if tag in BLOCKS:
                flush()
            if not attrs.rstrip().endswith("/"):
                dropped, depth = tag, 1
        elif tag in BLOCKS:
            flush()
            if tag in ("article", "main"):
                article += 1
                seen_article = True
    if not dropped and at < len(page):
        piece.append(page[at:])
    flush()
    return [x for x in out if x[0] == KEEP] if seen_article and not whole else out


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Indices into ``a`` of one longest common subsequence (Hunt and Szymanski)."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    where: dict[int, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        where.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple | None] = []
    for i in range(head, len(a) - tail):
        for j in where.get(a[i], ()):
            k = bisect.bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    middle, node = [], links[-1] if links else None
    while node:
        middle.append(node[0])
        node = node[1]
    return [*range(head), *reversed(middle), *range(len(a) - tail, len(a))]


def shared_lines(lines: list[int], declared: list[int], first: list[int] | None, second: list[int] | None
                 ) -> tuple[list[int], dict[int, int]]:
    """Indices of ``lines`` that go, and indices that go if enough classes of the host hold the
    line, with the least number that is enough. ``declared`` are indices of KEEP lines."""
    asked: set[int] = set()
    for other in (first, second):
        found = common_lines(lines, other) if lines and other else []
        if found and len(found) < ALIKE * min(len(lines), len(other)):
            keep = set(declared)
            return [i for i in found if i not in keep], dict.fromkeys(sorted(keep.intersection(found)), 3)
        asked.update(found)
    # A page that lies in another as a whole has a line of its own only by a third one's word.
    keep = asked if len(asked) == len(lines) else set(declared)
    return [], {i: 3 if i in keep else 2 for i in sorted(asked)}


def _line_hash(line: str) -> int:
    return xxhash.xxh64_intdigest(line) - (1 << 63)


_KEYS = pa.schema([("page_id", pa.int64()), ("page_key", pa.int64()), ("host", pa.string()),
                   ("path", pa.string()), ("lines", pa.list_(pa.int64())), ("declared", pa.list_(pa.int32()))])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the lines, and which of them are declared."""
    for part in C.slices(batches, "html"):
        lines, declared = [], []
        for p in part.column("html").to_pylist():
            found = lines_of(p or "", whole=True)
            lines.append([_line_hash(x) for _, x in found])
            declared.append([i for i, (kind, _) in enumerate(found) if kind == KEEP])
        yield C.arrow_rows({x: part.column(x) for x in ("page_id", "page_key", "host", "path")}
                           | {"lines": lines, "declared": declared}, _KEYS)


_ASKED = pa.struct([("at", pa.int32()), ("line", pa.int64()), ("least", pa.int32())])
_SHARED = pa.schema([("host", pa.string()), ("class", pa.int64()), ("sure", pa.list_(pa.int32())),
                     ("asked", pa.list_(_ASKED))])
_SHARED_DDL = "host string, class long, sure array<int>, asked array<struct<at:int,line:long,least:int>>"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        sure, asked = [], []
        for row in part.select(["lines", "declared", "first", "second"]).to_pylist():
            gone, maybe = shared_lines(row["lines"], row["declared"], row["first"], row["second"])
            sure.append(gone)
            asked.append([{"at": i, "line": row["lines"][i], "least": n} for i, n in maybe.items()])
        yield C.arrow_rows({"host": part.column("host"), "class": part.column("class"),
                            "sure": sure, "asked": asked}, _SHARED)


_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in C.slices(batches, "html"):
        texts = []
        for page, shared in zip(part.column("html").to_pylist(), part.column("shared").to_pylist(),
                                strict=True):
            gone = set(shared or ())
            texts.append("\n".join(line for i, (_, line) in enumerate(lines_of(page or "", whole=True))
                                   if i not in gone))
        yield C.arrow_rows({"page_id": part.column("page_id"), "url": part.column("url"),
                            "text": texts}, _TEXT)


def _neighbours(classes: DataFrame) -> DataFrame:
    """Each class with the lines of its two neighbours by path on its host, the nearer first.

    The order is cut into even ranges; the ends of each range (two rows) are
    handed to the next one."""
    order = ["host", "path", "class"]
    keys = C.stored(classes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "paths")
    w = Window.partitionBy("part").orderBy(*order)
    side = F.struct("host", "path", "lines")
    rows = (keys.withColumn("before", F.lag(side).over(w)).withColumn("after", F.lead(side).over(w)))
    ends = keys.groupBy("part").agg(F.min(F.struct(*order, "lines")).alias("first"),
                                    F.max(F.struct(*order, "lines")).alias("last"))
    across = Window.orderBy("part")      # two rows for each partition, whatever it holds
    ends = (ends.withColumn("b", F.lag("last").over(across)).withColumn("a", F.lead("first").over(across))
            .select("part", F.struct("b.host", "b.path", "b.lines").alias("b"),
                    F.struct("a.host", "a.path", "a.lines").alias("a")))
    rows = rows.join(ends, "part", "left")
    both = {"before": F.coalesce("before", "b"), "after": F.coalesce("after", "a")}
    same = {k: F.when(v.host == F.col("host"), v) for k, v in both.items()}
    rows = rows.select("host", "class", "path", "lines", "declared", *(v.alias(k) for k, v in same.items()))

    def alike(other):     # length of the common start of two paths
        n = F.least(F.length("path"), F.length(f"{other}.path"))
        return F.coalesce(F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(
            "path", F.lit(1), i) == F.substr(f"{other}.path", F.lit(1), i))), F.lit(-1))

    nearer = alike("before") >= alike("after")
    return rows.select("host", "class", "lines", "declared",
                       F.when(nearer, F.col("before.lines")).otherwise(F.col("after.lines")).alias("first"),
                       F.when(nearer, F.col("after.lines")).otherwise(F.col("before.lines")).alias("second"))


def _shared(keys: DataFrame) -> DataFrame:
    """page_id, page_key and the indices of the lines that go, for each page that has some."""
    of = ["host", "class"]
    classes = C.stored(keys.groupBy(*of).agg(F.min("path").alias("path"), F.first("lines").alias("lines"),
                                           F.max("declared").alias("declared")), "classes")
    found = C.stored(_neighbours(classes).mapInArrow(_compare, _SHARED_DDL), "aligned")
    # Lines that half of a host's classes hold: at most twice as many as a page has, for each host.
    held = classes.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy("host", "line").count()
    common = (held.join(classes.groupBy("host").agg(F.count("*").alias("all")), "host")
              .where(F.col("count") * 2 >= F.col("all")).select("host", "line", "count"))
    counted = (found.select(*of, F.explode("asked").alias("a")).select(*of, "a.*")
               .join(common, ["host", "line"]).where(F.col("count") >= F.col("least")).select(*of, "at"))
    gone = (found.select(*of, F.explode("sure").alias("at")).unionByName(counted)
            .groupBy(*of).agg(F.collect_list("at").alias("shared")))
    return (keys.select("page_id", "page_key", *of).join(gone, of)
            .select("page_id", "page_key", "shared").dropDuplicates(["page_id", "page_key"]))


def extract_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url",
                 html_column: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (blocks joined by a newline; empty if none).

    Null or empty html has no text; a null or odd URL is a host and path of its own
    kind; repeated rows and copies of a page are never compared with each other, and lose the
    same lines. Other columns are not read.
    """
    u, h = F.col(url), F.col(html_column)
    slim = pages.select(
        F.col(page_id).cast("long").alias("page_id"), u.alias("url"), h.alias("html"),
        F.xxhash64(u, h).alias("page_key"),
        F.coalesce(F.lower(F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(u, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1), F.lit("")).alias("path"))
    keys = slim.mapInArrow(_read, "page_id long, page_key long, host string, path string, lines array<long>, "
                           "declared array<int>")
    keys = C.stored(keys.where(F.size("lines") > 0).withColumn("class", F.xxhash64("lines")), "lines")
    shared = C.stored(_shared(keys), "shared")
    shared = shared.toDF("_id", "_key", "shared")
    return (slim.join(shared, F.col("page_id").eqNullSafe(F.col("_id"))
                      & (F.col("page_key") == F.col("_key")), "left")
            .select("page_id", "url", "html", "shared")
            .mapInArrow(_extract, "page_id long, url string, text string"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of query op4 from ``extract_text``."""
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
