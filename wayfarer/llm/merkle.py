"""Merkle manifest of a dataset: leaves, roots, and a proof for every document.

Every document is a leaf of its source's tree, in the order of ids; the roots of the
sources are the leaves of one more tree. A level is built by sibling-shift self-joins:
the node at slot zero of every run computes the indices of its siblings (its own index
and an offset), an equijoin fetches them, and it emits the parent. Proofs are read off
from the top down: a node hands its run and the way above it to its sixteen children,
so no join has a key with more than sixteen rows, however large a source is.

The index of a leaf comes from a range sort and counts per range, not from a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.llm import common as C

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WAY = "array<struct<slot:int,run:array<string>>>"


def field(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 length, a colon, and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The digest of one record: SHA-256 of its fields, each written by ``field``."""
    return F.sha2(F.concat(*map(field, values)), 256)


def proof(way: Column) -> Column:
    """SHA-256 of all siblings of a way, level by level to the root, left to right."""
    others = F.transform(way, lambda step: F.filter(step.run, lambda _, i: i != step.slot))
    return F.sha2(F.array_join(F.flatten(others), ""), 256)


def fold(digest: Column, way: Column) -> Column:
    """The root that a leaf leads to with the siblings of its way."""
    def up(below: Column, step: Column) -> Column:
        left = F.array_join(F.slice(step.run, F.lit(1), step.slot), "")
        right = F.array_join(F.slice(step.run, step.slot + 2, F.lit(FAN)), "")
        return F.sha2(F.concat(left, below, right), 256)
    return F.aggregate(way, digest, up)


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Stored ``rows`` with idx, their place in their tree by ``order`` from 0, and n, its size."""
    rows = C.ranged(rows, ["tree", *order], name)
    counts = C.stored(rows.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("from")),
                      f"{name}-counts")
    sizes = counts.groupBy("tree").agg(F.sum("rows").alias("n"))
    parts = C.stored(C.before(counts, "part", "rows", "tree").join(sizes, "tree")
                     .select("part", "tree", (F.col("before") - F.col("from")).alias("shift"), "n"), f"{name}-parts")
    return C.stored(rows.join(parts, ["part", "tree"])
                    .withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift"), f"{name}-numbered")


def _parents(nodes: DataFrame) -> DataFrame:
    """The level above: tree, idx, n, digest and run (its children's digests, in order)."""
    last = F.least(F.lit(FAN - 1), F.col("n") - 1 - F.col("idx"))
    heads = (nodes.where((F.col("n") > 1) & (F.col("idx") % FAN == 0))
             .select("tree", F.col("idx").alias("head"), "n",
                     F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("shift")))
    siblings = nodes.select("tree", "idx", "digest")
    runs = (heads.withColumn("idx", F.col("head") + F.col("shift")).join(siblings, ["tree", "idx"])
            .groupBy("tree", "head", "n")
            .agg(F.sort_array(F.collect_list(F.struct("shift", "digest")))["digest"].alias("run")))
    return runs.select("tree", F.expr(f"head div {FAN}").alias("idx"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
                       F.sha2(F.array_join("run", ""), 256).alias("digest"), "run")


def _levels(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The stored levels above the leaves, up to where every tree has one node."""
    size = nodes.agg(F.max("n")).first()[0] or 0
    levels = []
    while size > 1:
        nodes = C.stored(_parents(nodes), f"{name}-level")
        levels.append(nodes)
        size = -(-size // FAN)
    return levels


def _ways(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """``leaves`` with their way to the root of all, from the levels of their trees and from
    ``tops``: tree, subroot, root and way (from the subroot on), one row per tree."""
    above = None
    for level in [*reversed(levels), leaves]:
        ends = level.where("n = 1").join(tops, "tree")
        if above is not None:
            parents = above.select("tree", F.col("idx").alias("up"), F.col("run").alias("up_run"), "subroot", "root",
                                   F.col("way").alias("up_way"))
            step = F.struct((F.col("idx") % FAN).cast("int").alias("slot"), F.col("up_run").alias("run"))
            ends = ends.unionByName(level.where("n > 1").withColumn("up", F.expr(f"idx div {FAN}"))
                                    .join(parents, ["tree", "up"])
                                    .withColumn("way", F.concat(F.array(step), "up_way")).drop("up", "up_run", "up_way"))
        above = ends if level is leaves else C.stored(ends, f"{name}-ways")
    return above


def _roots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """tree, digest: the one node each tree ends in."""
    out = leaves.where("n = 1").select("tree", "digest")
    for level in levels:
        out = out.unionByName(level.where("n = 1").select("tree", "digest"))
    return out


def manifest(docs: DataFrame, *, fields: tuple[str, ...] = FIELDS, tree: str = "source", order: str = "doc_id",
             also: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: id (``order``), leaf, subroot (of its ``tree``), root and way: from
    the leaf's run to the root's, each step the leaf's or its ancestor's slot and the run.

    ``fields`` are hashed, in this order. Within a tree leaves ascend by ``order`` (null first), then
    by digest; trees by their name (null first, bytewise), and null is a tree of its own. Rows
    that agree in all fields are leaves of their own with equal digests. A tree of one leaf has
    that leaf as its subroot, one tree alone its subroot as the root. ``also`` adds columns
    computed from the documents' own. An empty table has no root and no rows. Columns that
    are not named here are not read.
    """
    also = also or {}
    name = F.col(f"`{tree}`").cast("string")
    slim = docs.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("-")).alias("tree"), F.col(f"`{order}`").alias("id"),
        leaf(*(F.col(f"`{f}`") for f in fields)).alias("digest"),
        F.struct(F.lit(0).alias("none"), *(c.alias(n) for n, c in also.items())).alias("also"))
    leaves = _numbered(C.stored(slim, "leaves"), ["id", "digest"], "leaves")
    levels = _levels(leaves, "leaves")
    subroots = _numbered(_roots(leaves, levels).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"),
                         ["name"], "subroots")
    tops = _levels(subroots, "subroots")
    crown = _roots(subroots, tops).select("tree", F.col("digest").alias("subroot"), F.col("digest").alias("root"),
                                          F.array().cast(WAY).alias("way"))
    top = C.stored(_ways(subroots, tops, crown, "subroots")
                   .select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", "way"), "tops")
    return _ways(leaves, levels, top, "leaves").select(
        "id", F.col("digest").alias("leaf"), "subroot", "root", "way", *(F.col(f"also.{n}").alias(n) for n in also))


def tampered(docs: DataFrame) -> Column:
    """The leaf of query op11's tampered record: of every fifth id by hash the text's A-Z lowered."""
    text = F.col("text")
    lowered = (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
               .otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(hit, leaf(*(lowered if f == "text" else F.col(f) for f in FIELDS)))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op11: the manifest, and whether each record, a fifth of them tampered,
    still leads to the root."""
    found = manifest(docs, also={"tampered": tampered(docs)})
    folded = fold(F.coalesce("tampered", "leaf"), F.col("way"))
    return (found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof(F.col("way")).alias("proof_sha256"),
                         folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def oracle(levels: int = 5, top_levels: int = 3) -> str:
    """DuckDB SQL for the columns of query op11, for FAN ** levels documents of a source at most
    and FAN ** top_levels sources."""
    def record(text: str) -> str:
        values = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
        return "sha256(" + " || ".join(f"coalesce(CAST(octet_length(encode({v})) AS VARCHAR) || ':' || {v}, '-')"
                                       for v in values) + ")"

    def climb(a: str, steps: int) -> list[str]:
        """CTEs a1.. (nodes of each level above a0) and a (their last)."""
        out = []
        for k in range(steps):
            out.append(f"""{a}{k + 1} AS MATERIALIZED (
  SELECT tree, idx // {FAN} AS idx, any_value(n + {FAN - 1}) // {FAN} AS n, sha256(string_agg(digest, '' ORDER BY idx)) AS digest
  FROM {a}{k} WHERE n > 1 GROUP BY tree, idx // {FAN}
  UNION ALL SELECT tree, idx, n, digest FROM {a}{k} WHERE n = 1)""")
        return out

    def follow(f: str, a: str, steps: int) -> list[str]:
        """CTEs f1..: the records with what they fold to and their siblings so far."""
        out = []
        for k in range(steps):
            out.append(f"""{f}{k + 1} AS MATERIALIZED (
  SELECT f.row, any_value(f.tree) AS tree, any_value(f.idx) // {FAN} AS idx,
         CASE WHEN any_value(s.n) = 1 THEN any_value(f.acc)
              ELSE sha256(string_agg(CASE WHEN s.idx = f.idx THEN f.acc ELSE s.digest END, '' ORDER BY s.idx)) END AS acc,
         any_value(f.proof) || coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx <> f.idx), '') AS proof
  FROM {f}{k} f JOIN {a}{k} s ON s.tree = f.tree AND s.idx // {FAN} = f.idx // {FAN} GROUP BY f.row)""")
        return out
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
      range(1, len(CAST(doc_id AS VARCHAR)) + 1),
      lambda i: [CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"""
    steps = [f"""r AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, {record('text')} AS digest,
         CASE WHEN {crc} % 5 = 0 THEN {record(lowered)} END AS bad FROM documents)""",
             """a0 AS MATERIALIZED (
  SELECT row_number() OVER () AS row, *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS n FROM r)""",
             *climb("a", levels),
             f"""b0 AS MATERIALIZED (
  SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n, digest FROM a{levels})""",
             *climb("b", top_levels),
             "f0 AS (SELECT row, tree, idx, coalesce(bad, digest) AS acc, '' AS proof FROM a0)",
             *follow("f", "a", levels),
             f"g0 AS (SELECT f.row, '' AS tree, b0.idx, f.acc, f.proof FROM f{levels} f JOIN b0 ON b0.name = f.tree)",
             *follow("g", "b", top_levels)]
    return "WITH " + ",\n".join(steps) + f"""
SELECT a0.doc_id, a0.digest AS leaf, s.digest AS subroot, t.digest AS root, sha256(g.proof) AS proof_sha256,
       g.acc AS folded_root, g.acc = t.digest AS verified
FROM a0 JOIN a{levels} s ON s.tree = a0.tree JOIN g{top_levels} g ON g.row = a0.row CROSS JOIN b{top_levels} t"""
