"""Line dedup: every line of some length stays in the first document that holds it.

A line's key is the line without blanks at its ends, A-Z lowered. Its 128-bit hash, the
document and the line's position are all that moves. The rows are range-partitioned by
hash and sorted by document and position within; one pass over each range gives every
line the first document of its hash, and a line of a later document is dropped. The
result is a bitmap per document, not text.

The most frequent hashes, found by a sketch of fixed size, would be one task each. They
are not shuffled: their first documents come from a pre-aggregated minimum, broadcast
(FREQUENT rows at most), and decide their lines where they are. The sketch decides only
which way a line takes, never its fate. Spark's own functions throughout.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm import common as C

BLANKS = " \t\n\x0b\x0c\r"
LEAST = 10           # code points of a key that counts
FREQUENT = 1000      # hashes decided without a shuffle
TRACKED = 10_000     # hashes the sketch follows: a share above about 1 / TRACKED is found
SKETCHES = 64        # sketches merged at once in the last step


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lowered and nothing else."""
    bare = F.btrim(line, F.lit(BLANKS))
    return (F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare))
            .otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)))


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty one has one, empty."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _frequent(rows: DataFrame) -> DataFrame:
    """The most frequent values of h1, as one column; FREQUENT rows at most."""
    sketches = (rows.select("h1", F.pmod(F.spark_partition_id(), F.lit(SKETCHES)).alias("group"))
                .groupBy("group").agg(F.expr(f"approx_top_k_accumulate(h1, {TRACKED})").alias("sketch")))
    # By a key, if the same for all: without rows there is no sketch to combine.
    return (sketches.groupBy(F.col("group") < 0).agg(F.expr("approx_top_k_combine(sketch)").alias("sketch"))
            .select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {FREQUENT})")).alias("top"))
            .select(F.col("top.item").alias("h1")))


def find_repeated_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                        least: int = LEAST) -> DataFrame:
    """One row per document that loses lines: doc_id, doc_key (hash of its text), n_dropped
    and keep, its bitmap: an array of (block, bits) by block, bit i of ``bits`` telling whether
    line 64 * block + i stays. Blocks that stay whole are not listed.

    A document is named by its id: rows that share one are the same document, so their lines
    stay or go together, and all rows without id are one document, after all others. A null
    text is one empty line. Other columns are not read, whatever their names.
    """
    # The hash of a text is taken before its lines are dealt out, once.
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc"), C.text_key(F.col(f"`{text}`")).alias("doc_key"),
                        lines_of(F.col(f"`{text}`")).alias("lines"))
    lines = texts.select("doc", "doc_key", F.posexplode("lines").alias("pos", "line"))
    key = line_key(F.col("line"))
    rows = C.stored(lines.where(F.octet_length("line") >= least).where(F.char_length(key) >= least)
                    .select("doc", "doc_key", "pos", F.xxhash64(key).alias("h1"),
                            F.xxhash64(F.lit(1), key).alias("h2")), "lines")
    frequent = C.stored(_frequent(rows), "frequent")
    # The rows of a frequent hash meet only in a minimum that every task takes of its own first.
    firsts = C.stored(rows.join(F.broadcast(frequent), "h1").groupBy("h1", "h2")
                      .agg(F.min("doc").alias("first")), "firsts")
    later = ~F.col("doc").eqNullSafe(F.col("first"))
    at_once = rows.join(F.broadcast(firsts), ["h1", "h2"]).where(later)
    stream = (Window.partitionBy("h1", "h2").orderBy(F.asc_nulls_last("doc"), "doc_key", "pos")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    streamed = (rows.join(F.broadcast(frequent), "h1", "left_anti").repartitionByRange("h1", "h2")
                .withColumn("first", F.first("doc").over(stream)).where(later))
    place = ["doc", "doc_key", "pos"]
    blocks = (at_once.select(*place).unionByName(streamed.select(*place))
              .groupBy("doc", "doc_key", F.shiftright("pos", 6).alias("block"))
              .agg(F.expr("bit_or(shiftleft(1L, pos & 63))").alias("gone")))
    return (blocks.groupBy("doc", "doc_key")
            .agg(F.sum(F.bit_count("gone")).alias("n_dropped"),
                 F.sort_array(F.collect_list(F.struct("block", F.bitwise_not("gone").alias("bits")))).alias("keep"))
            .withColumnRenamed("doc", "doc_id"))


# The bitmap is spread over all blocks up to its last (``words``, bound once by the outer
# lambda), so that each line finds its bit by its number.
_KEPT = """
transform(array(flatten(transform(keep, (x, i) -> concat(
    array_repeat(-1L, x.block - if(i = 0, -1, keep[i - 1].block) - 1), array(x.bits))))),
  words -> array_join(filter(lines, (line, i) ->
    (shiftright(coalesce(get(words, shiftright(i, 6)), -1L), i & 63) & 1L) = 1L), '\\n'))[0]"""


def _matched(docs: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """row (the document as a struct), n_lines, n_dropped, kept (its text without the lines dropped)."""
    keyed = C.packed(docs).select("row", F.col("row")[doc_id].alias("id"), F.col("row")[text].alias("text"))
    joined = (keyed.withColumn("key", C.text_key(F.col("text")))
              .join(found.select(F.col("doc_id").alias("found_id"), "doc_key", "n_dropped", "keep"),
                    F.col("id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("doc_key")), "left"))
    lines = lines_of(F.col("text"))
    return joined.withColumn("lines", lines).select(
        "row", F.size("lines").cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
        F.when(F.col("keep").isNull(), F.col("text")).otherwise(F.expr(_KEPT)).alias("kept"))


def drop_lines(docs: DataFrame, found: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents (all columns) with their kept lines, joined by \\n, as text; a null text stays null."""
    return _matched(docs, found, doc_id, text).select(
        *(F.col("kept").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))


def digest(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of query op13."""
    return _matched(docs.select("doc_id", "text"), found, "doc_id", "text").select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def oracle() -> str:
    """DuckDB SQL for the columns of query op13."""
    blanks = "' ' || " + " || ".join(f"chr({ord(b)})" for b in BLANKS[1:])
    return f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {blanks}), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= {LEAST} GROUP BY key),
m AS (SELECT k.*, coalesce(f.first < k.doc_id, false) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""
