"""Mix sources to target weights.

Sources get shares of a word budget by weight, up to a number of epochs of what they
have; what a full source cannot take is shared anew. Within each source the documents are
sorted by a random key, prefix sums of their words are taken over ranges of
that order, and the source is cut at its exact budget, after whole epochs.

The order is cut into ranges of even size, so a source with a third of all documents is
many ranges; only sums per range and source come together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm import common as C

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)      # of the sources in code-point order (null last), repeating
SHARE = (3, 2)           # of all words that the mix takes: 150 %
EPOCHS = 2


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target, for one row (source, source_size) per source.

    Filling by weight: in the order of limit to weight, a source is full if its share of
    what the fuller ones left exceeds its limit. One row per source in one task."""
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    num, den = share
    s = (sizes.withColumn("rank", F.row_number().over(by_name) - 1)
         .withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
                     .cast("decimal(38,0)"))
         .withColumn("cap", (F.col("source_size") * epochs).cast("decimal(38,0)"))
         .withColumn("all", F.sum(F.col("source_size")).over(Window.partitionBy()) * F.lit(num)))   # share * den
    fill = Window.orderBy((F.col("cap").cast("double") / F.col("w").cast("double")), "rank")
    up, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    zero = F.lit(0).cast("decimal(38,0)")
    s = (s.withColumn("left", F.col("all").cast("decimal(38,0)") - den * F.coalesce(F.sum("cap").over(up), zero))
         .withColumn("heft", F.sum("w").over(rest))
         .withColumn("full", F.col("left").cast("double") * F.col("w").cast("double")
                     >= F.col("cap").cast("double") * den * F.col("heft").cast("double")))
    everything = Window.partitionBy()
    level = [F.max(F.when(~F.col("full"), F.col(c))).over(everything).cast("double") for c in ("left", "heft")]
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.col("w").cast("double") * level[0] / (den * level[1]))
    return s.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        seed: int = 0, weights=WEIGHTS, share=SHARE, epochs: int = EPOCHS) -> DataFrame:
    """One row per document: doc_id, doc_key (hash of its text), size (words), source,
    source_size, target (of its source), taken (words the mix takes, repeats counted).

    Every source's ``taken`` add up to its target, rounded. A null text has no words
    and is not taken; null is a source of its own, the last; ids may repeat or be
    null. The key is md5 of seed and id, so reruns agree. Other columns are not read.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), C.text_key(F.col(text)).alias("doc_key"),
        F.col(source).alias("source"), size.alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).cast("binary"))
        .alias("key"))
    rows = C.ranged(slim, ["source", "key", "doc_id", "size", "doc_key"], "mix-order")
    sums = C.stored(rows.groupBy("part", "source").agg(F.sum("size").alias("words")), "mix-sums")
    goal = C.stored(targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")),
                            weights, share, epochs), "targets")
    # Each range holds one source or the ends of a few: as many rows as ranges and sources.
    parts = C.stored(C.before(sums, "part", "words", "source")
                     .join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
                     .select("part", F.col("source").alias("s"), "before", "source_size", "target"), "parts")
    inside = (Window.partitionBy("part", "source").orderBy("at")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.round("target").cast("long")
    whole = F.coalesce(F.floor(budget / F.nullif("source_size", F.lit(0))), F.lit(0))
    extra = budget - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), extra - F.col("start")))
    return (rows.join(parts.withColumnRenamed("part", "p"), (F.col("part") == F.col("p"))
                      & F.col("source").eqNullSafe(F.col("s")))
            .withColumn("start", start)
            .select("doc_id", "doc_key", "size", "source", "source_size", "target",
                    (whole * F.col("size") + part).cast("long").alias("taken")))


def materialise(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mix itself: the documents (all columns), each as often as it is taken.

    Documents are not cut: the one on which a source's budget ends is in if at least half
    of its words are taken. Documents without words are not in the mix."""
    taken = (mix(docs, doc_id=doc_id, text=text, **options).where("size > 0")
             .select(F.col("doc_id").alias("mix_id"), F.col("doc_key").alias("mix_key"),
                     F.round(F.col("taken") / F.col("size")).cast("int").alias("copies")))
    # Rows that repeat id and text are taken one by one: their copies are dealt together.
    taken = (taken.groupBy("mix_id", "mix_key")
             .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")))
    keyed = C.packed(docs).select("row", F.col("row")[doc_id].cast("long").alias("id"),
                                  C.text_key(F.col("row")[text]).alias("key"))
    joined = keyed.join(taken, F.col("id").eqNullSafe(F.col("mix_id")) & (F.col("key") == F.col("mix_key")))
    rank = F.when(F.col("rows") == 1, 1).otherwise(F.row_number().over(
        Window.partitionBy("id", "key").orderBy(F.lit(1))))
    share = F.floor(F.col("copies") / F.col("rows")) + F.when(
        F.col("rank") <= F.col("copies") % F.col("rows"), 1).otherwise(0)
    return (joined.withColumn("rank", rank).withColumn("times", share.cast("int")).where("times > 0")
            .withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
            .select(*(F.col("row")[c].alias(c) for c in docs.columns)))


def oracle(seed: int = 0) -> str:
    """DuckDB SQL for the columns of query op8."""
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    num, den = SHARE
    return rf"""
WITH d AS (
  SELECT doc_id, source, md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
         coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS n, {EPOCHS} * CAST(sum(size) AS DOUBLE) AS cap,
         CAST(CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % {len(WEIGHTS)} {weights} END
              AS DOUBLE) AS w
  FROM d GROUP BY source),
-- the water level l / (h * {den}): the highest that any set of full sources gives
levels AS (
  SELECT {num} * sum(n) AS l, sum(w) AS h FROM s
  UNION ALL
  SELECT {num} * (SELECT sum(n) FROM s) - {den} * (SELECT sum(cap) FROM s f WHERE f.cap / f.w <= x.cap / x.w),
         (SELECT sum(w) FROM s f WHERE f.cap / f.w > x.cap / x.w) FROM s x),
best AS (SELECT arg_max(l, l / ({den} * h)) AS l, arg_max(h, l / ({den} * h)) AS h FROM levels WHERE h > 0),
t AS (SELECT source, n, least(cap, w * l / ({den} * h)) AS target FROM s, best),
p AS (
  SELECT d.*, CAST(t.n AS BIGINT) AS source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(coalesce(budget // nullif(source_size, 0), 0) * size
            + greatest(0, least(size, budget - coalesce(budget // nullif(source_size, 0), 0) * source_size - start))
            AS BIGINT) AS taken
FROM p"""
