"""Exact quantiles by distributed selection, without a map of all values.

Every wanted rank starts with the range of its column and group. A round counts the
values of each range in BUCKETS equal buckets, with the least and largest value of
each, and the bucket that holds the rank becomes the next range; a range of one value is
the answer. All columns, ranks and groups share a round's one scan. What a task holds is
counts of buckets, whatever the number of different values, and a round divides every range
by BUCKETS or more, so smooth columns need two or three.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 2048
# Ranges (a few per group and column) up to this many are broadcast, more are joined by shuffle.
BROADCAST_RANGES = 20_000


def _other(rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` as a join's right side: the columns ``names`` get a mark."""
    return rows.withColumnsRenamed({n: f"{n}_" for n in names})


def _same(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.col(f"{n}_")) for n in names))


def exact_quantiles(rows: DataFrame, asked: dict[str, tuple[str, float]], by: tuple[str, ...] = ()) -> DataFrame:
    """One column per entry of ``asked`` (name: (column, share)), per group of the columns ``by``.

    The quantile lies between the two values around place (n - 1) * share, interpolated linearly, as
    ``percentile`` has it. Nulls and NaN are not counted; a column without values gives NULL. Without
    ``by`` there is one row, else one per group that occurs. Jobs run while the query is built.
    """
    columns = sorted({c for c, _ in asked.values()})
    stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    keys = ["item", *(f"by{i}" for i in range(len(by)))]
    groups = [F.col(b).alias(k) for b, k in zip(by, keys[1:])]
    values = (rows.select(*groups, F.expr(f"stack({len(columns)}, {stack}) AS (item, v)"))
              .where("v is not null and not isnan(v)"))
    spans = (values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
             .checkpoint(eager=True))
    wants = reduce(DataFrame.unionByName, (
        spans.where(F.col("item") == c).select("*", F.lit(name).alias("name"), ((F.col("n") - 1) * F.lit(float(p))).alias("spot"))
        for name, (c, p) in asked.items()))
    wants = (wants.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("spot"), F.ceil("spot")))))
             .select(*keys, "name", "spot", "rank", F.lit(0).cast("long").alias("below"), "lo", "hi")
             .checkpoint(eager=True))
    done = []
    while True:
        done.append(wants.where("lo = hi"))
        wants = wants.where("lo < hi")
        ranges = wants.select(*keys, "lo", "hi").distinct().checkpoint(eager=True)
        open_ranges = ranges.count()
        if not open_ranges:
            break
        side = _other(ranges, keys)
        side = F.broadcast(side) if open_ranges <= BROADCAST_RANGES else side
        # The width of a range may be beyond the doubles; the widths of its halves are not.
        width = F.col("hi") - F.col("lo")
        share = F.when(width < 1e300, (F.col("v") - F.col("lo")) / width).otherwise(
            (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2))
        inside = (values.join(side, _same(keys) & F.col("v").between(F.col("lo"), F.col("hi")))
                  .select(*keys, "lo", "hi", "v",
                          F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).alias("bucket")))
        counts = (inside.groupBy(*keys, "lo", "hi", "bucket")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most")))
        order = Window.partitionBy(*keys, "lo", "hi").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).checkpoint(eager=True)
        place = F.col("rank") - F.col("below")
        found = [*keys, "lo", "hi"]
        wants = (wants.join(_other(counts, found), _same(found) & (place >= F.col("before")) & (place < F.col("before") + F.col("n")))
                 .select(*keys, "name", "spot", "rank",
                         (F.col("below") + F.col("before")).alias("below"), F.col("least").alias("lo"),
                         F.col("most").alias("hi")).checkpoint(eager=True))
    found = reduce(DataFrame.unionByName, done)
    low, high = F.min_by("lo", "rank"), F.max_by("lo", "rank")
    spot = F.first("spot")
    value = F.when(low == high, low).otherwise((F.ceil(spot) - spot) * low + (spot - F.floor(spot)) * high)
    named = found.groupBy(*keys, "name").agg(value.alias("value"))
    return (named.groupBy(*(F.col(k).alias(b) for k, b in zip(keys[1:], by)))
            .agg(*(F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in asked)))
