"""A stored daily rollup of the analysable rows that merges over any period.

``cells`` has one row per day and value of each slice (the grouping columns, the hour, the
disruption flag, and the whole network): the number of journeys and, for every column behind an
additive metric, its sum or hits and the number of its values. ``people`` has per day the
customers as bitmaps over dense customer numbers, so distinct customers merge as well: the
union of the days' bitmaps, bucket by bucket. A query on a period reads days times values
rows instead of journeys. What the rollup cannot answer (a choice on some other column,
percentiles) is asked of the rows, as before.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.metrics import METRICS
from ..session import ensure_checkpoint_dir
from .filters import Period, Selection

NETWORK = "network"
SLICES = (*C.GROUPING_COLUMNS, "journey_hour", "service_disruption")


def _stored(rows: DataFrame, path: str, *parts: str) -> DataFrame:
    rows.write.partitionBy(*parts).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _sources() -> list[tuple[str, str]]:
    """(kind, column) of every additive metric, once each."""
    return list(dict.fromkeys(m.parts for m in METRICS.values() if m.parts and m.parts[1]))


def _cells(analytics: DataFrame) -> DataFrame:
    measures = [F.count(F.lit(1)).alias("journeys")]
    for kind, column in _sources():
        measures.append(F.sum(column).alias(f"{column}_sum") if kind == "avg"
                        else F.count(F.when(F.col(column), 1)).alias(f"{column}_sum"))
        measures.append(F.count(column).alias(f"{column}_n"))
    day = F.col("date")
    grouped = (analytics.groupingSets([[day], *([day, F.col(s)] for s in SLICES)], day, *(F.col(s) for s in SLICES))
               .agg(*(F.grouping(s).alias(f"{s}_out") for s in SLICES), *measures))
    name = F.coalesce(*(F.when(F.col(f"{s}_out") == 0, s) for s in SLICES), F.lit(NETWORK))
    value = F.coalesce(*(F.when(F.col(f"{s}_out") == 0, F.col(s).cast("string")) for s in SLICES))
    kept = [c for c in grouped.columns if c not in (*SLICES, *(f"{s}_out" for s in SLICES))]
    return grouped.select(name.alias("slice"), value.alias("value"), *kept)


def _numbered_customers(analytics: DataFrame, base: str) -> DataFrame:
    """customer_id, number: 1, 2, ... in the order of ids, from a range sort and counts per range."""
    place = F.monotonically_increasing_id()
    ids = _stored(analytics.select("customer_id").where("customer_id is not null").distinct()
                  .repartitionByRange("customer_id").sortWithinPartitions("customer_id")
                  .select("customer_id", F.shiftright(place, 33).alias("part"),
                          place.bitwiseAND((1 << 33) - 1).alias("at")), f"{base}/ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row per range
    parts = (ids.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    return ids.join(parts, "part").select("customer_id", (F.col("before") + F.col("at") + 1).alias("number"))


def _people(analytics: DataFrame, base: str) -> DataFrame:
    numbers = _numbered_customers(analytics, base)
    days = analytics.select("date", "customer_id").where("customer_id is not null").distinct()
    return (days.join(numbers, "customer_id")
            .groupBy("date", F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("seen")))


def merged(key: str, cond: Column | None = None) -> Column:
    """An additive metric over the cells of a group, or of those of them that meet ``cond``."""
    gate = (lambda c: F.col(c)) if cond is None else (lambda c: F.when(cond, F.col(c)))
    kind, column = METRICS[key].parts
    if kind == "count":
        return F.coalesce(F.sum(gate("journeys")), F.lit(0))
    ratio = F.sum(gate(f"{column}_sum")) / F.nullif(F.sum(gate(f"{column}_n")), F.lit(0))
    return ratio if kind == "avg" else F.lit(100.0) * F.sum(gate(f"{column}_sum")) / F.nullif(
        F.sum(gate(f"{column}_n")), F.lit(0))


@dataclass(frozen=True)
class Rollup:
    cells: DataFrame
    people: DataFrame

    @classmethod
    def build(cls, analytics: DataFrame, base: str | None = None) -> "Rollup":
        """Compute and store the rollup under ``base`` (a new folder of the shared checkpoint
        folder if not given); two scans of the rows."""
        spark = analytics.sparkSession
        base = f"{base or ensure_checkpoint_dir(spark).rstrip('/')}/rollup-{uuid.uuid4().hex[:8]}"
        cells = _cells(analytics).hint("rebalance", "slice").sortWithinPartitions("date")
        return cls(_stored(cells, f"{base}/cells", "slice"), _stored(_people(analytics, base), f"{base}/people"))

    def answers(self, selection: Selection | None, keys: Iterable[str], by: str | None = None,
                customers: bool = False) -> bool:
        """Whether metrics ``keys`` of ``selection``, per value of ``by``, can be read from here."""
        wanted = set(selection.wanted) if selection else set()
        plain = {k for k in keys if k in METRICS and (METRICS[k].parts or customers and k == "active_customers")}
        return wanted <= ({by} if by else set()) and plain == set(keys) and (by is None or by in SLICES)

    def slice(self, by: str | None, selection: Selection | None, period: Period | None = None) -> DataFrame:
        """The cells of one slice, of a period (the selection's if not given) and the wanted values."""
        rows = self.cells.where(F.col("slice") == (by or NETWORK))
        period = period or (selection.period if selection else None)
        if period:
            rows = rows.where(period.holds())
        if by and selection and by in selection.wanted:
            rows = rows.where(F.col("value").isin(*sorted(selection.wanted[by])))
        return rows

    def customers(self, *periods: Period | None) -> DataFrame:
        """One row: customers0, customers1, ..., the distinct customers of each period (None: all days)."""
        inside = [p.holds() if p else F.lit(True) for p in periods]
        nobody = F.lit(None).cast("binary")
        per_bucket = self.people.groupBy("bucket").agg(*(
            F.bitmap_count(F.coalesce(F.bitmap_or_agg(F.when(c, F.col("seen")).otherwise(nobody)), F.lit(b"")))
            .alias(f"c{i}") for i, c in enumerate(inside)))
        return per_bucket.agg(*(F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"customers{i}") for i in range(len(periods))))
