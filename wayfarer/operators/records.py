"""Record browsing: column pick, subsets, literal search, sorts, top-k.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps its
own top k and only k rows per task reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..plans.filters import Selection


def _sort_options() -> dict[str, list[Column]]:
    return {
        "Most recent": [F.col("timestamp").desc_nulls_last()],
        "Longest delay": [F.col("delay_minutes").desc_nulls_last()],
        "Lowest satisfaction": [F.col("customer_satisfaction").asc_nulls_last()],
        "Highest satisfaction": [F.col("customer_satisfaction").desc_nulls_last()],
        "Longest journey": [F.col("journey_duration_minutes").desc_nulls_last()],
        "Slowest complaint resolution": [F.col("resolution_time_hours").desc_nulls_last()],
    }


def subset_filters() -> dict[str, Column | None]:
    return {
        "All journeys": None,
        "Complaints only": F.col("complaint_flag"),
        "Delayed journeys only": ~F.col("on_time"),
        "Disrupted journeys only": F.col("service_disruption"),
        "Low satisfaction (1-2)": F.col("customer_satisfaction") <= 2,
        "Accessibility services used": F.col("accessibility_service_used"),
    }


def search_predicate(search: str) -> Column | None:
    """Case-insensitive LIKE over id, line, region and complaint category; the
    text is a literal pattern (``%`` / ``_`` in it act as wildcards)."""
    text = search.strip().lower()
    if not text:
        return None
    pattern = f"%{text}%"
    return (F.lower("journey_id").like(pattern) | F.lower("service_line").like(pattern)
            | F.lower("region").like(pattern)
            | F.lower(F.coalesce(F.col("complaint_category"), F.lit(""))).like(pattern))


def fetch_records(analytics: DataFrame, filters: Selection, *,
                  columns: tuple[str, ...] = C.DISPLAY_COLUMNS, sort: str = "Most recent",
                  subset: str = "All journeys", search: str = "", limit: int = 500) -> DataFrame:
    """Records behind the selection (unknown sort / subset fall back; unknown
    columns are dropped)."""
    selected = [c for c in columns if c in C.DISPLAY_COLUMNS] or list(C.DISPLAY_COLUMNS)
    df = analytics.where(filters.column())
    subset_cond = subset_filters().get(subset)
    if subset_cond is not None:
        df = df.where(subset_cond)
    cond = search_predicate(search)
    if cond is not None:
        df = df.where(cond)
    order = _sort_options().get(sort, _sort_options()["Most recent"])
    return df.orderBy(*order, F.col("journey_id").asc()).limit(limit).select(*selected)


def subset_counts(analytics: DataFrame, filters: Selection) -> DataFrame:
    """Row count of every subset, one scan with conditional counts."""
    subsets = subset_filters()
    aggs = [F.count(F.lit(1) if cond is None else F.when(cond, 1)).alias(f"c{i}")
            for i, cond in enumerate(subsets.values())]
    wide = analytics.where(filters.column()).agg(*aggs)
    stack = ", ".join(f"'{name}', c{i}" for i, name in enumerate(subsets))
    return wide.select(F.expr(f"stack({len(subsets)}, {stack}) AS (subset, journeys)"))
