"""KPI operators: metric sets, period comparison, breakdowns, summaries.

Two-period comparisons are a *single scan* over previous-start..end with the
metric inputs gated by a period condition (instead of two scans, or a full
outer join of two aggregates); the result is reshaped with ``stack``.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions.metrics import METRICS, Registry, check_keys, lower_is_better, metric_columns, np_round
from ..plans.filters import Period, Selection, period_filters
from ..plans.rollup import Rollup, merged


def _where(df: DataFrame, filters: Selection | None) -> DataFrame:
    return df if filters is None else df.where(filters.column())


def check_dimension(dimension: str) -> str:
    if dimension not in C.GROUPING_COLUMNS:
        raise ValueError(f"Unsupported grouping column: {dimension}")
    return dimension


def compute_metrics(analytics: DataFrame, filters: Selection | None,
                    keys: Iterable[str] | None = None, registry: Registry = METRICS) -> DataFrame:
    """A1: one row of metrics over the filtered population (empty -> counts 0); by default all of
    ``registry`` (``definitions.read_metrics`` for metrics of the user's own)."""
    keys = check_keys(keys or registry.keys(), registry)
    return _where(analytics, filters).agg(*metric_columns(keys, registry=registry))


def percent_change(current: Column, previous: Column) -> Column:
    return F.when(previous.isNull() | current.isNull() | (previous == 0), F.lit(None)) \
        .otherwise((current - previous) / F.abs(previous) * 100.0).cast("double")


def direction(metric_key: Column, change: Column, registry: Registry = METRICS) -> Column:
    lower = lower_is_better(metric_key, registry)
    improving = F.when(lower, change < 0).otherwise(change > 0)
    return (F.when(change.isNull() | (F.abs(change) < 1e-9), "flat")
            .when(improving, "good").otherwise("bad"))


def _stack_pairs(keys: Sequence[str], cols: dict[str, tuple[str, ...]]) -> Column:
    """``stack`` one row per metric out of a wide row: (metric, <cols>...)."""
    parts = []
    for i, k in enumerate(keys):
        parts.append(f"'{k}'")
        parts.append(str(i))
        for suffixes in cols.values():
            parts.extend(f"CAST(`{k}{s}` AS DOUBLE)" for s in suffixes)
    names = ["metric", "position"] + [n for n in cols]
    return F.expr(f"stack({len(keys)}, {', '.join(parts)}) AS ({', '.join(names)})")


def _both_periods(rollup: Rollup, filters: Selection, keys: tuple[str, ...]) -> DataFrame:
    """The wide row of ``compare_periods`` from the rollup: sums of days, unions of bitmaps."""
    current, previous = filters.period, filters.period.shifted_back()
    additive = [k for k in keys if METRICS[k].parts]
    sums = rollup.slice(None, filters, Period(previous.start, current.end)).agg(
        F.lit(0).alias("row"), *(merged(k, p.holds()).alias(f"{k}{s}")
                                 for s, p in (("__c", current), ("__p", previous)) for k in additive))
    if len(additive) == len(keys):
        return sums
    people = rollup.customers(current, previous).toDF("active_customers__c", "active_customers__p")
    return sums.join(people.withColumn("row", F.lit(0)), "row")      # one row each


def compare_periods(analytics: DataFrame, filters: Selection,
                    keys: Iterable[str] | None = None, rollup: Rollup | None = None,
                    registry: Registry = METRICS) -> DataFrame:
    """A2: current vs previous equal-length period, one row per metric; from the rollup if one
    is given that answers the question."""
    keys = check_keys(keys or C.HEADLINE_KPIS, registry)
    scan, current, previous = period_filters(filters)
    if rollup and rollup.answers(filters, keys, customers=True):
        wide = _both_periods(rollup, filters, keys)
    else:
        wide = analytics.where(scan).agg(*metric_columns(keys, current, "__c", registry),
                                         *metric_columns(keys, previous, "__p", registry))
    long = wide.select(_stack_pairs(keys, {"current": ("__c",), "previous": ("__p",)}))
    change = F.col("current") - F.col("previous")
    meta = F.create_map(*[x for k in keys for x in (F.lit(k), F.lit(registry[k].label))])
    units = F.create_map(*[x for k in keys for x in (F.lit(k), F.lit(registry[k].unit))])
    return long.select(
        "metric",
        "position",
        meta[F.col("metric")].alias("label"),
        units[F.col("metric")].alias("unit"),
        "current", "previous",
        change.alias("absolute_change"),
        percent_change(F.col("current"), F.col("previous")).alias("percent_change"),
        direction(F.col("metric"), change, registry).alias("direction"),
    )


def kpi_evidence(analytics: DataFrame, filters: Selection,
                 keys: Iterable[str] | None = None) -> DataFrame:
    """A3: evidence form of A2 (values rounded to 4 dp, percent change to 2 dp)."""
    cmp = compare_periods(analytics, filters, keys)
    return cmp.select(
        "metric", "label", "unit",
        np_round("current", 4).alias("current"),
        np_round("previous", 4).alias("previous"),
        np_round("absolute_change", 4).alias("absolute_change"),
        np_round("percent_change", 2).alias("percent_change"),
        "direction")


def population_summary(analytics: DataFrame, filters: Selection | None) -> DataFrame:
    """A4: journeys, distinct customers / regions / modes / lines, date bounds.

    Only the customer count is an (unbounded) distinct aggregate; regions,
    modes and service lines are vocabulary / catalogue sized, so their
    distinct counts are ``size(collect_set)`` partial aggregates - one distinct
    aggregate means no Expand of the scanned rows."""
    return _where(analytics, filters).agg(
        F.count(F.lit(1)).alias("journeys"),
        F.count_distinct("customer_id").alias("customers"),
        F.size(F.collect_set("region")).cast("bigint").alias("regions"),
        F.size(F.collect_set("transport_mode")).cast("bigint").alias("modes"),
        F.size(F.collect_set("service_line")).cast("bigint").alias("service_lines"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def metrics_by_dimension(analytics: DataFrame, filters: Selection | None, dimension: str,
                         keys: Iterable[str] | None = None, min_journeys: int = 1,
                         limit: int | None = None, rollup: Rollup | None = None,
                         registry: Registry = METRICS) -> DataFrame:
    """A5: metric set per dimension value; HAVING n >= min; NULL group dropped
    after ordering; optional top ``limit`` (by journeys, then value)."""
    check_dimension(dimension)
    keys = check_keys(keys or C.BREAKDOWN_METRICS, registry)
    if rollup and rollup.answers(filters, keys, dimension):
        groups = rollup.slice(dimension, filters).groupBy(F.col("value").alias("dimension_value"))
        grouped = groups.agg(*(merged(k).alias(k) for k in keys), F.sum("journeys").alias("_n"))
    else:
        groups = _where(analytics, filters).groupBy(F.col(dimension).alias("dimension_value"))
        grouped = groups.agg(*metric_columns(keys, registry=registry), F.count(F.lit(1)).alias("_n"))
    grouped = grouped.where(F.col("_n") >= min_journeys).drop("_n")
    if "total_journeys" in keys:
        ordering = [F.col("total_journeys").desc(), F.col("dimension_value").asc_nulls_last()]
    else:
        ordering = [F.col("dimension_value").asc_nulls_last()]
    ordered = grouped.orderBy(*ordering)
    if limit is not None:
        # NULL is dropped after ordering, before the head, as the definition says.
        return ordered.where(F.col("dimension_value").isNotNull()).limit(limit)
    return ordered.where(F.col("dimension_value").isNotNull())


def period_over_period_by_dimension(analytics: DataFrame, filters: Selection, dimension: str,
                                    metric: str, min_journeys: int = 50) -> DataFrame:
    """One metric per dimension value, current vs previous, both sides >= min; the largest
    absolute moves first.

    One scan with period-gated aggregates replaces two grouped scans joined by a
    full outer join; with min >= 1 only values present in both survive anyway.
    """
    check_dimension(dimension)
    check_keys([metric])
    scan, current, previous = period_filters(filters)
    spec = METRICS[metric]
    grouped = (analytics.where(scan)
               .groupBy(F.col(dimension).alias("dimension_value"))
               .agg(spec.build(current).cast("double").alias("current_value"),
                    spec.build(previous).cast("double").alias("previous_value"),
                    F.count(F.when(current, 1)).alias("current_journeys"),
                    F.count(F.when(previous, 1)).alias("previous_journeys")))
    change = F.col("current_value") - F.col("previous_value")
    return (grouped
            .where(F.col("dimension_value").isNotNull()
                   & (F.col("current_journeys") >= min_journeys)
                   & (F.col("previous_journeys") >= min_journeys))
            .select("dimension_value", "current_value", "previous_value",
                    "current_journeys", "previous_journeys",
                    change.alias("absolute_change"),
                    F.when(F.col("previous_value").isNull() | (F.col("previous_value") == 0),
                           F.lit(None).cast("double"))
                    .otherwise(F.lit(100.0) * change / F.abs(F.col("previous_value")))
                    .alias("percent_change"))
            .orderBy(F.abs(F.col("absolute_change")).desc_nulls_last(), "dimension_value"))


def compare_segments(analytics: DataFrame, filters: Selection, segment_a: str, segment_b: str,
                     keys: Sequence[str] | None = None) -> DataFrame:
    """Two customer segments side by side, one row per metric + difference.

    The segment filter of the selection is ignored; both segments come from one
    scan with segment-gated aggregates.
    """
    keys = check_keys(keys or C.SEGMENT_COMPARE_METRICS)
    base = filters.any_value_of("customer_segment")
    seg = F.col("customer_segment")
    wide = (analytics.where(base.column() & seg.isin(segment_a, segment_b))
            .agg(*metric_columns(keys, seg == segment_a, "__a"),
                 *metric_columns(keys, seg == segment_b, "__b"),
                 F.count(F.when(seg == segment_a, 1)).alias("_na"),
                 F.count(F.when(seg == segment_b, 1)).alias("_nb")))
    long = wide.select(_stack_pairs(keys, {"value_a": ("__a",), "value_b": ("__b",)}),
                       "_na", "_nb")
    # A segment with no rows has no group at all: its values are NULL.
    va = F.when(F.col("_na") > 0, F.col("value_a"))
    vb = F.when(F.col("_nb") > 0, F.col("value_b"))
    labels = F.create_map(*[x for k in keys for x in (F.lit(k), F.lit(METRICS[k].label))])
    units = F.create_map(*[x for k in keys for x in (F.lit(k), F.lit(METRICS[k].unit))])
    return long.where((F.col("_na") + F.col("_nb")) > 0).select(
        "metric", "position",
        labels[F.col("metric")].alias("label"),
        units[F.col("metric")].alias("unit"),
        F.lit(segment_a).alias("segment_a"), F.lit(segment_b).alias("segment_b"),
        va.alias("value_a"), vb.alias("value_b"),
        (va - vb).alias("difference"))


def disruption_comparison(analytics: DataFrame, filters: Selection) -> DataFrame:
    """A10: disrupted vs normal journeys (complaints, satisfaction, delay)."""
    keys = ("complaint_rate", "avg_satisfaction", "avg_delay_minutes")
    return (_where(analytics, filters)
            .where(F.col("service_disruption").isNotNull())
            .groupBy("service_disruption")
            .agg(F.count(F.lit(1)).alias("journeys"), *metric_columns(keys)))


def weekday_band_delay(analytics: DataFrame, filters: Selection,
                       min_journeys: int = C.MIN_SAMPLE_FOR_COMPARISON) -> DataFrame:
    """A11 input: delay / OTP per (weekday, time band) with >= min journeys, and the
    journey-weighted mean delay across the kept groups."""
    g = (_where(analytics, filters)
         .groupBy("day_of_week", "time_band")
         .agg(F.count(F.lit(1)).alias("journeys"),
              *metric_columns(("avg_delay_minutes", "on_time_performance")))
         .where(F.col("journeys") >= min_journeys))
    everything = Window.partitionBy()   # runs on <= 7 x 4 grouped rows
    weighted = (F.sum(F.col("avg_delay_minutes") * F.col("journeys")).over(everything)
                / F.sum("journeys").over(everything))
    return g.select("*", weighted.alias("overall_delay"))


def complaint_categories(analytics: DataFrame, filters: Selection) -> DataFrame:
    """Complaints per category with share of the total (tiny grouped result)."""
    g = (_where(analytics, filters)
         .where(F.col("complaint_flag") & F.col("complaint_category").isNotNull())
         .groupBy("complaint_category").agg(F.count(F.lit(1)).alias("complaints")))
    total = F.sum("complaints").over(Window.partitionBy())
    return g.select("complaint_category", "complaints", total.alias("total_complaints"),
                    (F.col("complaints") / total * 100.0).alias("share_pct"))


def segment_share(analytics: DataFrame, filters: Selection) -> DataFrame:
    """Journeys per customer segment and share of the total."""
    by = metrics_by_dimension(analytics, filters, "customer_segment", ("total_journeys",))
    total = F.sum("total_journeys").over(Window.partitionBy())
    return by.select("dimension_value", "total_journeys",
                     (F.col("total_journeys") / total * 100.0).alias("share_pct"))
