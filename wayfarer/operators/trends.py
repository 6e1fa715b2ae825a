"""Time series and profiles: grains, gap-free calendar, rolling means, top-N
series, hour / weekday profiles and the day x hour matrix.

All grouping happens on executors; the only un-partitioned windows (rolling
mean, calendar) run over already-aggregated rows - one per day - whose count is
bounded by the length of the date range, not by the data volume.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions.metrics import METRICS, check_keys, metric_columns, np_round
from ..plans.filters import Selection
from ..plans.rollup import Rollup, merged
from .kpis import _where, check_dimension


def check_grain(grain: str) -> str:
    if grain not in C.GRAIN_COLUMNS:
        raise ValueError(f"Unsupported grain: {grain}")
    return C.GRAIN_COLUMNS[grain]


def day_name(dow) -> F.Column:
    return F.element_at(F.array(*[F.lit(n) for n in C.DAY_NAMES]), (dow + 1).cast("int"))


def monday_first(dow) -> F.Column:
    return F.pmod(dow + 6, F.lit(7))


def time_series(analytics: DataFrame, filters: Selection | None, grain: str = "day",
                keys: Iterable[str] | None = None, rollup: Rollup | None = None) -> DataFrame:
    """Metric set per day / week / month."""
    column = check_grain(grain)
    keys = check_keys(keys or C.BREAKDOWN_METRICS)
    if rollup and rollup.answers(filters, keys):
        start = F.col("date") if grain == "day" else F.trunc("date", grain)
        return (rollup.slice(None, filters).groupBy(start.alias("period"))
                .agg(*(merged(k).alias(k) for k in keys)).orderBy("period"))
    return (_where(analytics, filters)
            .groupBy(F.col(column).cast("date").alias("period"))
            .agg(*metric_columns(keys))
            .orderBy("period"))


def daily_series(analytics: DataFrame, filters: Selection | None, dimensions: Iterable[str],
                 keys: Iterable[str] | None = None) -> DataFrame:
    """T1 for every combination of the dimensions' values: period, dimensions, metrics."""
    dims = [check_dimension(d) for d in dimensions]
    keys = check_keys(keys or C.BREAKDOWN_METRICS)
    return (_where(analytics, filters).groupBy(F.col("date").alias("period"), *dims)
            .agg(*metric_columns(keys)))


def fill_calendar(series: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Re-index a daily series onto every day between its first and last
    period, each series of the columns ``by`` on its own; missing days carry NULL
    metrics (counts too), rows without a period go. Every row brings the days up to the
    next one along, so the series is computed once. A window holds the days of one series."""
    by = list(by)
    after = F.lead("period").over(Window.partitionBy(*by).orderBy("period"))
    last = F.coalesce(F.date_sub(after, 1), F.col("period"))
    own = F.col("_day") == F.col("period")
    metrics = [c for c in series.columns if c != "period" and c not in by]
    return (series.where(F.col("period").isNotNull())
            .select("*", last.alias("_last"))
            .select("*", F.explode(F.sequence("period", "_last", F.expr("INTERVAL 1 DAY"))).alias("_day"))
            .select(F.col("_day").alias("period"), *by, *[F.when(own, F.col(c)).alias(c) for c in metrics])
            .orderBy("period", *by))


def add_rolling(series: DataFrame, column: str, window: int = 7,
                suffix: str = "_rolling", digits: int = 6, by: Iterable[str] = ()) -> DataFrame:
    """Trailing mean over ``window`` rows, per series of the columns ``by``, NULL until
    max(2, window // 3) non-null values are in the frame. Rounded to ``digits`` (moving-frame
    sums differ in the last bits between engines)."""
    frame = Window.partitionBy(*by).orderBy("period").rowsBetween(-(window - 1), 0)
    min_periods = max(2, window // 3)
    value = F.when(F.count(column).over(frame) >= min_periods, F.avg(column).over(frame))
    return series.select("*", np_round(value, digits).alias(f"{column}{suffix}"))


def series_by_dimension(analytics: DataFrame, filters: Selection | None, dimension: str,
                        metric: str, grain: str = "week", top_n: int = 6) -> DataFrame:
    """T4: one series per value of the ``top_n`` busiest dimension values.

    The top-N side is a ``limit(top_n)`` result - a proven size bound - so it is
    broadcast; the inner join both limits the series and drops NULL keys.
    """
    check_dimension(dimension)
    check_keys([metric])
    column = check_grain(grain)
    population = _where(analytics, filters)
    ranked = (population.groupBy(F.col(dimension).alias("dimension_value"))
              .agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), F.col("dimension_value").asc_nulls_last())
              .limit(top_n).select("dimension_value"))
    joined = population.join(F.broadcast(ranked),
                             population[dimension] == ranked["dimension_value"])
    return (joined.groupBy(F.col(column).cast("date").alias("period"), "dimension_value")
            .agg(METRICS[metric].build().alias("value"), F.count(F.lit(1)).alias("journeys"))
            .orderBy("period", "dimension_value"))


def hourly_profile(analytics: DataFrame, filters: Selection | None,
                   keys: Iterable[str] | None = None) -> DataFrame:
    """T5: metrics by hour of day, split weekday / weekend."""
    keys = check_keys(keys or C.HOURLY_METRICS)
    day_type = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return (_where(analytics, filters)
            .groupBy(F.col("journey_hour").alias("hour"), day_type.alias("day_type"))
            .agg(*metric_columns(keys)).orderBy("hour", "day_type"))


def weekday_profile(analytics: DataFrame, filters: Selection | None,
                    keys: Iterable[str] | None = None) -> DataFrame:
    """Metrics by day of week, named, Monday first."""
    keys = check_keys(keys or C.WEEKDAY_METRICS)
    g = _where(analytics, filters).groupBy("day_of_week").agg(*metric_columns(keys))
    return (g.select("*", day_name(F.col("day_of_week")).alias("day_name"),
                     monday_first(F.col("day_of_week")).alias("sort_order"))
            .orderBy("sort_order"))


def heatmap_cells(analytics: DataFrame, filters: Selection | None,
                  metric: str = "avg_delay_minutes", min_journeys: int = 5) -> DataFrame:
    """T7 (long form): one metric per (weekday, hour) cell with >= 5 journeys."""
    check_keys([metric])
    g = (_where(analytics, filters)
         .groupBy("day_of_week", F.col("journey_hour").alias("hour"))
         .agg(METRICS[metric].build().alias("value"), F.count(F.lit(1)).alias("journeys"))
         .where(F.col("journeys") >= min_journeys))
    return g.select("*", day_name(F.col("day_of_week")).alias("day_name"))


def heatmap_matrix(analytics: DataFrame, filters: Selection | None,
                   metric: str = "avg_delay_minutes") -> DataFrame:
    """The cells pivoted to one row per weekday (Monday first), one column per
    hour (``h00`` .. ``h23``; the 24 pivot values are fixed, so no extra pass)."""
    cells = heatmap_cells(analytics, filters, metric)
    wide = (cells.groupBy("day_of_week", "day_name")
            .pivot("hour", list(range(24))).agg(F.first("value")))
    return wide.select(
        "day_name", monday_first(F.col("day_of_week")).alias("sort_order"),
        *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)]).orderBy("sort_order")
