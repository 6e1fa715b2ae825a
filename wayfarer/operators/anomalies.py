"""Rolling-baseline anomaly detection over daily metric series.

Plan: ONE grouped scan builds the daily frame (selection + ``window + 7`` days
of history, per scope); it is unpivoted to (scope, metric, period, value) and
every baseline is a window function partitioned by (scope, metric), ordered by
period, over the trailing ``window`` rows (``rowsBetween(-window, -1)`` = the
day under test excluded). Gates are one declarative filter chain. Windows run
on already-aggregated rows (scopes x metrics x days), never on journeys.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions.metrics import METRICS, Registry, check_keys, lower_is_better, metric_columns, np_round
from ..plans.filters import Selection
from ..plans.rollup import Rollup, merged
from .kpis import check_dimension

METHODS = ("rolling_z", "iqr")
DIGITS = 6   # moving-frame sums differ in the last bits between engines


def needed_metrics(metrics: Iterable[str] | None,
                   registry: Registry = METRICS) -> tuple[dict[str, float], tuple[str, ...]]:
    """(scanned metric -> least move, all metrics the scan needs)."""
    names = check_keys(metrics or C.DEFAULT_SCAN_METRICS, registry)
    scan = {m: C.DEFAULT_SCAN_METRICS.get(m, registry[m].floor) for m in names}
    return scan, tuple(dict.fromkeys([*scan, *C.COMPANION_METRICS]))


def daily_frame(analytics: DataFrame, filters: Selection, dimension: str | None,
                lookback_days: int, metrics: Sequence[str], rollup: Rollup | None = None,
                registry: Registry = METRICS) -> DataFrame:
    """One row per (day, scope) with every needed metric, from
    ``start - lookback_days`` to the end of the selection."""
    if dimension is not None:
        check_dimension(dimension)
    extended = filters.during(filters.period.extended_back(lookback_days))
    if rollup and rollup.answers(filters, metrics, dimension):
        scope = F.lit("Network") if dimension is None else F.col("value")
        return (rollup.slice(dimension, extended)
                .groupBy(F.col("date").alias("period"), scope.alias("dimension_value"))
                .agg(*(merged(m).alias(m) for m in metrics))
                .where(F.col("dimension_value").isNotNull()))
    scope = F.lit("Network") if dimension is None else F.col(dimension)
    return (analytics.where(extended.column())
            .groupBy(F.col("date").alias("period"), scope.alias("dimension_value"))
            .agg(*metric_columns(metrics, registry=registry))
            .where(F.col("dimension_value").isNotNull()))


def long_series(daily: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Unpivot to (dimension_value, period, journeys, metric, value)."""
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    return daily.select("dimension_value", "period",
                        F.col("total_journeys").alias("journeys"),
                        F.expr(f"stack({len(metrics)}, {stack}) AS (metric, value)"))


def baselines(long: DataFrame, method: str = "rolling_z", window: int = C.ANOMALY_ROLLING_WINDOW,
              threshold: float = C.ANOMALY_Z_THRESHOLD) -> DataFrame:
    """Trailing baseline, bounds and z for every (scope, metric, day).

    rolling_z: mean +/- threshold x population sigma; iqr: Q1 - 1.5 IQR ..
    Q3 + 1.5 IQR around the median, spread IQR / 1.349. A zero spread gives a
    NULL z. Also the trailing mean of every metric (companion baselines).
    """
    if method not in METHODS:
        raise ValueError(f"Unsupported detection method: {method}")
    series = Window.partitionBy("dimension_value", "metric").orderBy("period")
    trailing = series.rowsBetween(-window, -1)
    v = F.col("value")
    enough = F.count(v).over(trailing) >= C.ANOMALY_MIN_HISTORY
    mean = F.when(enough, F.avg(v).over(trailing))
    if method == "iqr":
        qs = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).over(trailing)
        q1, med, q3 = (F.when(enough, qs[i]) for i in range(3))
        iqr = q3 - q1
        centre, lower, upper = med, q1 - 1.5 * iqr, q3 + 1.5 * iqr
        spread = F.when(iqr != 0, iqr / 1.349)
    else:
        sd = F.when(enough, F.stddev_pop(v).over(trailing))
        spread = F.when(sd != 0, sd)
        centre = mean
        lower, upper = centre - threshold * spread, centre + threshold * spread
    scope_days = F.count(F.lit(1)).over(Window.partitionBy("dimension_value", "metric"))
    return long.select(
        "dimension_value", "period", "metric", "value", "journeys",
        scope_days.alias("scope_days"),
        centre.alias("expected"), lower.alias("lower_bound"), upper.alias("upper_bound"),
        ((v - centre) / spread).alias("z_score"),
        mean.alias("trailing_mean"))


def _scope_label(dimension: str | None) -> Column:
    if dimension is None:
        return F.lit("Network")
    return F.concat(F.lit(dimension.replace("_", " ").title() + ": "), F.col("dimension_value"))


def _rounded(cols: Sequence[str]) -> list[Column]:
    return [np_round(c, DIGITS).alias(c) for c in cols]


def scan(analytics: DataFrame, filters: Selection, dimension: str | None = None,
         metrics: Iterable[str] | None = None, method: str = "rolling_z",
         window: int = C.ANOMALY_ROLLING_WINDOW,
         threshold: float = C.ANOMALY_Z_THRESHOLD,
         rollup: Rollup | None = None,
         registry: Registry = METRICS) -> tuple[DataFrame, dict[str, float]]:
    """Daily frame -> long series -> baselines (all needed metrics)."""
    floors, needed = needed_metrics(metrics, registry)
    daily = daily_frame(analytics, filters, dimension, window + 7, needed, rollup, registry)
    return baselines(long_series(daily, needed), method, window, threshold), floors


def detect(analytics: DataFrame, filters: Selection, dimension: str | None = None,
           metrics: Iterable[str] | None = None, method: str = "rolling_z",
           window: int = C.ANOMALY_ROLLING_WINDOW, threshold: float = C.ANOMALY_Z_THRESHOLD,
           min_journeys_per_day: int = 25, adverse_only: bool = False,
           limit: int | None = None, rollup: Rollup | None = None,
           registry: Registry = METRICS) -> DataFrame:
    """N3 + N4 + N6 + N9: flagged days, most extreme first."""
    base, floors = scan(analytics, filters, dimension, metrics, method, window, threshold, rollup, registry)
    return gate(base, floors, filters, dimension, method, threshold, min_journeys_per_day,
                adverse_only, limit, registry)


def gate(base: DataFrame, floors: dict[str, float], filters: Selection,
         dimension: str | None, method: str, threshold: float,
         min_journeys_per_day: int = 25, adverse_only: bool = False,
         limit: int | None = None, registry: Registry = METRICS) -> DataFrame:
    floor = F.create_map(*[x for k, f in floors.items() for x in (F.lit(k), F.lit(float(f)))])
    v, e, z = F.col("value"), F.col("expected"), F.col("z_score")
    flagged = ((v < F.col("lower_bound")) | (v > F.col("upper_bound"))) if method == "iqr" \
        else (F.abs(z) >= threshold)
    det = (base.where(F.col("metric").isin(*floors))
           .where(F.col("scope_days") >= C.ANOMALY_MIN_HISTORY + 1)
           .where(F.col("period").between(F.lit(filters.period.start), F.lit(filters.period.end)))
           .where(v.isNotNull() & e.isNotNull() & z.isNotNull())
           .where(F.col("journeys") >= min_journeys_per_day)
           .where(F.abs(v - e) >= floor[F.col("metric")])
           .where(flagged))
    adverse = (v > e) == lower_is_better(F.col("metric"), registry)
    if adverse_only:
        det = det.where(adverse)
    labels = F.create_map(*[x for k in floors for x in (F.lit(k), F.lit(registry[k].label))])
    scope = _scope_label(dimension)
    magnitude = F.when(e != 0, (v - e) / F.abs(e) * 100.0)
    absz = F.abs(z)
    out = det.select(
        "metric", labels[F.col("metric")].alias("metric_label"),
        F.lit(dimension or "network").alias("dimension"), "dimension_value",
        scope.alias("scope"), "period",
        *_rounded(["value", "expected", "lower_bound", "upper_bound", "z_score"]),
        "journeys",
        F.lit(method).alias("method"),
        F.when(v > e, "above").otherwise("below").alias("direction"),
        np_round(magnitude, DIGITS).alias("magnitude_pct"),
        F.when(absz >= 4.0, "High").when(absz >= 3.0, "Medium").otherwise("Low").alias("severity"),
        adverse.alias("adverse"),
        F.format_string(
            "%s for %s %s %.2f on %s, compared with a recent baseline of %.2f.",
            labels[F.col("metric")],
            F.lit("the network") if dimension is None else scope,
            F.when(v > e, "reached").otherwise("fell to"),
            np_round(v, 2), F.date_format("period", "yyyy-MM-dd"), np_round(e, 2),
        ).alias("statement"),
        *(["context"] if "context" in base.columns else []),
    ).withColumnRenamed("value", "actual")
    ordered = out.orderBy(F.abs(F.col("z_score")).desc(), F.col("period").desc(),
                          F.col("metric"), F.col("scope"))
    return ordered.limit(limit) if limit else ordered


def baseline_table(analytics: DataFrame, filters: Selection, dimension: str | None,
                   method: str, metrics: Iterable[str] | None = None) -> DataFrame:
    """N2 as a query: baselines of the scanned metrics on the selected days."""
    base, floors = scan(analytics, filters, dimension, metrics, method)
    return (base.where(F.col("metric").isin(*floors))
            .where(F.col("period").between(F.lit(filters.period.start), F.lit(filters.period.end)))
            .select("dimension_value", "metric", "period", "journeys", "scope_days",
                    *_rounded(["value", "expected", "lower_bound", "upper_bound", "z_score"])))


def companions(analytics: DataFrame, filters: Selection, dimension: str | None = None,
               method: str = "rolling_z", adverse_only: bool = False) -> DataFrame:
    """For every detection, the same-day value and trailing-mean baseline of
    each companion metric; ``noted`` marks the context metrics that moved >= 25 %."""
    base, floors = scan(analytics, filters, dimension, None, method)
    det = gate(base, floors, filters, dimension, method, C.ANOMALY_Z_THRESHOLD,
               adverse_only=adverse_only).select(
        F.col("metric").alias("anomaly_metric"), "dimension_value", "period")
    comp = base.where(F.col("metric").isin(*C.COMPANION_METRICS)).select(
        "dimension_value", "period", F.col("metric").alias("companion"),
        F.col("value").alias("actual"), F.col("trailing_mean").alias("baseline"))
    joined = det.join(comp, ["dimension_value", "period"])
    change = F.when(F.col("baseline").isNotNull() & (F.col("baseline") != 0)
                    & F.col("actual").isNotNull(),
                    (F.col("actual") - F.col("baseline")) / F.abs(F.col("baseline")) * 100.0)
    noted = (F.col("companion").isin(*C.CONTEXT_METRICS)
             & (F.col("companion") != F.col("anomaly_metric"))
             & change.isNotNull() & (F.abs(change) >= 25))
    return joined.select("anomaly_metric", "dimension_value", "period", "companion",
                         *_rounded(["actual", "baseline"]),
                         np_round(change, DIGITS).alias("change_pct"),
                         F.coalesce(noted, F.lit(False)).alias("noted"))


def _with_context(base: DataFrame, registry: Registry) -> DataFrame:
    """Adds ``context``, a sentence on the context metrics of the same scope and day whose value is
    at least 25 % off its trailing mean. A window over the metrics of a day, no second scan."""
    day = Window.partitionBy("dimension_value", "period")

    def shown(value: Column, unit: str) -> Column:
        if unit == "count":
            return F.format_string("%,d", np_round(value, 0).cast("bigint"))
        return F.format_string("%.1f%%", np_round(value, 1))

    notes = []
    for name in C.CONTEXT_METRICS:
        spec = registry[name]
        same = F.max(F.when(F.col("metric") == name, F.struct(
            F.lit(1).alias("has"), F.col("value").alias("a"), F.col("trailing_mean").alias("b")))).over(day)
        change = F.when(same["b"] != 0, (same["a"] - same["b"]) / F.abs(same["b"]) * 100.0)
        notes.append(F.when((F.col("metric") != name) & (F.abs(change) >= 25), F.concat(
            F.lit(f"{spec.label} was "), shown(same["a"], spec.unit), F.lit(" against a baseline of "),
            shown(same["b"], spec.unit), F.format_string(" (%+.0f%%)", np_round(change, 0)))))
    noted = F.concat_ws("; ", *notes)
    labels = F.create_map(*[x for k, s in registry.items() for x in (F.lit(k), F.lit(s.label.lower()))])
    return base.withColumn("context", F.when(noted != "", F.concat(F.lit("On the same day, "), noted, F.lit(".")))
                           .otherwise(F.concat(F.lit("No companion metric moved materially; the deviation is specific to "),
                                               labels[F.col("metric")], F.lit("."))))


def evidence(analytics: DataFrame, filters: Selection, dimension: str | None = None,
             metrics: Iterable[str] | None = None, method: str = "rolling_z", adverse_only: bool = False,
             limit: int | None = None, rollup: Rollup | None = None, registry: Registry = METRICS) -> DataFrame:
    """N5 + N9: the record of every detection, most extreme first: what was seen, the expected
    range, severity, statement and the context of the same day."""
    base, floors = scan(analytics, filters, dimension, metrics, method, rollup=rollup, registry=registry)
    det = gate(_with_context(base, registry), floors, filters, dimension, method, C.ANOMALY_Z_THRESHOLD,
               adverse_only=adverse_only, limit=limit, registry=registry)
    return det.select(
        "metric", "metric_label", "scope", F.col("period").alias("date"),
        np_round("actual", 3).alias("actual"), np_round("expected", 3).alias("expected_baseline"),
        np_round("lower_bound", 3).alias("expected_from"), np_round("upper_bound", 3).alias("expected_to"),
        np_round("z_score", 2).alias("z_score"), "severity", "direction", "adverse", "journeys", "method",
        "statement", "context")


def summarise(detections: DataFrame, top_n: int = 5) -> DataFrame:
    """Totals, adverse count, high-severity count, adverse scopes, date range,
    and the ``top_n`` most severe adverse statements (a top-k, then joined)."""
    from ..sources.feeds import combine_rows
    top = (detections.where(F.col("adverse"))
           .orderBy(F.abs(F.col("z_score")).desc(), F.col("period").desc(), F.col("metric"),
                    F.col("scope"))
           .limit(top_n)
           .select(F.struct(-F.abs(F.col("z_score")).alias("a"),
                            (-F.unix_date(F.col("period"))).alias("p"),
                            "metric", "scope", "statement").alias("s")))
    # <= top_n rows: collected and re-sorted in the same order as the top-k
    most_severe = top.agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("s")), lambda x: x["statement"]), " | ")
        .alias("most_severe"))
    counts = detections.agg(
        F.count(F.lit(1)).alias("total_detected"),
        F.count(F.when(F.col("adverse"), 1)).alias("adverse_detected"),
        F.count(F.when(F.col("severity") == "High", 1)).alias("high_severity"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("adverse"), F.col("scope")))),
                     ", ").alias("scopes_affected"),
        F.min("period").alias("first_period"),
        F.max("period").alias("last_period"))
    return combine_rows(counts, most_severe)


def series(analytics: DataFrame, filters: Selection, metric: str,
           dimension: str | None = None, dimension_value: str | None = None,
           method: str = "rolling_z", window: int = C.ANOMALY_ROLLING_WINDOW,
           threshold: float = C.ANOMALY_Z_THRESHOLD) -> DataFrame:
    """One scope's daily series with band and flag (no volume / floor /
    history gates) on the selected days. With a dimension, a value is required."""
    check_keys([metric])
    if dimension is not None and dimension_value is None:
        raise ValueError("dimension_value is required when a dimension is given")
    needed = tuple(dict.fromkeys([metric, *C.COMPANION_METRICS]))
    daily = daily_frame(analytics, filters, dimension, window + 7, needed)
    if dimension is not None:
        daily = daily.where(F.col("dimension_value") == dimension_value)
    base = baselines(long_series(daily, (metric,)), method, window, threshold)
    v = F.col("value")
    flagged = ((v < F.col("lower_bound")) | (v > F.col("upper_bound"))) if method == "iqr" \
        else (F.abs(F.col("z_score")) >= threshold)
    return (base.where(F.col("period").between(F.lit(filters.period.start),
                                               F.lit(filters.period.end)))
            .select("period", *_rounded(["value", "expected"]),
                    np_round("lower_bound", DIGITS).alias("lower"),
                    np_round("upper_bound", DIGITS).alias("upper"),
                    F.coalesce(flagged, F.lit(False)).alias("flagged"))
            .orderBy("period"))


def window_recall(detections: DataFrame, windows: DataFrame) -> DataFrame:
    """Detections held against known windows (same scope and metric, period between start and
    end): days found, recall, precision. Windows that repeat count once.

    Detections are read once, as one row per scope and metric with its days (as many as the
    range has at most); a window meets that row by an equijoin and counts the days inside. There
    may be any number of windows: whether a side is broadcast is left to the sizes Spark knows.
    """
    days = (detections.where(F.col("dimension_value").isNotNull() & F.col("metric").isNotNull())
            .groupBy("dimension_value", "metric").agg(F.collect_set("period").alias("days")))
    known = windows.select("dimension_value", "metric", "start_date", "end_date").distinct()
    inside = F.size(F.filter("days", lambda d: d.between(F.col("start_date"), F.col("end_date"))))
    res = (known.join(days, ["dimension_value", "metric"], "left")
           .withColumn("days_detected", F.coalesce(F.when(F.col("days").isNotNull(), inside), F.lit(0)).cast("long"))
           .withColumn("days_outside", F.coalesce(F.when(F.col("days").isNotNull(), F.size("days")), F.lit(0)).cast("long")
                       - F.col("days_detected")))
    days = F.datediff("end_date", "start_date") + 1
    found = F.col("days_detected")
    out_n = F.col("days_outside")
    return res.select(
        "dimension_value", "metric", "start_date", "end_date",
        days.cast("bigint").alias("window_days"), found.alias("days_detected"),
        out_n.alias("days_outside"),
        (found / days).alias("recall"),
        F.when(found + out_n > 0, found / (found + out_n)).alias("precision"))
