"""Metric registry: each KPI is one aggregate ``Column`` builder.

``MetricSpec.build(cond)`` wraps every input in ``when(cond, x)`` so one
definition serves a plain ``agg``, a two-period single-scan aggregate and any
``groupBy``. Rates are null-aware: a NULL flag shrinks the denominator.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def gated(cond: Column | None, value: Column) -> Column:
    return value if cond is None else F.when(cond, value)


def rate(flag: str | Column, cond: Column | None = None) -> Column:
    """100 * count(flag is true) / count(flag is not null), NULL when no flags."""
    col = F.col(flag) if isinstance(flag, str) else flag
    hits = F.count(gated(cond, F.when(col, F.lit(1))))
    known = F.count(gated(cond, col))
    return F.lit(100.0) * hits / F.nullif(known, F.lit(0))


def share(flag: str | Column, cond: Column | None = None) -> Column:
    """100 * count(flag is true) / count(*) (NULL flags count as 'no')."""
    col = F.col(flag) if isinstance(flag, str) else flag
    hits = F.count(gated(cond, F.when(col, F.lit(1))))
    return F.lit(100.0) * hits / F.nullif(F.count(gated(cond, F.lit(1))), F.lit(0))


@dataclass(frozen=True)
class MetricSpec:
    key: str
    label: str
    unit: str
    builder: Callable[[Column | None], Column]
    compare_as_points: bool = False
    lower: bool | None = None      # None: as the fixed list says
    floor: float = 0.0             # least move that an anomaly scan reports

    @property
    def lower_is_better(self) -> bool:
        return self.key in C.LOWER_IS_BETTER if self.lower is None else self.lower

    @property
    def parts(self) -> tuple[str, str] | None:
        """(count | avg | rate, column) of an additive metric, else None."""
        return getattr(self.builder, "parts", None)

    def build(self, cond: Column | None = None) -> Column:
        return self.builder(cond)


def _additive(kind: str, column: str, build: Callable) -> Callable:
    """A builder whose metric is a quotient of sums: kept per day, the sums merge over any period."""
    build.parts = (kind, column)
    return build


_count = _additive("count", "", lambda cond: F.count(gated(cond, F.lit(1))))


def _distinct(column):
    return lambda cond: F.count_distinct(gated(cond, F.col(column)))


def _avg(column):
    return _additive("avg", column, lambda cond: F.avg(gated(cond, F.col(column))))


def _rate(column):
    return _additive("rate", column, lambda cond: rate(column, cond))


def _p90(cond):
    # Within one aggregate with the other metrics: a count per different delay of 0 to 180 minutes.
    # ``selection.exact_quantiles`` is the form for columns with many different values.
    return F.percentile(gated(cond, F.col("delay_minutes")), F.lit(0.9))


METRICS: dict[str, MetricSpec] = {m.key: m for m in (
    MetricSpec("total_journeys", "Total Journeys", "count", _count),
    MetricSpec("active_customers", "Active Customers", "count", _distinct("customer_id")),
    MetricSpec("avg_satisfaction", "Average Satisfaction", "score", _avg("customer_satisfaction")),
    MetricSpec("on_time_performance", "On-Time Performance", "percent", _rate("on_time"), True),
    MetricSpec("avg_delay_minutes", "Average Delay", "minutes", _avg("delay_minutes")),
    MetricSpec("p90_delay_minutes", "90th Percentile Delay", "minutes", _p90),
    MetricSpec("complaint_rate", "Complaint Rate", "percent", _rate("complaint_flag"), True),
    MetricSpec("disruption_rate", "Disruption Rate", "percent", _rate("service_disruption"), True),
    MetricSpec("avg_resolution_hours", "Avg Complaint Resolution", "hours",
               _avg("resolution_time_hours")),
    MetricSpec("repeat_rate", "Repeat Customer Share", "percent", _rate("repeat_customer"), True),
    MetricSpec("digital_rate", "Digital Interaction Rate", "percent",
               _rate("digital_interaction"), True),
    MetricSpec("accessibility_rate", "Accessibility Service Use", "percent",
               _rate("accessibility_service_used"), True),
)}


Registry = Mapping[str, MetricSpec]


def check_keys(keys: Iterable[str], registry: Registry = METRICS) -> tuple[str, ...]:
    keys = tuple(keys)
    unknown = [k for k in keys if k not in registry]
    if unknown:
        raise ValueError(f"Unknown metric(s): {unknown}")
    return keys


def metric_columns(keys: Iterable[str], cond: Column | None = None,
                   suffix: str = "", registry: Registry = METRICS) -> list[Column]:
    return [registry[k].build(cond).alias(f"{k}{suffix}") for k in check_keys(keys, registry)]


def lower_is_better(metric: Column, registry: Registry = METRICS) -> Column:
    return metric.isin(*sorted(k for k, spec in registry.items() if spec.lower_is_better))


def np_round(col: Column | str, digits: int) -> Column:
    """Round half-to-even after scaling in double arithmetic (numpy/pandas
    ``round`` semantics); the same spelling is used by the SQL oracle."""
    col = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.bround(col * F.lit(scale), 0) / F.lit(scale)
