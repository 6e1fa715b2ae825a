"""Data quality on the raw enriched rows: rule checks, completeness, score,
freshness, value outliers.

Every count comes from ONE aggregate pass (``count(when(rule))`` per rule,
``count(col)`` per profiled field, one ``count(DISTINCT journey_id)``); the
result is a single wide row that is reshaped with ``stack``.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.definitions import Rule
from ..functions.metrics import np_round
from ..functions.selection import exact_quantiles
from ..plans.filters import Selection


def check_definitions(rules: Sequence[Rule] = ()) -> list[tuple[str, str, str, Column | None]]:
    """(key, label, category, failing-row predicate); duplicates need a distinct count. ``rules``
    (``definitions.read_rules``) follow the built-in checks."""
    sat = F.col("customer_satisfaction")
    dur = F.col("journey_duration_minutes")
    delay = F.col("delay_minutes")
    mode = F.col("transport_mode")
    return [
        ("null_customer_id", "Null customer ID", "Completeness", F.col("customer_id").isNull()),
        ("missing_region", "Missing region", "Completeness",
         F.col("region").isNull() | (F.trim(F.col("region")) == "")),
        ("missing_satisfaction", "Missing satisfaction score", "Completeness", sat.isNull()),
        ("invalid_satisfaction", "Satisfaction outside 1-5", "Validity",
         sat.isNotNull() & ((sat < C.SATISFACTION_MIN) | (sat > C.SATISFACTION_MAX))),
        ("negative_duration", "Non-positive journey duration", "Validity",
         dur.isNotNull() & (dur <= 0)),
        ("implausible_duration", "Implausible journey duration", "Validity",
         dur > C.MAX_PLAUSIBLE_DURATION_MINUTES),
        ("invalid_delay", "Impossible delay value", "Validity",
         delay.isNull() | (delay < 0) | (delay > C.MAX_PLAUSIBLE_DELAY_MINUTES)),
        ("invalid_transport_mode", "Unrecognised transport mode", "Validity",
         mode.isNull() | ~mode.isin(*C.TRANSPORT_MODES)),
        ("duplicate_journey_id", "Duplicate journey ID", "Uniqueness", None),
        *((r.key, r.label, r.category, r.fails) for r in rules),
    ]


def _population(raw: DataFrame, filters: Selection | None) -> DataFrame:
    return raw if filters is None else raw.where(filters.column())


def profile(raw: DataFrame, filters: Selection | None, rules: Sequence[Rule] = ()) -> DataFrame:
    """One wide row: total, latest date, failing rows per check, present values
    per profiled field."""
    aggs = [F.count(F.lit(1)).alias("total_rows"), F.max("date").alias("latest_date"),
            (F.count(F.lit(1)) - F.count_distinct("journey_id")).alias("duplicate_journey_id")]
    aggs += [F.count(F.when(pred, 1)).alias(key)
             for key, _, _, pred in check_definitions(rules) if pred is not None]
    aggs += [F.count(c).alias(f"present_{c}") for c in C.PROFILED_FIELDS]
    return _population(raw, filters).agg(*aggs)


def checks(raw: DataFrame, filters: Selection | None, rules: Sequence[Rule] = ()) -> DataFrame:
    """Q1-Q3: one row per rule - failing rows, failure rate %, passed, severity."""
    defs = check_definitions(rules)
    cells = [x for i, (k, label, cat, _) in enumerate(defs)
             for x in (F.lit(k), F.lit(label), F.lit(cat), F.lit(i), F.col(k).cast("bigint"))]
    long = profile(raw, filters, rules).select(
        "total_rows", F.stack(F.lit(len(defs)), *cells)
        .alias("check_key", "label", "category", "position", "failed_rows"))
    rate = F.when(F.col("total_rows") == 0, F.lit(0.0)) \
        .otherwise(F.col("failed_rows") / F.col("total_rows") * 100.0)
    return long.select(
        "check_key", "label", "category", "position", "failed_rows", "total_rows",
        rate.alias("failure_rate"),
        (F.col("failed_rows") == 0).alias("passed"),
        F.when(rate == 0, "Pass").when(rate < 0.5, "Low").when(rate < 2.0, "Medium")
        .otherwise("High").alias("severity"))


def field_completeness(raw: DataFrame, filters: Selection | None) -> DataFrame:
    """Q4: present / missing / completeness % per profiled field."""
    stack = ", ".join(f"'{c}', {i}, present_{c}, {str(c in C.CONDITIONAL_FIELDS).lower()}"
                      for i, c in enumerate(C.PROFILED_FIELDS))
    long = profile(raw, filters).select(
        "total_rows",
        F.expr(f"stack({len(C.PROFILED_FIELDS)}, {stack}) "
               "AS (field, position, present, conditional)"))
    return long.select(
        "field", "position", "present",
        (F.col("total_rows") - F.col("present")).alias("missing"),
        F.when(F.col("total_rows") == 0, F.lit(100.0))
        .otherwise(F.col("present") / F.col("total_rows") * 100.0).alias("completeness_pct"),
        "conditional")


def _rate(key: str) -> Column:
    return F.when(F.col("total_rows") == 0, F.lit(0.0)) \
        .otherwise(F.col(key) / F.col("total_rows") * 100.0)


def _sum(cols: list[Column]) -> Column:
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total


def score_columns(rules: Sequence[Rule] = ()) -> list[Column]:
    """Q5 over the wide profile row: family scores (100 - summed failure rates,
    floored at 0), weighted score (1 dp), rating, mean unconditional completeness."""
    fams = {}
    for cat in C.QUALITY_CATEGORY_WEIGHTS:
        members = [_rate(k) for k, _, c, _ in check_definitions(rules) if c == cat]
        fams[cat] = F.greatest(F.lit(0.0), F.lit(100.0) - _sum(members)) if members \
            else F.lit(100.0)
    weighted = _sum([fams[cat] * w for cat, w in C.QUALITY_CATEGORY_WEIGHTS.items()])
    score = np_round(weighted, 1)
    fields = [c for c in C.PROFILED_FIELDS if c not in C.CONDITIONAL_FIELDS]
    completeness = F.when(F.col("total_rows") == 0, F.lit(100.0)).otherwise(
        _sum([F.col(f"present_{c}") / F.col("total_rows") * 100.0 for c in fields])
        / float(len(fields)))
    return [
        fams["Completeness"].alias("completeness_score"),
        fams["Validity"].alias("validity_score"),
        fams["Uniqueness"].alias("uniqueness_score"),
        score.alias("quality_score"),
        F.when(score >= 97, "Good").when(score >= 92, "Acceptable")
        .otherwise("Needs attention").alias("rating"),
        completeness.alias("completeness_pct"),
    ]


def score(raw: DataFrame, filters: Selection | None, rules: Sequence[Rule] = ()) -> DataFrame:
    return profile(raw, filters, rules).select(*score_columns(rules))


def summary(raw: DataFrame, analytics: DataFrame, filters: Selection | None,
            as_of: dt.date = C.AS_OF, rules: Sequence[Rule] = ()) -> DataFrame:
    """Q6 (+ Q5): raw / analysable / excluded rows, latest date, freshness, score."""
    prof = profile(raw, filters, rules)
    usable = (analytics if filters is None else analytics.where(filters.column())) \
        .agg(F.count(F.lit(1)).alias("analysable_rows"))
    # analysable_rows is a single value: attach it as a scalar subquery.
    analysable = usable.scalar()
    failing = _sum([F.when(F.col(k) > 0, 1).otherwise(0) for k, _, _, _ in check_definitions(rules)])
    return prof.select(
        "total_rows",
        analysable.alias("analysable_rows"),
        F.greatest(F.lit(0), F.col("total_rows") - analysable).alias("excluded_rows"),
        "latest_date",
        F.datediff(F.lit(as_of), F.col("latest_date")).cast("bigint").alias("freshness_days"),
        failing.alias("failing_checks"),
        *score_columns(rules))


def value_outliers(raw: DataFrame, filters: Selection | None) -> DataFrame:
    """Q7: values beyond 3 x IQR (delay upper side only; duration both sides).

    The quartiles are found by selection, one row used as an uncorrelated scalar
    subquery (inlined as a value), not a cross join.
    """
    pop = _population(raw, filters)
    bounds = exact_quantiles(pop, {"d1": ("delay_minutes", 0.25), "d3": ("delay_minutes", 0.75),
                                   "u1": ("journey_duration_minutes", 0.25),
                                   "u3": ("journey_duration_minutes", 0.75)})
    q = bounds.select(F.struct("d1", "d3", "u1", "u3")).scalar()
    d_iqr = q["d3"] - q["d1"]
    u_iqr = q["u3"] - q["u1"]
    dur = F.col("journey_duration_minutes")
    return pop.agg(
        F.count(F.when(F.col("delay_minutes") > q["d3"] + 3 * d_iqr, 1)).alias("delay_outliers"),
        F.count(F.when((dur > q["u3"] + 3 * u_iqr) | (dur < q["u1"] - 3 * u_iqr), 1))
        .alias("duration_outliers"))


def worst_check(raw: DataFrame, filters: Selection | None, rules: Sequence[Rule] = ()) -> DataFrame:
    """Q8: failing checks count and the worst one (highest rate; first in rule order)."""
    c = checks(raw, filters, rules).where(~F.col("passed"))
    order = F.struct(F.col("failure_rate"), -F.col("position"))
    return c.agg(
        F.count(F.lit(1)).alias("failing_checks"),
        F.max_by("check_key", order).alias("worst_check"),
        F.max_by("label", order).alias("worst_label"),
        F.max_by("failed_rows", order).alias("worst_failed_rows"),
        F.max("failure_rate").alias("worst_failure_rate"))
