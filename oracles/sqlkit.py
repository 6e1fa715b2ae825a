"""DuckDB spellings of the metric registry and the default selection."""

from __future__ import annotations

import datetime as dt

from wayfarer import config as C

RATE_FLAGS = {
    "on_time_performance": "on_time",
    "complaint_rate": "complaint_flag",
    "disruption_rate": "service_disruption",
    "repeat_rate": "repeat_customer",
    "digital_rate": "digital_interaction",
    "accessibility_rate": "accessibility_service_used",
}
AVGS = {
    "avg_satisfaction": "customer_satisfaction",
    "avg_delay_minutes": "delay_minutes",
    "avg_resolution_hours": "resolution_time_hours",
}


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


START, END = C.DEFAULT_START, C.DEFAULT_END
PREV_END = START - dt.timedelta(days=1)
PREV_START = PREV_END - dt.timedelta(days=(END - START).days)
WHERE_DEFAULT = f"date BETWEEN {d(START)} AND {d(END)}"
CUR = WHERE_DEFAULT
PREV = f"date BETWEEN {d(PREV_START)} AND {d(PREV_END)}"
SCAN2 = f"date BETWEEN {d(PREV_START)} AND {d(END)}"


def spark_pct(values: str, p: float, cond: str | None = None) -> str:
    """Exact percentile: sort the non-NULL values, interpolate linearly between
    the order statistics around (n - 1) * p (weights ceil - pos, pos - floor)."""
    f = f" FILTER (WHERE {cond})" if cond else ""
    vals = f"list_sort(list_filter(list({values}){f}, lambda x: x IS NOT NULL))"
    pos = f"((len({vals}) - 1) * CAST({p!r} AS DOUBLE))"
    lo, hi = f"floor({pos})", f"ceil({pos})"
    vlo, vhi = f"{vals}[CAST({lo} AS BIGINT) + 1]", f"{vals}[CAST({hi} AS BIGINT) + 1]"
    return (f"(CASE WHEN len({vals}) = 0 THEN NULL WHEN {lo} = {hi} OR {vlo} = {vhi} "
            f"THEN CAST({vlo} AS DOUBLE) ELSE ({hi} - {pos}) * {vlo} + ({pos} - {lo}) * {vhi} END)")


def metric(key: str, cond: str | None = None) -> str:
    f = f" FILTER (WHERE {cond})" if cond else ""
    if key == "total_journeys":
        return f"count(*){f}"
    if key == "active_customers":
        return f"count(DISTINCT customer_id){f}"
    if key in AVGS:
        return f"avg({AVGS[key]}){f}"
    if key == "p90_delay_minutes":
        return spark_pct("delay_minutes", 0.9, cond)
    flag = RATE_FLAGS[key]
    c1 = f"({cond}) AND {flag}" if cond else flag
    c2 = f"({cond}) AND {flag} IS NOT NULL" if cond else f"{flag} IS NOT NULL"
    return (f"100.0 * count(*) FILTER (WHERE {c1}) / "
            f"nullif(count(*) FILTER (WHERE {c2}), 0)")


def metrics(keys, cond: str | None = None, suffix: str = "") -> str:
    return ",\n  ".join(f"{metric(k, cond)} AS {k}{suffix}" for k in keys)


def npround(expr: str, digits: int) -> str:
    scale = float(10 ** digits)
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def values_table(rows, names) -> str:
    """``(VALUES ...) t(names)`` literal for small fixed lookup tables."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return repr(v)
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(names)})"
