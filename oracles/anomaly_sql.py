"""DuckDB spelling of the rolling-baseline anomaly scan."""

from __future__ import annotations

import datetime as dt

from wayfarer import config as C
from wayfarer.functions.metrics import METRICS

from .sqlkit import END, START, d, metrics, npround

SCAN = tuple(C.DEFAULT_SCAN_METRICS)
NEEDED = tuple(dict.fromkeys([*SCAN, *C.COMPANION_METRICS]))
LOWER = ", ".join(f"'{k}'" for k in sorted(C.LOWER_IS_BETTER))


def ctes(dimension: str | None, method: str, keep: tuple[str, ...] = NEEDED,
         scope_value: str | None = None, columns: str = metrics(NEEDED)) -> str:
    scope = "'Network'" if dimension is None else dimension
    ext = START - dt.timedelta(days=C.ANOMALY_ROLLING_WINDOW + 7)
    value_cond = f" AND dimension_value = '{scope_value}'" if scope_value else ""
    long = "\nUNION ALL\n".join(
        f"SELECT dimension_value, period, total_journeys AS journeys, '{m}' AS metric, "
        f"CAST({m} AS DOUBLE) AS value FROM daily" for m in keep)
    if method == "iqr":
        # exact percentile with linear interpolation between the two order
        # statistics around (n - 1) * p, spelled out on the sorted frame values
        stats = """
         CASE WHEN count(value) OVER w >= 14
              THEN list_sort(list_filter(list(value) OVER w, lambda x: x IS NOT NULL)) END
             AS vals"""

        def pct(p: float) -> str:
            pos = f"((len(vals) - 1) * CAST({p!r} AS DOUBLE))"
            lo, hi = f"floor({pos})", f"ceil({pos})"
            vlo, vhi = f"vals[CAST({lo} AS BIGINT) + 1]", f"vals[CAST({hi} AS BIGINT) + 1]"
            return (f"CASE WHEN vals IS NULL THEN NULL WHEN {lo} = {hi} OR {vlo} = {vhi} "
                    f"THEN {vlo} ELSE ({hi} - {pos}) * {vlo} + ({pos} - {lo}) * {vhi} END")
        derived = f"""
  SELECT *, q2 AS expected, q1 - 1.5 * (q3 - q1) AS lower_bound,
         q3 + 1.5 * (q3 - q1) AS upper_bound,
         (value - q2) / (CASE WHEN q3 - q1 <> 0 THEN (q3 - q1) / 1.349 END) AS z_score
  FROM (SELECT *, {pct(0.25)} AS q1, {pct(0.5)} AS q2, {pct(0.75)} AS q3 FROM b1)"""
    else:
        stats = """
         CASE WHEN count(value) OVER w >= 14 THEN stddev_pop(value) OVER w END AS sd"""
        derived = """
  SELECT *, mean AS expected,
         mean - 2.5 * (CASE WHEN sd <> 0 THEN sd END) AS lower_bound,
         mean + 2.5 * (CASE WHEN sd <> 0 THEN sd END) AS upper_bound,
         (value - mean) / (CASE WHEN sd <> 0 THEN sd END) AS z_score
  FROM b1"""
    return f"""
daily AS (
  SELECT * FROM (
    SELECT date AS period, {scope} AS dimension_value, {columns}
    FROM an WHERE date BETWEEN {d(ext)} AND {d(END)} GROUP BY 1, 2
  ) WHERE dimension_value IS NOT NULL{value_cond}
),
a_long AS ({long}),
b1 AS (
  SELECT *, count(*) OVER (PARTITION BY dimension_value, metric) AS scope_days,
         CASE WHEN count(value) OVER w >= 14 THEN avg(value) OVER w END AS mean,{stats}
  FROM a_long
  WINDOW w AS (PARTITION BY dimension_value, metric ORDER BY period
               ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)
),
base AS ({derived})"""


_CHANGE = "((b.value - b.mean) / abs(b.mean) * 100.0)"


def _shown(value: str) -> str:
    return (f"CASE WHEN b.metric = 'total_journeys' THEN format('{{:,}}', CAST({npround(value, 0)} AS BIGINT)) "
            f"ELSE printf('%.1f%%', {npround(value, 1)}) END")


def detections_sql(dimension: str | None, method: str, adverse_only: bool = False,
                   limit: int | None = None, more: dict | None = None,
                   scan: tuple[str, ...] = SCAN, evidence: bool = False) -> tuple[str, str]:
    """``more``: further metrics, name -> (aggregate, label, lower is better, floor)."""
    more = more or {}
    least = {**C.DEFAULT_SCAN_METRICS, **{k: m[3] for k, m in more.items()}}
    floors = " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in least.items())
    called = {**{k: METRICS[k].label for k in METRICS}, **{k: m[1] for k, m in more.items()}}
    labels = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in called.items())
    lower = ", ".join([LOWER, *(f"'{k}'" for k, m in more.items() if m[2])])
    keep = tuple(dict.fromkeys([*scan, *C.COMPANION_METRICS]))
    columns = ", ".join(f"{more[k][0]} AS {k}" if k in more else metrics([k]) for k in keep)
    flag = ("(value < lower_bound OR value > upper_bound)" if method == "iqr"
            else "abs(z_score) >= 2.5")
    scope = ("'Network'" if dimension is None else
             f"'{dimension.replace('_', ' ').title()}: ' || dimension_value")
    who = "'the network'" if dimension is None else scope
    adverse = f"((value > expected) = (metric IN ({lower})))"
    extra = f" AND {adverse}" if adverse_only else ""
    det = f"""
det AS (
  SELECT * FROM base
  WHERE metric IN ({', '.join(f"'{m}'" for m in scan)}) AND scope_days >= 15
    AND period BETWEEN {d(START)} AND {d(END)}
    AND value IS NOT NULL AND expected IS NOT NULL AND z_score IS NOT NULL
    AND journeys >= 25 AND abs(value - expected) >= (CASE metric {floors} END)
    AND {flag}{extra}
)"""
    order = ("ORDER BY abs(z_score) DESC, period DESC, metric, scope LIMIT " + str(limit)
             if limit else "")
    body = f"""
SELECT metric, CASE metric {labels} END AS metric_label,
       '{dimension or 'network'}' AS dimension, dimension_value, {scope} AS scope, period,
       {npround('value', 6)} AS actual, {npround('expected', 6)} AS expected,
       {npround('lower_bound', 6)} AS lower_bound, {npround('upper_bound', 6)} AS upper_bound,
       {npround('z_score', 6)} AS z_score, journeys, '{method}' AS method,
       CASE WHEN value > expected THEN 'above' ELSE 'below' END AS direction,
       {npround('CASE WHEN expected <> 0 THEN (value - expected) / abs(expected) * 100.0 END', 6)}
           AS magnitude_pct,
       CASE WHEN abs(z_score) >= 4.0 THEN 'High' WHEN abs(z_score) >= 3.0 THEN 'Medium'
            ELSE 'Low' END AS severity,
       {adverse} AS adverse,
       printf('%s for %s %s %.2f on %s, compared with a recent baseline of %.2f.',
              CASE metric {labels} END, {who},
              CASE WHEN value > expected THEN 'reached' ELSE 'fell to' END,
              {npround('value', 2)}, strftime(period, '%Y-%m-%d'), {npround('expected', 2)})
           AS statement
FROM det {order}"""
    if evidence:
        body = f"""
SELECT t.metric, t.metric_label, t.scope, t.period AS date,
       {npround('t.actual', 3)} AS actual, {npround('t.expected', 3)} AS expected_baseline,
       {npround('t.lower_bound', 3)} AS expected_from, {npround('t.upper_bound', 3)} AS expected_to,
       {npround('t.z_score', 2)} AS z_score, t.severity, t.direction, t.adverse, t.journeys, t.method, t.statement,
       CASE WHEN n.notes IS NULL
            THEN 'No companion metric moved materially; the deviation is specific to ' || lower(t.metric_label) || '.'
            ELSE 'On the same day, ' || n.notes || '.' END AS context
FROM ({body}) t LEFT JOIN (
  SELECT s.metric, s.dimension_value, s.period, string_agg(
      c.label || ' was ' || {_shown('b.value')} || ' against a baseline of ' || {_shown('b.mean')}
      || printf(' (%+.0f%%)', {npround(_CHANGE, 0)}), '; ' ORDER BY c.place) AS notes
  FROM det s JOIN base b ON b.dimension_value = s.dimension_value AND b.period = s.period
  JOIN (VALUES ('disruption_rate', 1, 'Disruption Rate'), ('complaint_rate', 2, 'Complaint Rate'),
               ('total_journeys', 3, 'Total Journeys')) c(name, place, label) ON c.name = b.metric
  WHERE b.metric <> s.metric AND b.mean <> 0 AND abs({_CHANGE}) >= 25
  GROUP BY 1, 2, 3) n ON n.metric = t.metric AND n.dimension_value = t.dimension_value AND n.period = t.period"""
    return ctes(dimension, method, keep, columns=columns) + "," + det, body
