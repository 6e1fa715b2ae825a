"""DuckDB oracle statements for the registered queries (correctness gate)."""

from __future__ import annotations

from wayfarer import config as C
from wayfarer.functions.metrics import METRICS

from .prefix import DERIVED, q
from .sqlkit import CUR, PREV, SCAN2, WHERE_DEFAULT, metric, metrics

ORACLES: dict[str, str] = {}

ALL_COLUMNS = ", ".join(
    ['"timestamp"' if c == "timestamp" else c for c in C.JOURNEY_COLUMNS]
    + list(C.DERIVED_COLUMNS) + list(C.DIMENSION_ATTRIBUTE_COLUMNS))

ORACLES["analytics_rows"] = q(f"SELECT {ALL_COLUMNS} FROM an")


def _stack(keys, cols: dict[str, str], source: str) -> str:
    """UNION ALL reshaping of a one-row wide CTE into one row per metric."""
    parts = []
    for i, k in enumerate(keys):
        sel = ", ".join(f"CAST({tmpl.format(k=k)} AS DOUBLE) AS {name}"
                        for name, tmpl in cols.items())
        parts.append(f"SELECT '{k}' AS metric, {i} AS position, "
                     f"'{METRICS[k].label}' AS label, '{METRICS[k].unit}' AS unit, {sel} "
                     f"FROM {source}")
    return "\nUNION ALL\n".join(parts)


LOWER = ", ".join(f"'{k}'" for k in sorted(C.LOWER_IS_BETTER))


def direction_sql(metric_col: str, change: str) -> str:
    return (f"CASE WHEN {change} IS NULL OR abs({change}) < 1e-9 THEN 'flat' "
            f"WHEN (CASE WHEN {metric_col} IN ({LOWER}) THEN {change} < 0 ELSE {change} > 0 END) "
            f"THEN 'good' ELSE 'bad' END")


def pct_sql(cur: str, prev: str) -> str:
    return (f"CASE WHEN {prev} IS NULL OR {cur} IS NULL OR {prev} = 0 THEN NULL "
            f"ELSE CAST(({cur} - {prev}) / abs({prev}) * 100.0 AS DOUBLE) END")


def compare_periods_sql(keys, dims_cond: str | None = None) -> tuple[str, str]:
    """(extra CTEs, body) for the two-period comparison."""
    scan = SCAN2 + (f" AND {dims_cond}" if dims_cond else "")
    ctes = f"""
wide AS (SELECT {metrics(keys, CUR, '__c')}, {metrics(keys, PREV, '__p')} FROM an WHERE {scan}),
long AS ({_stack(keys, {'current': '{k}__c', 'previous': '{k}__p'}, 'wide')})"""
    body = f"""
SELECT metric, position, label, unit, current, previous,
       current - previous AS absolute_change,
       {pct_sql('current', 'previous')} AS percent_change,
       {direction_sql('metric', 'current - previous')} AS direction
FROM long"""
    return ctes, body


ORACLES["kpi_period_compare"] = q(*reversed(compare_periods_sql(C.HEADLINE_KPIS)))


def breakdown_sql(dimension: str, keys=C.BREAKDOWN_METRICS, min_journeys: int = 1,
                  where: str = WHERE_DEFAULT, limit: int | None = None) -> str:
    order = ("ORDER BY total_journeys DESC, dimension_value ASC NULLS LAST"
             if "total_journeys" in keys else "ORDER BY dimension_value ASC NULLS LAST")
    lim = f" LIMIT {limit}" if limit is not None else ""
    return f"""
SELECT * FROM (
  SELECT {dimension} AS dimension_value, {metrics(keys)}
  FROM an WHERE {where}
  GROUP BY 1 HAVING count(*) >= {min_journeys}
) WHERE dimension_value IS NOT NULL {order}{lim}"""


for _name, _dim in {
    "metrics_by_region": "region",
    "metrics_by_mode": "transport_mode",
    "metrics_by_segment": "customer_segment",
    "metrics_by_service_line": "service_line",
    "metrics_by_channel": "channel",
    "metrics_by_purpose": "journey_purpose",
    "metrics_by_time_band": "time_band",
    "metrics_by_complaint_category": "complaint_category",
    "metrics_by_age_group": "age_group",
    "metrics_by_fare_type": "fare_type",
    "metrics_by_origin_region": "origin_region",
    "metrics_by_destination_region": "destination_region",
    "metrics_by_feedback_category": "feedback_text_category",
}.items():
    ORACLES[_name] = q(breakdown_sql(_dim))


# ---------------------------------------------------------------------------
# Sources, enrichment, filters
# ---------------------------------------------------------------------------
from .sqlkit import d, npround  # noqa: E402

ORACLES["feed_validation"] = q("""
SELECT feed, level, code, message, CAST(n_rows AS BIGINT) AS n_rows FROM (
  SELECT 'required_only' AS feed, 'warning' AS level, 'absent_optional_columns' AS code,
         '18 optional column(s) are absent: timestamp, origin_region, destination_region, '
         || 'service_line, journey_purpose, age_group...' AS message, 18 AS n_rows,
         delay_num > 0 AND sat_num > 0 AS hit FROM s
  UNION ALL SELECT 'some_defects', 'warning', 'dates_partly_unparseable',
         'Rows with an unparseable date are excluded from analysis.', sevens, sevens > 0 FROM s
  UNION ALL SELECT 'some_defects', 'warning', 'unrecognised_booleans',
         'Rows hold a boolean text that is not recognised; it is read as missing.', digital,
         digital > 0 FROM s
  UNION ALL SELECT 'no_values', 'error', 'dates_unparseable',
         'The ''date'' column could not be parsed as dates.', n, TRUE FROM s
  UNION ALL SELECT 'no_values', 'error', 'delay_minutes_not_numeric',
         'The ''delay_minutes'' column contains no numeric values.', 0, TRUE
  UNION ALL SELECT 'no_values', 'error', 'customer_satisfaction_not_numeric',
         'The ''customer_satisfaction'' column contains no numeric values.', 0, TRUE
  UNION ALL SELECT 'columns_missing', 'error', 'missing_required_columns',
         'Missing required column(s): date, region', NULL, TRUE
  UNION ALL SELECT 'empty', 'error', 'empty_feed', 'The feed contains no rows.', 0, TRUE
) WHERE hit""", """
s AS (
  SELECT count(*) AS n,
         count(*) FILTER (WHERE date IS NULL OR suffix(journey_id, '7')) AS sevens,
         count(*) FILTER (WHERE digital_interaction) AS digital,
         count(delay_minutes) AS delay_num, count(customer_satisfaction) AS sat_num
  FROM journeys
)""")


def _bool_text(expr: str) -> str:
    return (f"CASE WHEN {expr} IN ('true', 'True', 'TRUE', '1', 'yes') THEN TRUE "
            f"WHEN {expr} IN ('false', 'False', 'FALSE', '0', 'no') THEN FALSE END")


def _text_back(name: str, kind: str, texts: tuple[str, str] = ("true", "false")) -> str:
    """A column rendered as text and read again."""
    if kind == "BOOLEAN":
        return _bool_text(f"(CASE WHEN {name} THEN '{texts[0]}' WHEN NOT {name} THEN '{texts[1]}' END)")
    return f"TRY_CAST(CAST({name} AS VARCHAR) AS {kind})"


_REQUIRED_BACK = f"""journey_id, customer_id, region, transport_mode, customer_segment,
       {_text_back('date', 'DATE')} AS date,
       {_text_back('delay_minutes', 'DOUBLE')} AS delay_minutes,
       {_text_back('customer_satisfaction', 'DOUBLE')} AS customer_satisfaction"""

ORACLES["canonical_feed"] = q(f"""
SELECT {_REQUIRED_BACK},
       {_text_back('"timestamp"', 'TIMESTAMP')} AS "timestamp",
       origin_region, destination_region, service_line, journey_purpose, age_group, channel,
       {_text_back('journey_duration_minutes', 'DOUBLE')} AS journey_duration_minutes,
       coalesce({_text_back('on_time', 'BOOLEAN')}, delay_minutes <= 5.0, FALSE) AS on_time,
       {_text_back('complaint_flag', 'BOOLEAN', ('True', 'False'))} AS complaint_flag,
       complaint_category,
       {_text_back('resolution_time_hours', 'DOUBLE')} AS resolution_time_hours,
       {_text_back('repeat_customer', 'BOOLEAN', ('1', '0'))} AS repeat_customer,
       {_text_back('service_disruption', 'BOOLEAN', ('yes', 'no'))} AS service_disruption,
       {_text_back('accessibility_service_used', 'BOOLEAN', ('TRUE', 'FALSE'))}
           AS accessibility_service_used,
       fare_type, {_text_back('digital_interaction', 'BOOLEAN')} AS digital_interaction,
       feedback_text_category
FROM journeys""")

ORACLES["canonical_feed_required"] = q(f"""
SELECT {_REQUIRED_BACK}, CAST(date AS TIMESTAMP) AS "timestamp",
       coalesce(delay_minutes <= 5.0, FALSE) AS on_time,
       {", ".join(f"CAST(NULL AS {kind}) AS {name}" for kind, names in (
           ("VARCHAR", "origin_region destination_region service_line journey_purpose age_group "
                       "channel complaint_category fare_type feedback_text_category"),
           ("DOUBLE", "journey_duration_minutes resolution_time_hours"),
           ("BOOLEAN", "complaint_flag repeat_customer service_disruption "
                       "accessibility_service_used digital_interaction"))
           for name in names.split())}
FROM journeys""")

ORACLES["enriched_no_dims"] = q(f"SELECT {ALL_COLUMNS} FROM raw_j")

ORACLES["source_manifest"] = q("""
SELECT (SELECT count(*) FROM journeys) AS n_journeys,
       (SELECT count(*) FROM an) AS analysable_rows,
       (SELECT min(date) FROM an) AS start_date,
       (SELECT max(date) FROM an) AS end_date""")

_DIMS = """
_cust AS (
  SELECT 'C' || CAST(o.o_custkey AS VARCHAR) AS customer_id, nr.r_name AS home_region,
         CAST(o.o_custkey % 10 AS DOUBLE) / CAST(10.0 AS DOUBLE) AS digital_affinity,
         min(CAST(o.o_orderdate AS DATE)) AS first_seen_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN _nr nr ON c.c_nationkey = nr.n_nationkey
  GROUP BY o.o_custkey, nr.r_name
),
_lines AS (
  SELECT 'L' || CAST(code AS VARCHAR) AS service_line,
         CAST(0.7 AS DOUBLE) + CAST(code % 10 AS DOUBLE) * CAST(0.05 AS DOUBLE)
             AS reliability_index,
         CAST(0.65 AS DOUBLE) + CAST(code % 14 AS DOUBLE) * CAST(0.05 AS DOUBLE)
             AS capacity_index,
         CAST(20.0 AS DOUBLE) + CAST(code % 20 AS DOUBLE) AS scheduled_duration_minutes
  FROM range(48) t(code)
)"""

_J_COLS = ", ".join('j."timestamp"' if c == "timestamp" else f"j.{c}" for c in C.JOURNEY_COLUMNS)
ORACLES["enriched_journeys"] = q(f"""
SELECT {_J_COLS}, {", ".join(C.DERIVED_COLUMNS)},
       c.home_region AS customer_home_region, c.digital_affinity,
       c.first_seen_date AS customer_first_seen_date,
       s.reliability_index AS line_reliability_index,
       s.capacity_index AS line_capacity_index,
       s.scheduled_duration_minutes AS line_scheduled_minutes
FROM (SELECT j.*,{DERIVED} FROM journeys j) j
LEFT JOIN _cust c ON c.customer_id = j.customer_id
LEFT JOIN _lines s ON s.service_line = j.service_line""", _DIMS)

ORACLES["time_band_profile"] = q("""
SELECT time_band, is_peak, is_weekend, count(*) AS journeys,
       avg(delay_minutes) AS avg_delay_minutes
FROM raw_j GROUP BY 1, 2, 3""")

ORACLES["filtered_population"] = q(f"""
SELECT journey_id, date, region, transport_mode, time_band, delay_minutes FROM an
WHERE {WHERE_DEFAULT} AND region IN ('ASIA', 'EUROPE') AND transport_mode IN ('Bus', 'Metro')
  AND time_band IN ('AM Peak', 'PM Peak', 'Off-Peak')""")

ORACLES["dimension_values"] = q("\nUNION\n".join(
    f"SELECT DISTINCT '{c}' AS dimension, {c} AS value FROM an WHERE {c} IS NOT NULL"
    for c in C.GROUPING_COLUMNS))

ORACLES["dataset_bounds"] = q(f"""
SELECT coalesce(min(date), {d(C.AS_OF)}) AS first_date,
       coalesce(max(date), {d(C.AS_OF)}) AS last_date FROM an""")

ORACLES["row_counts"] = q("""
SELECT (SELECT count(*) FROM raw_j) AS raw_rows, (SELECT count(*) FROM an) AS analysable_rows""")

# ---------------------------------------------------------------------------
# KPIs
# ---------------------------------------------------------------------------
ORACLES["kpi_all_metrics"] = q(f"SELECT {metrics(METRICS.keys())} FROM an WHERE {WHERE_DEFAULT}")

_c, _b = compare_periods_sql(C.HEADLINE_KPIS)
ORACLES["kpi_evidence"] = q(f"""
SELECT metric, label, unit, {npround('current', 4)} AS current,
       {npround('previous', 4)} AS previous,
       {npround('absolute_change', 4)} AS absolute_change,
       {npround('percent_change', 2)} AS percent_change, direction
FROM ({_b})""", _c)

ORACLES["population_summary"] = q(f"""
SELECT count(*) AS journeys, count(DISTINCT customer_id) AS customers,
       count(DISTINCT region) AS regions, count(DISTINCT transport_mode) AS modes,
       count(DISTINCT service_line) AS service_lines, min(date) AS first_date,
       max(date) AS last_date
FROM an WHERE {WHERE_DEFAULT}""")


def pop_sql(dimension: str, key: str, min_journeys: int) -> str:
    return f"""
SELECT dimension_value, current_value, previous_value, current_journeys, previous_journeys,
       current_value - previous_value AS absolute_change,
       CASE WHEN previous_value IS NULL OR previous_value = 0 THEN NULL
            ELSE 100.0 * (current_value - previous_value) / abs(previous_value) END
           AS percent_change
FROM (
  SELECT {dimension} AS dimension_value,
         CAST({metric(key, CUR)} AS DOUBLE) AS current_value,
         CAST({metric(key, PREV)} AS DOUBLE) AS previous_value,
         count(*) FILTER (WHERE {CUR}) AS current_journeys,
         count(*) FILTER (WHERE {PREV}) AS previous_journeys
  FROM an WHERE {SCAN2} GROUP BY 1
) WHERE dimension_value IS NOT NULL AND current_journeys >= {min_journeys}
    AND previous_journeys >= {min_journeys}"""


ORACLES["pop_by_region"] = q(pop_sql("region", "on_time_performance", 50))
ORACLES["pop_by_segment"] = q(pop_sql("customer_segment", "avg_satisfaction", 100))


def compare_segments_sql(a: str, b: str, keys=C.SEGMENT_COMPARE_METRICS) -> tuple[str, str]:
    ca, cb = f"customer_segment = '{a}'", f"customer_segment = '{b}'"
    ctes = f"""
wide AS (
  SELECT {metrics(keys, ca, '__a')}, {metrics(keys, cb, '__b')},
         count(*) FILTER (WHERE {ca}) AS _na, count(*) FILTER (WHERE {cb}) AS _nb
  FROM an WHERE {WHERE_DEFAULT} AND customer_segment IN ('{a}', '{b}')
),
long AS ({_stack(keys, {'value_a': '{k}__a', 'value_b': '{k}__b',
                        'na': '_na', 'nb': '_nb'}, 'wide')})"""
    body = f"""
SELECT metric, position, label, unit, '{a}' AS segment_a, '{b}' AS segment_b,
       CASE WHEN na > 0 THEN value_a END AS value_a,
       CASE WHEN nb > 0 THEN value_b END AS value_b,
       (CASE WHEN na > 0 THEN value_a END) - (CASE WHEN nb > 0 THEN value_b END) AS difference
FROM long WHERE na + nb > 0"""
    return ctes, body


ORACLES["compare_segments"] = q(*reversed(compare_segments_sql(
    "Frequent Commuters", "Occasional Travellers")))

ORACLES["segment_share"] = q(f"""
SELECT dimension_value, total_journeys,
       total_journeys / sum(total_journeys) OVER () * 100.0 AS share_pct
FROM ({breakdown_sql('customer_segment', ('total_journeys',))})""")

# ---------------------------------------------------------------------------
# Trends
# ---------------------------------------------------------------------------
for _grain, _col in C.GRAIN_COLUMNS.items():
    ORACLES[f"time_series_{_grain}"] = q(f"""
SELECT CAST({_col} AS DATE) AS period, {metrics(C.BREAKDOWN_METRICS)}
FROM an WHERE {WHERE_DEFAULT} GROUP BY 1""")

_DAILY = f"""
daily AS (
  SELECT CAST(date AS DATE) AS period, {metrics(C.BREAKDOWN_METRICS)}
  FROM an WHERE {WHERE_DEFAULT} GROUP BY 1
),
cal AS (
  SELECT CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 DAY)) AS DATE)
      AS period FROM daily
),
filled AS (SELECT cal.period, daily.* EXCLUDE (period) FROM cal LEFT JOIN daily USING (period))"""
ORACLES["calendar_filled_daily"] = q("SELECT * FROM filled", _DAILY)
ORACLES["rolling_7d"] = q(f"""
SELECT period, avg_delay_minutes, total_journeys,
       {npround('CASE WHEN count(avg_delay_minutes) OVER w >= 2 '
                'THEN avg(avg_delay_minutes) OVER w END', 6)} AS avg_delay_minutes_rolling
FROM filled
WINDOW w AS (ORDER BY period ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", _DAILY)

_SERIES = "region, transport_mode, customer_segment"
ORACLES["calendar_filled_by_dimensions"] = q(f"""
SELECT period, {_SERIES}, total_journeys, avg_delay_minutes,
       {npround('CASE WHEN count(avg_delay_minutes) OVER w >= 2 '
                'THEN avg(avg_delay_minutes) OVER w END', 6)} AS avg_delay_minutes_rolling
FROM series_filled
WINDOW w AS (PARTITION BY {_SERIES} ORDER BY period ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", f"""
series_daily AS (SELECT CAST(date AS DATE) AS period, {_SERIES},
                        {metrics(('total_journeys', 'avg_delay_minutes'))} FROM an WHERE date IS NOT NULL GROUP BY ALL),
series_days AS (SELECT {_SERIES}, CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 DAY)) AS DATE) AS period
                FROM series_daily GROUP BY {_SERIES}),
series_filled AS (SELECT c.*, d.total_journeys, d.avg_delay_minutes FROM series_days c LEFT JOIN series_daily d
  ON d.period = c.period AND d.region IS NOT DISTINCT FROM c.region
     AND d.transport_mode IS NOT DISTINCT FROM c.transport_mode
     AND d.customer_segment IS NOT DISTINCT FROM c.customer_segment)""")

ORACLES["series_by_dimension"] = q(f"""
SELECT CAST(j.week_start AS DATE) AS period, j.service_line AS dimension_value,
       {metric('avg_delay_minutes')} AS value, count(*) AS journeys
FROM an j JOIN ranked r ON r.dimension_value = j.service_line
WHERE {WHERE_DEFAULT}
GROUP BY 1, 2""", f"""
ranked AS (
  SELECT service_line AS dimension_value, count(*) AS n FROM an WHERE {WHERE_DEFAULT}
  GROUP BY 1 ORDER BY n DESC, dimension_value ASC NULLS LAST LIMIT 6
)""")

ORACLES["hourly_profile"] = q(f"""
SELECT journey_hour AS hour, CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       {metrics(C.HOURLY_METRICS)}
FROM an WHERE {WHERE_DEFAULT} GROUP BY 1, 2""")

_DAYS = "['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday']"
ORACLES["weekday_profile"] = q(f"""
SELECT day_of_week, {metrics(C.WEEKDAY_METRICS)},
       {_DAYS}[day_of_week + 1] AS day_name, (day_of_week + 6) % 7 AS sort_order
FROM an WHERE {WHERE_DEFAULT} GROUP BY 1""")

_CELLS = f"""
cells AS (
  SELECT day_of_week, journey_hour AS hour, {metric('avg_delay_minutes')} AS value,
         count(*) AS journeys, {_DAYS}[day_of_week + 1] AS day_name
  FROM an WHERE {WHERE_DEFAULT} GROUP BY 1, 2 HAVING count(*) >= 5
)"""
ORACLES["heatmap_cells"] = q("SELECT * FROM cells", _CELLS)
ORACLES["heatmap_matrix"] = q(
    "SELECT day_name, (day_of_week + 6) % 7 AS sort_order, "
    + ", ".join(f"max(value) FILTER (WHERE hour = {h}) AS h{h:02d}" for h in range(24))
    + " FROM cells GROUP BY day_of_week, day_name", _CELLS)

# ---------------------------------------------------------------------------
# Records
# ---------------------------------------------------------------------------
_DISPLAY = ", ".join('"timestamp"' if c == "timestamp" else c for c in C.DISPLAY_COLUMNS)


def records_sql(order: str, extra: str = "", limit: int = 500) -> str:
    return (f"SELECT {_DISPLAY} FROM an WHERE {WHERE_DEFAULT} {extra} "
            f"ORDER BY {order}, journey_id ASC LIMIT {limit}")


ORACLES["records_recent"] = q(records_sql('"timestamp" DESC NULLS LAST'))
ORACLES["records_longest_delay"] = q(records_sql("delay_minutes DESC NULLS LAST",
                                                 "AND complaint_flag"))
ORACLES["records_lowest_satisfaction"] = q(records_sql(
    "customer_satisfaction ASC NULLS LAST", "AND NOT on_time", 300))
ORACLES["records_search"] = q(records_sql(
    "journey_duration_minutes DESC NULLS LAST",
    "AND (lower(journey_id) LIKE '%crowd%' OR lower(service_line) LIKE '%crowd%' "
    "OR lower(region) LIKE '%crowd%' OR lower(coalesce(complaint_category, '')) LIKE '%crowd%')"))
ORACLES["records_subset_counts"] = q(f"""
SELECT subset, journeys FROM (
  SELECT count(*) AS c0, count(*) FILTER (WHERE complaint_flag) AS c1,
         count(*) FILTER (WHERE NOT on_time) AS c2,
         count(*) FILTER (WHERE service_disruption) AS c3,
         count(*) FILTER (WHERE customer_satisfaction <= 2) AS c4,
         count(*) FILTER (WHERE accessibility_service_used) AS c5
  FROM an WHERE {WHERE_DEFAULT}
) UNPIVOT (journeys FOR subset IN (
  c0 AS 'All journeys', c1 AS 'Complaints only', c2 AS 'Delayed journeys only',
  c3 AS 'Disrupted journeys only', c4 AS 'Low satisfaction (1-2)',
  c5 AS 'Accessibility services used'))""")
ORACLES["top_service_lines"] = q(breakdown_sql(
    "service_line", C.SERVICE_METRICS + ("total_journeys",), 20, limit=15))


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------
from .sqlkit import spark_pct as _P  # noqa: E402
_CHECKS = [
    ("null_customer_id", "Null customer ID", "Completeness", "customer_id IS NULL"),
    ("missing_region", "Missing region", "Completeness", "region IS NULL OR trim(region) = ''"),
    ("missing_satisfaction", "Missing satisfaction score", "Completeness",
     "customer_satisfaction IS NULL"),
    ("invalid_satisfaction", "Satisfaction outside 1-5", "Validity",
     "customer_satisfaction IS NOT NULL AND (customer_satisfaction < 1 "
     "OR customer_satisfaction > 5)"),
    ("negative_duration", "Non-positive journey duration", "Validity",
     "journey_duration_minutes IS NOT NULL AND journey_duration_minutes <= 0"),
    ("implausible_duration", "Implausible journey duration", "Validity",
     "journey_duration_minutes > 240.0"),
    ("invalid_delay", "Impossible delay value", "Validity",
     "delay_minutes IS NULL OR delay_minutes < 0 OR delay_minutes > 180.0"),
    ("invalid_transport_mode", "Unrecognised transport mode", "Validity",
     "transport_mode IS NULL OR transport_mode NOT IN "
     "('Metro', 'Train', 'Bus', 'Light Rail', 'Ferry')"),
    ("duplicate_journey_id", "Duplicate journey ID", "Uniqueness", None),
]
_PROF = "prof AS (SELECT count(*) AS total_rows, max(date) AS latest_date, " \
    "count(*) - count(DISTINCT journey_id) AS duplicate_journey_id, " \
    + ", ".join(f"count(*) FILTER (WHERE {p}) AS {k}" for k, _, _, p in _CHECKS if p) + ", " \
    + ", ".join(f"count({c}) AS present_{c}" for c in C.PROFILED_FIELDS) \
    + f" FROM raw_j WHERE {WHERE_DEFAULT})"
_CHECKS_CTE = _PROF + ",\nchk AS (" + "\nUNION ALL\n".join(
    f"SELECT '{k}' AS check_key, '{lab}' AS label, '{cat}' AS category, {i} AS position, "
    f"CAST({k} AS BIGINT) AS failed_rows, total_rows FROM prof"
    for i, (k, lab, cat, _) in enumerate(_CHECKS)) + "),\n" + """
chk2 AS (
  SELECT *, CASE WHEN total_rows = 0 THEN 0.0 ELSE failed_rows / total_rows * 100.0 END
      AS failure_rate FROM chk
)"""
ORACLES["dq_checks"] = q("""
SELECT check_key, label, category, position, failed_rows, total_rows, failure_rate,
       failed_rows = 0 AS passed,
       CASE WHEN failure_rate = 0 THEN 'Pass' WHEN failure_rate < 0.5 THEN 'Low'
            WHEN failure_rate < 2.0 THEN 'Medium' ELSE 'High' END AS severity
FROM chk2""", _CHECKS_CTE)

ORACLES["dq_field_completeness"] = q("\nUNION ALL\n".join(
    f"SELECT '{c}' AS field, {i} AS position, present_{c} AS present, "
    f"total_rows - present_{c} AS missing, "
    f"CASE WHEN total_rows = 0 THEN 100.0 ELSE present_{c} / total_rows * 100.0 END "
    f"AS completeness_pct, {str(c in C.CONDITIONAL_FIELDS).upper()} AS conditional FROM prof"
    for i, c in enumerate(C.PROFILED_FIELDS)), _PROF)


def _rate_sql(k: str) -> str:
    return f"(CASE WHEN total_rows = 0 THEN 0.0 ELSE {k} / total_rows * 100.0 END)"


def _fam(cat: str) -> str:
    members = [_rate_sql(k) for k, _, c, _ in _CHECKS if c == cat]
    return f"greatest(0.0, 100.0 - ({' + '.join(members)}))"


_WEIGHTED = " + ".join(f"{_fam(cat)} * {w}" for cat, w in C.QUALITY_CATEGORY_WEIGHTS.items())
_UNCOND = [c for c in C.PROFILED_FIELDS if c not in C.CONDITIONAL_FIELDS]
_SCORE_COLS = f"""
  {_fam('Completeness')} AS completeness_score,
  {_fam('Validity')} AS validity_score,
  {_fam('Uniqueness')} AS uniqueness_score,
  {npround(_WEIGHTED, 1)} AS quality_score,
  CASE WHEN {npround(_WEIGHTED, 1)} >= 97 THEN 'Good'
       WHEN {npround(_WEIGHTED, 1)} >= 92 THEN 'Acceptable' ELSE 'Needs attention' END AS rating,
  CASE WHEN total_rows = 0 THEN 100.0 ELSE
    ({' + '.join(f'present_{c} / total_rows * 100.0' for c in _UNCOND)}) / {float(len(_UNCOND))}
  END AS completeness_pct"""
ORACLES["dq_score"] = q(f"SELECT {_SCORE_COLS} FROM prof", _PROF)
ORACLES["dq_summary"] = q(f"""
SELECT total_rows, (SELECT count(*) FROM an WHERE {WHERE_DEFAULT}) AS analysable_rows,
       greatest(0, total_rows - (SELECT count(*) FROM an WHERE {WHERE_DEFAULT})) AS excluded_rows,
       latest_date, date_diff('day', latest_date, {d(C.AS_OF)}) AS freshness_days,
       {' + '.join(f'CASE WHEN {k} > 0 THEN 1 ELSE 0 END' for k, _, _, _ in _CHECKS)}
           AS failing_checks,
       {_SCORE_COLS}
FROM prof""", _PROF)
ORACLES["dq_value_outliers"] = q(f"""
SELECT count(*) FILTER (WHERE delay_minutes > b.d3 + 3 * (b.d3 - b.d1)) AS delay_outliers,
       count(*) FILTER (WHERE journey_duration_minutes > b.u3 + 3 * (b.u3 - b.u1)
                           OR journey_duration_minutes < b.u1 - 3 * (b.u3 - b.u1))
           AS duration_outliers
FROM raw_j j, b WHERE {WHERE_DEFAULT}""", f"""
b AS (
  SELECT {_P('delay_minutes', 0.25)} AS d1, {_P('delay_minutes', 0.75)} AS d3,
         {_P('journey_duration_minutes', 0.25)} AS u1,
         {_P('journey_duration_minutes', 0.75)} AS u3
  FROM raw_j WHERE {WHERE_DEFAULT}
)""")
ORACLES["dq_worst_check"] = q("""
SELECT count(*) AS failing_checks,
       first(check_key ORDER BY failure_rate DESC, position ASC) AS worst_check,
       first(label ORDER BY failure_rate DESC, position ASC) AS worst_label,
       first(failed_rows ORDER BY failure_rate DESC, position ASC) AS worst_failed_rows,
       max(failure_rate) AS worst_failure_rate
FROM chk2 WHERE failed_rows > 0""", _CHECKS_CTE)

# ---------------------------------------------------------------------------
# Customers and segmentation
# ---------------------------------------------------------------------------


def _share(flag: str) -> str:
    return f"100.0 * count(*) FILTER (WHERE {flag}) / nullif(count(*), 0)"


def _mode_cte(name: str, col: str) -> str:
    return f"""
{name} AS (
  SELECT customer_id, {col} AS v FROM (
    SELECT customer_id, {col},
           row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, {col} ASC) AS rn
    FROM an WHERE {WHERE_DEFAULT} AND customer_id IS NOT NULL AND {col} IS NOT NULL
    GROUP BY customer_id, {col}
  ) WHERE rn = 1
)"""


FEATURES_CTE = f"""
cf_base AS (
  SELECT customer_id, count(*) AS journeys, count(DISTINCT date) AS active_days,
         count(DISTINCT transport_mode) AS modes_used, count(DISTINCT region) AS regions_used,
         avg(delay_minutes) AS a_delay, avg(customer_satisfaction) AS a_sat,
         {_share('complaint_flag')} AS r_complaint, {_share('is_peak')} AS r_peak,
         {_share('digital_interaction')} AS r_digital,
         {_share('accessibility_service_used')} AS r_access,
         100.0 * count(*) FILTER (WHERE on_time)
             / nullif(count(*) FILTER (WHERE on_time IS NOT NULL), 0) AS r_otp,
         min(date) AS first_journey, max(date) AS last_journey,
         min(customer_segment) AS assigned_segment, min(age_group) AS age_group
  FROM an WHERE {WHERE_DEFAULT} AND customer_id IS NOT NULL
  GROUP BY customer_id HAVING count(*) >= 3
),
{_mode_cte('m_channel', 'channel').strip()},
{_mode_cte('m_mode', 'transport_mode').strip()},
features AS (
  SELECT b.customer_id, journeys, active_days, modes_used, regions_used,
         {npround('a_delay', 2)} AS avg_delay_minutes,
         {npround('a_sat', 2)} AS avg_satisfaction,
         {npround('r_complaint', 1)} AS complaint_rate,
         {npround('r_peak', 1)} AS peak_share,
         {npround('r_digital', 1)} AS digital_share,
         {npround('r_access', 1)} AS accessibility_share,
         {npround('r_otp', 1)} AS on_time_performance,
         first_journey, last_journey, assigned_segment, age_group,
         mc.v AS primary_channel, mm.v AS primary_mode,
         {npround("journeys / (greatest(date_diff('day', first_journey, last_journey), 6) + 1) * 7", 2)}
             AS journeys_per_week
  FROM cf_base b LEFT JOIN m_channel mc ON mc.customer_id = b.customer_id
  LEFT JOIN m_mode mm ON mm.customer_id = b.customer_id
)"""

RULE_SQL = """CASE
  WHEN coalesce(accessibility_share, 0) >= 20.0 OR coalesce(complaint_rate, 0) >= 12.0
       THEN 'High-Service-Need Customers'
  WHEN journeys_per_week >= 3.0 AND coalesce(peak_share, 0) >= 45.0 THEN 'Frequent Commuters'
  WHEN coalesce(digital_share, 0) >= 70.0 THEN 'Digital-First Customers'
  WHEN journeys_per_week >= 1.2 AND coalesce(peak_share, 0) < 30.0 THEN 'Off-Peak Regulars'
  ELSE 'Occasional Travellers' END"""

ORACLES["customer_features"] = q("SELECT * FROM features", FEATURES_CTE)
ORACLES["rule_segments"] = q(f"SELECT *, {RULE_SQL} AS rule_segment FROM features",
                             FEATURES_CTE)
ORACLES["rule_segment_profile"] = q(f"""
SELECT segment, customers, {', '.join(c for c in C.CLUSTER_FEATURES)},
       {npround('customers / sum(customers) OVER () * 100', 1)} AS share_pct
FROM (
  SELECT {RULE_SQL} AS segment, count(*) AS customers,
         {', '.join(f"{npround(f'avg({c})', 2)} AS {c}" for c in C.CLUSTER_FEATURES)}
  FROM features GROUP BY 1
)""", FEATURES_CTE)

_BANDS = [f"""SELECT '{name}' AS band, {i} AS position,
       count(*) FILTER (WHERE journeys_per_week > {lo} AND journeys_per_week <= {hi}) AS customers,
       round_even(avg(avg_satisfaction) FILTER (WHERE journeys_per_week > {lo}
           AND journeys_per_week <= {hi}) * 1000000.0, 0) / 1000000.0 AS satisfaction
FROM features""" for i, (name, lo, hi) in enumerate(C.ENGAGEMENT_BANDS)]
ORACLES["engagement_bands"] = q("\nUNION ALL\n".join(_BANDS), FEATURES_CTE)
ORACLES["frequency_histogram"] = q(f"""
SELECT e.bin, lo + e.bin * ((hi - lo) / 40.0) AS bin_start,
       lo + (e.bin + 1) * ((hi - lo) / 40.0) AS bin_end, coalesce(customers, 0) AS customers
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(40)) e
CROSS JOIN (SELECT {_P('journeys_per_week', 0.99)} AS hi, min(journeys_per_week) AS lo
            FROM features) edges
LEFT JOIN (
  SELECT CAST(CASE WHEN hi - lo > 0
                   THEN least(floor((least(journeys_per_week, hi) - lo) / (hi - lo) * 40), 39)
                   ELSE 0 END AS INTEGER) AS bin,
         count(*) AS customers
  FROM features, (SELECT {_P('journeys_per_week', 0.99)} AS hi,
                         min(journeys_per_week) AS lo FROM features) b
  GROUP BY 1
) g ON g.bin = e.bin
WHERE hi > lo OR (lo IS NOT NULL AND e.bin = 0)""", FEATURES_CTE)
ORACLES["top_customers"] = q("""
SELECT customer_id, assigned_segment, age_group, journeys, journeys_per_week, avg_satisfaction,
       complaint_rate, peak_share, digital_share, primary_mode, primary_channel
FROM features ORDER BY journeys DESC, customer_id LIMIT 200""", FEATURES_CTE)

_FEATS = list(C.CLUSTER_FEATURES)
ORACLES["standardised_features"] = q(
    "SELECT customer_id, " + ", ".join(
        npround(f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE {c} - m_{c} END", 6)
        + f" AS {c}" for c in _FEATS) + " FROM filled, mom",
    FEATURES_CTE + ",\nmed AS (SELECT "
    + ", ".join(f"{_P(f'CAST({c} AS DOUBLE)', 0.5)} AS {c}" for c in _FEATS)
    + " FROM features),\nfilled AS (SELECT f.customer_id, "
    + ", ".join(f"coalesce(CAST(f.{c} AS DOUBLE), med.{c}) AS {c}" for c in _FEATS)
    + " FROM features f, med),\nmom AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _FEATS)
    + " FROM filled)")


# ---------------------------------------------------------------------------
# Anomalies
# ---------------------------------------------------------------------------
from . import anomaly_sql as _A  # noqa: E402

ORACLES["anomaly_daily_frame"] = q("SELECT * FROM daily", _A.ctes("region", "rolling_z"))
for _name, _method in (("anomaly_baselines_z", "rolling_z"), ("anomaly_baselines_iqr", "iqr")):
    ORACLES[_name] = q(f"""
SELECT dimension_value, metric, period, journeys, scope_days,
       {npround('value', 6)} AS value, {npround('expected', 6)} AS expected,
       {npround('lower_bound', 6)} AS lower_bound, {npround('upper_bound', 6)} AS upper_bound,
       {npround('z_score', 6)} AS z_score
FROM base WHERE metric IN ({', '.join(f"'{m}'" for m in _A.SCAN)})
  AND period BETWEEN {d(C.DEFAULT_START)} AND {d(C.DEFAULT_END)}""", _A.ctes("region", _method))

for _name, _dim, _method in (("anomalies_region_z", "region", "rolling_z"),
                             ("anomalies_mode_z", "transport_mode", "rolling_z"),
                             ("anomalies_network_z", None, "rolling_z"),
                             ("anomalies_region_iqr", "region", "iqr")):
    _c, _b = _A.detections_sql(_dim, _method)
    ORACLES[_name] = q(_b, _c)

_c, _b = _A.detections_sql("region", "rolling_z", evidence=True)
ORACLES["anomaly_evidence_region"] = q(_b, _c)
_c, _b = _A.detections_sql("transport_mode", "iqr", adverse_only=True, evidence=True)
ORACLES["anomaly_evidence_mode"] = q(_b, _c)

_c, _b = _A.detections_sql("region", "rolling_z", adverse_only=True, limit=10)
ORACLES["anomalies_region_adverse"] = q(_b, _c)

_c, _b = _A.detections_sql("region", "rolling_z")
ORACLES["anomaly_companions"] = q(f"""
SELECT anomaly_metric, dimension_value, period, companion,
       {npround('actual', 6)} AS actual, {npround('baseline', 6)} AS baseline,
       {npround('chg', 6)} AS change_pct,
       coalesce(companion IN ('disruption_rate', 'complaint_rate', 'total_journeys')
                AND companion <> anomaly_metric AND chg IS NOT NULL AND abs(chg) >= 25, FALSE)
           AS noted
FROM (
  SELECT t.metric AS anomaly_metric, t.dimension_value, t.period, b.metric AS companion,
         b.value AS actual, b.mean AS baseline,
         CASE WHEN b.mean IS NOT NULL AND b.mean <> 0 AND b.value IS NOT NULL
              THEN (b.value - b.mean) / abs(b.mean) * 100.0 END AS chg
  FROM ({_b}) t JOIN base b ON b.dimension_value = t.dimension_value AND b.period = t.period
  WHERE b.metric IN ({', '.join(f"'{m}'" for m in C.COMPANION_METRICS)})
)""", _c)
ORACLES["anomaly_summary"] = q(f"""
SELECT count(*) AS total_detected, count(*) FILTER (WHERE adverse) AS adverse_detected,
       count(*) FILTER (WHERE severity = 'High') AS high_severity,
       coalesce(string_agg(DISTINCT scope, ', ' ORDER BY scope) FILTER (WHERE adverse), '')
           AS scopes_affected,
       min(period) AS first_period, max(period) AS last_period,
       (SELECT coalesce(string_agg(statement, ' | '
                                   ORDER BY abs(z_score) DESC, period DESC, metric, scope), '')
        FROM (SELECT * FROM ({_b}) WHERE adverse
              ORDER BY abs(z_score) DESC, period DESC, metric, scope LIMIT 5)) AS most_severe
FROM ({_b})""", _c)
ORACLES["anomaly_series"] = q(f"""
SELECT period, {npround('value', 6)} AS value, {npround('expected', 6)} AS expected,
       {npround('lower_bound', 6)} AS lower, {npround('upper_bound', 6)} AS upper,
       coalesce(abs(z_score) >= 2.5, FALSE) AS flagged
FROM base WHERE metric = 'avg_delay_minutes'
  AND period BETWEEN {d(C.DEFAULT_START)} AND {d(C.DEFAULT_END)}""",
    _A.ctes("region", "rolling_z", ("avg_delay_minutes",), "ASIA"))
ORACLES["anomaly_window_recall"] = q(f"""
SELECT w.dimension_value, w.metric, w.start_date, w.end_date,
       CAST(date_diff('day', w.start_date, w.end_date) + 1 AS BIGINT) AS window_days,
       count(DISTINCT t.period) FILTER (WHERE t.period BETWEEN w.start_date AND w.end_date)
           AS days_detected,
       count(DISTINCT t.period) FILTER (WHERE t.period NOT BETWEEN w.start_date AND w.end_date)
           AS days_outside,
       count(DISTINCT t.period) FILTER (WHERE t.period BETWEEN w.start_date AND w.end_date)
           / (date_diff('day', w.start_date, w.end_date) + 1) AS recall,
       CASE WHEN count(DISTINCT t.period) > 0 THEN
           count(DISTINCT t.period) FILTER (WHERE t.period BETWEEN w.start_date AND w.end_date)
           / count(DISTINCT t.period) END AS precision
FROM (SELECT 'ASIA' AS dimension_value, 'avg_delay_minutes' AS metric,
             DATE '2026-05-09' AS start_date, DATE '2026-05-20' AS end_date) w
LEFT JOIN ({_b}) t ON t.dimension_value = w.dimension_value AND t.metric = w.metric
GROUP BY 1, 2, 3, 4""", _c)


# ---------------------------------------------------------------------------
# Insights, reports, routing
# ---------------------------------------------------------------------------
from . import insight_sql as _I  # noqa: E402

_cmp_c, _cmp_b = compare_periods_sql(C.HEADLINE_KPIS)
ORACLES["insight_kpi_movement"] = q(_I.kpi_movement(_cmp_b), _cmp_c)
_mv_c, _mv_b = _I.movers(pop_sql)
ORACLES["insight_dimension_movers"] = q(_mv_b, _mv_c)
ORACLES["disruption_impact"] = q(_I.DISRUPTION)
ORACLES["peak_pressure"] = q(_I.PEAK)
ORACLES["complaint_concentration"] = q(_I.COMPLAINTS)
_adv_c, _adv_b = _A.detections_sql("region", "rolling_z", adverse_only=True, limit=20)
ORACLES["insight_top_anomaly"] = q(_I.top_anomaly(_adv_b), _adv_c)
_SUMMARY_BODY = ORACLES["dq_summary"].split(_PROF)[-1].strip()
ORACLES["insight_data_quality"] = q(_I.dq_notice(_SUMMARY_BODY), _PROF)

_ICOLS = "key, category, headline, detail, direction, importance, evidence"
_ALL_INSIGHTS = f"""
  SELECT {_ICOLS} FROM ({_I.kpi_movement(_cmp_b)})
  UNION ALL SELECT {_ICOLS} FROM ({_mv_b})
  UNION ALL SELECT {_ICOLS} FROM ({_I.DISRUPTION})
  UNION ALL SELECT {_ICOLS} FROM ({_I.PEAK})
  UNION ALL SELECT {_ICOLS} FROM ({_I.COMPLAINTS})
  UNION ALL SELECT {_ICOLS} FROM ({_I.top_anomaly(_adv_b)})
  UNION ALL SELECT {_ICOLS} FROM ({_I.dq_notice(_SUMMARY_BODY)})"""
_INSIGHT_CTES = ",\n".join([_cmp_c.strip(), _mv_c.strip(), _adv_c.strip(), _PROF])
ORACLES["insights_ranked"] = q(f"""
SELECT {_ICOLS} FROM ({_ALL_INSIGHTS}) ORDER BY importance DESC, key LIMIT 8""", _INSIGHT_CTES)

_FOUND10 = f"found AS (SELECT * FROM ({_ALL_INSIGHTS}) ORDER BY importance DESC, key LIMIT 10)"
_POPULATION_LINES = " UNION ALL ".join(
    f"SELECT 'population' AS section, CAST({i} AS BIGINT) AS position, "
    f"'{name}: ' || coalesce(CAST({expr} AS VARCHAR), 'none') AS text FROM an WHERE {WHERE_DEFAULT}"
    for i, (name, expr) in enumerate((
        ("journeys", "count(*)"), ("customers", "count(DISTINCT customer_id)"), ("regions", "count(DISTINCT region)"),
        ("modes", "count(DISTINCT transport_mode)"), ("service_lines", "count(DISTINCT service_line)"),
        ("first_date", "CAST(min(date) AS DATE)"), ("last_date", "CAST(max(date) AS DATE)"))))
ORACLES["report_kpi_summary"] = q(f"""
{_POPULATION_LINES}
UNION ALL
SELECT 'kpis', CAST(position AS BIGINT),
       CASE WHEN current IS NULL THEN printf('%s: no data', label)
            ELSE printf('%s: %.2f', label, {npround('current', 2)}) END
FROM ({_cmp_b})
UNION ALL
SELECT 'movements', CAST(row_number() OVER (ORDER BY abs(percent_change) DESC, position) - 1 AS BIGINT) AS place,
       printf('%s %+.2f %%', label, {npround('percent_change', 2)})
FROM ({_cmp_b}) WHERE abs(percent_change) >= 2 QUALIFY place < 3
UNION ALL
SELECT 'movements', CAST(0 AS BIGINT), 'no headline metric moved by 2 % or more'
WHERE NOT EXISTS (SELECT 1 FROM ({_cmp_b}) WHERE abs(percent_change) >= 2)""", _cmp_c)
ORACLES["brief_sections"] = q(f"""
{_POPULATION_LINES}
UNION ALL
SELECT 'current_performance' AS section, CAST(position AS BIGINT) AS position,
       CASE WHEN current IS NULL THEN printf('%s: no data', label)
            WHEN absolute_change IS NULL
                 THEN printf('%s: %.2f (no comparison period)', label, {npround('current', 2)})
            ELSE printf('%s: %.2f (%+.2f vs previous period)', label, {npround('current', 2)},
                        {npround('absolute_change', 2)}) END AS text
FROM ({_cmp_b})
UNION ALL
SELECT section, CAST(p - 1 AS BIGINT) AS position, text FROM (
  SELECT section, headline || ' ' || detail AS text,
         row_number() OVER (PARTITION BY section ORDER BY importance DESC, key) AS p
  FROM (SELECT *, unnest([
          CASE WHEN category IN ('Service performance', 'Demand', 'Customer experience')
               THEN 'key_changes' END,
          CASE WHEN direction = 'bad' THEN 'attention' END,
          CASE WHEN direction = 'good' THEN 'positives' END]) AS section FROM found)
  WHERE section IS NOT NULL)
WHERE p <= CASE section WHEN 'positives' THEN 4 ELSE 5 END""", _INSIGHT_CTES + ",\n" + _FOUND10)
ORACLES["report_top_issues"] = q(f"""
SELECT CAST(rank AS BIGINT) AS rank, {_ICOLS} FROM (
  SELECT *, row_number() OVER (ORDER BY direction <> 'bad', importance DESC, key) AS rank,
         max(CASE WHEN direction = 'bad' THEN 1 ELSE 0 END) OVER () AS has_bad
  FROM found)
WHERE rank <= 3 AND (has_bad = 0 OR direction = 'bad')""", _INSIGHT_CTES + ",\n" + _FOUND10)

ORACLES["report_kpi_movers"] = q(f"""
SELECT metric, label, current, previous, absolute_change, percent_change, direction
FROM ({_cmp_b}) WHERE percent_change IS NOT NULL AND abs(percent_change) >= 2
ORDER BY abs(percent_change) DESC, position LIMIT 3""", _cmp_c)

_k8 = tuple(METRICS)[:8]
_p8_c, _p8_b = compare_periods_sql(_k8)
ORACLES["report_period_changes"] = q(f"""
SELECT metric, label, current, previous, absolute_change, percent_change, direction, rank,
       abs(percent_change) >= 2 AND sum(CASE WHEN abs(percent_change) >= 2 THEN 1 ELSE 0 END)
           OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= 4 AS material
FROM (SELECT *, row_number() OVER (ORDER BY abs(percent_change) DESC, position) AS rank
      FROM ({_p8_b}) WHERE percent_change IS NOT NULL)""", _p8_c)


def _report_dim_sql(dim: str, focus: str | None) -> str:
    focus_sql = f"(bd.dimension_value = '{focus}')" if focus else "FALSE"
    return f"""
SELECT bd.*, mv2.move_current, mv2.move_previous, mv2.move_change, mv2.is_best, mv2.is_worst,
       {focus_sql} AS is_focus
FROM ({breakdown_sql(dim)}) bd
LEFT JOIN (
  SELECT dimension_value, current_value AS move_current, previous_value AS move_previous,
         absolute_change AS move_change,
         row_number() OVER (ORDER BY absolute_change DESC, abs(absolute_change) DESC,
                            dimension_value) = 1 AS is_best,
         row_number() OVER (ORDER BY absolute_change ASC, abs(absolute_change) DESC,
                            dimension_value) = 1 AS is_worst
  FROM ({pop_sql(dim, 'on_time_performance', 100)}) WHERE absolute_change IS NOT NULL
) mv2 ON mv2.dimension_value = bd.dimension_value"""


ORACLES["report_region"] = q(_report_dim_sql("region", "ASIA"))
ORACLES["report_mode"] = q(_report_dim_sql("transport_mode", None))
ORACLES["report_complaints"] = q(f"""
SELECT * FROM (
  SELECT dimension_value AS worst_mode, {npround('complaint_rate', 6)} AS worst_mode_complaint_rate,
         total_journeys AS worst_mode_journeys
  FROM ({breakdown_sql('transport_mode', ('total_journeys', 'complaint_rate'))})
  ORDER BY complaint_rate DESC, total_journeys DESC, dimension_value LIMIT 1
), (
  SELECT dimension_value AS top_reason,
         {npround('total_journeys / (SELECT sum(total_journeys) FROM bc) * 100', 6)}
             AS top_reason_share
  FROM bc ORDER BY total_journeys DESC, dimension_value LIMIT 1
)""", f"bc AS ({breakdown_sql('complaint_category', ('total_journeys',))})")
ORACLES["report_satisfaction"] = q(f"""
SELECT * FROM (
  SELECT dimension_value AS worst_segment, {npround('previous_value', 6)} AS worst_previous,
         {npround('current_value', 6)} AS worst_current,
         {npround('percent_change', 6)} AS worst_percent_change
  FROM u ORDER BY absolute_change, abs(absolute_change) DESC, dimension_value LIMIT 1
), (
  SELECT dimension_value AS best_segment, {npround('previous_value', 6)} AS best_previous,
         {npround('current_value', 6)} AS best_current,
         {npround('percent_change', 6)} AS best_percent_change
  FROM u ORDER BY absolute_change DESC, abs(absolute_change) DESC, dimension_value LIMIT 1
), (
  SELECT string_agg(printf('%s: %.2f (%d)', dimension_value, {npround('current_value', 2)}, current_journeys), '; '
                    ORDER BY dimension_value) AS current_levels
  FROM ({pop_sql('customer_segment', 'avg_satisfaction', 0)}) WHERE current_value IS NOT NULL
)""", f"u AS (SELECT * FROM ({pop_sql('customer_segment', 'avg_satisfaction', 100)}) "
      "WHERE absolute_change IS NOT NULL)")
ORACLES["route_questions"] = _I.routing_sql()
ORACLES["route_dimension_questions"] = q(_I.routing_sql("", _I.ASKED))
ORACLES["question_entities"] = q(_I.entities_sql(("region", "transport_mode", "customer_segment", "service_line")))

ORACLES["csv_roundtrip"] = ORACLES["canonical_feed"]
ORACLES["stored_feed"] = ORACLES["analytics_rows"]
ORACLES["upload_template"] = q(f"""
SELECT {', '.join('"timestamp"' if c == 'timestamp' else c for c in C.JOURNEY_COLUMNS)}
FROM journeys ORDER BY "timestamp" ASC NULLS LAST, journey_id LIMIT 300""")


# Preset selection resolved from the data bounds: "Last 90 days".
_PRESET_CTES = """
pb AS (SELECT min(date) AS lo, max(date) AS hi FROM an),
per AS (SELECT greatest(lo, hi - 89) AS s, hi AS e, greatest(lo, hi - 89) - 1 AS pe,
               greatest(lo, hi - 89) - 1 - CAST(hi - greatest(lo, hi - 89) AS INTEGER) AS ps
        FROM pb)"""
_PCUR, _PPREV = "date BETWEEN per.s AND per.e", "date BETWEEN per.ps AND per.pe"
ORACLES["kpi_compare_last_90_days"] = q(f"""
SELECT metric, position, label, unit, current, previous,
       current - previous AS absolute_change,
       {pct_sql('current', 'previous')} AS percent_change,
       {direction_sql('metric', 'current - previous')} AS direction
FROM long""", _PRESET_CTES + f""",
wide AS (SELECT {metrics(C.HEADLINE_KPIS, _PCUR, '__c')}, {metrics(C.HEADLINE_KPIS, _PPREV, '__p')}
         FROM an, per WHERE date BETWEEN per.ps AND per.e),
long AS ({_stack(C.HEADLINE_KPIS, {'current': '{k}__c', 'previous': '{k}__p'}, 'wide')})""")

ORACLES["customer_sample"] = q(f"""
SELECT *, {RULE_SQL} AS rule_segment FROM features
ORDER BY md5(customer_id), customer_id LIMIT 4000""", FEATURES_CTE)
ORACLES["disruption_comparison"] = q(f"""
SELECT service_disruption, count(*) AS journeys,
       {metrics(('complaint_rate', 'avg_satisfaction', 'avg_delay_minutes'))}
FROM an WHERE {WHERE_DEFAULT} AND service_disruption IS NOT NULL GROUP BY 1""")

# A period is no part of these: the same statements over every row.
_BREAKDOWN_NAMES = [name for name in ORACLES if name.startswith("metrics_by_")]
for _name in _BREAKDOWN_NAMES + """
kpi_all_metrics population_summary compare_segments segment_share
calendar_filled_daily rolling_7d series_by_dimension hourly_profile
weekday_profile heatmap_cells heatmap_matrix records_recent
records_longest_delay records_lowest_satisfaction records_search records_subset_counts
top_service_lines dq_checks dq_field_completeness dq_score
dq_summary dq_value_outliers dq_worst_check disruption_impact
peak_pressure complaint_concentration insight_data_quality report_complaints
disruption_comparison time_series_day time_series_week time_series_month
customer_features rule_segments rule_segment_profile engagement_bands
frequency_histogram top_customers standardised_features customer_sample
""".split():
    ORACLES[_name] = ORACLES[_name].replace(WHERE_DEFAULT, "TRUE")

# Metrics and rules defined by rows: the aggregates spelled out.
_DEFINED = {   # name -> (aggregate with {f} for a filter's condition, label, unit, lower is better, floor)
    "long_delay_rate": ("100.0 * count(*) FILTER (WHERE delay_minutes > 30 AND {f}) "
                        "/ nullif(count(*) FILTER (WHERE delay_minutes IS NOT NULL AND {f}), 0)",
                        "Delays Over 30 Minutes", "percent", True, 1.0),
    "disrupted_delay": ("avg(delay_minutes) FILTER (WHERE service_disruption AND {f})",
                        "Delay When Disrupted", "minutes", True, 0.5),
    "digital_customers": ("count(DISTINCT customer_id) FILTER (WHERE digital_interaction AND {f})",
                          "Customers Seen Online", "count", False, 0.0),
    "longest_delay": ("max(delay_minutes) FILTER (WHERE {f})", "Longest Delay", "minutes", True, 0.0),
    "weekend_journeys": ("count(*) FILTER (WHERE is_weekend AND {f})", "Journeys on Saturday or Sunday",
                         "count", False, 20.0),
    "resolved_share": ("100.0 * count(resolution_time_hours) FILTER (WHERE {f}) / nullif(count(*) FILTER (WHERE {f}), 0)",
                       "Journeys With a Resolution Time", "percent", False, 0.0),
}


def _defined(cond: str = "TRUE", suffix: str = "") -> str:
    return ", ".join(f"{m[0].format(f=cond)} AS {k}{suffix}" for k, m in _DEFINED.items())


ORACLES["defined_metrics"] = q(f"SELECT count(*) AS total_journeys, {_defined()} FROM an")
ORACLES["defined_metrics_by_region"] = q(f"""
SELECT * FROM (SELECT region AS dimension_value, count(*) AS total_journeys, {_defined()} FROM an GROUP BY 1)
WHERE dimension_value IS NOT NULL""")
ORACLES["defined_metrics_compare"] = q(f"""
SELECT metric, position, label, unit, current, previous, current - previous AS absolute_change,
       {pct_sql('current', 'previous')} AS percent_change,
       CASE WHEN current - previous IS NULL OR abs(current - previous) < 1e-9 THEN 'flat'
            WHEN (current < previous) = lower THEN 'good' ELSE 'bad' END AS direction
FROM ({" UNION ALL ".join(
    f"SELECT '{k}' AS metric, {i} AS position, '{m[1]}' AS label, '{m[2]}' AS unit, {str(m[3]).upper()} AS lower, "
    f"CAST({k}__c AS DOUBLE) AS current, CAST({k}__p AS DOUBLE) AS previous FROM wide"
    for i, (k, m) in enumerate(_DEFINED.items()))})""",
    f"wide AS (SELECT {_defined(CUR, '__c')}, {_defined(PREV, '__p')} FROM an WHERE {SCAN2})")
_c, _b = _A.detections_sql(
    "transport_mode", "rolling_z",
    more={k: (m[0].format(f="TRUE"), m[1], m[3], m[4]) for k, m in _DEFINED.items()},
    scan=("long_delay_rate", "disrupted_delay", "weekend_journeys", "avg_delay_minutes"))
ORACLES["defined_metrics_anomalies"] = q(_b, _c)

_USER_CHECKS = [
    ("slow_resolution", "Resolution slower than two days", "Validity", 9, "resolution_time_hours > 48"),
    ("complaint_uncategorised", "Complaint without a category", "Completeness", 10,
     "complaint_flag AND complaint_category IS NULL"),
]
ORACLES["defined_rules_checks"] = q("""
SELECT *, failed_rows = 0 AS passed,
       CASE WHEN failure_rate = 0 THEN 'Pass' WHEN failure_rate < 0.5 THEN 'Low'
            WHEN failure_rate < 2.0 THEN 'Medium' ELSE 'High' END AS severity
FROM (SELECT * FROM chk2 UNION ALL """ + " UNION ALL ".join(
    f"SELECT '{k}', '{label}', '{cat}', {i}, count(*) FILTER (WHERE {p}), count(*), "
    f"CASE WHEN count(*) = 0 THEN 0.0 ELSE count(*) FILTER (WHERE {p}) / count(*) * 100.0 END FROM raw_j"
    for k, label, cat, i, p in _USER_CHECKS) + ")", _CHECKS_CTE.replace(WHERE_DEFAULT, "TRUE"))
_families = {cat: "greatest(0.0, 100.0 - (" + " + ".join(
    [_rate_sql(k) for k, _, c, _ in _CHECKS if c == cat] + [_rate_sql(k) for k, _, c, _, _ in _USER_CHECKS if c == cat])
    + "))" for cat in ("Completeness", "Validity", "Uniqueness")}
ORACLES["defined_rules_score"] = q(f"""
SELECT completeness_score, validity_score, uniqueness_score, quality_score,
       CASE WHEN quality_score >= 97 THEN 'Good' WHEN quality_score >= 92 THEN 'Acceptable'
            ELSE 'Needs attention' END AS rating, completeness_pct
FROM (SELECT *, {npround("completeness_score * 0.4 + validity_score * 0.4 + uniqueness_score * 0.2", 1)} AS quality_score,
             CASE WHEN total_rows = 0 THEN 100.0 ELSE ({' + '.join(f'present_{c} / total_rows * 100.0' for c in _UNCOND)})
               / {float(len(_UNCOND))} END AS completeness_pct
      FROM (SELECT *, {_families['Completeness']} AS completeness_score, {_families['Validity']} AS validity_score,
                   {_families['Uniqueness']} AS uniqueness_score
            FROM (SELECT prof.*, {', '.join(f"(SELECT count(*) FILTER (WHERE {p}) FROM raw_j) AS {k}"
                                            for k, _, _, _, p in _USER_CHECKS)} FROM prof)))""",
    _PROF.replace(WHERE_DEFAULT, "TRUE"))

# The K-means fit held against its definition, and the crosstab's column sums.
ORACLES["kmeans_fit_check"] = f"""
SELECT CAST(4 AS INTEGER) AS k, count(*) AS customers, CAST(4 AS BIGINT) AS clusters,
       CAST(0 AS BIGINT) AS misplaced, TRUE AS centres_settled, TRUE AS cost_agrees
FROM ({ORACLES['customer_features']}) f"""
ORACLES["cluster_rule_totals"] = f"""
SELECT names.rule_segment, count(f.rule_segment) AS customers
FROM (SELECT unnest(['Frequent Commuters', 'Occasional Travellers', 'Off-Peak Regulars',
                     'Digital-First Customers', 'High-Service-Need Customers'])
             AS rule_segment) names
LEFT JOIN ({ORACLES['rule_segments']}) f ON f.rule_segment = names.rule_segment
GROUP BY 1"""
ORACLES["weekday_band_delay"] = q(f"""
SELECT day_of_week, time_band, journeys, {npround('delay', 6)} AS avg_delay_minutes,
       {npround('punctual', 6)} AS on_time_performance,
       {npround('sum(delay * journeys) OVER () / sum(journeys) OVER ()', 6)} AS overall_delay
FROM (SELECT day_of_week, time_band, count(*) AS journeys, avg(delay_minutes) AS delay,
             100.0 * count(*) FILTER (WHERE on_time) / count(on_time) AS punctual
      FROM an GROUP BY ALL HAVING count(*) >= 100)""")

# The fits replayed step by step, on the same matrix (standardised to six places).
from . import cluster_sql as _K  # noqa: E402

_STD = ORACLES["standardised_features"]
ORACLES["kmeans_profile"] = _K.profile(_STD, ORACLES["customer_features"])
ORACLES["kmeans_silhouette"] = _K.silhouette(_STD)
ORACLES["kmeans_elbow"] = _K.elbow(_STD)
ORACLES["cluster_rule_crosstab"] = _K.crosstab(_STD, ORACLES["rule_segments"])

# The same statements for the queries that read the daily rollup.
for _name in ("kpi_period_compare", "insights_ranked"):
    ORACLES[f"{_name}_rollup"] = ORACLES[_name]
