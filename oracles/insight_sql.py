"""DuckDB spellings of the insight generators, reports and routing."""

from __future__ import annotations

from wayfarer import config as C
from wayfarer.functions.metrics import METRICS
from wayfarer.operators.insights import MOVER_CONFIGS

from . import anomaly_sql as A
from .sqlkit import WHERE_DEFAULT, metrics, npround

POINTS = ", ".join(f"'{k}'" for k in METRICS if METRICS[k].compare_as_points)


def evidence(texts: dict[str, str], counts: dict[str, str], numbers: dict[str, str]) -> str:
    """A JSON object of the figures; numbers with 6 decimals."""
    members = [f"""'"{k}":' || coalesce(CAST(to_json({v}) AS VARCHAR), 'null')"""
               for k, v in texts.items()]
    members += [f"""'"{k}":' || coalesce(CAST({v} AS VARCHAR), 'null')""" for k, v in counts.items()]
    members += [f"""'"{k}":' || coalesce(printf('%.6f', {npround(v, 6)}), 'null')"""
                for k, v in numbers.items()]
    return "'{' || " + " || ',' || ".join(members) + " || '}' AS evidence"


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def kpi_movement(compare_body: str) -> str:
    return f"""
SELECT 'kpi_' || metric AS key,
       CASE WHEN unit = 'count' THEN 'Demand' ELSE 'Service performance' END AS category,
       printf('%s %s by %s against the previous period.', label,
              CASE WHEN absolute_change > 0 THEN 'increased' ELSE 'decreased' END,
              CASE WHEN metric IN ({POINTS})
                   THEN printf('%.1f percentage points', {npround('abs(absolute_change)', 1)})
                   ELSE printf('%.1f%%', {npround('abs(percent_change)', 1)}) END) AS headline,
       direction, {npround('least(abs(percent_change) / 10.0, 3.0)', 6)} AS importance,
       printf('%s is %.2f, against %.2f in the previous period.', label, {npround('current', 2)},
              {npround('previous', 2)}) AS detail,
       {evidence(_same('metric', 'unit'), {},
                 _same('current', 'previous', 'absolute_change', 'percent_change'))}
FROM ({compare_body})
WHERE absolute_change IS NOT NULL AND percent_change IS NOT NULL AND abs(percent_change) >= 3.0"""


def movers(pop_sql) -> tuple[str, str]:
    ctes, bodies = [], []
    for i, (dim, metric, category, noun) in enumerate(MOVER_CONFIGS):
        spec = METRICS[metric]
        imp = "-absolute_change" if spec.lower_is_better else "absolute_change"
        ctes.append(f"""
mv{i} AS ({pop_sql(dim, metric, 100)}),
pk{i} AS (
  SELECT *, row_number() OVER (ORDER BY -imp, -abs(absolute_change), dimension_value) AS rb,
            row_number() OVER (ORDER BY imp, -abs(absolute_change), dimension_value) AS rw
  FROM (SELECT *, {imp} AS imp FROM mv{i}
        WHERE current_value IS NOT NULL AND previous_value IS NOT NULL)
),
bo{i} AS (SELECT TRUE AS is_best, * FROM pk{i} WHERE rb = 1
          UNION ALL SELECT FALSE AS is_best, * FROM pk{i} WHERE rw = 1)""")
        mag = (f"printf('%.1f percentage points', {npround('abs(absolute_change)', 1)})"
               if spec.compare_as_points else
               f"printf('%.1f%%', {npround('abs(percent_change)', 1)})")
        bodies.append(f"""
SELECT '{dim}_{metric}_' || CASE WHEN is_best THEN 'best' ELSE 'worst' END AS key,
       '{category}' AS category,
       printf('%s recorded the largest %s in {spec.label.lower()} among {noun}, which %s by %s.',
              dimension_value, CASE WHEN is_best THEN 'improvement' ELSE 'deterioration' END,
              CASE WHEN absolute_change > 0 THEN 'increased' ELSE 'decreased' END, {mag})
           AS headline,
       CASE WHEN is_best THEN 'good' ELSE 'bad' END AS direction,
       {npround('least(abs(percent_change) / 8.0, 3.0)', 6)} AS importance,
       dimension_value, {npround('current_value', 6)} AS current,
       {npround('previous_value', 6)} AS previous, current_journeys,
       printf('%s went from %.2f to %.2f over %d journeys.', dimension_value,
              {npround('previous_value', 2)}, {npround('current_value', 2)}, current_journeys)
           AS detail,
       {evidence(_same('dimension_value'), _same('current_journeys'),
                 {'current': 'current_value', 'previous': 'previous_value',
                  'percent_change': 'percent_change'})}
FROM bo{i}
WHERE abs(absolute_change) >= 1e-6 AND percent_change IS NOT NULL AND abs(percent_change) >= 3.0""")
    return ",".join(c.rstrip() for c in ctes), "\nUNION ALL\n".join(bodies)


_DIS_KEYS = ("complaint_rate", "avg_satisfaction", "avg_delay_minutes")
DISRUPTION = f"""
SELECT 'disruption_impact' AS key, 'Operations' AS category,
       printf('Complaint rates were %.1fx higher on journeys affected by a service disruption.',
              {npround('mult', 1)}) AS headline,
       CASE WHEN mult > 1.2 THEN 'bad' ELSE 'neutral' END AS direction,
       {npround('least(mult, 3.0)', 6)} AS importance,
       {npround('d_rate', 6)} AS disrupted_complaint_rate,
       {npround('n_rate', 6)} AS baseline_complaint_rate,
       {npround('mult', 2)} AS multiplier, {npround('gap', 6)} AS satisfaction_gap,
       {npround('avg_delay_minutes_d', 6)} AS disrupted_avg_delay,
       {npround('avg_delay_minutes_n', 6)} AS baseline_avg_delay,
       disrupted_journeys, baseline_journeys,
       printf('The complaint rate is %.1f%% on %d disrupted journeys and %.1f%% on %d others.',
              {npround('d_rate', 1)}, disrupted_journeys, {npround('n_rate', 1)},
              baseline_journeys) AS detail,
       {evidence({}, _same('disrupted_journeys', 'baseline_journeys'),
                 {'disrupted_complaint_rate': 'd_rate', 'baseline_complaint_rate': 'n_rate',
                  'multiplier': 'mult', 'satisfaction_gap': 'gap',
                  'disrupted_avg_delay': 'avg_delay_minutes_d',
                  'baseline_avg_delay': 'avg_delay_minutes_n'})}
FROM (
  SELECT *, d_rate / n_rate AS mult FROM (
    SELECT *, coalesce(complaint_rate_d, 0.0) AS d_rate, coalesce(complaint_rate_n, 0.0) AS n_rate,
           coalesce(avg_satisfaction_n, 0.0) - coalesce(avg_satisfaction_d, 0.0) AS gap
    FROM (
      SELECT count(*) FILTER (WHERE service_disruption) AS disrupted_journeys,
             count(*) FILTER (WHERE NOT service_disruption) AS baseline_journeys,
             {metrics(_DIS_KEYS, 'service_disruption', '_d')},
             {metrics(_DIS_KEYS, 'NOT service_disruption', '_n')}
      FROM an WHERE {WHERE_DEFAULT})))
WHERE disrupted_journeys >= 100 AND baseline_journeys > 0 AND n_rate > 0"""

_DAYS = "['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday']"
PEAK = f"""
SELECT 'peak_pressure' AS key, 'Operations' AS category,
       printf('%s %s delay levels exceeded the period baseline.', {_DAYS}[day_of_week + 1],
              lower(time_band)) AS headline,
       'bad' AS direction,
       {npround('least((avg_delay_minutes / overall_delay - 1) * 4, 3.0)', 6)} AS importance,
       {_DAYS}[day_of_week + 1] AS day, time_band,
       {npround('avg_delay_minutes', 6)} AS avg_delay_minutes,
       {npround('overall_delay', 6)} AS period_average_delay_minutes,
       {npround('avg_delay_minutes / overall_delay', 6)} AS ratio, journeys,
       printf('Delay averages %.1f minutes there over %d journeys, %.2f times the period average '
              || 'of %.1f.', {npround('avg_delay_minutes', 1)}, journeys,
              {npround('avg_delay_minutes / overall_delay', 2)}, {npround('overall_delay', 1)})
           AS detail,
       {evidence({'day': _DAYS + '[day_of_week + 1]', 'time_band': 'time_band'}, _same('journeys'),
                 {'avg_delay_minutes': 'avg_delay_minutes',
                  'period_average_delay_minutes': 'overall_delay',
                  'ratio': 'avg_delay_minutes / overall_delay'})}
FROM (
  SELECT * FROM (
    SELECT *, sum(avg_delay_minutes * journeys) OVER () / sum(journeys) OVER () AS overall_delay
    FROM (
      SELECT day_of_week, time_band, count(*) AS journeys,
             {metrics(('avg_delay_minutes', 'on_time_performance'))}
      FROM an WHERE {WHERE_DEFAULT} GROUP BY 1, 2 HAVING count(*) >= 100))
  ORDER BY avg_delay_minutes DESC, day_of_week ASC, time_band ASC LIMIT 1)
WHERE overall_delay IS NOT NULL AND overall_delay > 0 AND avg_delay_minutes > overall_delay * 1.15"""

COMPLAINTS = f"""
SELECT 'complaint_concentration' AS key, 'Customer experience' AS category,
       printf('''%s'' accounts for %.0f%% of all complaints in the selected population.',
              complaint_category, {npround('share_pct', 0)}) AS headline,
       'neutral' AS direction, {npround('least(share_pct / 20.0, 2.5)', 6)} AS importance,
       complaint_category AS top_category, complaints AS top_complaints, total_complaints,
       {npround('share_pct', 1)} AS share_pct,
       printf('%d of %d complaints that name a category.', complaints, total_complaints) AS detail,
       {evidence({'top_category': 'complaint_category'},
                 {'top_complaints': 'complaints', 'total_complaints': 'total_complaints'},
                 _same('share_pct'))}
FROM (
  SELECT *, CAST(sum(complaints) OVER () AS BIGINT) AS total_complaints,
         complaints / sum(complaints) OVER () * 100.0 AS share_pct
  FROM (SELECT complaint_category, count(*) AS complaints FROM an
        WHERE {WHERE_DEFAULT} AND complaint_flag AND complaint_category IS NOT NULL GROUP BY 1)
  ORDER BY complaints DESC, complaint_category LIMIT 1)
WHERE total_complaints >= 100 AND share_pct >= 20"""


def top_anomaly(adverse20_body: str) -> str:
    return f"""
SELECT 'top_anomaly' AS key, 'Service performance' AS category, statement AS headline,
       'bad' AS direction, {npround('least(abs(z_score) / 2.0, 3.0)', 6)} AS importance,
       metric, scope, period, z_score, severity,
       printf('A %s deviation of %s in %s: z score %.2f.', severity, metric, scope,
              {npround('z_score', 2)}) AS detail,
       {evidence(_same('metric', 'scope', 'severity') | {'period': 'CAST(period AS VARCHAR)'}, {},
                 _same('z_score'))}
FROM ({adverse20_body}) ORDER BY abs(z_score) DESC, period DESC, metric, scope LIMIT 1"""


def dq_notice(summary_body: str) -> str:
    return f"""
SELECT 'data_quality' AS key, 'Data quality' AS category,
       printf('%d of %d rows (%.2f%%) were excluded from analysis by validity rules.',
              excluded_rows, total_rows, {npround('pct', 2)}) AS headline,
       CASE WHEN pct > 1 THEN 'bad' ELSE 'neutral' END AS direction,
       {npround('least(pct, 1.5)', 6)} AS importance,
       excluded_rows, total_rows, quality_score, rating,
       {npround('completeness_pct', 6)} AS completeness_pct,
       printf('Quality is rated %s (%.1f), completeness is %.1f%%.', rating,
              {npround('CAST(quality_score AS DOUBLE)', 1)}, {npround('completeness_pct', 1)})
           AS detail,
       {evidence(_same('rating'), _same('excluded_rows', 'total_rows'),
                 {'quality_score': 'CAST(quality_score AS DOUBLE)',
                  'completeness_pct': 'completeness_pct'})}
FROM (SELECT *, excluded_rows / total_rows * 100.0 AS pct FROM ({summary_body}))
WHERE total_rows > 0 AND NOT (pct < 0.1 AND completeness_pct > 99.5)"""


USER_TURNS = "SELECT conv_id, turn, text AS question FROM conversations WHERE role = 'user'"
ASKED = """SELECT DISTINCT 'How do ' || customer_segment || ' in the ' || region || ' region rate the '
              || transport_mode || ', and where is satisfaction falling?' AS question FROM an
WHERE region IS NOT NULL AND transport_mode IS NOT NULL AND customer_segment IS NOT NULL"""


def entities_sql(columns) -> str:
    """Whole-word terms found by every run of words of a question; none inside a longer one."""
    word = r"[\p{L}\p{N}_]"
    terms = " UNION ".join(f"SELECT '{c}' AS kind, {c} AS value FROM an WHERE {c} IS NOT NULL" for c in columns)
    return f"""
SELECT question, kind, value, CAST(i // 2 + 1 AS BIGINT) AS first_word, CAST((n + 1) // 2 AS BIGINT) AS n_words
FROM (
  WITH term AS (SELECT DISTINCT kind, value FROM ({terms})),
  cut AS (SELECT question, regexp_extract_all(lower(question), '{word}+|[^{word[1:]}+') AS p FROM ({ASKED})),
  place AS (SELECT question, p, unnest(range(0, len(p))) AS i FROM cut),
  run AS (SELECT question, i, n, array_to_string(p[i + 1:i + n], '') AS held
          FROM (SELECT *, unnest(range(1, 12, 2)) AS n FROM place WHERE regexp_matches(p[i + 1], '^{word}'))
          WHERE i + n <= len(p)),
  hit AS (SELECT run.*, kind, value FROM run JOIN term ON held = lower(value))
  SELECT * FROM hit WHERE NOT EXISTS (
    SELECT 1 FROM hit h WHERE h.question = hit.question AND h.n > hit.n AND h.i <= hit.i AND h.i + h.n >= hit.i + hit.n))"""


def routing_sql(keys: str = "conv_id, turn, ", questions: str = USER_TURNS) -> str:
    scores = []
    for name, kws in C.ROUTING_TOOLS:
        terms = " + ".join(f"(CASE WHEN instr(low, '{k}') > 0 THEN {len(k)} ELSE 0 END)"
                           for k in kws)
        found = ", ".join(f"CASE WHEN instr(low, '{k}') > 0 THEN '{k}' END" for k in kws)
        scores.append((name, f"({terms})", f"concat_ws(', ', {found})"))
    cols = ",\n         ".join(f"{expr} AS s_{i}, {found} AS m_{i}"
                               for i, (_, expr, found) in enumerate(scores))
    best = f"greatest({', '.join(f's_{i}' for i in range(len(scores)))})"
    winner = "CASE " + " ".join(f"WHEN s_{i} = best THEN '{n}'"
                                for i, (n, _, _) in enumerate(scores)) + " END"
    matched = "CASE " + " ".join(f"WHEN s_{i} = best THEN m_{i}" for i in range(len(scores))) + " END"
    word = r"[^\p{L}\p{N}_]"

    def first(terms):
        return "CASE " + " ".join(
            f"WHEN regexp_matches(low, '(^|{word}){t.lower()}({word}|$)') THEN '{t}'"
            for t in terms) + " END"
    hits = ", ".join(
        "CASE WHEN " + " OR ".join(f"instr(low, '{t}') > 0" for t in toks) + f" THEN '{seg}' END"
        for seg, toks in C.SEGMENT_TOKENS)
    return f"""
SELECT {keys}question,
       CASE WHEN low = '' OR best = 0 THEN '{C.DEFAULT_TOOL}'
            WHEN segs[2] IS NOT NULL THEN 'compare_segments' ELSE winner END AS tool,
       CASE WHEN low = '' THEN 0 ELSE best END AS score,
       CASE WHEN low = '' OR best = 0 THEN '' ELSE matched END AS matched_terms,
       CASE WHEN low = '' THEN NULL ELSE region END AS region,
       CASE WHEN low = '' THEN NULL ELSE transport_mode END AS transport_mode,
       CASE WHEN low = '' THEN NULL ELSE segs[1] END AS segment_a,
       CASE WHEN low = '' THEN NULL ELSE segs[2] END AS segment_b
FROM (
  SELECT *, {winner} AS winner, {matched} AS matched FROM (
    SELECT *, {best} AS best FROM (
      SELECT {keys}question, low,
             {cols},
             {first(C.REGIONS)} AS region,
             {first(C.TRANSPORT_MODES)} AS transport_mode,
             list_filter([{hits}], lambda x: x IS NOT NULL) AS segs
      FROM (SELECT *, trim(lower(coalesce(question, ''))) AS low FROM ({questions})))))"""
