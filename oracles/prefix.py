"""DuckDB spelling of the testdata adapter and the two views.

Every oracle query is ``WITH <prefix>, ... SELECT ...`` over the driver's
pre-registered tables. ``raw_j`` = enriched raw rows (no dimensions);
``an`` = analysable rows (validity, then one row per journey_id).
"""

from __future__ import annotations

MODES = "['Metro', 'Train', 'Bus', 'Light Rail', 'Ferry']"

ADAPTER = """
_nr AS (
  SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
_base AS (
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, l.l_linenumber AS ln,
         CAST(l.l_quantity AS BIGINT) AS q, l.l_returnflag AS rf,
         datediff('day', DATE '1995-01-01', CAST(l.l_shipdate AS DATE)) % 200 AS off,
         (l.l_partkey % 40) = 0 AS disr,
         o.o_custkey AS ck, o.o_orderpriority AS prio, c.c_mktsegment AS mkt, nr.r_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN _nr nr ON c.c_nationkey = nr.n_nationkey
),
_b2 AS (
  SELECT *,
    ((rf = 'R' AND q > 45) OR (disr AND q % 3 = 0)) AS cf,
    CASE WHEN ok % 700 = 17 THEN CAST(999.0 AS DOUBLE)
         ELSE CAST(q % 12 AS DOUBLE) * CAST(0.5 AS DOUBLE)
              + CASE WHEN disr THEN CAST(12.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
              + CASE WHEN r_name = 'ASIA' AND off BETWEEN 147 AND 158
                     THEN CAST(6.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
    END AS delay,
    DATE '2025-12-13' + CAST(off AS INTEGER) AS d
  FROM _base
),
_feed1 AS (
  SELECT
    'J' || CAST(ok AS VARCHAR) || '-' || CAST(ln AS VARCHAR) || '-' || CAST(pk AS VARCHAR)
        || '-' || CAST(sk AS VARCHAR) AS journey_id,
    CASE WHEN ok % 500 = 7 THEN NULL ELSE 'C' || CAST(ck AS VARCHAR) END AS customer_id,
    d AS date,
    CASE WHEN ok % 250 = 3 THEN NULL ELSE r_name END AS region,
    CASE WHEN ok % 600 = 11 THEN 'UNKNOWN'
         ELSE ['Metro', 'Train', 'Bus', 'Light Rail', 'Ferry'][CAST(pk % 5 AS INTEGER) + 1] END
        AS transport_mode,
    CASE mkt WHEN 'AUTOMOBILE' THEN 'Frequent Commuters'
             WHEN 'BUILDING' THEN 'Occasional Travellers'
             WHEN 'FURNITURE' THEN 'Off-Peak Regulars'
             WHEN 'HOUSEHOLD' THEN 'Digital-First Customers'
             ELSE 'High-Service-Need Customers' END AS customer_segment,
    delay AS delay_minutes,
    CASE WHEN ok % 22 = 1 THEN CAST(NULL AS DOUBLE)
         WHEN ok % 650 = 2 THEN CAST(7.0 AS DOUBLE)
         WHEN delay > 12 THEN CAST(1.0 AS DOUBLE) WHEN delay > 5 THEN CAST(2.0 AS DOUBLE)
         WHEN delay > 4 THEN CAST(3.0 AS DOUBLE) WHEN delay > 2 THEN CAST(4.0 AS DOUBLE)
         ELSE CAST(5.0 AS DOUBLE) END AS customer_satisfaction,
    CAST(d AS TIMESTAMP) + to_minutes(CAST(((pk * 7 + ln) % 19 + 5) * 60 + sk % 60 AS BIGINT))
        AS "timestamp",
    r_name AS origin_region,
    CASE WHEN ln % 2 = 0 THEN 'ASIA' ELSE r_name END AS destination_region,
    'L' || CAST(sk % 48 AS VARCHAR) AS service_line,
    ['Commute', 'Education', 'Business', 'Leisure', 'Healthcare', 'Shopping', 'Other']
        [CAST(sk % 7 AS INTEGER) + 1] AS journey_purpose,
    ['16-24', '25-34', '35-49', '50-64', '65+'][CAST(ck % 5 AS INTEGER) + 1] AS age_group,
    CASE prio WHEN '1-URGENT' THEN 'Contact Centre' WHEN '2-HIGH' THEN 'Mobile App'
              WHEN '3-MEDIUM' THEN 'Website' WHEN '5-LOW' THEN 'Station Kiosk'
              ELSE 'Third-Party App' END AS channel,
    CASE WHEN ok % 800 = 5 THEN CAST(-12.0 AS DOUBLE) WHEN ok % 900 = 9 THEN CAST(300.0 AS DOUBLE)
         ELSE CAST(10 + 2 * q AS DOUBLE) END AS journey_duration_minutes,
    delay <= 5.0 AS on_time,
    cf AS complaint_flag,
    CASE WHEN NOT cf THEN NULL WHEN disr THEN 'Information & Wayfinding'
         WHEN ln <= 3 THEN 'Delay' WHEN ln <= 5 THEN 'Crowding' ELSE 'Cleanliness' END
        AS complaint_category,
    CASE WHEN cf THEN CAST(q AS DOUBLE) * CAST(1.5 AS DOUBLE) END AS resolution_time_hours,
    ck % 3 <> 0 AS repeat_customer,
    disr AS service_disruption,
    (ck % 11 = 0 AND ln <= 3) AS accessibility_service_used,
    ['Student', 'Adult', 'Concession', 'Visitor', 'Senior'][CAST(ck % 5 AS INTEGER) + 1]
        AS fare_type,
    (sk % 10) < (ck % 10) AS digital_interaction,
    CASE WHEN delay > 8 THEN 'Negative - Delay' WHEN delay > 5 THEN 'Negative - Information'
         WHEN delay > 2 THEN 'Neutral' ELSE 'Positive - Reliability' END
        AS feedback_text_category,
    ok
  FROM _b2
),
journeys AS (
  SELECT * EXCLUDE (ok) FROM _feed1
  UNION ALL
  SELECT * EXCLUDE (ok) FROM _feed1 WHERE ok % 400 = 13
)"""

# Later columns use earlier ones of the same select by name.
DERIVED = """
    CAST(hour(j."timestamp") AS INTEGER) AS journey_hour,
    CAST(dayofweek(j.date) AS INTEGER) AS day_of_week,
    coalesce(day_of_week IN (0, 6), FALSE) AS is_weekend,
    CASE WHEN is_weekend THEN 'Weekend'
         WHEN journey_hour BETWEEN 7 AND 9 THEN 'AM Peak'
         WHEN journey_hour BETWEEN 16 AND 18 THEN 'PM Peak'
         ELSE 'Off-Peak' END AS time_band,
    time_band IN ('AM Peak', 'PM Peak') AS is_peak,
    j.date - CAST(isodow(j.date) - 1 AS INTEGER) AS week_start,
    j.date - CAST(day(j.date) - 1 AS INTEGER) AS month_start"""

# The six attributes that a feed without dimension tables leaves empty.
NULL_DIMS = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in (
    ("customer_home_region", "VARCHAR"), ("digital_affinity", "DOUBLE"),
    ("customer_first_seen_date", "DATE"), ("line_reliability_index", "DOUBLE"),
    ("line_capacity_index", "DOUBLE"), ("line_scheduled_minutes", "DOUBLE")))

# FIXED VALUES: what makes a row analysable: column, least, whether the least itself is in, most
# (in), and whether a missing value is in.
RANGES = (
    ("delay_minutes", 0, True, 180, False),
    ("journey_duration_minutes", 0, False, 240, True),
    ("customer_satisfaction", 1, True, 5, True),
)
KNOWN_MODES = ("Metro", "Train", "Bus", "Light Rail", "Ferry")


def valid() -> str:
    """The predicate of an analysable row."""
    terms = ["journey_id IS NOT NULL", f"transport_mode IN {KNOWN_MODES}"]
    for column, low, inclusive, high, missing in RANGES:
        inside = f"{column} {'>=' if inclusive else '>'} {low} AND {column} <= {high}"
        terms.append(f"({column} IS NULL OR ({inside}))" if missing else f"({column} IS NOT NULL AND {inside})")
    return " AND ".join(terms)


# Columns of the canonical feed after journey_id / timestamp / date, in order:
# the dedup tie-break.
_TIE = ("customer_id, region, transport_mode, customer_segment, delay_minutes, "
        "customer_satisfaction, origin_region, destination_region, service_line, "
        "journey_purpose, age_group, channel, journey_duration_minutes, on_time, "
        "complaint_flag, complaint_category, resolution_time_hours, repeat_customer, "
        "service_disruption, accessibility_service_used, fare_type, digital_interaction, "
        "feedback_text_category")
TIE_BREAK = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in _TIE.split(","))

VIEWS = f"""
raw_j AS (
  SELECT j.*,{DERIVED},
    {NULL_DIMS}
  FROM journeys j
),
an AS (
  SELECT * FROM raw_j
  WHERE {valid()}
  QUALIFY row_number() OVER (
    PARTITION BY journey_id
    ORDER BY "timestamp" ASC NULLS LAST, date ASC NULLS LAST, {TIE_BREAK}) = 1
)"""

PREFIX = "WITH " + ADAPTER.strip() + ",\n" + VIEWS.strip()


def q(body: str, extra_ctes: str = "") -> str:
    """Full oracle statement: prefix, optional extra CTEs, final SELECT."""
    ctes = f",\n{extra_ctes.strip()}" if extra_ctes.strip() else ""
    return f"{PREFIX}{ctes}\n{body.strip()}"
