"""Thresholds, vocabularies and allow-lists.

Everything here is a fixed value that must equal the analytical definitions the
engine reproduces; nothing is derived. Operators import from this module instead
of re-stating literals.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# FIXED VALUES - canonical journey schema (column order matters)
# ---------------------------------------------------------------------------
REQUIRED_COLUMNS = (
    "journey_id", "customer_id", "date", "region", "transport_mode",
    "customer_segment", "delay_minutes", "customer_satisfaction",
)
OPTIONAL_COLUMNS = (
    "timestamp", "origin_region", "destination_region", "service_line",
    "journey_purpose", "age_group", "channel", "journey_duration_minutes",
    "on_time", "complaint_flag", "complaint_category", "resolution_time_hours",
    "repeat_customer", "service_disruption", "accessibility_service_used",
    "fare_type", "digital_interaction", "feedback_text_category",
)
JOURNEY_COLUMNS = REQUIRED_COLUMNS + OPTIONAL_COLUMNS
NUMERIC_COLUMNS = (
    "journey_duration_minutes", "delay_minutes", "customer_satisfaction",
    "resolution_time_hours",
)
BOOLEAN_COLUMNS = (
    "on_time", "complaint_flag", "repeat_customer", "service_disruption",
    "accessibility_service_used", "digital_interaction",
)
DATE_COLUMNS = ("date",)
TIMESTAMP_COLUMNS = ("timestamp",)

# Texts accepted for booleans when a feed arrives as text; anything else is NULL.
# FIXED VALUES
BOOLEAN_TRUE_TEXTS = ("true", "True", "TRUE", "1", "yes")
BOOLEAN_FALSE_TEXTS = ("false", "False", "FALSE", "0", "no")

# Derived by the enriched view, in order.
DERIVED_COLUMNS = (
    "journey_hour", "day_of_week", "is_weekend", "is_peak", "time_band",
    "week_start", "month_start",
)
DIMENSION_ATTRIBUTE_COLUMNS = (
    "customer_home_region", "digital_affinity", "customer_first_seen_date",
    "line_reliability_index", "line_capacity_index", "line_scheduled_minutes",
)

# ---------------------------------------------------------------------------
# FIXED VALUES - domain vocabulary
# ---------------------------------------------------------------------------
REGIONS = ("Central", "North", "South", "East", "West", "Northwest")
TRANSPORT_MODES = ("Metro", "Train", "Bus", "Light Rail", "Ferry")
CUSTOMER_SEGMENTS = (
    "Frequent Commuters", "Occasional Travellers", "Off-Peak Regulars",
    "Digital-First Customers", "High-Service-Need Customers",
)
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# ---------------------------------------------------------------------------
# FIXED VALUES - analytical thresholds
# ---------------------------------------------------------------------------
ON_TIME_THRESHOLD_MINUTES = 5.0
PEAK_HOURS_AM = (7, 9)
PEAK_HOURS_PM = (16, 18)
SATISFACTION_MIN = 1
SATISFACTION_MAX = 5
MAX_PLAUSIBLE_DURATION_MINUTES = 240.0
MAX_PLAUSIBLE_DELAY_MINUTES = 180.0
ANOMALY_ROLLING_WINDOW = 28
ANOMALY_Z_THRESHOLD = 2.5
ANOMALY_MIN_HISTORY = 14
MIN_SAMPLE_FOR_COMPARISON = 100
MATERIAL_CHANGE_PCT = 3.0
LOWER_IS_BETTER = frozenset({
    "avg_delay_minutes", "complaint_rate", "avg_resolution_hours",
    "disruption_rate", "p90_delay_minutes",
})

# ---------------------------------------------------------------------------
# FIXED VALUES - allow-lists
# ---------------------------------------------------------------------------
FILTER_COLUMNS = (
    "region", "transport_mode", "customer_segment", "service_line", "channel",
    "time_band", "journey_purpose", "age_group",
)
GROUPING_COLUMNS = (
    "region", "transport_mode", "customer_segment", "service_line", "channel",
    "age_group", "journey_purpose", "time_band", "fare_type", "origin_region",
    "destination_region", "complaint_category", "feedback_text_category",
)
GRAIN_COLUMNS = {"day": "date", "week": "week_start", "month": "month_start"}

# ---------------------------------------------------------------------------
# FIXED VALUES - metric sets, record columns, profiled fields, anomaly floors,
# segmentation rules and phrases, insight categories, routing keywords
# ---------------------------------------------------------------------------
# Default metric sets.
HEADLINE_KPIS = (
    "total_journeys", "active_customers", "avg_satisfaction",
    "on_time_performance", "avg_delay_minutes", "complaint_rate",
)
BREAKDOWN_METRICS = (
    "total_journeys", "avg_satisfaction", "on_time_performance",
    "avg_delay_minutes", "complaint_rate",
)
HOURLY_METRICS = ("total_journeys", "avg_delay_minutes", "on_time_performance", "avg_satisfaction")
WEEKDAY_METRICS = (
    "total_journeys", "avg_delay_minutes", "on_time_performance",
    "avg_satisfaction", "complaint_rate",
)
SEGMENT_COMPARE_METRICS = HEADLINE_KPIS + ("digital_rate", "repeat_rate")
SERVICE_METRICS = (
    "on_time_performance", "avg_delay_minutes", "p90_delay_minutes",
    "disruption_rate", "complaint_rate", "avg_resolution_hours",
)

# Record browser.
DISPLAY_COLUMNS = (
    "journey_id", "date", "timestamp", "region", "transport_mode", "service_line",
    "customer_segment", "channel", "time_band", "journey_duration_minutes",
    "delay_minutes", "on_time", "customer_satisfaction", "complaint_flag",
    "complaint_category", "resolution_time_hours", "service_disruption",
    "journey_purpose", "age_group", "fare_type",
)

# Data-quality profile.
PROFILED_FIELDS = (
    "journey_id", "customer_id", "date", "region", "transport_mode", "service_line",
    "customer_segment", "channel", "journey_duration_minutes", "delay_minutes",
    "customer_satisfaction", "complaint_flag", "complaint_category",
    "resolution_time_hours", "fare_type", "feedback_text_category",
)
CONDITIONAL_FIELDS = ("complaint_category", "resolution_time_hours")
# Names of a result that a metric or rule defined by the user cannot take.
RESERVED_METRICS = ("dimension_value", "period", "metric", "value")
RESERVED_RULES = (
    "null_customer_id", "missing_region", "missing_satisfaction", "invalid_satisfaction",
    "negative_duration", "implausible_duration", "invalid_delay", "invalid_transport_mode",
    "duplicate_journey_id", "total_rows", "latest_date",
)
QUALITY_CATEGORY_WEIGHTS = {"Completeness": 0.40, "Validity": 0.40, "Uniqueness": 0.20}

# Anomaly scan.
DEFAULT_SCAN_METRICS = {
    "avg_delay_minutes": 1.0,
    "total_journeys": 0.0,
    "complaint_rate": 1.5,
    "avg_satisfaction": 0.15,
    "on_time_performance": 3.0,
}
COMPANION_METRICS = (
    "total_journeys", "avg_delay_minutes", "on_time_performance",
    "avg_satisfaction", "complaint_rate", "disruption_rate",
)
CONTEXT_METRICS = ("disruption_rate", "complaint_rate", "total_journeys")

# Segmentation.
CLUSTER_FEATURES = (
    "journeys_per_week", "peak_share", "digital_share", "avg_satisfaction",
    "complaint_rate", "avg_delay_minutes", "modes_used",
)
RULE_THRESHOLDS = {
    "frequent_journeys_per_week": 3.0,
    "frequent_peak_share": 45.0,
    "high_need_accessibility_share": 20.0,
    "high_need_complaint_rate": 12.0,
    "digital_first_share": 70.0,
    "regular_journeys_per_week": 1.2,
    "regular_peak_share": 30.0,
}
CLUSTER_PHRASES = {
    "journeys_per_week": ("High-frequency", "Low-frequency"),
    "peak_share": ("peak-focused", "off-peak"),
    "digital_share": ("digitally engaged", "assisted-channel"),
    "avg_satisfaction": ("satisfied", "dissatisfied"),
    "complaint_rate": ("complaint-prone", "low-complaint"),
    "avg_delay_minutes": ("delay-affected", "reliable-service"),
    "modes_used": ("multi-modal", "single-mode"),
}
ENGAGEMENT_BANDS = (
    ("Under 1/week", 0.0, 1.0),
    ("1-3/week", 1.0, 3.0),
    ("3-7/week", 3.0, 7.0),
    ("7+/week", 7.0, 1000.0),
)
CLUSTER_RANDOM_STATE = 42
SILHOUETTE_SAMPLE = 4000

# Insights.
CATEGORY_PERFORMANCE = "Service performance"
CATEGORY_CUSTOMER = "Customer experience"
CATEGORY_DEMAND = "Demand"
CATEGORY_OPERATIONS = "Operations"
CATEGORY_QUALITY = "Data quality"

# Question routing: tools in registry order (order breaks ties) and their
# keywords; segment tokens.
ROUTING_TOOLS = (
    ("get_kpi_summary", ("summar", "overview", "how are we", "performance", "current",
                         "kpi", "headline", "overall")),
    ("compare_periods", ("change", "changed", "this month", "versus last", "vs last",
                         "compared with", "movement", "trend", "since")),
    ("compare_segments", ("segment", "commuter", "traveller", "traveler", "digital-first",
                          "compare customers", "versus", "vs")),
    ("analyse_region", ("region", "where", "area", "corridor", "north", "south", "east",
                        "west", "central", "northwest", "location")),
    ("analyse_mode", ("mode", "bus", "train", "metro", "ferry", "light rail", "service type")),
    ("find_anomalies", ("anomal", "unusual", "spike", "outlier", "abnormal", "strange",
                        "unexpected")),
    ("analyse_complaints", ("complaint", "complain", "dissatisf", "issue reported", "feedback")),
    ("analyse_satisfaction", ("satisfaction", "satisfied", "csat", "score", "happy",
                              "experience")),
    ("top_issues", ("investigate", "issues", "problems", "worry", "attention", "three main",
                    "what should i", "priorit", "concern")),
    ("assess_data_quality", ("data quality", "missing", "trust", "reliable", "complete",
                             "duplicate", "clean")),
)
DEFAULT_TOOL = "get_kpi_summary"
SEGMENT_TOKENS = (
    ("Frequent Commuters", ("commuter", "frequent")),
    ("Occasional Travellers", ("occasional", "traveller", "traveler")),
    ("Off-Peak Regulars", ("off-peak regular", "off peak regular")),
    ("Digital-First Customers", ("digital-first", "digital first")),
    ("High-Service-Need Customers", ("high-service", "high service", "assisted")),
)

# ---------------------------------------------------------------------------
# Registered-query parameters (the reference's test fixture: a 60-day
# selection ending on the last day of data).
# ---------------------------------------------------------------------------
DEFAULT_END = _dt.date(2026, 6, 30)
DEFAULT_START = DEFAULT_END - _dt.timedelta(days=59)
AS_OF = _dt.date(2026, 7, 1)
