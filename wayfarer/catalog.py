"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each entry runs one operator over the whole testdata-derived journey table. Where
a period is the feature (comparisons, anomalies, insights, briefs, reports on them)
the period is the reference fixture's: 60 days ending 2026-06-30.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C
from .functions import definitions
from .functions.metrics import np_round
from .operators import anomalies, insights, kpis, quality, records, routing, segmentation, trends
from .plans.filters import Period, Selection, preset_period
from .plans.model import JourneySource, source_for
from .sources import feeds
from .sources.testdata import planted_windows, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Callable[[JourneySource], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(source_for(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return wrap


# Every row: what a query reads unless a period is its feature.
EVERYTHING = Selection()


def default_filter() -> Selection:
    return Selection.default()


# ---------------------------------------------------------------------------
# Model / enrichment
# ---------------------------------------------------------------------------
@register("analytics_rows")
def _analytics_rows(src: JourneySource) -> DataFrame:
    return src.analytics


# ---------------------------------------------------------------------------
# KPIs
# ---------------------------------------------------------------------------
@register("kpi_period_compare")
def _kpi_period_compare(src):
    return kpis.compare_periods(src.analytics, default_filter())


_BREAKDOWNS = {
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
}


def _breakdown(dimension: str):
    def fn(src):
        return kpis.metrics_by_dimension(src.analytics, EVERYTHING, dimension, rollup=src.rollup())
    return fn


for _name, _dim in _BREAKDOWNS.items():
    register(_name)(_breakdown(_dim))


# ---------------------------------------------------------------------------
# Sources, enrichment, filters
# ---------------------------------------------------------------------------


FILTERED = dict(region=("ASIA", "EUROPE"), transport_mode=("Bus", "Metro"),
                time_band=("AM Peak", "PM Peak", "Off-Peak"))


@register("feed_validation")
def _feed_validation(src):
    """S2 on the whole feed rendered as uploaded text files: a sound one, one with the
    required columns only, and one for each kind of defect."""
    required = C.REQUIRED_COLUMNS
    no_region = tuple(c for c in required if c not in ("date", "region"))
    texts = {
        "sound": feeds.text_feed(src.journeys),
        "required_only": feeds.text_feed(src.journeys, required),
        "some_defects": feeds.text_feed(
            src.journeys,
            date=F.when(F.col("journey_id").endswith("7"), "soon")
            .otherwise(F.date_format("date", "yyyy/M/d")),
            digital_interaction=F.when(F.col("digital_interaction"), "Y").otherwise("no")),
        "no_values": feeds.text_feed(src.journeys, required, date=F.lit("soon"),
                                     delay_minutes=F.lit("late"),
                                     customer_satisfaction=F.lit("good")),
        "columns_missing": feeds.text_feed(src.journeys, no_region),
        "empty": feeds.text_feed(src.journeys.where(F.lit(False)), no_region),
    }
    found = [feeds.validate_feed(t).select(F.lit(n).alias("feed"), "*") for n, t in texts.items()]
    return reduce(DataFrame.unionByName, found)


@register("canonical_feed")
def _canonical_feed(src):
    """S3: the text rendering canonicalised back to the 26 typed columns."""
    return feeds.canonicalise(feeds.text_feed(src.journeys))


@register("canonical_feed_required")
def _canonical_feed_required(src):
    """S3 of a text feed without any optional column: the timestamp is the date."""
    return feeds.canonicalise(feeds.text_feed(src.journeys, C.REQUIRED_COLUMNS))


@register("enriched_no_dims")
def _enriched_no_dims(src):
    """Raw enriched rows of a feed without dimension tables."""
    return src.raw


@register("source_manifest")
def _source_manifest(src):
    return feeds.manifest(src.journeys, src.analytics)


@register("enriched_journeys")
def _enriched_journeys(src):
    """F1 + J1: raw view with the customer and service-line attributes joined."""
    return src.enriched_with_dimensions()


@register("time_band_profile")
def _time_band_profile(src):
    """journeys, peak flag and mean delay per derived time band (raw rows)."""
    return (src.raw.groupBy("time_band", "is_peak", "is_weekend")
            .agg(F.count(F.lit(1)).alias("journeys"),
                 F.avg("delay_minutes").alias("avg_delay_minutes")))


@register("filtered_population")
def _filtered_population(src):
    """the analysable rows of a multi-dimension selection."""
    state = Selection.of(C.DEFAULT_START, C.DEFAULT_END, **FILTERED)
    return src.analytics.where(state.column()).select(
        "journey_id", "date", "region", "transport_mode", "time_band", "delay_minutes")


@register("dimension_values")
def _dimension_values(src):
    """distinct non-NULL values of every allow-listed grouping column.

    One single-column distinct per column, unioned: each scan reads only its
    column (columnar pruning, so the bytes read equal one wide scan) and each
    partial aggregate sees one value per row - no 13x row explosion."""
    parts = [src.analytics.where(F.col(c).isNotNull())
             .select(F.lit(c).alias("dimension"), F.col(c).alias("value")).distinct()
             for c in C.GROUPING_COLUMNS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("dimension", "value")


@register("dataset_bounds")
def _dataset_bounds(src):
    """first / last analysable date (the as-of day when there are none)."""
    return src.analytics.agg(
        F.coalesce(F.min("date"), F.lit(C.AS_OF)).alias("first_date"),
        F.coalesce(F.max("date"), F.lit(C.AS_OF)).alias("last_date"))


@register("row_counts")
def _row_counts(src):
    """raw and analysable row counts."""
    return feeds.combine_rows(src.raw.agg(F.count(F.lit(1)).alias("raw_rows")),
                              src.analytics.agg(F.count(F.lit(1)).alias("analysable_rows")))


# ---------------------------------------------------------------------------
# KPIs (A1, A3, A4, A6, A7, A13)
# ---------------------------------------------------------------------------
@register("kpi_all_metrics")
def _kpi_all_metrics(src):
    return kpis.compute_metrics(src.analytics, EVERYTHING)


@register("kpi_evidence")
def _kpi_evidence(src):
    return kpis.kpi_evidence(src.analytics, default_filter())


@register("population_summary")
def _population_summary(src):
    return kpis.population_summary(src.analytics, EVERYTHING)


@register("pop_by_region")
def _pop_by_region(src):
    return kpis.period_over_period_by_dimension(
        src.analytics, default_filter(), "region", "on_time_performance", 50)


@register("pop_by_segment")
def _pop_by_segment(src):
    return kpis.period_over_period_by_dimension(
        src.analytics, default_filter(), "customer_segment", "avg_satisfaction", 100)


@register("compare_segments")
def _compare_segments(src):
    return kpis.compare_segments(src.analytics, EVERYTHING,
                                 "Frequent Commuters", "Occasional Travellers")


@register("segment_share")
def _segment_share(src):
    return kpis.segment_share(src.analytics, EVERYTHING)


# ---------------------------------------------------------------------------
# Trends (T1-T7)
# ---------------------------------------------------------------------------
for _grain in ("day", "week", "month"):
    register(f"time_series_{_grain}")(
        (lambda g: lambda src: trends.time_series(src.analytics, EVERYTHING, g, rollup=src.rollup()))(_grain))


@register("calendar_filled_daily")
def _calendar_filled(src):
    return trends.fill_calendar(trends.time_series(src.analytics, EVERYTHING, "day", rollup=src.rollup()))


@register("rolling_7d")
def _rolling_7d(src):
    daily = trends.fill_calendar(trends.time_series(src.analytics, EVERYTHING, "day", rollup=src.rollup()))
    return trends.add_rolling(daily.select("period", "avg_delay_minutes", "total_journeys"),
                              "avg_delay_minutes")


SERIES = ("region", "transport_mode", "customer_segment")


@register("calendar_filled_by_dimensions")
def _calendar_filled_by_dimensions(src):
    """T2 and T3 for every region, mode and segment: days without journeys are filled per series,
    the trailing mean of the delay runs over them."""
    daily = trends.daily_series(src.analytics, EVERYTHING, SERIES, ("total_journeys", "avg_delay_minutes"))
    return trends.add_rolling(trends.fill_calendar(daily, SERIES), "avg_delay_minutes", by=SERIES)


@register("series_by_dimension")
def _series_by_dimension(src):
    return trends.series_by_dimension(src.analytics, EVERYTHING, "service_line",
                                      "avg_delay_minutes", "week", 6)


@register("hourly_profile")
def _hourly_profile(src):
    return trends.hourly_profile(src.analytics, EVERYTHING)


@register("weekday_profile")
def _weekday_profile(src):
    return trends.weekday_profile(src.analytics, EVERYTHING)


@register("heatmap_cells")
def _heatmap_cells(src):
    return trends.heatmap_cells(src.analytics, EVERYTHING)


@register("heatmap_matrix")
def _heatmap_matrix(src):
    return trends.heatmap_matrix(src.analytics, EVERYTHING)


# ---------------------------------------------------------------------------
# Records (R1-R6)
# ---------------------------------------------------------------------------
@register("records_recent")
def _records_recent(src):
    return records.fetch_records(src.analytics, EVERYTHING)


@register("records_longest_delay")
def _records_longest_delay(src):
    return records.fetch_records(src.analytics, EVERYTHING, sort="Longest delay",
                                 subset="Complaints only")


@register("records_lowest_satisfaction")
def _records_lowest_satisfaction(src):
    return records.fetch_records(src.analytics, EVERYTHING, sort="Lowest satisfaction",
                                 subset="Delayed journeys only", limit=300)


@register("records_search")
def _records_search(src):
    return records.fetch_records(src.analytics, EVERYTHING, sort="Longest journey",
                                 search=" Crowd ", limit=500)


@register("records_subset_counts")
def _records_subset_counts(src):
    return records.subset_counts(src.analytics, EVERYTHING)


@register("top_service_lines")
def _top_service_lines(src):
    """First 15 service lines by journeys (>= 20 journeys), service metrics."""
    return kpis.metrics_by_dimension(src.analytics, EVERYTHING, "service_line",
                                     C.SERVICE_METRICS + ("total_journeys",), 20, 15)


# ---------------------------------------------------------------------------
# Metrics and rules defined by rows (2.17)
# ---------------------------------------------------------------------------
USER_METRICS = [
    ("long_delay_rate", "Delays Over 30 Minutes", "percent", "rate", "delay_minutes > 30", None, True, True, 1.0),
    ("disrupted_delay", "Delay When Disrupted", "minutes", "avg", "delay_minutes", "service_disruption", True, False, 0.5),
    ("digital_customers", "Customers Seen Online", "count", "distinct", "customer_id", "digital_interaction", False, False, None),
    ("longest_delay", "Longest Delay", "minutes", "max", "delay_minutes", None, True, False, None),
    ("weekend_journeys", "Journeys on Saturday or Sunday", "count", "count", None, "is_weekend", None, None, 20.0),
    ("resolved_share", "Journeys With a Resolution Time", "percent", "share", "resolution_time_hours IS NOT NULL", None,
     False, True, 0.0),
]
USER_RULES = [
    ("slow_resolution", "Resolution slower than two days", "Validity", "resolution_time_hours > 48"),
    ("complaint_uncategorised", "Complaint without a category", "Completeness", "complaint_flag AND complaint_category IS NULL"),
]


def _user_metrics(src):
    return definitions.read_metrics(
        src.analytics.sparkSession.createDataFrame(USER_METRICS, definitions.METRIC_SCHEMA), src.analytics)


def _user_rules(src):
    return definitions.read_rules(
        src.raw.sparkSession.createDataFrame(USER_RULES, definitions.RULE_SCHEMA), src.raw)


@register("defined_metrics")
def _defined_metrics(src):
    """A1 with metrics defined by rows, beside the built-in journeys."""
    return kpis.compute_metrics(src.analytics, EVERYTHING, ["total_journeys", *(r[0] for r in USER_METRICS)],
                                _user_metrics(src))


@register("defined_metrics_compare")
def _defined_metrics_compare(src):
    """A2 with metrics defined by rows."""
    return kpis.compare_periods(src.analytics, default_filter(), [r[0] for r in USER_METRICS],
                                registry=_user_metrics(src))


@register("defined_metrics_by_region")
def _defined_metrics_by_region(src):
    """A5 with metrics defined by rows."""
    return kpis.metrics_by_dimension(src.analytics, EVERYTHING, "region",
                                     ["total_journeys", *(r[0] for r in USER_METRICS)], registry=_user_metrics(src))


@register("defined_metrics_anomalies")
def _defined_metrics_anomalies(src):
    """N3 over metrics defined by rows and one built-in metric."""
    return anomalies.detect(src.analytics, default_filter(), "transport_mode",
                            ["long_delay_rate", "disrupted_delay", "weekend_journeys", "avg_delay_minutes"],
                            registry=_user_metrics(src))


@register("defined_rules_checks")
def _defined_rules_checks(src):
    """Q1-Q3 with rules defined by rows after the built-in ones."""
    return quality.checks(src.raw, EVERYTHING, _user_rules(src))


@register("defined_rules_score")
def _defined_rules_score(src):
    """Q5 with rules defined by rows."""
    return quality.score(src.raw, EVERYTHING, _user_rules(src))


# ---------------------------------------------------------------------------
# Data quality (Q1-Q8) - on the raw enriched rows
# ---------------------------------------------------------------------------


@register("dq_checks")
def _dq_checks(src):
    return quality.checks(src.raw, EVERYTHING)


@register("dq_field_completeness")
def _dq_field_completeness(src):
    return quality.field_completeness(src.raw, EVERYTHING)


@register("dq_score")
def _dq_score(src):
    return quality.score(src.raw, EVERYTHING)


@register("dq_summary")
def _dq_summary(src):
    return quality.summary(src.raw, src.analytics, EVERYTHING)


@register("dq_value_outliers")
def _dq_value_outliers(src):
    return quality.value_outliers(src.raw, EVERYTHING)


@register("dq_worst_check")
def _dq_worst_check(src):
    return quality.worst_check(src.raw, EVERYTHING)


# ---------------------------------------------------------------------------
# Customers and segmentation
# ---------------------------------------------------------------------------
def features_of(src):
    return segmentation.customer_features(src.analytics, EVERYTHING)


@register("customer_features")
def _customer_features(src):
    return features_of(src)


@register("rule_segments")
def _rule_segments(src):
    return segmentation.rule_segments(features_of(src))


@register("rule_segment_profile")
def _rule_segment_profile(src):
    return segmentation.segment_profile(segmentation.rule_segments(features_of(src)),
                                        "rule_segment")


@register("engagement_bands")
def _engagement_bands(src):
    return segmentation.engagement_bands(features_of(src))


@register("frequency_histogram")
def _frequency_histogram(src):
    return segmentation.frequency_histogram(features_of(src))


@register("top_customers")
def _top_customers(src):
    return segmentation.top_customers(features_of(src))


@register("standardised_features")
def _standardised_features(src):
    return segmentation.standardised_features(features_of(src))


@register("kmeans_profile")
def _kmeans_profile(src):
    clustered = segmentation.cluster_customers(features_of(src), k=4)
    return segmentation.segment_profile(clustered, "cluster_label")


@register("kmeans_silhouette")
def _kmeans_silhouette(src):
    return segmentation.silhouette(features_of(src), k=4)


@register("kmeans_elbow")
def _kmeans_elbow(src):
    return segmentation.inertia_curve(features_of(src))


@register("kmeans_fit_check")
def _kmeans_fit_check(src):
    """The fit held against what K-means promises."""
    return segmentation.fit_check(features_of(src), k=4)


@register("customer_sample")
def _customer_sample(src):
    return segmentation.customer_sample(segmentation.rule_segments(features_of(src)))


@register("cluster_rule_crosstab")
def _cluster_rule_crosstab(src):
    return segmentation.cluster_rule_crosstab(
        segmentation.cluster_customers(features_of(src), k=4))


# ---------------------------------------------------------------------------
# Anomalies
# ---------------------------------------------------------------------------


@register("anomaly_daily_frame")
def _anomaly_daily_frame(src):
    _, needed = anomalies.needed_metrics(None)
    return anomalies.daily_frame(src.analytics, default_filter(), "region",
                                 C.ANOMALY_ROLLING_WINDOW + 7, needed, src.rollup())


@register("anomaly_baselines_z")
def _anomaly_baselines_z(src):
    return anomalies.baseline_table(src.analytics, default_filter(), "region", "rolling_z")


@register("anomaly_baselines_iqr")
def _anomaly_baselines_iqr(src):
    return anomalies.baseline_table(src.analytics, default_filter(), "region", "iqr")


@register("anomalies_region_z")
def _anomalies_region_z(src):
    return anomalies.detect(src.analytics, default_filter(), "region", rollup=src.rollup())


@register("anomalies_mode_z")
def _anomalies_mode_z(src):
    return anomalies.detect(src.analytics, default_filter(), "transport_mode", rollup=src.rollup())


@register("anomalies_network_z")
def _anomalies_network_z(src):
    return anomalies.detect(src.analytics, default_filter(), None, rollup=src.rollup())


@register("anomalies_region_iqr")
def _anomalies_region_iqr(src):
    return anomalies.detect(src.analytics, default_filter(), "region", method="iqr",
                            rollup=src.rollup())


@register("anomalies_region_adverse")
def _anomalies_region_adverse(src):
    """The adverse region anomalies report (top 10)."""
    return anomalies.detect(src.analytics, default_filter(), "region", adverse_only=True,
                            limit=10, rollup=src.rollup())


@register("anomaly_companions")
def _anomaly_companions(src):
    return anomalies.companions(src.analytics, default_filter(), "region")


@register("anomaly_evidence_region")
def _anomaly_evidence_region(src):
    """N5 + N9: records of the region anomalies with the context of the day."""
    return anomalies.evidence(src.analytics, default_filter(), "region", rollup=src.rollup())


@register("anomaly_evidence_mode")
def _anomaly_evidence_mode(src):
    """The adverse ones over transport modes by quartiles, from the journeys."""
    return anomalies.evidence(src.analytics, default_filter(), "transport_mode", method="iqr", adverse_only=True)


@register("anomaly_summary")
def _anomaly_summary(src):
    return anomalies.summarise(anomalies.detect(src.analytics, default_filter(), "region", rollup=src.rollup()))


@register("anomaly_series")
def _anomaly_series(src):
    return anomalies.series(src.analytics, default_filter(), "avg_delay_minutes",
                            "region", "ASIA")


@register("anomaly_window_recall")
def _anomaly_window_recall(src):
    return anomalies.window_recall(
        anomalies.detect(src.analytics, default_filter(), "region", rollup=src.rollup()), planted_windows(src.spark))


# ---------------------------------------------------------------------------
# Insights and reports (I1-I18), routing
# ---------------------------------------------------------------------------


@register("insight_kpi_movement")
def _insight_kpi_movement(src):
    return insights.kpi_movement(src.analytics, default_filter())


@register("insight_dimension_movers")
def _insight_dimension_movers(src):
    return insights.all_dimension_movers(src.analytics, default_filter())


@register("kpi_period_compare_rollup")
def _kpi_period_compare_rollup(src):
    """A2 from the daily rollup: sums of days, distinct customers from the union of their bitmaps."""
    return kpis.compare_periods(src.analytics, default_filter(), rollup=src.rollup())


@register("insights_ranked_rollup")
def _insights_ranked_rollup(src):
    """I8 with every generator but data quality on the daily rollup."""
    return insights.generate(src.raw, src.analytics, default_filter(), limit=8, rollup=src.rollup())


@register("disruption_impact")
def _disruption_impact(src):
    return insights.disruption_impact(src.analytics, EVERYTHING)


@register("cluster_rule_totals")
def _cluster_rule_totals(src):
    """A17 summed over the clusters: the customers of each rule segment."""
    table17 = segmentation.cluster_rule_crosstab(
        segmentation.cluster_customers(features_of(src), k=4))
    return (table17.unpivot("cluster_label", list(C.CUSTOMER_SEGMENTS), "rule_segment", "customers")
            .groupBy("rule_segment").agg(F.sum("customers").alias("customers")))


@register("weekday_band_delay")
def _weekday_band_delay(src):
    """Delay and punctuality per weekday and time band against the overall delay."""
    return (kpis.weekday_band_delay(src.analytics, EVERYTHING)
            .select("day_of_week", "time_band", "journeys", *[
                np_round(c, 6).alias(c)
                for c in ("avg_delay_minutes", "on_time_performance", "overall_delay")]))


@register("peak_pressure")
def _peak_pressure(src):
    return insights.peak_pressure(src.analytics, EVERYTHING)


@register("complaint_concentration")
def _complaint_concentration(src):
    return insights.complaint_concentration(src.analytics, EVERYTHING)


@register("insight_top_anomaly")
def _insight_top_anomaly(src):
    return insights.top_anomaly(src.analytics, default_filter(), src.rollup())


@register("insight_data_quality")
def _insight_data_quality(src):
    return insights.data_quality_notice(src.raw, src.analytics, EVERYTHING)


@register("insights_ranked")
def _insights_ranked(src):
    return insights.generate(src.raw, src.analytics, default_filter(), limit=8)


@register("brief_sections")
def _brief_sections(src):
    return insights.executive_brief(src.raw, src.analytics, default_filter())


@register("report_kpi_summary")
def _report_kpi_summary(src):
    """I10 in whole: population, headline KPIs, largest moves."""
    return insights.report_kpi_summary(src.analytics, default_filter())


@register("report_kpi_movers")
def _report_kpi_movers(src):
    return insights.report_kpi_movers(src.analytics, default_filter())


@register("report_period_changes")
def _report_period_changes(src):
    return insights.report_period_changes(src.analytics, default_filter())


@register("report_region")
def _report_region(src):
    return insights.report_dimension(src.analytics, default_filter(), "region", "ASIA")


@register("report_mode")
def _report_mode(src):
    return insights.report_dimension(src.analytics, default_filter(), "transport_mode", None)


@register("report_complaints")
def _report_complaints(src):
    return insights.report_complaints(src.analytics, EVERYTHING)


@register("report_satisfaction")
def _report_satisfaction(src):
    return insights.report_satisfaction(src.analytics, default_filter())


@register("report_top_issues")
def _report_top_issues(src):
    return insights.report_top_issues(src.raw, src.analytics, default_filter())


@register("route_questions")
def _route_questions(src):
    """X1 + X2 over every user turn of the conversations table."""
    return routing.route(routing.user_questions(table(src.spark, src.sf_dir, "conversations")))


@register("route_dimension_questions")
def _route_dimension_questions(src):
    """X1 + X2 over a question for each region, mode and segment that meet in a journey."""
    return routing.route(routing.dimension_questions(src.analytics))


@register("question_entities")
def _question_entities(src):
    """X2 by a vocabulary of all regions, modes, segments and service lines, over the same questions."""
    vocabulary = routing.vocabulary_of(src.analytics, (*SERIES, "service_line"))
    return routing.find_entities(routing.dimension_questions(src.analytics), vocabulary, ["question"])


# ---------------------------------------------------------------------------
# CSV round trip and upload template
# ---------------------------------------------------------------------------
@register("csv_roundtrip")
def _csv_roundtrip(src):
    """S7 export of the whole text feed as CSV (shared folder), S1 read back as
    text, S3 canonicalise: must equal ``canonical_feed``."""
    import uuid as _uuid
    from .session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(src.spark).rstrip('/')}/csv-{_uuid.uuid4().hex[:10]}"
    feeds.export_csv(feeds.text_feed(src.journeys), path)
    return feeds.canonicalise(feeds.read_csv(src.spark, path))


@register("stored_feed")
def _stored_feed(src):
    """The whole text feed as CSV files in two deliveries (before the default period, and the rest with rows
    without a date), gzipped, each taken up by a refresh of the feed's store: the analysable rows of the second version."""
    import uuid as _uuid
    from .plans.store import FeedStore
    from .session import ensure_checkpoint_dir
    feed = f"{ensure_checkpoint_dir(src.spark).rstrip('/')}/delivered-{_uuid.uuid4().hex[:10]}"
    store = FeedStore(src.spark, feed, f"{feed}-store")
    early = F.coalesce(F.col("date") < F.lit(C.DEFAULT_START), F.lit(False))
    for part in (early, ~early):
        (feeds.text_feed(src.journeys.where(part)).write.mode("append").option("header", True)
         .csv(feed, compression="gzip"))
        store.refresh()
    return store.source().analytics


@register("upload_template")
def _upload_template(src):
    """The 300-row sample upload (first journeys by timestamp, id)."""
    return feeds.upload_template(src.journeys)


@register("kpi_compare_last_90_days")
def _kpi_compare_last_90_days(src):
    """A2 over the "Last 90 days" preset resolved from the data's own bounds
    (F11: two scalars) - the selection the reference opens with."""
    b = src.analytics.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    period = preset_period("Last 90 days", Period(b.lo or C.AS_OF, b.hi or C.AS_OF))
    return kpis.compare_periods(src.analytics, Selection(period))


@register("disruption_comparison")
def _disruption_comparison(src):
    """A10: disrupted vs normal journeys - complaints, satisfaction, delay."""
    return kpis.disruption_comparison(src.analytics, EVERYTHING)
