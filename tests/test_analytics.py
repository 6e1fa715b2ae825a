"""Anomalies, data quality, segmentation, insights, routing, streaming."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfarer import config as C
from wayfarer.operators import anomalies, insights, quality, routing, segmentation
from wayfarer.plans.filters import Selection
from wayfarer.plans.model import JourneySource
from wayfarer.sources import feeds


def test_planted_delay_window_found(source):
    det = anomalies.detect(source.analytics, Selection.default(), "region",
                           metrics=["avg_delay_minutes"])
    asia = det.where(F.col("dimension_value") == "ASIA").collect()
    assert asia, "planted ASIA delay window not detected"
    assert all(dt.date(2026, 5, 9) <= r.period <= dt.date(2026, 5, 20) for r in asia)
    assert max(r.z_score for r in asia) > 10
    assert all(r.adverse and r.direction == "above" for r in asia)


def test_threshold_monotone_and_adverse_subset(source):
    f = Selection.default()
    a = anomalies.detect(source.analytics, f, "region", threshold=2.5).count()
    b = anomalies.detect(source.analytics, f, "region", threshold=3.5).count()
    assert b <= a
    adv = anomalies.detect(source.analytics, f, "region", adverse_only=True)
    assert adv.where(~F.col("adverse")).count() == 0
    assert adv.count() <= a


def test_findings_confined_to_narrow_window(source):
    f = Selection.of(dt.date(2026, 6, 10), dt.date(2026, 6, 30))
    det = anomalies.detect(source.analytics, f, "region").collect()
    assert all(f.period.start <= r.period <= f.period.end for r in det)


def test_bounds_bracket_expected(source):
    s = anomalies.series(source.analytics, Selection.default(), "avg_delay_minutes",
                         "region", "ASIA").collect()
    for r in s:
        if r.expected is not None and r.lower is not None:
            assert r.lower <= r.expected <= r.upper


def test_clean_feed_scores_exactly_100(spark):
    rows = [dict(journey_id=f"J{i}", customer_id=f"C{i % 7}", date=dt.date(2026, 6, 1),
                 region="North", transport_mode="Bus", customer_segment="Frequent Commuters",
                 delay_minutes=2.0, customer_satisfaction=4.0, journey_duration_minutes=20.0,
                 complaint_flag=False, service_line="L1", channel="Website", fare_type="Adult",
                 feedback_text_category="Neutral") for i in range(50)]
    src = JourneySource.from_journeys(spark, feeds.canonicalise(spark.createDataFrame(rows)))
    s = quality.summary(src.raw, src.analytics, None).first()
    assert s.excluded_rows == 0 and s.quality_score == 100.0 and s.rating == "Good"


def test_excluded_equals_raw_minus_analysable(source):
    s = quality.summary(source.raw, source.analytics, Selection.default()).first()
    assert s.excluded_rows == s.total_rows - s.analysable_rows > 0
    assert 0 <= s.quality_score <= 100


def test_planted_defects_found(source):
    checks = {r.check_key: r for r in quality.checks(source.raw, None).collect()}
    for key in ("null_customer_id", "missing_region", "missing_satisfaction",
                "invalid_satisfaction", "negative_duration", "implausible_duration",
                "invalid_delay", "invalid_transport_mode", "duplicate_journey_id"):
        assert checks[key].failed_rows > 0, key


def test_rules_exhaustive_and_first_match(source):
    feats = segmentation.rule_segments(
        segmentation.customer_features(source.analytics, Selection.default()))
    segs = {r.rule_segment for r in feats.select("rule_segment").distinct().collect()}
    assert segs <= set(C.CUSTOMER_SEGMENTS)
    assert feats.where(F.col("rule_segment").isNull()).count() == 0
    high = feats.where((F.col("accessibility_share") >= 20) | (F.col("complaint_rate") >= 12))
    assert high.where(F.col("rule_segment") != "High-Service-Need Customers").count() == 0


def test_features_thresholds(source):
    feats = segmentation.customer_features(source.analytics, Selection.default())
    assert feats.where(F.col("journeys") < 3).count() == 0
    assert feats.where(F.col("customer_id").isNull()).count() == 0


def test_kmeans_labels_unique_and_profile_totals(source):
    feats = segmentation.customer_features(source.analytics, Selection.default())
    clustered = segmentation.cluster_customers(feats, k=4, n_init=3)
    prof = segmentation.segment_profile(clustered, "cluster_label").collect()
    assert len(prof) == 4 and len({r.segment for r in prof}) == 4
    assert sum(r.customers for r in prof) == feats.count()
    assert sum(r.share_pct for r in prof) == pytest.approx(100.0, abs=0.3)
    again = segmentation.segment_profile(
        segmentation.cluster_customers(feats, k=4, n_init=3), "cluster_label").collect()
    assert sorted(r.customers for r in prof) == sorted(r.customers for r in again)


def test_silhouette_in_range(source):
    feats = segmentation.customer_features(source.analytics, Selection.default())
    (row,) = segmentation.silhouette(feats, k=3, n_init=2).collect()
    assert row.k == 3 and -1.0 <= row.silhouette <= 1.0


def test_insight_order_stable(source):
    a = [r.key for r in insights.generate(source.raw, source.analytics,
                                          Selection.default()).collect()]
    b = [r.key for r in insights.generate(source.raw, source.analytics,
                                          Selection.default()).collect()]
    assert a == b and len(a) == 8


def test_brief_sections(source):
    rows = insights.executive_brief(source.raw, source.analytics, Selection.default()).collect()
    by = {}
    for r in rows:
        by.setdefault(r.section, []).append(r)
    assert len(by["current_performance"]) == 6
    assert len(by.get("key_changes", [])) <= 5 and len(by.get("positives", [])) <= 4


# FIXED VALUES - the reference's routing test cases (question -> tool)
ROUTING_CASES = (
    ("Summarise current service performance.", "get_kpi_summary"),
    ("Which customer segment experienced the largest decline in satisfaction?",
     "analyse_satisfaction"),
    ("Which transport mode has the highest complaint rate?", "analyse_complaints"),
    ("Were there any unusual days this period?", "find_anomalies"),
    ("What are the three main issues I should investigate?", "top_issues"),
    ("How complete is the underlying data?", "assess_data_quality"),
    ("How are delays in the West region?", "analyse_region"),
    ("Compare frequent commuters with occasional travellers", "compare_segments"),
    ("xyzzy", "get_kpi_summary"),
)


def test_routing_cases(spark):
    df = spark.createDataFrame([(q,) for q, _ in ROUTING_CASES], "question string")
    got = routing.route(df).collect()
    assert [r.tool for r in got] == [t for _, t in ROUTING_CASES]
    assert got[6].region == "West"
    assert (got[7].segment_a, got[7].segment_b) == ("Frequent Commuters", "Occasional Travellers")


def test_streaming_matches_batch(spark, smoke_source, tmp_path):
    src_dir = str(tmp_path / "in")
    smoke_source.journeys.write.parquet(src_dir)
    from wayfarer.streaming.feed import read_feed_stream, valid_enriched_stream
    stream = read_feed_stream(spark, src_dir, smoke_source.journeys.schema,
                              max_files_per_trigger=2)
    q = (valid_enriched_stream(stream).writeStream.format("memory").queryName("valid_rows")
         .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    from wayfarer.plans.model import valid_predicate
    assert spark.table("valid_rows").count() == smoke_source.raw.where(valid_predicate()).count()


def test_insight_cube_matches_direct_aggregates(source):
    f = Selection.default()
    cube = insights.insight_cube(source.analytics, f)
    cols = ["day_of_week", "time_band", "journeys", "avg_delay_minutes", "on_time_performance"]
    direct = sorted(tuple(r) for r in
                    insights.kpis.weekday_band_delay(source.analytics, f).select(*cols).collect())
    from_cube = sorted(tuple(r) for r in insights.peak_groups_from_cube(cube).select(*cols).collect())
    assert direct == from_cube and len(direct) > 0
    assert (insights._disruption_from_cube(cube).collect()
            == insights.disruption_impact(source.analytics, f).collect())
    assert (insights._complaints_from_cube(cube).collect()
            == insights.complaint_concentration(source.analytics, f).collect())


def test_elbow_and_crosstab(source):
    feats = segmentation.customer_features(source.analytics, Selection.default())
    curve = segmentation.inertia_curve(feats, k_values=(2, 3, 4), n_init=2).collect()
    assert [r.k for r in curve] == [2, 3, 4]
    assert all(r.inertia > 0 and -1 <= r.silhouette <= 1 for r in curve)
    assert curve[-1].inertia <= curve[0].inertia
    clustered = segmentation.cluster_customers(feats, k=3, n_init=2)
    cross = segmentation.cluster_rule_crosstab(clustered)
    assert set(cross.columns) == {"cluster_label", *C.CUSTOMER_SEGMENTS}
    total = sum(sum(r[s] for s in C.CUSTOMER_SEGMENTS) for r in cross.collect())
    assert total == feats.count()


def test_too_few_customers_gives_no_clusters(spark, source):
    feats = segmentation.customer_features(source.analytics, Selection.default()).limit(3)
    assert segmentation.cluster_customers(feats, k=4, n_init=1).count() == 0
    assert segmentation.inertia_curve(feats, n_init=1).count() == 0


def test_baselines_match_pandas_rolling(source):
    """Trailing baselines equal pandas' shift(1).rolling(28, min_periods=14) on the
    collected daily frame (days x regions - small by construction)."""
    import numpy as np
    import pandas as pd
    f = Selection.default()
    _, needed = anomalies.needed_metrics(None)
    daily = anomalies.daily_frame(source.analytics, f, "region", 35, needed).toPandas()
    base = anomalies.baseline_table(source.analytics, f, "region", "rolling_z").toPandas()
    base = base[base.metric == "avg_delay_minutes"].set_index(["dimension_value", "period"])
    checked = 0
    for scope, g in daily.groupby("dimension_value"):
        g = g.sort_values("period").reset_index(drop=True)
        trailing = g["avg_delay_minutes"].shift(1).rolling(28, min_periods=14)
        mean, sd = trailing.mean(), trailing.std(ddof=0).replace(0, np.nan)
        z = (g["avg_delay_minutes"] - mean) / sd
        for i, row in g.iterrows():
            if row.period < f.period.start:
                continue
            got = base.loc[(scope, row.period)]
            for want, have in ((mean[i], got.expected), (z[i], got.z_score)):
                if pd.isna(want):
                    assert have is None or pd.isna(have)
                else:
                    assert abs(want - have) < 1e-5
            checked += 1
    assert checked == 5 * 60


def test_iqr_baselines_match_pandas_rolling(source):
    import pandas as pd
    f = Selection.default()
    _, needed = anomalies.needed_metrics(None)
    daily = anomalies.daily_frame(source.analytics, f, "region", 35, needed).toPandas()
    base = anomalies.baseline_table(source.analytics, f, "region", "iqr").toPandas()
    base = base[base.metric == "complaint_rate"].set_index(["dimension_value", "period"])
    for scope, g in daily.groupby("dimension_value"):
        g = g.sort_values("period").reset_index(drop=True)
        trailing = g["complaint_rate"].shift(1).rolling(28, min_periods=14)
        q1, med, q3 = trailing.quantile(0.25), trailing.median(), trailing.quantile(0.75)
        for i, row in g.iterrows():
            if row.period < f.period.start:
                continue
            got = base.loc[(scope, row.period)]
            for want, have in ((med[i], got.expected), (q1[i] - 1.5 * (q3[i] - q1[i]), got.lower_bound),
                               (q3[i] + 1.5 * (q3[i] - q1[i]), got.upper_bound)):
                if pd.isna(want):
                    assert have is None or pd.isna(have)
                else:
                    assert abs(want - have) < 1e-5


def test_customer_features_match_pandas(source):
    import pandas as pd
    f = Selection.default()
    rows = source.analytics.where(f.column()).where(F.col("customer_id").isNotNull()).select(
        "customer_id", "date", "transport_mode", "region", "delay_minutes",
        "customer_satisfaction", "complaint_flag", "is_peak", "digital_interaction",
        "accessibility_service_used", "on_time", "channel").toPandas()
    g = rows.groupby("customer_id")
    share = lambda c: 100.0 * g[c].apply(lambda s: (s == True).sum()) / g.size()  # noqa: E712,E731
    pdf = pd.DataFrame({
        "journeys": g.size(), "active_days": g["date"].nunique(),
        "modes_used": g["transport_mode"].nunique(), "regions_used": g["region"].nunique(),
        "avg_delay_minutes": g["delay_minutes"].mean().round(2),
        "avg_satisfaction": g["customer_satisfaction"].mean().round(2),
        "complaint_rate": share("complaint_flag").round(1),
        "peak_share": share("is_peak").round(1),
        "first": g["date"].min(), "last": g["date"].max(),
    })
    pdf = pdf[pdf.journeys >= 3]
    span = (pd.to_datetime(pdf["last"]) - pd.to_datetime(pdf["first"])).dt.days.clip(lower=6) + 1
    pdf["journeys_per_week"] = (pdf["journeys"] / span * 7).round(2)
    spark_rows = {r.customer_id: r for r in
                  segmentation.customer_features(source.analytics, f).collect()}
    assert set(spark_rows) == set(pdf.index)
    for cid, want in pdf.iterrows():
        got = spark_rows[cid]
        for col in ("journeys", "active_days", "modes_used", "regions_used", "avg_delay_minutes",
                    "complaint_rate", "peak_share", "journeys_per_week"):
            assert getattr(got, col) == want[col], (cid, col, getattr(got, col), want[col])
        if pd.isna(want["avg_satisfaction"]):
            assert got.avg_satisfaction is None
        else:
            assert got.avg_satisfaction == want["avg_satisfaction"]


@pytest.mark.parametrize("many", [100_000, 5, 0])
def test_customer_features_aggregate_journeys_where_they_meet(spark, monkeypatch, many):
    """Sets and counts of a customer whose journeys are spread over tasks are wider than the journeys:
    no row is aggregated before it moves but those of customers of very many. The features are the
    same whether no customer (100,000), one (5) or every one (0) has that many."""
    import re
    from tools.plans import plan_text
    monkeypatch.setattr(segmentation, "MANY_JOURNEYS", many)
    day = dt.date(2026, 1, 5)
    rows = []
    for cid, n in (("A", 12), ("B", 4), ("C", 2), (None, 9)):
        for i in range(n):
            rows.append((cid, day + dt.timedelta(i // 2), ("Bus", "Ferry", "Bus")[i % 3], None if i == 1 else "ASIA",
                         float(i), None if i % 2 else 4.0, i % 4 == 0, None, i < 1, True, None if i == 0 else i > 2,
                         "S2" if i else "S1", "65+", "Web" if i % 4 else None))
    journeys = spark.createDataFrame(rows, (
        "customer_id string, date date, transport_mode string, region string, delay_minutes double, "
        "customer_satisfaction double, complaint_flag boolean, is_peak boolean, digital_interaction boolean, "
        "accessibility_service_used boolean, on_time boolean, customer_segment string, age_group string, "
        "channel string")).repartition(6)
    features = segmentation.customer_features(journeys, None)
    assert re.search(r"ObjectHashAggregate \(\d+\)\n\W*ObjectHashAggregate \(\d+\)\n\W*Exchange", plan_text(features))
    assert {tuple(r) for r in features.collect()} == {
        ("A", 12, 6, 2, 1, 5.5, 4.0, 25.0, 0.0, 8.3, 100.0, 81.8, day, day + dt.timedelta(5), "S1", "65+", "Web", "Bus", 12.0),
        ("B", 4, 2, 2, 1, 1.5, 4.0, 25.0, 0.0, 25.0, 100.0, 33.3, day, day + dt.timedelta(1), "S1", "65+", "Web", "Bus", 4.0)}


def test_kmeans_assignment_is_a_lloyd_fixed_point(smoke_source):
    """Brute force on the small fixture: every customer sits in the cluster whose
    centroid (mean of its members' standardised vectors) is nearest."""
    import numpy as np
    feats = segmentation.customer_features(smoke_source.analytics, None)
    clustered = segmentation.cluster_customers(feats, k=3, n_init=3)
    std = segmentation.standardised_features(feats, digits=None)
    rows = std.join(clustered.select("customer_id", "cluster"), "customer_id").collect()
    x = np.array([[r[c] for c in C.CLUSTER_FEATURES] for r in rows], dtype=float)
    lab = np.array([r.cluster for r in rows])
    assert set(lab) == {0, 1, 2}
    centres = np.array([x[lab == k].mean(axis=0) for k in range(3)])
    dist = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    nearest = dist.min(axis=1)
    own = dist[np.arange(len(lab)), lab]
    assert np.all(own <= nearest + 1e-6)


def test_single_config_movers_agree_with_feed_pipeline(source):
    f = Selection.default()
    allm = {r.key: r for r in insights.all_dimension_movers(source.analytics, f).collect()}
    single = {}
    for cfg in insights.MOVER_CONFIGS:
        for r in insights.dimension_movers(source.analytics, f, *cfg).collect():
            single[r.key] = r
    assert set(allm) == set(single)
    for k in allm:
        assert allm[k].asDict() == single[k].asDict()


def test_calendar_and_rolling_match_pandas(source):
    import pandas as pd
    from wayfarer.operators import trends
    f = Selection.of(dt.date(2026, 5, 2), dt.date(2026, 6, 30), region=["ASIA"],
                           transport_mode=["Ferry"], time_band=["AM Peak"])
    daily = trends.time_series(source.analytics, f, "day")
    filled = trends.fill_calendar(daily)
    rolled = trends.add_rolling(filled, "avg_delay_minutes").toPandas()
    pdf = daily.toPandas()
    pdf["period"] = pd.to_datetime(pdf["period"])
    cal = pd.date_range(pdf["period"].min(), pdf["period"].max(), freq="D")
    pdf = pdf.set_index("period").reindex(cal)
    want = pdf["avg_delay_minutes"].rolling(window=7, min_periods=2).mean()
    assert len(rolled) == len(cal) and rolled["total_journeys"].isna().sum() == pdf["total_journeys"].isna().sum()
    for got, exp in zip(rolled["avg_delay_minutes_rolling"], want):
        if pd.isna(exp):
            assert got is None or pd.isna(got)
        else:
            assert abs(got - exp) < 1e-6


def test_stream_lands_as_month_partitioned_table(spark, smoke_source, tmp_path):
    from wayfarer.plans.model import valid_predicate
    from wayfarer.streaming.feed import land, read_feed_stream, valid_enriched_stream
    src_dir = str(tmp_path / "in")
    smoke_source.journeys.write.parquet(src_dir)
    stream = valid_enriched_stream(read_feed_stream(spark, src_dir, smoke_source.journeys.schema))
    q = land(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(300)
    landed = spark.read.parquet(str(tmp_path / "out"))
    assert "month_start" in landed.columns
    assert landed.count() == smoke_source.raw.where(valid_predicate()).count()
