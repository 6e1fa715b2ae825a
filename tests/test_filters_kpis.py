"""Selection semantics and KPI invariants (the reference's KPI / filter tests)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfarer import config as C
from wayfarer.operators import kpis, records
from wayfarer.plans.filters import Period, Selection, preset_period


def test_previous_period_is_adjacent_and_equal():
    f = Selection.of(dt.date(2026, 6, 30), dt.date(2026, 5, 2), region=["ASIA", "", None])
    assert f.period.start < f.period.end and f.wanted == {"region": {"ASIA"}}
    before = f.period.shifted_back()
    assert before.end == f.period.start - dt.timedelta(days=1)
    assert before.days == f.period.days == 60


def test_unknown_dimension_rejected():
    with pytest.raises(ValueError):
        Selection.of(dt.date(2026, 1, 1), dt.date(2026, 1, 2), colour=["red"])
    with pytest.raises(ValueError):
        kpis.check_dimension("1=1; DROP TABLE journeys")


def test_total_matches_direct_count(source):
    f = Selection.default()
    total = kpis.compute_metrics(source.analytics, f, ["total_journeys"]).first()[0]
    direct = source.analytics.where(
        F.col("date").between(C.DEFAULT_START, C.DEFAULT_END)).count()
    assert total == direct


def test_on_time_null_aware(source):
    f = Selection.default()
    otp = kpis.compute_metrics(source.analytics, f, ["on_time_performance"]).first()[0]
    rows = source.analytics.where(f.column())
    hits = rows.where(F.col("on_time")).count()
    known = rows.where(F.col("on_time").isNotNull()).count()
    assert otp == pytest.approx(100.0 * hits / known)


def test_breakdown_sums_to_total(source):
    f = Selection.default()
    by_mode = kpis.metrics_by_dimension(source.analytics, f, "transport_mode")
    total = kpis.compute_metrics(source.analytics, f, ["total_journeys"]).first()[0]
    assert by_mode.agg(F.sum("total_journeys")).first()[0] == total


def test_empty_population(source):
    empty = Selection.of(dt.date(2000, 1, 1), dt.date(2000, 1, 1))
    row = kpis.compute_metrics(source.analytics, empty).first().asDict()
    assert row["total_journeys"] == 0 and row["active_customers"] == 0
    assert row["avg_satisfaction"] is None and row["on_time_performance"] is None


def test_delta_consistency(source):
    cmp = kpis.compare_periods(source.analytics, Selection.default()).collect()
    for r in cmp:
        if r.current is not None and r.previous is not None:
            assert r.absolute_change == pytest.approx(r.current - r.previous)
        assert r.direction in {"good", "bad", "flat"}


def test_each_filter_narrows(source):
    base = Selection.default()
    n = source.analytics.where(base.column()).count()
    for dim, val in (("region", ["ASIA"]), ("transport_mode", ["Bus"]),
                     ("time_band", ["AM Peak"]), ("age_group", ["65+"])):
        narrowed = Selection.of(base.period.start, base.period.end, **{dim: val})
        assert 0 < source.analytics.where(narrowed.column()).count() < n


def test_search_is_literal_text(source):
    out = records.fetch_records(source.analytics, Selection.default(),
                                search="'; DROP TABLE journeys; --")
    assert out.count() == 0


def test_presets_clamp_to_first_day():
    june = Period(dt.date(2026, 6, 1), dt.date(2026, 6, 30))
    longer = Period(dt.date(2025, 1, 1), june.end)
    assert preset_period("Last 30 days", june) == june
    assert preset_period("Last 90 days", june) == june
    assert preset_period("Last 30 days", longer) == june
    assert preset_period("All available data", longer) == longer
    with pytest.raises(ValueError):
        preset_period("Last decade", june)


def test_selection_without_period_reads_every_row(source):
    assert source.analytics.where(Selection().column()).count() == source.analytics.count()
