"""What the daily rollup answers equals what the rows give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfarer import config as C
from wayfarer.operators import anomalies, insights, kpis, trends
from wayfarer.plans.filters import Period, Selection
from wayfarer.plans.rollup import SLICES, Rollup

DATED = Selection.default()


def rows(df):
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def rollup(smoke_source):
    return smoke_source.rollup()


@pytest.mark.parametrize("dimension", C.GROUPING_COLUMNS)
def test_breakdowns(smoke_source, rollup, dimension):
    for selection in (Selection(), DATED):
        want = kpis.metrics_by_dimension(smoke_source.analytics, selection, dimension)
        assert rows(kpis.metrics_by_dimension(smoke_source.analytics, selection, dimension, rollup=rollup)) == rows(want)


def test_comparison_and_distinct_customers(smoke_source, rollup):
    a = smoke_source.analytics
    assert rows(kpis.compare_periods(a, DATED, rollup=rollup)) == rows(kpis.compare_periods(a, DATED))
    one_day, nothing = Period(dt.date(2026, 3, 3), dt.date(2026, 3, 3)), Period(dt.date(1999, 1, 1), dt.date(1999, 1, 2))
    got = rollup.customers(None, DATED.period, one_day, nothing).first()
    want = [a.where(p.holds() if p else F.lit(True)).select("customer_id").distinct().where("customer_id is not null").count()
            for p in (None, DATED.period, one_day, nothing)]
    assert list(got) == want and want[-1] == 0


def test_series_frames_and_cube(smoke_source, rollup):
    a = smoke_source.analytics
    for grain in ("day", "week", "month"):
        assert rows(trends.time_series(a, DATED, grain, rollup=rollup)) == rows(trends.time_series(a, DATED, grain))
    _, needed = anomalies.needed_metrics(None)
    some = Selection(DATED.period, {"region": ["ASIA", "EUROPE"]})
    for dimension, selection in (("region", DATED), ("region", some), (None, DATED)):
        assert rows(anomalies.daily_frame(a, selection, dimension, 35, needed, rollup)) == rows(
            anomalies.daily_frame(a, selection, dimension, 35, needed))
    cube, want = insights.insight_cube(a, DATED, rollup), insights.insight_cube(a, DATED)
    assert set(cube.columns) == set(want.columns)
    assert rows(cube.select(want.columns)) == rows(want)


def test_only_what_it_can_answer(rollup):
    region = Selection(DATED.period, {"region": ["ASIA"]})
    assert rollup.answers(DATED, C.BREAKDOWN_METRICS, "region") and rollup.answers(region, C.BREAKDOWN_METRICS, "region")
    assert not rollup.answers(region, C.BREAKDOWN_METRICS, "transport_mode")
    assert not rollup.answers(region, C.BREAKDOWN_METRICS)
    assert not rollup.answers(DATED, ("p90_delay_minutes",)) and not rollup.answers(DATED, ("active_customers",))
    assert rollup.answers(DATED, C.HEADLINE_KPIS, customers=True)


def test_rows_without_values_and_empty_table(spark, smoke_source):
    a = smoke_source.analytics
    odd = a.limit(50).withColumn("customer_id", F.lit(None).cast("string")).withColumn("region", F.lit(None).cast("string"))
    made = Rollup.build(odd)
    assert made.customers(None).first()[0] == 0
    assert rows(kpis.metrics_by_dimension(odd, None, "region", rollup=made)) == []
    assert made.cells.where("slice = 'region'").agg(F.sum("journeys")).first()[0] == 50
    empty = Rollup.build(a.limit(0))
    assert rows(kpis.compare_periods(a.limit(0), DATED, rollup=empty)) == rows(kpis.compare_periods(a.limit(0), DATED))
    assert {r.slice for r in made.cells.select("slice").distinct().collect()} == {*SLICES, "network"}
