"""Plan guards: no Python evaluation anywhere; date selections prune partitions
and push filters into the parquet scan."""

import pytest

from conftest import SMOKE
from tools.plans import SKIP, plan_text, summarise
from wayfarer.catalog import QUERIES
from wayfarer.operators import anomalies, kpis, quality, records, segmentation, trends
from wayfarer.plans.filters import Selection

DATED = Selection.default()
PRUNED = {
    "kpi_period_compare": lambda s: kpis.compare_periods(s.analytics, DATED),
    "metrics_by_region": lambda s: kpis.metrics_by_dimension(s.analytics, DATED, "region"),
    "time_series_day": lambda s: trends.time_series(s.analytics, DATED, "day"),
    "anomalies_region_z": lambda s: anomalies.detect(s.analytics, DATED, "region"),
    "customer_features": lambda s: segmentation.customer_features(s.analytics, DATED),
    "dq_checks": lambda s: quality.checks(s.raw, DATED),
    "records_recent": lambda s: records.fetch_records(s.analytics, DATED),
    "population_summary": lambda s: kpis.population_summary(s.analytics, DATED),
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_python_in_plan(spark, name):
    assert summarise(plan_text(QUERIES[name](spark, SMOKE)))["python"] == 0


@pytest.mark.parametrize("name", PRUNED)
def test_selection_prunes_and_pushes(source, name):
    s = summarise(plan_text(PRUNED[name](source)))
    assert s["partition_filtered"] >= 1 and s["pushed_filters"] >= 1, s
