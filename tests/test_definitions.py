"""Metrics and quality rules defined by rows of a table."""

import pytest
from pyspark.sql import functions as F

from wayfarer.functions import definitions as D
from wayfarer.operators import anomalies, kpis, quality
from wayfarer.plans.filters import Selection


def metrics_of(spark, rows, journeys):
    return D.read_metrics(spark.createDataFrame(rows, D.METRIC_SCHEMA), journeys)


def rules_of(spark, rows, raw):
    return D.read_rules(spark.createDataFrame(rows, D.RULE_SCHEMA), raw)


def row(name="m", kind="avg", value="delay_minutes", condition=None, unit="minutes", label="It's \\ a label", floor=None):
    return (name, label, unit, kind, value, condition, True, False, floor)


def test_every_kind_against_plain_python(spark, smoke_source):
    rows = [row(f"m_{kind}", kind, value, condition)
            for kind, value, condition in (
                ("count", None, "delay_minutes > 5"), ("distinct", "customer_id", "is_weekend"),
                ("rate", "complaint_flag", "transport_mode = 'Bus'"), ("share", "delay_minutes > 5", None),
                ("sum", "delay_minutes", "is_peak"), ("avg", "delay_minutes", "is_peak"),
                ("min", "delay_minutes", "delay_minutes > 3"), ("max", "journey_duration_minutes", None))]
    an = smoke_source.analytics
    registry = metrics_of(spark, rows, an)
    got = kpis.compute_metrics(an, None, [r[0] for r in rows], registry).first().asDict()
    data = an.toPandas()
    peak, delays = data[data.is_peak == True], data.delay_minutes  # noqa: E712
    bus = data[(data.transport_mode == "Bus") & data.complaint_flag.notna()]
    assert got["m_count"] == (delays > 5).sum()
    assert got["m_distinct"] == data[data.is_weekend == True].customer_id.nunique()  # noqa: E712
    assert got["m_rate"] == pytest.approx(100 * bus.complaint_flag.astype(bool).mean())
    assert got["m_share"] == pytest.approx(100 * (delays > 5).mean())
    assert got["m_sum"] == pytest.approx(peak.delay_minutes.sum())
    assert got["m_avg"] == pytest.approx(peak.delay_minutes.mean())
    assert got["m_min"] == delays[delays > 3].min()
    assert got["m_max"] == data.journey_duration_minutes.max()


def test_metrics_reach_comparison_and_breakdown_in_one_scan(spark, smoke_source):
    an = smoke_source.analytics
    registry = metrics_of(spark, [row(), row("n", "count", None, "delay_minutes > 5", "count", None)], an)
    compared = kpis.compare_periods(an, Selection.default(), ["m", "n", "avg_delay_minutes"], registry=registry)
    by = {r.metric: r for r in compared.collect()}
    assert by["m"].label == "It's \\ a label" and by["n"].label == "n"
    assert by["m"].current == by["avg_delay_minutes"].current and by["m"].direction == by["avg_delay_minutes"].direction
    assert compared._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    rolled = kpis.metrics_by_dimension(an, None, "region", ["total_journeys", "m"], rollup=smoke_source.rollup(),
                                       registry=registry)          # the rollup has no such metric
    plain = kpis.metrics_by_dimension(an, None, "region", ["total_journeys", "avg_delay_minutes"])
    assert [tuple(r) for r in rolled.collect()] == [tuple(r) for r in plain.collect()]


def test_anomaly_scan_of_a_defined_metric(spark, source):
    an, days = source.analytics, Selection.default()
    columns = ["dimension_value", "period", "actual", "expected", "z_score", "adverse"]
    wanted = anomalies.detect(an, days, "transport_mode", ["avg_delay_minutes"]).select(columns).collect()
    registry = metrics_of(spark, [row(floor=1.0), row("high", floor=1e9)], an)
    found = anomalies.detect(an, days, "transport_mode", ["m", "high"], registry=registry)
    assert wanted and found.select(columns).collect() == wanted          # nothing moves by the floor of ``high``
    assert found.first().metric_label == "It's \\ a label"


def test_rules(spark, smoke_source):
    raw = smoke_source.raw
    rules = rules_of(spark, [("long_trip", "Trip's \\ length", "Validity", "journey_duration_minutes > 60"),
                             ("unknown", None, "Completeness", "fare_type IS NULL"),
                             ("never", None, "Uniqueness", "CAST(NULL AS BOOLEAN)")], raw)
    rows = {r.check_key: r for r in quality.checks(raw, None, rules).collect()}
    assert list(rows)[-3:] == ["long_trip", "unknown", "never"] and rows["long_trip"].label == "Trip's \\ length"
    assert rows["long_trip"].failed_rows == raw.where("journey_duration_minutes > 60").count()
    assert rows["unknown"].failed_rows == raw.where(F.col("fare_type").isNull()).count()
    assert rows["never"].failed_rows == 0 and rows["never"].passed
    plain, more = quality.score(raw, None).first(), quality.score(raw, None, rules).first()
    assert more.validity_score == pytest.approx(
        max(0.0, plain.validity_score - rows["long_trip"].failure_rate))
    assert quality.worst_check(raw, None, rules).first().worst_check == max(
        rows.values(), key=lambda r: (r.failure_rate, -r.position)).check_key
    assert {r.check_key for r in quality.checks(raw, None, rules_of(spark, [], raw)).collect()} == set(rows) - {
        "long_trip", "unknown", "never"}


@pytest.mark.parametrize("wrong, says", [
    (row("total_journeys"), "built-in"), (row("region"), "built-in"), (row("period"), "built-in"),
    (row("a b"), "name"), (row(None), "name"), (row(kind="median"), "kind"), (row(unit="km"), "unit"),
    (row(value=None), "value"), (row(kind="count"), "value"), (row(value="region"), "string"),
    (row(kind="rate"), "double"), (row(value="no_such_column"), "expression"), (row(value="delay_minutes +"), "expression"),
    (row(value="sum(delay_minutes)"), "expression"), (row(value="rand()"), "expression"),
    (row(value="lag(delay_minutes) over (order by date)"), "expression"), (row(condition="delay_minutes"), "double"),
])
def test_wrong_metrics_are_refused(spark, smoke_source, wrong, says):
    with pytest.raises(ValueError, match=says):
        metrics_of(spark, [wrong], smoke_source.analytics)


@pytest.mark.parametrize("wrong, says", [
    (("null_customer_id", None, "Validity", "true"), "built-in"), (("present_x", None, "Validity", "true"), "built-in"),
    (("r", None, "Beauty", "true"), "category"), (("r", None, "Validity", None), "predicate"),
    (("r", None, "Validity", "delay_minutes"), "double"), (("r", None, "Validity", "count(*) > 1"), "expression"),
])
def test_wrong_rules_are_refused(spark, smoke_source, wrong, says):
    with pytest.raises(ValueError, match=says):
        rules_of(spark, [wrong], smoke_source.raw)


def test_names_are_unique_and_tables_bounded(spark, smoke_source):
    with pytest.raises(ValueError, match="Several"):
        metrics_of(spark, [row(), row()], smoke_source.analytics)
    with pytest.raises(ValueError, match="More than"):
        metrics_of(spark, [row(f"m{i}") for i in range(D.MOST_ROWS + 1)], smoke_source.analytics)
