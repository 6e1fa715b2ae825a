"""Known windows against detections, and the order of moves."""

import datetime as dt
import random

from pyspark.sql import functions as F

from wayfarer.operators import anomalies, kpis
from wayfarer.plans.filters import Selection

DAY = dt.date(2026, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def test_recall_by_brute_force(spark):
    rng = random.Random(4)
    found = [(s, m, day(rng.randrange(60))) for s in ("A", "B", None) for m in ("x", "y") for _ in range(25)]
    spans = sorted({(rng.choice("ABC"), rng.choice("xyz"), a, a + rng.randrange(9)) for a in rng.choices(range(60), k=40)})
    detections = spark.createDataFrame(found, "dimension_value string, metric string, period date")
    windows = spark.createDataFrame([(s, m, day(a), day(b)) for s, m, a, b in spans * 2],
                                    "dimension_value string, metric string, start_date date, end_date date")
    got = {(r.dimension_value, r.metric, r.start_date, r.end_date): r for r in
           anomalies.window_recall(detections, windows).collect()}
    assert len(got) == len(spans)
    for s, m, a, b in spans:
        days = {d for t, k, d in found if (t, k) == (s, m)}
        inside = sum(day(a) <= d <= day(b) for d in days)
        r = got[s, m, day(a), day(b)]
        assert (r.window_days, r.days_detected, r.days_outside) == (b - a + 1, inside, len(days) - inside)
        assert r.recall == inside / (b - a + 1) and r.precision == (inside / len(days) if days else None)


def test_a_million_windows(spark):
    windows = spark.range(1_000_000).select(
        F.concat(F.lit("s"), (F.col("id") % 50).cast("string")).alias("dimension_value"), F.lit("m").alias("metric"),
        F.date_add(F.lit(DAY), (F.col("id") / 50).cast("int")).alias("start_date"),
        F.date_add(F.lit(DAY), ((F.col("id") / 50) + 6).cast("int")).alias("end_date"))
    detections = spark.range(5_000).select(
        F.concat(F.lit("s"), (F.col("id") % 50).cast("string")).alias("dimension_value"), F.lit("m").alias("metric"),
        F.date_add(F.lit(DAY), (F.col("id") / 50 * 10).cast("int")).alias("period"))
    out = anomalies.window_recall(detections, windows)
    total = out.agg(F.count(F.lit(1)), F.sum("days_detected")).first()
    days = [int(i / 50 * 10) for i in range(0, 5_000)]
    want = sum(min(d, 19_999) - max(d - 6, 0) + 1 for d in days)
    assert total[0] == 1_000_000 and total[1] == want


def test_largest_moves_first(smoke_source):
    moves = [abs(r.absolute_change) for r in kpis.period_over_period_by_dimension(
        smoke_source.analytics, Selection.default(), "region", "avg_delay_minutes", 1).collect()]
    assert len(moves) > 2 and moves == sorted(moves, reverse=True)
