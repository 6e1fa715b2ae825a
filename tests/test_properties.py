"""Property tests: validity, de-duplication and the metric registry against a
pure-Python brute force on random small journey frames."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wayfarer import config as C
from wayfarer.operators import kpis
from wayfarer.plans.model import JourneySource
from wayfarer.sources import feeds

IDS = st.sampled_from(["A", "B", "C", "D", None])
DAYS = st.sampled_from([dt.date(2026, 6, 1), dt.date(2026, 6, 2), dt.date(2026, 6, 6), None])
TS = st.sampled_from([dt.datetime(2026, 6, 1, 8), dt.datetime(2026, 6, 1, 17),
                      dt.datetime(2026, 6, 2, 12), None])
DELAY = st.sampled_from([0.0, 2.5, 5.0, 7.5, 200.0, -1.0, None])
SAT = st.sampled_from([1.0, 3.0, 5.0, 7.0, None])
MODE = st.sampled_from(["Bus", "Metro", "UNKNOWN", None])
FLAG = st.sampled_from([True, False, None])
CUST = st.sampled_from(["C1", "C2", None])

ROW = st.fixed_dictionaries(dict(
    journey_id=IDS, customer_id=CUST, date=DAYS, timestamp=TS, transport_mode=MODE,
    delay_minutes=DELAY, customer_satisfaction=SAT, complaint_flag=FLAG, on_time=FLAG,
    journey_duration_minutes=st.sampled_from([10.0, 300.0, -5.0, None])))


def _valid(r):
    d, dur, s = r["delay_minutes"], r["journey_duration_minutes"], r["customer_satisfaction"]
    return (d is not None and 0 <= d <= 180 and (dur is None or 0 < dur <= 240)
            and (s is None or 1 <= s <= 5) and r["transport_mode"] in C.TRANSPORT_MODES
            and r["journey_id"] is not None)


def _order_key(r):
    def nf(v):            # NULLS FIRST
        return (v is not None, v if v is not None else 0)
    others = [c for c in C.JOURNEY_COLUMNS if c not in ("journey_id", "timestamp", "date")]
    ts, day = r["timestamp"], r["date"]
    return ((ts is None, ts or dt.datetime.min), (day is None, day or dt.date.min),
            *[nf(r[c]) for c in others])


def _brute(rows):
    canon = []
    # canonicalisation rule: a wholly empty timestamp column defaults to the date
    no_timestamps = all(r.get("timestamp") is None for r in rows)
    for r in rows:
        full = {c: r.get(c) for c in C.JOURNEY_COLUMNS}
        if no_timestamps and full["date"] is not None:
            full["timestamp"] = dt.datetime.combine(full["date"], dt.time())
        if full["on_time"] is None:
            d = full["delay_minutes"]
            full["on_time"] = bool(d is not None and d <= 5.0)
        canon.append(full)
    best = {}
    for r in filter(_valid, canon):
        k = r["journey_id"]
        if k not in best or _order_key(r) < _order_key(best[k]):
            best[k] = r
    return list(best.values())


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=25))
def test_dedup_and_metrics_match_brute_force(spark, rows):
    df = feeds.canonicalise(spark.createDataFrame(
        rows, "journey_id string, customer_id string, date date, timestamp timestamp_ntz, "
              "transport_mode string, delay_minutes double, customer_satisfaction double, "
              "complaint_flag boolean, on_time boolean, journey_duration_minutes double"))
    src = JourneySource.from_journeys(spark, df)
    got = sorted((r.journey_id, r.delay_minutes, r.customer_satisfaction, r.timestamp, r.date)
                 for r in src.analytics.collect())
    kept = _brute(rows)
    want = sorted((r["journey_id"], r["delay_minutes"], r["customer_satisfaction"],
                   r["timestamp"], r["date"]) for r in kept)
    got = sorted(got, key=repr)
    want = sorted(want, key=repr)
    assert got == want

    m = kpis.compute_metrics(src.analytics, None, ["total_journeys", "active_customers",
                                                   "avg_delay_minutes", "on_time_performance",
                                                   "complaint_rate"]).first()
    assert m.total_journeys == len(kept)
    assert m.active_customers == len({r["customer_id"] for r in kept if r["customer_id"]})
    delays = [r["delay_minutes"] for r in kept]
    if delays:
        assert math.isclose(m.avg_delay_minutes, sum(delays) / len(delays))
    else:
        assert m.avg_delay_minutes is None
    for key, flag in (("on_time_performance", "on_time"), ("complaint_rate", "complaint_flag")):
        known = [r[flag] for r in kept if r[flag] is not None]
        value = getattr(m, key)
        if known:
            assert math.isclose(value, 100.0 * sum(known) / len(known))
        else:
            assert value is None


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=25))
def test_quality_rule_counts_match_brute_force(spark, rows):
    from wayfarer.operators import quality
    df = feeds.canonicalise(spark.createDataFrame(
        rows, "journey_id string, customer_id string, date date, timestamp timestamp_ntz, "
              "transport_mode string, delay_minutes double, customer_satisfaction double, "
              "complaint_flag boolean, on_time boolean, journey_duration_minutes double"))
    src = JourneySource.from_journeys(spark, df)
    got = {r.check_key: r.failed_rows for r in quality.checks(src.raw, None).collect()}
    sat = [r["customer_satisfaction"] for r in rows]
    dur = [r["journey_duration_minutes"] for r in rows]
    delay = [r["delay_minutes"] for r in rows]
    want = {
        "null_customer_id": sum(r["customer_id"] is None for r in rows),
        "missing_region": len(rows),                      # no region column in the feed
        "missing_satisfaction": sum(s is None for s in sat),
        "invalid_satisfaction": sum(s is not None and (s < 1 or s > 5) for s in sat),
        "negative_duration": sum(d is not None and d <= 0 for d in dur),
        "implausible_duration": sum(d is not None and d > 240 for d in dur),
        "invalid_delay": sum(d is None or d < 0 or d > 180 for d in delay),
        "invalid_transport_mode": sum(r["transport_mode"] not in C.TRANSPORT_MODES for r in rows),
        "duplicate_journey_id": len(rows) - len({r["journey_id"] for r in rows
                                                 if r["journey_id"] is not None}),
    }
    assert got == want


def _route_brute(question):
    import re
    low = (question or "").lower().strip()
    if not low:
        return C.DEFAULT_TOOL, None, None, None, None
    scores = {name: sum(len(k) for k in kws if k in low) for name, kws in C.ROUTING_TOOLS}
    best = max(scores.values())
    tool = next(n for n, _ in C.ROUTING_TOOLS if scores[n] == best) if best else C.DEFAULT_TOOL
    region = next((r for r in C.REGIONS if re.search(rf"\b{r.lower()}\b", low)), None)
    mode = next((m for m in C.TRANSPORT_MODES if re.search(rf"\b{m.lower()}\b", low)), None)
    segs = [s for s, toks in C.SEGMENT_TOKENS if any(t in low for t in toks)]
    a = segs[0] if segs else None
    b = segs[1] if len(segs) > 1 else None
    if b is not None and best:
        tool = "compare_segments"
    return tool, region, mode, a, b


WORDS = st.sampled_from([k for _, kws in C.ROUTING_TOOLS for k in kws]
                        + [r.lower() for r in C.REGIONS] + ["Light Rail", "ferry", "regional",
                                                           "eastern", "x", "the", "1", "_west"])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(WORDS, max_size=6).map(" ".join), min_size=1, max_size=30))
def test_routing_matches_brute_force(spark, questions):
    from wayfarer.operators import routing
    df = spark.createDataFrame([(q,) for q in questions], "question string")
    for q, r in zip(questions, routing.route(df).collect()):
        assert (r.tool, r.region, r.transport_mode, r.segment_a, r.segment_b) == _route_brute(q), q


def test_routing_matches_brute_force_on_conversations(spark, source):
    from wayfarer.operators import routing
    from wayfarer.sources.testdata import table
    out = routing.route(routing.user_questions(table(spark, source.sf_dir, "conversations")))
    for r in out.collect():
        assert (r.tool, r.region, r.transport_mode, r.segment_a, r.segment_b) == \
            _route_brute(r.question), r.question[:80]
