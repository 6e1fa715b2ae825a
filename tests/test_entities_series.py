"""Entities by a vocabulary, and series filled one by one, by brute force."""

import datetime as dt
import random
import re

import pytest

from wayfarer.operators import routing, trends
from wayfarer.plans.filters import Selection

VOCABULARY = [("region", "North"), ("region", "North West"), ("area", "north west"), ("mode", "Light Rail"),
              ("mode", "Rail"), ("line", "Rail-Link"), ("line", "Ünder Line"), ("region", "North"), ("region", None)]


def mentions(text):
    """Every whole-word term, those inside a longer one taken out."""
    low = (text or "").lower()
    found = set()
    for kind, value in VOCABULARY:
        if value:
            for m in re.finditer(rf"(?=(?<!\w){re.escape(value.lower())}(?!\w))", low):
                found.add((kind, value, m.start(), m.start() + len(value)))
    keep = [f for f in found if not any(
        g[2] <= f[2] and g[3] >= f[3] and g[3] - g[2] > f[3] - f[2] for g in found)]
    return sorted((k, v, len(re.findall(r"\w+", low[:a])) + 1, len(re.findall(r"\w+", v))) for k, v, a, _ in keep)


def test_entities_by_brute_force(spark):
    rng = random.Random(2)
    words = ["north", "West", "light", "rail", "link", "ünder", "line", "the", "northern", ","]
    texts = [None, "", "!!", "North", "light rail", "light-rail", "light  rail", "rail-link rail"]
    texts += ["".join(rng.choice(words) + rng.choice([" ", "-", " ", ", "]) for _ in range(rng.randrange(40)))
              for _ in range(60)]
    asked = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "`a.id` int, question string, kind string")
    vocabulary = spark.createDataFrame(VOCABULARY, "kind string, value string")
    got = {}
    for r in routing.find_entities(asked, vocabulary, ["a.id"]).collect():
        got.setdefault(r["a.id"], []).append((r.kind, r.value, r.first_word, r.n_words))
    assert any(got.values())
    for i, text in enumerate(texts):
        assert sorted(got.get(i, [])) == mentions(text), text


def test_entities_of_nothing(spark):
    none = spark.createDataFrame([], "kind string, value string")
    asked = spark.createDataFrame([(1, "North")], "id int, question string")
    out = routing.find_entities(asked, none, ["id"])
    assert out.columns == ["id", "kind", "value", "first_word", "n_words"] and out.count() == 0
    full = spark.createDataFrame(VOCABULARY, "kind string, value string")
    assert routing.find_entities(asked.limit(0), full, ["id"]).count() == 0


@pytest.mark.parametrize(("question", "tool"), [
    ("Summarise current service performance.", "get_kpi_summary"),
    ("Which customer segment experienced the largest decline in satisfaction?", "analyse_satisfaction"),
])
def test_vocabulary_of_the_journeys(spark, smoke_source, question, tool):
    vocabulary = routing.vocabulary_of(smoke_source.analytics, ("region", "transport_mode"))
    region = min(r.value for r in vocabulary.where("kind = 'region'").collect())
    asked = spark.createDataFrame([(f"{question} {region.upper()}, by light rail",)], "question string")
    found = {(r.kind, r.value) for r in routing.find_entities(asked, vocabulary, ["question"]).collect()}
    row = routing.route(spark.createDataFrame([(question,)], "question string")).first()
    assert row.tool == tool and found == {("region", region), ("transport_mode", "Light Rail")}


def test_series_are_filled_one_by_one(spark):
    rng = random.Random(3)
    day = dt.date(2026, 1, 1)
    values = {(k, day + dt.timedelta(days=d)): float(rng.randrange(9))
              for k in ("a", "b", None) for d in rng.sample(range(60), 15)}
    rows = [(p, k, v) for (k, p), v in values.items()] + [(None, "a", 1.0)]
    series = spark.createDataFrame(rows, "period date, k string, v double")
    out = trends.add_rolling(trends.fill_calendar(series, ["k"]), "v", by=["k"]).collect()
    got = {(r.k, r.period): (r.v, r.v_rolling) for r in out}
    assert len(got) == len(out)
    for k in ("a", "b", None):
        days = [p for (s, p) in values if s == k]
        span = [min(days) + dt.timedelta(days=d) for d in range((max(days) - min(days)).days + 1)]
        assert len(span) > len(days) and {p for (s, p) in got if s == k} == set(span)
        for i, p in enumerate(span):
            frame = [values[k, q] for q in span[max(0, i - 6):i + 1] if (k, q) in values]
            mean = round(sum(frame) / len(frame), 6) if len(frame) >= 2 else None
            assert got[k, p][0] == values.get((k, p)) and got[k, p][1] == pytest.approx(mean, abs=1e-6)


def test_sparse_series_have_gaps(smoke_source):
    by = ["region", "transport_mode", "customer_segment"]
    daily = trends.daily_series(smoke_source.analytics, Selection(), by, ("total_journeys",))
    filled = trends.fill_calendar(daily, by)
    assert filled.where("total_journeys is null").count() > 100
    assert filled.where("total_journeys is not null").count() == daily.where("period is not null").count()
