"""The feed store against a build from scratch, for added, changed and withdrawn files."""

import datetime as dt
import os

import pytest

from wayfarer import config as C
from wayfarer.plans.model import JourneySource
from wayfarer.plans.store import FeedStore
from wayfarer.sources import feeds

COLUMNS = [*C.REQUIRED_COLUMNS, "timestamp"]


def row(journey, day, delay=1, stamp="", customer="C1"):
    return (journey, customer, day, "North", "Bus", "Frequent Commuters", str(delay), "4", stamp)


def put(folder, name, rows, columns=COLUMNS):
    lines = [",".join(columns), *[",".join(r) for r in rows]]
    (folder / name).write_text("\n".join(lines) + "\n")


def content(df):
    return sorted(df.collect(), key=str)


def same_as_scratch(spark, store, uploads):
    """The store's rows equal those of the uploads taken one by one."""
    frames = [feeds.canonicalise(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))
                                 .replace("", None)) for rows in uploads if rows]
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    want, got = JourneySource.from_journeys(spark, whole), store.source()
    assert content(got.journeys) == content(want.journeys)
    assert content(got.raw) == content(want.raw)
    assert content(got.analytics.select(want.analytics.columns)) == content(want.analytics)


@pytest.fixture
def store(spark, tmp_path):
    (tmp_path / "in").mkdir()
    return FeedStore(spark, str(tmp_path / "in"), str(tmp_path / "store")), tmp_path / "in"


def test_added_changed_withdrawn(spark, store):
    store, folder = store
    a = [row("J1", "2026-05-02", 3, "2026-05-02 09:00:00"), row("J2", "2026-05-03", 1, "2026-05-03 09:00:00"),
         row("J3", "not a day", 2, "2026-06-01 10:00:00")]
    # J1 again, earlier, in another month, and a file without any timestamp
    b = [row("J1", "2026-04-30", 9, "2026-04-30 07:00:00"), row("J4", "2026-06-09", -5, "2026-06-09 07:00:00")]
    c = [row("J5", "2026-06-10"), row("J2", "2026-06-11")]
    put(folder, "a.csv", a)
    put(folder, "c.csv", c)
    assert store.refresh() and store.current()[0] == 1
    same_as_scratch(spark, store, [a, c])
    assert not store.refresh() and store.current()[0] == 1

    put(folder, "b.csv", b)                                      # added
    assert store.refresh()
    same_as_scratch(spark, store, [a, b, c])
    untouched = {m: tag for m, tag in store._held(store.current()[1])["journeys"]}
    assert untouched[dt.date(2026, 5, 1)].startswith("v000001")  # b holds no rows of May ...
    chosen = {r.journey_id: r.date for r in store.source().analytics.collect()}
    assert chosen["J1"] == dt.date(2026, 4, 30)                  # ... and still takes May's J1

    a = [row("J2", "2026-05-03", 7, "2026-05-03 09:00:00"), row("J6", "2026-05-04", 0, "2026-05-04 01:00:00")]
    put(folder, "a.csv", a)                                      # changed
    assert store.refresh()
    same_as_scratch(spark, store, [a, b, c])

    os.remove(folder / "b.csv")                                  # withdrawn
    assert store.refresh() and store.current()[0] == 4
    same_as_scratch(spark, store, [a, c])

    removed = store.remove_old()
    assert removed and all(not t.startswith("v000004") for t in removed)
    same_as_scratch(spark, store, [a, c])
    assert store.remove_old() == [] and not store.refresh()


def test_empty_feed_and_failed_refresh(spark, store):
    store, folder = store
    put(folder, "a.csv", [])
    assert store.refresh()
    assert store.source().journeys.count() == store.source().analytics.count() == 0
    put(folder, "b.csv", [row("J1", "2026-05-02")])
    assert store.refresh()
    same_as_scratch(spark, store, [[row("J1", "2026-05-02")]])
    # two headers in one refresh are refused, and the version before stays
    put(folder, "c.csv", [("J9", "2026-05-02")], ["journey_id", "date"])
    put(folder, "d.csv", [row("J8", "2026-05-02")])
    with pytest.raises(Exception):
        store.refresh()
    assert store.current()[0] == 2
    same_as_scratch(spark, store, [[row("J1", "2026-05-02")]])
    os.remove(folder / "c.csv")
    os.remove(folder / "d.csv")
    assert not store.refresh() and store.remove_old()
    same_as_scratch(spark, store, [[row("J1", "2026-05-02")]])


def test_open_reads_only_asked_months(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "a.csv", [row(f"J{i}", f"2026-0{1 + i % 6}-10") for i in range(30)])
    src = JourneySource.open(spark, str(folder), str(tmp_path / "store"))
    may = src.analytics.where("month_start = DATE'2026-05-01'")
    assert may.count() == 5 and len(may.inputFiles()) >= 1
    plan = may._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month_start" in plan.split("PartitionFilters", 1)[1]
    assert src.rollup().cells.count() > 0


def test_only_ids_with_several_or_lost_rows_are_chosen_anew(spark, store):
    store, folder = store
    put(folder, "a.csv", [row("J1", "2026-05-02"), row("J2", "2026-05-03"), row("J3", "2026-05-04", -1)])
    store.refresh()
    assert store._table("ids", "_h long", store.current()[1]).isEmpty()
    put(folder, "b.csv", [row("J1", "2026-06-02"), row("J3", "2026-06-03"), row("J4", "2026-06-04")])
    store.refresh()
    chosen = store._table("ids", "_h long", store.current()[1]).collect()
    want = spark.createDataFrame([("J1",)], "i string").selectExpr("xxhash64(i) as _h").collect()
    assert chosen == want
    assert {r.journey_id for r in store.source().analytics.collect()} == {"J1", "J2", "J3", "J4"}
