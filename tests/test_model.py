"""Canonical feed, enrichment, validity and de-duplication on tiny frames."""

import datetime as dt

from pyspark.sql import functions as F

from wayfarer import config as C
from wayfarer.plans.model import JourneySource, enrich
from wayfarer.sources import feeds


def _upload(spark, rows, cols):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_minimal_upload_three_rows(spark):
    cols = list(C.REQUIRED_COLUMNS)
    rows = [("J1", "C1", "2026-06-01", "North", "Bus", "Frequent Commuters", "1", "4"),
            ("J2", "C2", "2026-06-02", "North", "Bus", "Frequent Commuters", "12", "2"),
            ("J3", "C3", "2026-06-03", "South", "Metro", "Frequent Commuters", "3", "5")]
    feed = feeds.canonicalise(_upload(spark, rows, cols))
    assert feed.columns == list(C.JOURNEY_COLUMNS)
    src = JourneySource.from_journeys(spark, feed)
    got = src.analytics.orderBy("journey_id").select("on_time", "timestamp", "date").collect()
    assert [r.on_time for r in got] == [True, False, True]
    # whole timestamp column absent -> timestamp defaults to the date
    assert all(r.timestamp == dt.datetime.combine(r.date, dt.time()) for r in got)
    assert src.raw.count() == 3


def test_headers_and_booleans(spark):
    df = spark.createDataFrame(
        [(" J1", "yes", "Y"), ("J2", "0", "FALSE")], "` Journey_ID ` string, Complaint_Flag string, SERVICE_DISRUPTION string")
    out = feeds.canonicalise(df).orderBy("complaint_flag").collect()
    assert [r.complaint_flag for r in out] == [False, True]
    # 'Y' is not an accepted boolean text -> NULL
    assert sorted([str(r.service_disruption) for r in out]) == ["False", "None"]


def test_validation_reports_everything(spark):
    df = spark.createDataFrame([("x", "y")], "journey_id string, date string")
    rows = feeds.validate_feed(df).collect()
    assert rows[0].code == "missing_required_columns"
    cols = list(C.REQUIRED_COLUMNS)
    bad = _upload(spark, [("J1", "C1", "not a date", "N", "Bus", "S", "x", "y")], cols)
    codes = {r.code for r in feeds.validate_feed(bad).collect()}
    # absent optional columns are told only where nothing is wrong
    assert codes == {"dates_unparseable", "delay_minutes_not_numeric",
                     "customer_satisfaction_not_numeric"}


def test_validation_of_booleans_empty_feeds_and_files(spark, tmp_path):
    good = ("J1", "C1", "30 Jun 2026", "N", "Bus", "S", "1", "4")
    cols = [*C.REQUIRED_COLUMNS, "on_time", "complaint_flag"]
    feed = _upload(spark, [(*good, "Y", "yes"), (*good, "TRUE ", None), (*good, "1", "")], cols)
    found = {r.code: r.n_rows for r in feeds.validate_feed(feed).collect()}
    assert found == {"unrecognised_booleans": 2, "absent_optional_columns": 16}
    nothing = spark.createDataFrame([], "journey_id string")
    assert [r.code for r in feeds.validate_feed(nothing).collect()] == ["empty_feed"]
    lost = feeds.validate_csv(spark, str(tmp_path / "nowhere.csv")).collect()
    assert [(r.level, r.code) for r in lost] == [("error", "unreadable_file")]


def test_date_and_timestamp_formats(spark):
    texts = ["2026-06-30", "2026/06/30", "6/30/2026", "30 Jun 2026", "30 June 2026",
             "Jun 30, 2026", "2026/06/30 08:05"]
    df = spark.createDataFrame([(str(i), t, t) for i, t in enumerate([*texts, "soon", ""])],
                               "journey_id string, date string, timestamp string")
    out = {r.journey_id: r for r in feeds.canonicalise(df).collect()}
    for i, text in enumerate(texts):
        assert out[str(i)].date == dt.date(2026, 6, 30), text
        clock = dt.time(8, 5) if text.endswith("08:05") else dt.time()
        assert out[str(i)].timestamp == dt.datetime.combine(dt.date(2026, 6, 30), clock), text
    assert out["7"].date is None and out["8"].date is None


def test_invalid_rows_removed_and_dedup(spark):
    base = dict(customer_id="C1", region="North", transport_mode="Bus",
                customer_segment="S", customer_satisfaction=4.0, date=dt.date(2026, 6, 1))
    rows = [
        dict(base, journey_id="A", delay_minutes=1.0, timestamp=dt.datetime(2026, 6, 1, 9)),
        dict(base, journey_id="A", delay_minutes=7.0, timestamp=dt.datetime(2026, 6, 1, 8)),
        dict(base, journey_id="B", delay_minutes=999.0, timestamp=dt.datetime(2026, 6, 1, 8)),
        dict(base, journey_id="C", delay_minutes=2.0, transport_mode="UNKNOWN",
             timestamp=dt.datetime(2026, 6, 1, 8)),
        dict(base, journey_id=None, delay_minutes=2.0, timestamp=dt.datetime(2026, 6, 1, 8)),
    ]
    df = feeds.canonicalise(spark.createDataFrame(rows))
    src = JourneySource.from_journeys(spark, df)
    got = src.analytics.collect()
    assert len(got) == 1 and got[0].journey_id == "A" and got[0].delay_minutes == 7.0


def test_no_weekend_peak(smoke_source):
    assert smoke_source.raw.where(F.col("is_weekend") & F.col("is_peak")).count() == 0
    bands = {r.time_band for r in smoke_source.raw.select("time_band").distinct().collect()}
    assert bands <= {"Weekend", "AM Peak", "PM Peak", "Off-Peak"}


def test_enrich_without_dimensions_has_typed_nulls(smoke_source):
    fields = {f.name: f.dataType.simpleString() for f in smoke_source.raw.schema.fields}
    assert fields["digital_affinity"] == "double"
    assert fields["customer_first_seen_date"] == "date"
    assert smoke_source.raw.where(F.col("line_capacity_index").isNotNull()).count() == 0


def test_dimensions_joined(smoke_source):
    df = smoke_source.enriched_with_dimensions()
    assert df.count() == smoke_source.raw.count()
    assert df.where(F.col("customer_id").isNotNull()
                    & F.col("customer_home_region").isNull()).count() == 0


def test_text_timestamps_and_numbers_parse(spark):
    df = spark.createDataFrame(
        [("J1", "2026-06-01", "2026-06-01 08:15:00", "3.5", "NaN"),
         ("J2", "2026-06-02", "not a time", "x", "4")],
        "journey_id string, date string, timestamp string, delay_minutes string, "
        "customer_satisfaction string")
    rows = {r.journey_id: r for r in feeds.canonicalise(df).collect()}
    assert rows["J1"].timestamp == dt.datetime(2026, 6, 1, 8, 15)
    assert rows["J2"].timestamp is None            # present column: no default to the date
    assert rows["J1"].delay_minutes == 3.5 and rows["J2"].delay_minutes is None
    assert rows["J1"].customer_satisfaction is None and rows["J2"].customer_satisfaction == 4.0
    assert rows["J1"].on_time is True and rows["J2"].on_time is False


def test_dimension_joins_agree_when_shuffled(spark, source):
    lines = spark.createDataFrame([("L1", 0.5, 1.0, 30.0)],
                                  "service_line string, reliability_index double, "
                                  "capacity_index double, scheduled_duration_minutes double")
    customers = (source.journeys.where("customer_id is not null").groupBy("customer_id")
                 .agg(F.min("region").alias("home_region"), F.min("date").alias("first_seen_date"))
                 .withColumn("digital_affinity", F.lit(0.25)))

    def digest():
        rows = enrich(source.journeys, customers, lines)
        assert rows.columns == enrich(source.journeys).columns
        return rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")),
                        F.count("digital_affinity"), F.count("line_capacity_index")).first()

    small = digest()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert digest() == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    keyed = source.journeys.where("customer_id is not null").count()
    assert small[0] == source.journeys.count() and small[2] == keyed < small[0]


def _tables(spark, path):
    """Tables of the testdata's schema whose rows are repeated, lack keys or dates, and repeat an id in two months."""
    day = lambda m, d: dt.datetime(1995, m, d)
    frames = {
        "region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
        "nation": ([(0, 0), (1, 1)], "n_nationkey int, n_regionkey int"),
        "customer": ([(1, 0, "BUILDING"), (2, 1, "MACHINERY"), (2, 1, "MACHINERY"), (None, 0, "X")],
                     "c_custkey long, c_nationkey int, c_mktsegment string"),
        "orders": ([(i, 1 + i % 2, "2-HIGH") for i in range(1, 40)] + [(40, None, "5-LOW"), (41, 9, "5-LOW")],
                   "o_orderkey long, o_custkey long, o_orderpriority string"),
        "lineitem": ([(i, 3 * i, i, 1, float(i), "R", day(1 + i % 7, 3)) for i in range(1, 42)]
                     + [(4, 12, 4, 1, 4.0, "R", day(2, 9)), (6, 18, 6, 1, 6.0, "N", None), (10, 31, 10, 2, 6.0, "N", None),
                        (8, 24, 8, 1, None, "N", day(3, 9)), (None, 1, 1, 1, 1.0, "R", day(3, 3))],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_returnflag string, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")


def test_stored_months_hold_the_rows_of_the_feed(spark, tmp_path):
    from wayfarer.plans.model import JourneySource
    _tables(spark, tmp_path)
    got = JourneySource.from_testdata(spark, str(tmp_path))
    want = JourneySource.from_testdata(spark, str(tmp_path), materialize=False)
    for name in ("journeys", "raw", "analytics"):
        mine, other = getattr(got, name), getattr(want, name)
        assert mine.columns == other.columns
        assert sorted(mine.collect(), key=str) == sorted(other.collect(), key=str), name
    assert want.analytics.where("month_start is null").count() and want.analytics.count() < want.journeys.count()


def test_rows_are_stored_without_shuffles_of_all_columns(spark, smoke_source):
    from wayfarer.plans.model import repeated_keys, single_rows, small_side
    from wayfarer.sources.testdata import journey_feed
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    feed = plan(journey_feed(spark, smoke_source.sf_dir, by_month=True))
    head, tail = feed.split("Sort [month_start", 1)
    assert "Exchange" not in head and "journey_id" in head and "journey_id" not in tail
    stored = spark.read.parquet(f"{smoke_source.base}/journeys")
    repeated = small_side(repeated_keys(stored).checkpoint())
    rows = plan(single_rows(stored, repeated, "2026-05-01"))
    assert "BroadcastExchange" in rows and "hashpartitioning" not in rows and "Sort" not in rows
