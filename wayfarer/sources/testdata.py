"""Adapter: the driver's TPC-H-style tables -> a canonical journey feed.

The testdata has no journey table, so a deterministic mapping turns
``lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region`` into journey-grain records
(with planted defects, exact duplicates and one planted delay window). Every
operator downstream takes *any* canonical feed; this module is only the feed.

Plan shape: customers meet the orders, which are fewer and narrower than lineitem, then
lineitem ⋈ orders is the one big-big join (shuffled on the order key, map-side pruned
to the columns used), so lineitem moves once; customer is left to Spark's size-checked
broadcast threshold; nation ⋈ region is TPC-H's fixed 25-row dimension and is broadcast
outright. Duplicates are produced with one ``explode`` over the joined rows instead of a
second scan + union. Rows are put in order by month while they have the joined columns
only; the 26 columns are made after that.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C

# FIXED VALUES - adapter vocabulary (index = key modulo list length)
MODES_BY_PART = ("Metro", "Train", "Bus", "Light Rail", "Ferry")
PURPOSES_BY_SUPP = ("Commute", "Education", "Business", "Leisure", "Healthcare", "Shopping",
                    "Other")
AGE_BY_CUST = ("16-24", "25-34", "35-49", "50-64", "65+")
FARE_BY_CUST = ("Student", "Adult", "Concession", "Visitor", "Senior")
SEGMENT_BY_MKT = (
    ("AUTOMOBILE", "Frequent Commuters"),
    ("BUILDING", "Occasional Travellers"),
    ("FURNITURE", "Off-Peak Regulars"),
    ("HOUSEHOLD", "Digital-First Customers"),
)
SEGMENT_OTHER = "High-Service-Need Customers"
CHANNEL_BY_PRIORITY = (
    ("1-URGENT", "Contact Centre"),
    ("2-HIGH", "Mobile App"),
    ("3-MEDIUM", "Website"),
    ("5-LOW", "Station Kiosk"),
)
CHANNEL_OTHER = "Third-Party App"
EPOCH = dt.date(1995, 1, 1)
FIRST_DAY = dt.date(2025, 12, 13)
CALENDAR_DAYS = 200
SERVICE_LINE_COUNT = 48


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utc_date(df: DataFrame, name: str) -> Column:
    """Calendar date of a timestamp column independent of the session time zone:
    wall-clock (NTZ) values cast directly; instants (LTZ) by their UTC day."""
    from pyspark.sql import types as T
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_seconds(F.col(name)) / 86400).cast("int"))
    return F.col(name).cast("date")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    """Element ``index`` of a fixed literal list (element_at is 1-based)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _lookup(col: Column, pairs: tuple[tuple[str, str], ...], other: str) -> Column:
    expr = None
    for key, value in pairs:
        expr = (F.when(col == key, value) if expr is None else expr.when(col == key, value))
    return expr.otherwise(other)


def _region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # TPC-H nation/region are fixed-size (25 / 5 rows): a proven broadcast bound.
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey) \
        .select("n_nationkey", "r_name")


def _customer_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nr = _region_dim(spark, sf_dir)
    return customer.join(F.broadcast(nr), customer.c_nationkey == nr.n_nationkey) \
        .select("c_custkey", "c_mktsegment", "r_name")


def journey_feed(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """The canonical 26-column journey feed (raw: defects and duplicates included). ``by_month``
    adds ``month_start``, and each task's rows are in its order, then in that of the dates."""
    l = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cr = _customer_region(spark, sf_dir)
    rows = l.join(o.join(cr, o.o_custkey == cr.c_custkey), l.l_orderkey == o.o_orderkey)

    ok, pk, sk, ln = (F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
                      F.col("l_linenumber"))
    ck = F.col("o_custkey")
    off = F.pmod(F.datediff(utc_date(l, "l_shipdate"), F.lit(EPOCH)), F.lit(CALENDAR_DAYS))
    q = F.col("l_quantity").cast("bigint")
    disr = (pk % 40) == 0
    day = F.date_add(F.lit(FIRST_DAY), off.cast("int"))
    staged = rows.select(
        *(c for c in rows.columns if c not in ("l_shipdate", "o_orderkey", "c_custkey")),
        off.alias("_off"), q.alias("_q"), disr.alias("_disr"),
        F.trunc(day, "month").alias("month_start"),
        # one row, or two identical rows for the planted exact duplicates
        F.explode(F.when((ok % 400) == 13, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")
    if by_month:
        staged = staged.sortWithinPartitions("month_start", "_off")
    q, disr, off = F.col("_q"), F.col("_disr"), F.col("_off")
    cf = ((F.col("l_returnflag") == "R") & (q > 45)) | (disr & ((q % 3) == 0))
    delay = (F.when((ok % 700) == 17, F.lit(999.0))
             .otherwise((q % 12).cast("double") * 0.5
                        + F.when(disr, 12.0).otherwise(0.0)
                        + F.when((F.col("r_name") == "ASIA") & off.between(147, 158), 6.0)
                        .otherwise(0.0)))
    staged = staged.select("*", cf.alias("_cf"), delay.alias("_delay"))
    cf, delay = F.col("_cf"), F.col("_delay")
    day = F.date_add(F.lit(FIRST_DAY), off.cast("int"))
    minutes = ((pk * 7 + ln) % 19 + 5) * 60 + (sk % 60)
    satisfaction = (F.when((ok % 22) == 1, F.lit(None).cast("double"))
                    .when((ok % 650) == 2, F.lit(7.0))
                    .when(delay > 12, 1.0).when(delay > 5, 2.0).when(delay > 4, 3.0)
                    .when(delay > 2, 4.0).otherwise(5.0))
    category = (F.when(~cf, F.lit(None).cast("string"))
                .when(disr, "Information & Wayfinding")
                .when(ln <= 3, "Delay").when(ln <= 5, "Crowding").otherwise("Cleanliness"))
    feedback = (F.when(delay > 8, "Negative - Delay").when(delay > 5, "Negative - Information")
                .when(delay > 2, "Neutral").otherwise("Positive - Reliability"))
    feed = staged.select(
        F.concat(F.lit("J"), ok.cast("string"), F.lit("-"), ln.cast("string"), F.lit("-"),
                 pk.cast("string"), F.lit("-"), sk.cast("string")).alias("journey_id"),
        F.when((ok % 500) == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("C"), ck.cast("string"))).alias("customer_id"),
        day.alias("date"),
        F.when((ok % 250) == 3, F.lit(None).cast("string")).otherwise(F.col("r_name"))
        .alias("region"),
        F.when((ok % 600) == 11, F.lit("UNKNOWN")).otherwise(_pick(pk % 5, MODES_BY_PART))
        .alias("transport_mode"),
        _lookup(F.col("c_mktsegment"), SEGMENT_BY_MKT, SEGMENT_OTHER).alias("customer_segment"),
        delay.alias("delay_minutes"),
        satisfaction.alias("customer_satisfaction"),
        F.timestamp_add("MINUTE", minutes, day.cast("timestamp_ntz")).alias("timestamp"),
        F.col("r_name").alias("origin_region"),
        F.when((ln % 2) == 0, F.lit("ASIA")).otherwise(F.col("r_name")).alias("destination_region"),
        F.concat(F.lit("L"), (sk % SERVICE_LINE_COUNT).cast("string")).alias("service_line"),
        _pick(sk % 7, PURPOSES_BY_SUPP).alias("journey_purpose"),
        _pick(ck % 5, AGE_BY_CUST).alias("age_group"),
        _lookup(F.col("o_orderpriority"), CHANNEL_BY_PRIORITY, CHANNEL_OTHER).alias("channel"),
        F.when((ok % 800) == 5, F.lit(-12.0)).when((ok % 900) == 9, F.lit(300.0))
        .otherwise((q * 2 + 10).cast("double")).alias("journey_duration_minutes"),
        (delay <= C.ON_TIME_THRESHOLD_MINUTES).alias("on_time"),
        cf.alias("complaint_flag"),
        category.alias("complaint_category"),
        F.when(cf, q.cast("double") * 1.5).alias("resolution_time_hours"),
        ((ck % 3) != 0).alias("repeat_customer"),
        disr.alias("service_disruption"),
        (((ck % 11) == 0) & (ln <= 3)).alias("accessibility_service_used"),
        _pick(ck % 5, FARE_BY_CUST).alias("fare_type"),
        ((sk % 10) < (ck % 10)).alias("digital_interaction"),
        feedback.alias("feedback_text_category"),
        "month_start",
    )
    return feed.select(*C.JOURNEY_COLUMNS, *(["month_start"] if by_month else []))


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customers`` dimension: one row per ordering customer."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    first = o.groupBy("o_custkey").agg(F.min(utc_date(o, "o_orderdate")).alias("_first"))
    cr = _customer_region(spark, sf_dir)
    ck = F.col("o_custkey")
    return first.join(cr, first.o_custkey == cr.c_custkey).select(
        F.concat(F.lit("C"), ck.cast("string")).alias("customer_id"),
        _lookup(F.col("c_mktsegment"), SEGMENT_BY_MKT, SEGMENT_OTHER).alias("customer_segment"),
        _pick(ck % 5, AGE_BY_CUST).alias("age_group"),
        F.col("r_name").alias("home_region"),
        _pick(ck % 5, FARE_BY_CUST).alias("fare_type"),
        ((ck % 3) != 0).alias("repeat_customer"),
        ((ck % 10).cast("double") / 10.0).alias("digital_affinity"),
        F.col("_first").alias("first_seen_date"),
    )


def service_line_dim(spark: SparkSession) -> DataFrame:
    """``service_lines`` dimension: the 48 line codes (fixed size by construction)."""
    code = F.col("id")
    return spark.range(SERVICE_LINE_COUNT).select(
        F.concat(F.lit("L"), code.cast("string")).alias("service_line"),
        _pick(code % 5, MODES_BY_PART).alias("transport_mode"),
        F.lit(None).cast("string").alias("region"),
        (F.lit(20.0) + (code % 20).cast("double")).alias("scheduled_duration_minutes"),
        (F.lit(0.7) + (code % 10).cast("double") * 0.05).alias("reliability_index"),
        (F.lit(0.65) + (code % 14).cast("double") * 0.05).alias("capacity_index"),
    )


# FIXED VALUES - the planted incident of the adapter: region ASIA, delay +6 min
# on offsets 147..158 (the known window a detector should recover).
PLANTED_WINDOWS = (
    ("ASIA", "avg_delay_minutes", dt.date(2026, 5, 9), dt.date(2026, 5, 20)),
)


def planted_windows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(PLANTED_WINDOWS),
        "dimension_value STRING, metric STRING, start_date DATE, end_date DATE")
