"""Raw enriched rows, the validity predicate and analysable rows.

* ``enrich``       - journey rows + derived time columns (+ optional dimensions)
* ``valid_rows``   - the hard validity predicate
* ``dedupe``       - one row per journey_id, first by (timestamp, date)
* ``JourneySource``- holder of the raw and analytics DataFrames; materialises
                     them once as parquet in the shared checkpoint folder,
                     analytics partitioned by ``month_start`` for pruning.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..session import ensure_checkpoint_dir
from .rollup import Rollup

# Hashes of keys (some 20 bytes each in a hash table) up to this many are broadcast.
BROADCAST_KEYS = 2_000_000
# Stored bytes that a task of the analytics write reads, and months written at once.
ANALYTICS_TASK_BYTES = 32 << 20
MONTHS_AT_ONCE = 8
COMPRESSION = "zstd"    # of the stored tables

# Join keys that rows without a key are spread over.
NULL_KEY_SPREAD = 9973
# Folder name of rows without a month.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def derived_columns(stored_month: bool = False) -> list[Column]:
    """The seven derived time columns; ``stored_month`` reuses a stored
    ``month_start`` partition column (so selections prune partitions)."""
    ts, day = F.col("timestamp"), F.col("date")
    hour = F.hour(ts)
    dow = F.dayofweek(day) - 1                      # 0 = Sunday
    weekend = F.coalesce(dow.isin(0, 6), F.lit(False))
    am = hour.between(*C.PEAK_HOURS_AM)
    pm = hour.between(*C.PEAK_HOURS_PM)
    return [
        hour.alias("journey_hour"),
        dow.alias("day_of_week"),
        weekend.alias("is_weekend"),
        F.when(weekend, False).when(am | pm, True).otherwise(False).alias("is_peak"),
        F.when(weekend, "Weekend").when(am, "AM Peak").when(pm, "PM Peak")
        .otherwise("Off-Peak").alias("time_band"),
        F.trunc(day, "week").alias("week_start"),
        (F.col("month_start") if stored_month else F.trunc(day, "month")).alias("month_start"),
    ]


def null_dimension_columns() -> list[Column]:
    return [
        F.lit(None).cast("string").alias("customer_home_region"),
        F.lit(None).cast("double").alias("digital_affinity"),
        F.lit(None).cast("date").alias("customer_first_seen_date"),
        F.lit(None).cast("double").alias("line_reliability_index"),
        F.lit(None).cast("double").alias("line_capacity_index"),
        F.lit(None).cast("double").alias("line_scheduled_minutes"),
    ]


def _with_dimension(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``facts`` left-joined with ``dim`` on the text ``key``. Rows without a key match
    nothing, and get keys of their own, so that a shuffle doesn't send them to one task.
    Whether the join shuffles or broadcasts is left to the sizes that Spark knows."""
    own = F.concat(F.lit("none "), F.pmod(F.xxhash64("journey_id"), F.lit(NULL_KEY_SPREAD))
                   .cast("string"))
    at = F.coalesce(F.concat(F.lit("key "), F.col(key)), own)
    side = dim.withColumn("_at", F.concat(F.lit("key "), F.col(key))).drop(key)
    return facts.withColumn("_at", at).join(side, "_at", "left").drop("_at")


def enrich(journeys: DataFrame, customers: DataFrame | None = None,
           lines: DataFrame | None = None, stored_month: bool = False) -> DataFrame:
    """The raw enriched view. Without dimensions the six attributes are typed NULLs."""
    base = journeys.select(*C.JOURNEY_COLUMNS, *derived_columns(stored_month))
    if customers is None or lines is None:
        return base.select("*", *null_dimension_columns())

    cust = customers.select(
        "customer_id",
        F.col("home_region").alias("customer_home_region"),
        "digital_affinity",
        F.col("first_seen_date").alias("customer_first_seen_date"))
    line = lines.select(
        "service_line",
        F.col("reliability_index").alias("line_reliability_index"),
        F.col("capacity_index").alias("line_capacity_index"),
        F.col("scheduled_duration_minutes").alias("line_scheduled_minutes"))

    joined = _with_dimension(_with_dimension(base, cust, "customer_id"), line, "service_line")
    return joined.select(*C.JOURNEY_COLUMNS, *C.DERIVED_COLUMNS, *C.DIMENSION_ATTRIBUTE_COLUMNS)


def valid_predicate() -> Column:
    delay = F.col("delay_minutes")
    duration = F.col("journey_duration_minutes")
    sat = F.col("customer_satisfaction")
    return (
        delay.isNotNull() & (delay >= 0) & (delay <= C.MAX_PLAUSIBLE_DELAY_MINUTES)
        & (duration.isNull() | ((duration > 0) & (duration <= C.MAX_PLAUSIBLE_DURATION_MINUTES)))
        & (sat.isNull() | sat.between(C.SATISFACTION_MIN, C.SATISFACTION_MAX))
        & F.col("transport_mode").isin(*C.TRANSPORT_MODES)
        & F.col("journey_id").isNotNull()
    )


def repeated_keys(rows: DataFrame, key: str = "journey_id") -> DataFrame:
    """_h: the hashes of keys that occur more than once. One narrow aggregate: eight bytes a row move."""
    return (rows.groupBy(F.xxhash64(key).alias("_h")).agg(F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("_h"))


def dedupe(rows: DataFrame, key: str = "journey_id", repeated: DataFrame | None = None) -> DataFrame:
    """Keep the first row per key by (timestamp, date) NULLS LAST, then the
    remaining columns as a total-order tie-break (NULLS FIRST).

    Expressed as ``groupBy(key).agg(min(struct))`` rather than a
    ``row_number`` window: the aggregate combines map-side, so a key holding a
    large share of all rows shrinks to one row per map task before the shuffle
    instead of landing whole in one window partition.

    With ``repeated`` (a stored ``repeated_keys``) only the rows of those keys are aggregated;
    the others are single and pass as they are. Spark broadcasts the hashes if their stored
    size allows, else it joins by shuffle. Keys that share a hash are told apart by the aggregate.
    """
    if repeated is not None:
        hashed = rows.withColumn("_h", F.xxhash64(key))
        single = hashed.join(repeated, "_h", "left_anti").select(*rows.columns)
        several = hashed.join(repeated, "_h", "left_semi").select(*rows.columns)
        return single.unionByName(dedupe(several, key))
    others = [c for c in rows.columns if c not in (key, "timestamp", "date")]
    order = F.struct(
        F.col("timestamp").isNull().alias("_ts_null"), F.col("timestamp"),
        F.col("date").isNull().alias("_date_null"), F.col("date"),
        *[F.col(c) for c in others])
    first = rows.groupBy(key).agg(F.min(order).alias("_first"))
    return first.select(key, "_first.timestamp", "_first.date",
                        *[F.col(f"_first.{c}") for c in others]).select(*rows.columns)


def small_side(keys: DataFrame) -> DataFrame:
    """Stored hashes, to be broadcast if they are up to BROADCAST_KEYS; else Spark joins by their size."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def valid_rows(enriched: DataFrame) -> DataFrame:
    return enriched.where(valid_predicate())


def analytics_rows(enriched: DataFrame) -> DataFrame:
    """Valid rows only, one per journey_id (validity first, then de-duplication)."""
    return dedupe(valid_rows(enriched))


def analytics_from_journeys(journeys: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Same rows as ``analytics_rows(enrich(journeys))``, planned narrower: the
    validity predicate and the de-duplication only read canonical columns and
    the derived columns are functions of the row, so rows are de-duplicated on
    the 26 canonical columns first and enriched after."""
    return enrich(dedupe(journeys.select(*C.JOURNEY_COLUMNS).where(valid_predicate()), repeated=repeated))


def single_rows(stored: DataFrame, repeated: DataFrame, month: str) -> DataFrame:
    """The analysable rows of one stored month whose ids are not repeated."""
    at = F.col("month_start").isNull() if month == NO_MONTH else F.col("month_start") == F.lit(month).cast("date")
    rows = stored.where(at & valid_predicate()).withColumn("_h", F.xxhash64("journey_id"))
    return enrich(rows.join(repeated, "_h", "left_anti"), stored_month=True)


def write_analytics(stored: DataFrame, repeated: DataFrame, source: str, path: str) -> None:
    """The analysable rows of ``stored``, the table of the folder ``source``, a folder per ``month_start``.

    Rows of repeated ids are chosen over all months; of a month the others pass as they are, in
    tasks that write its folder alone. So no row but those of repeated ids is shuffled or
    sorted, whatever the size; the calendar bounds the months."""
    spark = stored.sparkSession
    several = (stored.where(valid_predicate()).withColumn("_h", F.xxhash64("journey_id"))
               .join(repeated, "_h", "left_semi").select(*C.JOURNEY_COLUMNS))
    enrich(dedupe(several)).write.partitionBy("month_start").parquet(path, compression=COMPRESSION)
    folder = spark._jvm.org.apache.hadoop.fs.Path(source)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def write(month: str, size: int) -> None:
        (single_rows(stored, repeated, month).drop("month_start").coalesce(-(-size // ANALYTICS_TASK_BYTES) or 1)
         .write.mode("append").parquet(f"{path}/month_start={month}", compression=COMPRESSION))

    folders = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("month_start=")]
    with ThreadPoolExecutor(MONTHS_AT_ONCE) as pool:
        list(pool.map(lambda f: write(f.getName().removeprefix("month_start="), fs.getContentSummary(f).getLength()),
                      folders))


# ---------------------------------------------------------------------------
# Source holder
# ---------------------------------------------------------------------------

_CACHE: dict[tuple[str, str], "JourneySource"] = {}
_CACHE_LOCK = threading.Lock()


@dataclass
class JourneySource:
    spark: SparkSession
    journeys: DataFrame          # canonical 26-column feed (raw)
    raw: DataFrame               # enriched raw view, no dimension columns joined
    analytics: DataFrame         # valid + de-duplicated enriched rows
    origin: str = "testdata"
    sf_dir: str | None = None
    base: str | None = None                      # folder of the materialised tables
    _dims: tuple[DataFrame, DataFrame] | None = None
    _rollup: Rollup | None = None

    @classmethod
    def from_journeys(cls, spark: SparkSession, journeys: DataFrame,
                      origin: str = "upload") -> "JourneySource":
        raw = enrich(journeys)
        return cls(spark, journeys, raw, analytics_from_journeys(journeys), origin)

    @classmethod
    def open(cls, spark: SparkSession, feed: str, root: str | None = None) -> "JourneySource":
        """S4 for any feed: the CSV file or folder ``feed`` through its store, brought up to its files."""
        from .store import FeedStore
        store = FeedStore(spark, feed, root)
        store.refresh()
        return store.source()

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str,
                      materialize: bool = True) -> "JourneySource":
        from ..sources.testdata import journey_feed
        sf_dir = os.path.abspath(sf_dir)
        if not materialize:
            src = cls.from_journeys(spark, journey_feed(spark, sf_dir), origin="testdata")
            src.sf_dir = sf_dir
            return src
        key = (spark.sparkContext.applicationId, sf_dir)
        with _CACHE_LOCK:            # one materialisation per (application, tables)
            if key not in _CACHE:
                _CACHE[key] = cls._materialise(spark, sf_dir)
            return _CACHE[key]

    @classmethod
    def rebuild(cls, spark: SparkSession, sf_dir: str) -> "JourneySource":
        """Materialise again (fresh folder) and make it the cached source."""
        sf_dir = os.path.abspath(sf_dir)
        src = cls._materialise(spark, sf_dir)
        with _CACHE_LOCK:
            _CACHE[(spark.sparkContext.applicationId, sf_dir)] = src
        return src

    @classmethod
    def _materialise(cls, spark: SparkSession, sf_dir: str) -> "JourneySource":
        from ..sources.testdata import journey_feed
        root = ensure_checkpoint_dir(spark).rstrip("/")
        tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
        base = f"{root}/wayfarer-{tag}-{uuid.uuid4().hex[:8]}"
        # raw feed stored by month too: date selections on raw rows (data
        # quality) prune partitions like the analytics table does. The feed comes
        # in the order of the months, so no wide row is shuffled or sorted for it
        (journey_feed(spark, sf_dir, by_month=True)
         .write.mode("overwrite").partitionBy("month_start").parquet(f"{base}/journeys", compression=COMPRESSION))
        stored = spark.read.parquet(f"{base}/journeys")
        journeys = stored.select(*C.JOURNEY_COLUMNS)
        raw = enrich(stored, stored_month=True)
        repeated_keys(journeys.where(valid_predicate())).write.parquet(f"{base}/repeated")
        repeated = small_side(spark.read.schema("_h long").parquet(f"{base}/repeated"))
        write_analytics(stored, repeated, f"{base}/journeys", f"{base}/analytics")
        analytics = spark.read.parquet(f"{base}/analytics").select(
            *C.JOURNEY_COLUMNS, *C.DERIVED_COLUMNS, *C.DIMENSION_ATTRIBUTE_COLUMNS)
        return cls(spark, journeys, raw, analytics, "testdata", sf_dir, base)

    def rollup(self) -> Rollup:
        """The daily rollup of the analysable rows, stored on first use next to the fact tables."""
        with _CACHE_LOCK:
            if self._rollup is None:
                made = Rollup.build(self.analytics, self.base)
                # days times values rows, whatever the number of journeys
                self._rollup = Rollup(made.cells.coalesce(1).persist(), made.people)
            return self._rollup

    def dimensions(self) -> tuple[DataFrame, DataFrame]:
        """The two dimension tables of the star schema (customers, service
        lines), written once next to the fact tables on first use."""
        from ..sources.testdata import customer_dim, service_line_dim
        with _CACHE_LOCK:
            if self._dims is None:
                base = self.base or (ensure_checkpoint_dir(self.spark).rstrip("/")
                                     + f"/wayfarer-dims-{uuid.uuid4().hex[:8]}")
                customer_dim(self.spark, self.sf_dir).write.mode("overwrite") \
                    .parquet(f"{base}/customers")
                service_line_dim(self.spark).write.mode("overwrite") \
                    .parquet(f"{base}/service_lines")
                self._dims = (self.spark.read.parquet(f"{base}/customers"),
                              self.spark.read.parquet(f"{base}/service_lines"))
            return self._dims

    def enriched_with_dimensions(self) -> DataFrame:
        if self.sf_dir is None:
            return self.raw
        customers, lines = self.dimensions()
        return enrich(self.journeys, customers, lines)


def source_for(spark: SparkSession, sf_dir: str) -> JourneySource:
    return JourneySource.from_testdata(spark, sf_dir)
