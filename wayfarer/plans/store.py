"""A stored journey feed that follows the CSV files it is read from.

Folder of a store (every table is Parquet, ``tag`` names the refresh that wrote the rows)::

    journeys/tag=/month_start=    canonical rows and the file each came from
    analytics/tag=/month_start=   valid rows, one per journey_id, enriched
    files/tag=                    path, length, modified of all files of a version
    months/tag=                   fact, month_start, held: the tag whose folder holds that month
    ids/tag=                      hashes of the journey ids whose row a refresh chose anew
    heads/                        version, tag: one row per published version

``refresh`` compares the files with those of the current version by path, length and time, reads only new and
changed ones, and writes only the months that hold their rows or rows of withdrawn ones. A journey id may occur
in several files and months, so the analysable row of a touched id that has several rows or lost one is chosen
anew among all its rows; a fresh row that is its id's only one passes as it is. Only hashes of ids are shuffled, and
the rows of those ids. A
version becomes current with its one row in ``heads``, which is written last and is one file: readers
see the old version or the new one, and what a failed refresh left behind belongs to no version. One writer at a time.

Files are uploads: those that one refresh reads have one header (two are an error; a later refresh may bring
another, columns go by their names), and where a file has no timestamp at all its timestamps are its dates. Files
without rows add none. The driver sees paths of changed files, as a read
needs them, and months, which the calendar bounds.
"""

from __future__ import annotations

import functools
import hashlib
import operator
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import ensure_checkpoint_dir
from ..sources import feeds

FACTS = ("journeys", "analytics")
FILES = "path string, length long, modified timestamp"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
MONTHS_OPEN = 32        # a task's rows of more months are sorted by month
COMPRESSION = "zstd"
MONTHS = "fact string, month_start date, held string"


def _fact_schema(spark: SparkSession, fact: str) -> T.StructType:
    from .model import enrich
    empty = feeds.canonicalise(spark.createDataFrame([], "journey_id string"), probe_timestamp=False)
    if fact == "journeys":
        empty = empty.withColumn("_file", F.lit(None).cast("string"))
        return empty.schema.add("month_start", "date").add("tag", "string")
    own = [f for f in enrich(empty).schema.fields if f.name != "month_start"]
    return T.StructType(own).add("month_start", "date").add("tag", "string")


class FeedStore:
    def __init__(self, spark: SparkSession, feed: str, root: str | None = None):
        """``feed``: a CSV file or a folder of them. ``root``: the store's folder, by
        default one in the shared checkpoint folder that is named by the feed's path."""
        self.spark, self.feed = spark, feed
        name = hashlib.sha1(feed.encode()).hexdigest()[:12]
        self.root = (root or f"{ensure_checkpoint_dir(spark)}/feed-{name}").rstrip("/")

    # -- versions ---------------------------------------------------------
    def _hadoop(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _table(self, name: str, schema, tag: str | None = None) -> DataFrame:
        parts = (name,) if tag is None else (name, f"tag={tag}")
        if not self._hadoop().exists(self._path(*parts)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet("/".join((self.root, *parts)))

    def heads(self) -> DataFrame:
        """version, tag of all published versions that are not removed."""
        return self._table("heads", "version long, tag string")

    def current(self) -> tuple[int, str | None]:
        last = self.heads().orderBy(F.desc("version"), F.desc("tag")).first()
        return (last.version, last.tag) if last else (0, None)

    def files(self, tag: str | None) -> DataFrame:
        if tag is None:
            return self.spark.createDataFrame([], FILES)
        return self._table("files", FILES, tag)

    def _held(self, tag: str | None) -> dict[str, list[tuple]]:
        """fact -> (month, tag of the folder that holds it); the calendar bounds the list."""
        held: dict[str, list[tuple]] = {fact: [] for fact in FACTS}
        if tag is not None:
            for row in self._table("months", MONTHS, tag).collect():
                held[row.fact].append((row.month_start, row.held))
        return held

    def _fact(self, fact: str, held: list[tuple]) -> DataFrame:
        """The rows of a version: a filter on partition columns only."""
        rows = self._table(fact, _fact_schema(self.spark, fact))
        by_tag: dict[str, list] = {}
        for month, tag in held:
            by_tag.setdefault(tag, []).append(month)
        pick = [(F.col("tag") == tag) & _among("month_start", months) for tag, months in sorted(by_tag.items())]
        return rows.where(functools.reduce(operator.or_, pick, F.lit(False))).drop("tag")

    # -- refresh ----------------------------------------------------------
    def listing(self) -> DataFrame:
        """path, length, modified of the feed's files; their contents are not read."""
        return (self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.feed)
                .select("path", "length", F.col("modificationTime").alias("modified")))

    def refresh(self) -> bool:
        """Bring the store up to the files; False if it was."""
        version, old = self.current()
        tag = f"v{version + 1:06d}-{uuid.uuid4().hex[:8]}"
        self._write(self.listing(), "files", tag)
        now, before = self.files(tag), self.files(old)
        changed = [r.path for r in now.exceptAll(before).select("path").collect()]
        gone = before.exceptAll(now).select(F.col("path").alias("_file"))
        if old is not None and not changed and gone.isEmpty():
            self._hadoop().delete(self._path("files", f"tag={tag}"), True)
            return False
        held = self._held(old)
        journeys = self._fact("journeys", held["journeys"])
        self._write(self._read(changed), "fresh", tag)
        fresh = self._table("fresh", journeys.schema, tag)
        gone = F.broadcast(gone)            # one row per file
        lost = journeys.join(gone, "_file", "left_semi")
        held["journeys"] = self._rewrite(
            "journeys", tag, held["journeys"], _months(lost, fresh),
            journeys.join(gone, "_file", "left_anti"), fresh)
        held["analytics"] = self._choose(tag, held, fresh, lost)
        rows = [(fact, month, at) for fact in FACTS for month, at in held[fact]]
        self._write(self.spark.createDataFrame(rows, MONTHS), "months", tag)
        (self.spark.createDataFrame([(version + 1, tag)], "version long, tag string").coalesce(1)
         .write.mode("append").parquet(f"{self.root}/heads"))
        self._hadoop().delete(self._path("fresh", f"tag={tag}"), True)
        return True

    def _write(self, rows: DataFrame, name: str, tag: str) -> None:
        rows.write.parquet(f"{self.root}/{name}/tag={tag}", compression=COMPRESSION)

    def _read(self, paths: list[str]) -> DataFrame:
        """Canonical rows of the files with month and file."""
        if not paths:
            return self.spark.createDataFrame([], self._fact("journeys", []).schema)
        header = feeds.read_csv(self.spark, paths).schema
        text = (self.spark.read.option("header", True).option("enforceSchema", False).schema(header)
                .csv(paths).select("*", F.col("_metadata.file_path").alias("_file")))
        typed = feeds.canonicalise(text, probe_timestamp=False, keep=("_file",))
        # one row per file
        timed = F.broadcast(typed.groupBy("_file").agg(F.max(F.col("timestamp").isNotNull()).alias("_timed")))
        stamp = F.when(F.col("_timed"), F.col("timestamp")).otherwise(F.col("date").cast("timestamp_ntz"))
        return (typed.join(timed, "_file").withColumn("timestamp", stamp)
                .select(*C.JOURNEY_COLUMNS, "_file", F.trunc("date", "month").alias("month_start")))

    def _choose(self, tag: str, held: dict[str, list[tuple]], fresh: DataFrame, lost: DataFrame) -> list[tuple]:
        """The analysable rows: those of touched ids that have several rows or lost one anew, fresh
        ones that are alone and the others as they are."""
        from .model import analytics_from_journeys, enrich, small_side, valid_predicate
        now = self._fact("journeys", held["journeys"]).where(valid_predicate())
        before = self._fact("analytics", held["analytics"])
        marks = [rows.where(F.col("journey_id").isNotNull())
                 .select(F.xxhash64("journey_id").alias("_h"), F.lit(n).alias("n"), F.lit(touch).alias("touch"))
                 for rows, n, touch in ((now, 1, 0), (fresh, 0, 1), (lost, 0, 2))]
        self._write(functools.reduce(DataFrame.union, marks).groupBy("_h")
                    .agg(F.sum("n").alias("n"), F.max("touch").alias("touch"))
                    .where("touch = 2 or touch = 1 and n > 1").select("_h"), "ids", tag)
        ids = small_side(self._table("ids", "_h long", tag))

        def only(rows: DataFrame, how: str) -> DataFrame:
            return rows.withColumn("_h", F.xxhash64("journey_id")).join(ids, "_h", how).drop("_h")

        self._write(analytics_from_journeys(only(now, "left_semi")), "chosen", tag)
        chosen = self._table("chosen", before.schema, tag)
        alone = only(fresh.where(valid_predicate()), "left_anti")
        touched = _months(only(before, "left_semi"), chosen, alone)
        added = chosen.unionByName(enrich(alone, stored_month=True).select(*chosen.columns))
        held_now = self._rewrite("analytics", tag, held["analytics"], touched, only(before, "left_anti"), added)
        self._hadoop().delete(self._path("chosen", f"tag={tag}"), True)
        return held_now

    def _rewrite(self, fact: str, tag: str, held: list[tuple], touched: list, kept: DataFrame,
                 added: DataFrame) -> list[tuple]:
        """Write the touched months anew; the months and tags of the version. A task has a file
        open per month, so rows are neither shuffled nor sorted for it."""
        rows = kept.where(_among("month_start", touched)).unionByName(added)
        conf = self.spark.conf
        was = conf.get(OPEN_FILES, None)
        conf.set(OPEN_FILES, str(max(int(was or 0), MONTHS_OPEN)))
        try:
            (rows.write.partitionBy("month_start")
             .parquet(f"{self.root}/{fact}/tag={tag}", compression=COMPRESSION))
        finally:
            conf.set(OPEN_FILES, was) if was is not None else conf.unset(OPEN_FILES)
        written = [(month, tag) for month in touched]
        full = _months(self._fact(fact, written))
        return [(m, at) for m, at in held if m not in touched] + [(m, tag) for m in full]

    # -- reading ----------------------------------------------------------
    def source(self):
        """The current version as a ``JourneySource``."""
        from .model import JourneySource, enrich
        tag = self.current()[1]
        held = self._held(tag)
        journeys = self._fact("journeys", held["journeys"])
        analytics = self._fact("analytics", held["analytics"]).select(
            *C.JOURNEY_COLUMNS, *C.DERIVED_COLUMNS, *C.DIMENSION_ATTRIBUTE_COLUMNS)
        return JourneySource(self.spark, journeys.select(*C.JOURNEY_COLUMNS), enrich(journeys, stored_month=True),
                             analytics, "feed", base=f"{self.root}/derived/tag={tag}")

    def remove_old(self, keep: int = 1) -> list[str]:
        """Remove all but the ``keep`` latest versions, and what failed refreshes left; the tags
        removed. Months that a kept version still reads stay. No reader may hold an older version."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        heads = [r.tag for r in self.heads().orderBy(F.desc("version"), F.desc("tag")).limit(keep).collect()]
        read = {fact: {at for tag in heads for _, at in self._held(tag)[fact]} for fact in FACTS}
        fs, removed = self._hadoop(), set()
        for name in (*FACTS, "files", "months", "ids", "fresh", "chosen", "derived"):
            if not fs.exists(self._path(name)):
                continue
            for status in fs.listStatus(self._path(name)):
                tag = status.getPath().getName().removeprefix("tag=")
                if tag not in read.get(name, set()) and (name in FACTS or tag not in heads):
                    fs.delete(status.getPath(), True)
                    removed.add(tag)
        return sorted(removed - set(heads))


def _among(column: str, values: list) -> Column:
    there = [v for v in values if v is not None]
    found = F.col(column).isin(there) if there else F.lit(False)
    return found | F.col(column).isNull() if None in values else found


def _months(*frames: DataFrame) -> list:
    """The different months of the rows; the calendar bounds them."""
    months = functools.reduce(DataFrame.union, [f.select("month_start") for f in frames]).distinct()
    return [r.month_start for r in months.collect()]
