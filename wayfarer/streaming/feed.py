"""Journey feeds as Structured Streaming sources.

The row-level stages - canonicalise (S3), enrich (F1/F2, no dimensions),
validity (F3) and the population filter (F5) - are stateless, so the same
functions run unchanged on a streaming DataFrame. De-duplication and every
aggregate stay batch operators over the landed table (the analytics have no
streaming semantics of their own: no watermarks, windows or late data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.filters import Selection
from ..plans.model import enrich, valid_predicate
from ..sources.feeds import canonicalise


def read_feed_stream(spark: SparkSession, path: str, schema: T.StructType,
                     fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def valid_enriched_stream(feed: DataFrame, filters: Selection | None = None) -> DataFrame:
    """canonicalise -> enrich -> validity [-> selection], all stateless."""
    rows = enrich(canonicalise(feed, probe_timestamp=False)).where(valid_predicate())
    return rows if filters is None else rows.where(filters.column())


def land(stream: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Append the stream to a parquet table partitioned by month (exactly-once
    file sink with its own checkpoint)."""
    writer = (stream.writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).partitionBy("month_start")
              .outputMode("append"))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
