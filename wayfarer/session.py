"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


# Settings for a large cluster (WAYFARER_PROFILE=cluster): start with many
# shuffle partitions and let AQE coalesce them to ~256 MB each; split skewed
# partitions (a hot key) at 5x the median; read ~256 MB parquet splits.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "wayfarer",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session tuned for the engine's plans (local runs; a cluster passes its own)."""
    # spark-submit has named a master and started the JVM; one set here would win over it.
    if master is None and "PYSPARK_GATEWAY_PORT" not in os.environ:
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    parts = shuffle_partitions or int(os.environ.get("WAYFARER_SHUFFLE_PARTITIONS", "8"))
    builder = (
        (SparkSession.builder.master(master) if master else SparkSession.builder).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("WAYFARER_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if os.environ.get("WAYFARER_PROFILE") == "cluster":
        for key, value in CLUSTER_CONF.items():
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared lineage-cutting folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder; only a local-mode session (tests, the
    bench) gets a private one created here when the setting is absent.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="wayfarer-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
