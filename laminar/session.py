"""Session construction for tests/bench and a shared scratch location.

Library code never creates a session; it takes the caller's.  Scratch tables
(lineage cuts between incremental steps, layout trials) go below the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that is unset (local tests)
(and only on a ``local`` master) is a private temporary folder chosen.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def _default_driver_memory() -> str:
    """Half of physical memory, between 1 and 16 GB (local mode: the driver is the executor)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, total // 2 // (1 << 30)))}g"


def build_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "laminar", driver_memory: str | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory or os.environ.get("LAMINAR_DRIVER_MEMORY")
                or _default_driver_memory())
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; set one only when unset.

    Reads the session conf first (works for classic and Connect sessions), then the
    context's checkpoint folder.  When neither is set, a session on one machine (a
    ``local`` master, as in tests) gets a private temporary folder, registered as the
    checkpoint folder; any other session must name a shared one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
        if current:
            return current
    if sc is None or not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="laminar-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint folder for a written table."""
    return f"{checkpoint_root(spark).rstrip('/')}/laminar/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this library's scratch folder and its unnamed catalog tables, once nothing reads them any more."""
    for t in spark.catalog.listTables():
        if t.name.startswith("laminar_"):
            spark.sql(f"DROP TABLE IF EXISTS `{t.name}`")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/laminar")
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


# Runtime SQL settings for a large cluster (~100 TB inputs).  Shuffle partitions are
# sized for the largest shuffle (~1 GB per partition before AQE); adaptive execution
# coalesces the smaller shuffles and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    "spark.sql.shuffle.partitions": "100000",
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def apply_scale_conf(spark: SparkSession, overrides: dict[str, str] | None = None) -> None:
    """Set ``SCALE_CONF`` (plus ``overrides``) on a running session."""
    for k, v in {**SCALE_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)
