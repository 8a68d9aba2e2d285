"""SparkSession with the settings the package relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job assumes: civil days never shift (UTC session zone, NTZ
# reading times), ANSI stays on (bad input goes through try_cast), AQE may
# coalesce partitions, switch joins to broadcast by measured size and split
# skewed join partitions.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def cluster_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings sized for a cluster run over `input_bytes` of input.

    Scan splits and the advisory shuffle partition size are `partition_bytes`
    (256 MiB: fits executor memory with room for sort buffers); the initial
    shuffle partition count is sized so that a shuffle of the whole input
    (C2's anti-join) still gets partitions of that size, and AQE coalesces it
    for the small shuffles (partial aggregates, 30-day windows). Broadcasts
    stay behind AQE's measured-size check; skewed join partitions are split.
    Files are cut alike however many executors there are at the moment, which
    readers in two passes (sources.rawlines) need."""
    n = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.files.minPartitionNum": str(n),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def get_spark(master: str | None = None, app: str = "gaugekeep",
              shuffle_partitions: int | None = None, extra: dict | None = None,
              input_bytes: int | None = None) -> SparkSession:
    """Build or fetch the session. On a cluster call it without `master`,
    optionally with `input_bytes` to apply cluster_conf."""
    b = SparkSession.builder.appName(app)
    for k, v in (cluster_conf(input_bytes).items() if input_bytes else ()):
        b = b.config(k, v)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false")
        b = b.config("spark.ui.showConsoleProgress", "false")
        b = b.config("spark.driver.memory", os.environ.get("GAUGEKEEP_DRIVER_MEMORY", "16g"))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    # checkpoints written per job or micro-batch are removed once unreferenced
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared `spark.checkpoint.dir`. Only a session of one
    process (tests, benchmarks) may fall back to a fresh scratch folder; on a cluster
    an unset setting is an error, never a machine-local folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return conf
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="gaugekeep-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables under the shared checkpoint
    folder (a local scratch folder only for local sessions)."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


# For readers of many small files: tasks of some thousand files each (Spark counts 4 MB for opening one, so a
# task would get 32), and listings in some hundred tasks (10,000 otherwise).
SMALL_FILES_CONF = {
    "spark.sql.files.openCostInBytes": str(64 << 10),
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}


def small_files_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of `spark` and, where it sets nothing else, those
    for small files, so that no other query gets them."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    for k, v in SMALL_FILES_CONF.items():
        if spark.conf.get(k, None) is None:
            own.conf.set(k, v)
    return own
