"""Spark session settings and shared-storage location.

Settings are chosen for a large cluster and work unchanged on local[N]:
adaptive execution re-plans joins from measured sizes (broadcast only when the
materialised side is under the threshold, sort-merge otherwise), coalesces
small shuffle partitions and splits skewed ones.
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import time

from pyspark.sql import SparkSession

# Conf that every job of this package relies on for correct results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",  # timestamps are labelled UTC, never shifted
    "spark.sql.ansi.enabled": "true",     # overflow raises instead of wrapping
}

# Conf that jobs of this package need to be fast on any session: the JVM never
# compiles a method over 8000 bytes, and the typing of a line is several times
# that in one generated method.  Spark then runs such a stage operator by
# operator, in generated code that is compiled.
COMPILED_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Conf for scale; applied when building a session, left alone on a given one.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Runtime broadcast only for sides measured under 64 MB after a shuffle stage.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    # routed stage outputs have 2 partition values: write them with concurrent
    # writers instead of sorting every task's rows by the route first
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def apply_required(spark: SparkSession) -> SparkSession:
    for k, v in {**REQUIRED_CONF, **COMPILED_CONF}.items():
        spark.conf.set(k, v)
    return spark


def build_session(
    master: str | None = None,
    app: str = "ledgerstar",
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """A session with this package's settings.  `checkpoint_dir` is only used
    when the cluster does not already name one in spark.checkpoint.dir."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    conf.update(REQUIRED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_required(spark)
    if checkpoint_dir and not checkpoint_location(spark):
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed.  Spark removes them when
    the driver's collector finds their plans, which may be long after; a job that
    has stored its result needs them no more, and the next one needs the disk.
    What a first collection lets go of may hold a plan until a second one."""
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(0.1)
    spark._jvm.System.gc()


def checkpoint_location(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    return conf_dir or None


def storage_root(spark: SparkSession, subdir: str = "ledgerstar") -> str:
    """Where stored layers live: under the session's checkpoint folder.

    Never falls back to a machine-local folder on a cluster, where that would
    be a different disk per executor; only a local session gets one of its own.
    """
    base = checkpoint_location(spark)
    if not base and re.match(r"local(\[|$)", spark.sparkContext.master):
        # one process: the driver's disk is the executors' disk
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerstar-"))
        base = checkpoint_location(spark)
    if not base:
        raise RuntimeError(
            "no shared storage configured: set spark.checkpoint.dir "
            "(or pass an explicit layer root)"
        )
    return os.path.join(base, subdir) if "://" not in base else base.rstrip("/") + "/" + subdir


def cluster_conf(total_cores: int, input_bytes: int, target_partition_bytes: int = 512 << 20) -> dict:
    """Shuffle sizing for a cluster run, to pass as `extra` to build_session.

    Start with enough shuffle partitions that each holds about
    `target_partition_bytes` of the largest stage input (at least three waves
    of tasks), whatever the input's size, and
    let adaptive execution coalesce small partitions and split skewed ones at
    run time.  Sort-based shuffle spills, so a partition larger than memory
    slows down but does not fail.  Example: 100 TB on 8000 cores -> 200k
    initial partitions (~512 MB each), coalesced by AQE as stages shrink."""
    by_size = -(-input_bytes // target_partition_bytes)
    initial = max(3 * total_cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 4),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }
