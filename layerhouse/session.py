"""Session set-up and the one place that decides where intermediate tables go."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# AQE re-plans joins, merges small shuffle partitions and splits skewed ones from run-time sizes.
# Forced splitting also covers a join whose output partitioning a later step relies on: the
# extra shuffle is added only when a partition is found to be skewed.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Tasks that list the folders of a partitioned table; the default is one for each folder up to 10,000.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}

# Bytes of shuffled data for one task, and from where on a partition counts as skewed. The rows of numeric tables take some 25
# times their compressed bytes in a task that sorts, joins and sums them: 1.6 GB at Spark's 64 MB, a quarter of it here.
TASK_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 64 << 20,
}

# UTC keeps timestamps comparable between runs.
SETTINGS = {**ADAPTIVE, **{k: str(v) for k, v in TASK_BYTES.items()}, "spark.sql.session.timeZone": "UTC"}


def adapt(spark: SparkSession) -> SparkSession:
    """Turns the run-time settings on in a session that someone else has built.

    The registered queries call this for the session they are given, and leave it so; its time zone
    is the caller's business (dates in the queries do not depend on it). Smaller tasks than ``TASK_BYTES`` stay as they are.
    """
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    for key, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return spark


def _bytes(size: str) -> int:
    """A size as Spark writes it: 64MB, 8m, 20000b or 20000."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def build_session(app: str = "layerhouse", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above and ``**{name: value}`` of further ones."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory below the shared folder named by ``spark.checkpoint.dir``.

    A session without that setting uses its warehouse folder, which all executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
