"""Session settings the warehouse relies on, and the shared checkpoint folder."""

from __future__ import annotations

import math
import re

from pyspark.sql import SparkSession

# Runtime settings. None of them sizes the cluster: executor count, memory and
# shuffle.partitions belong to spark-submit; AQE coalesces from there.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join input even where that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # dt=2024-01-22 stays a string, as every dt comparison expects.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.orc.filterPushdown": "true",
}

# Read once when the session starts. Recording a call site for every column
# expression costs more than planning the query does.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the warehouse's runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# What a task of a shuffle over a large table gets: rows per partition, and compressed bytes up to
# which AQE merges partitions. In the sorts and hash maps of one stage, together, a
# row takes some 20 times its shuffled bytes.
TASK_ROWS, TASK_BYTES = 250_000, 8 << 20
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def bound_tasks(spark: SparkSession, rows: int) -> None:
    """Let the number of shuffle partitions grow with a table of `rows` rows, so that what one task
    holds does not. The session's own number is the least, its own advisory size the
    most; tables that fit one task change nothing."""
    if rows <= TASK_ROWS:
        return
    partitions = int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if (needed := math.ceil(rows / TASK_ROWS)) > partitions:
        spark.conf.set(INITIAL, str(needed))
    number, unit = re.match(r"(\d+)\s*([kmgt]?)", spark.conf.get(ADVISORY).lower()).groups()
    if int(number) << 10 * " kmgt".index(unit or " ") > TASK_BYTES:
        spark.conf.set(ADVISORY, str(TASK_BYTES))


def build_session(app_name: str = "bazaarlake", master: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder in spark.checkpoint.dir; where it is unset, as in tests, one in the
    warehouse, which all executors share as well."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared")
