"""Row counts per layer, the daily gate, and expired partitions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.functions.common import shift


class QualityError(RuntimeError):
    """A report of the day is empty or a table misses rows."""


def layer_row_counts(tables: Mapping[str, DataFrame], by_dt: bool = False) -> DataFrame:
    """One row per table (and dt): its rows."""
    parts = []
    for name, frame in tables.items():
        counted = frame.groupBy("dt") if by_dt else frame.groupBy()
        keys = ["dt"] if by_dt else []
        parts.append(
            counted.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), *keys, "row_count"
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def quality_gate(counts: DataFrame, minimum: Mapping[str, int]) -> DataFrame:
    """Counts against the least rows each named table must have; tables without a
    requirement need one row."""
    floor = F.lit(1)
    for name, rows in minimum.items():
        floor = F.when(F.col("table_name") == name, rows).otherwise(floor)
    return counts.withColumn("min_rows", floor.cast("bigint")).withColumn(
        "passed", F.col("row_count") >= F.col("min_rows")
    )


def assert_quality(gate: DataFrame) -> None:
    """Raise if any check of the gate failed. The gate has one row per table."""
    failed = [r["table_name"] for r in gate.where(~F.col("passed")).collect()]
    if failed:
        raise QualityError(f"too few rows in {', '.join(sorted(failed))}")


def expired_partitions(partitions: DataFrame, today: str, keep_days: int = 7) -> DataFrame:
    """Partitions (table_name, dt) older than keep_days; listed, never deleted."""
    return partitions.where(F.col("dt") < shift(today, -keep_days))


def list_partitions(spark: SparkSession, roots: Mapping[str, str]) -> DataFrame:
    """table_name, dt of the partition directories under each table's folder. Names
    only: a folder listing, no data is read."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for name, root in roots.items():
        pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/dt=*")
        for status in pattern.getFileSystem(conf).globStatus(pattern) or []:
            rows.append((name, status.getPath().getName().split("=", 1)[1]))
    return spark.createDataFrame(rows, "table_name string, dt string")
