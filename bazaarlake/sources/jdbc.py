"""Relational source and report sink over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.functions.common import shift


def hash_predicates(column: str, parts: int) -> list[str]:
    """Slices of a text key by its checksum in the source database, rows without a key in the
    first: one parallel read each, evenly filled whatever the keys look like."""
    slices = [f"MOD(CRC32({column}), {parts}) = {i}" for i in range(parts)]
    return [f"{slices[0]} OR {column} IS NULL", *slices[1:]]


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    column: str | None = None,
    num_partitions: int = 16,
    text_column: str | None = None,
) -> DataFrame:
    """A whole table, read in key ranges of a numeric column, whose ends are asked from the
    database, one row; or in slices of a text key."""
    if text_column is not None:
        return spark.read.jdbc(
            url, table, predicates=hash_predicates(text_column, num_partitions), properties=dict(properties)
        )
    if column is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    ends = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    row = spark.read.jdbc(url, ends, properties=dict(properties)).first()
    if row is None or row[0] is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=int(row[0]),
        upperBound=int(row[1]),
        numPartitions=num_partitions,
        properties=dict(properties),
    )


def hour_predicates(column: str, dt: str, step: int = 1) -> list[str]:
    """Half-open time slices covering one day: one parallel read each. Times may be text with
    or without seconds, so the day's ends are bare dates and the others have minutes."""
    starts = [dt, *[f"{dt} {hour:02d}:00" for hour in range(step, 24, step)]]
    ends = [*starts[1:], shift(dt, 1)]
    return [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(starts, ends, strict=True)]


def read_created_on(
    spark: SparkSession,
    url: str,
    table: str,
    dt: str,
    properties: Mapping[str, str],
    columns: Sequence[str] | None = None,
    time_column: str = "create_time",
) -> DataFrame:
    """The rows created on dt, filtered in the database, an hour per task."""
    rows = spark.read.jdbc(
        url, table, predicates=hour_predicates(time_column, dt), properties=dict(properties)
    )
    return rows.select(*columns) if columns else rows


def export_report(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    dt: str | None = None,
    batch_size: int = 5000,
    writers: int = 8,
) -> None:
    """Replace a report table's rows, keeping its definition. Only dt is exported if
    the frame has one."""
    if dt is not None and "dt" in df.columns:
        df = df.where(F.col("dt") == dt)
    (
        df.coalesce(writers)
        .write.mode("overwrite")
        .option("truncate", "true")
        .option("batchsize", batch_size)
        .jdbc(url, table, properties=dict(properties))
    )


def export_matches(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> bool:
    """Whether the exported table has as many rows as the report."""
    counted = f"(SELECT COUNT(*) AS n FROM {table}) counted"
    exported = df.sparkSession.read.jdbc(url, counted, properties=dict(properties)).first()[0]
    return int(exported) == df.count()
