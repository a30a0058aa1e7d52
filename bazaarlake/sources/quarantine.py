"""What is wrong with a raw line, kept beside the lines that are read.

read_raw turns a value that is none of its type into NULL, and the cleaning rules drop rows
that lack what they need. Here every such line is kept as it came, with a reason per field, so that
no row leaves the warehouse without one. A line is rejected if a field its table needs is damaged;
other damaged lines stay in the warehouse with NULL in the field, and are listed all the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.functions.common import count_if, present
from bazaarlake.sources.files import (
    NULL_MARKER,
    NULL_WORD,
    raw_fields,
    raw_lines,
    raw_parts,
    read_table,
    write_partition,
)

REASONS = "array<struct<field: string, reason: string>>"


@dataclass(frozen=True)
class Rules:
    """needed: fields without which a row is dropped; limits: field → SQL condition that its value has to
    meet; time: the field that gives the row its day."""

    needed: Sequence[str] = ()
    limits: Mapping[str, str] = field(default_factory=dict)
    time: str | None = None


def outcomes(lines: DataFrame, schema: T.StructType, rules: Rules) -> DataFrame:
    """line, reasons, rejected of every line, sound ones with no reasons.

    lines: column value. Reasons are "too few fields" and "too many fields" (field NULL),
    "unreadable number", "unreadable time" (fields called *_time), "missing" and "out of range".
    NULL markers and empty values are no damage unless the field is needed. A line of other
    width is rejected only if a needed field is missing by it.
    """
    parts = raw_parts()
    typed = lines.select("value", parts.alias("__parts"), *raw_fields(schema))
    found = [
        _reason(F.size("__parts") < len(schema), None, "too few fields"),
        _reason(F.size("__parts") > len(schema), None, "too many fields"),
    ]
    required = {*rules.needed, *rules.limits, *([rules.time] if rules.time else [])}
    for i, column in enumerate(schema.fields):
        name = column.name
        written = F.get("__parts", F.lit(i))
        blank = F.coalesce(written.isin(NULL_MARKER, NULL_WORD, ""), F.lit(True))
        unreadable = F.lit(False)
        if not isinstance(column.dataType, T.StringType):
            unreadable = ~blank & F.col(name).isNull()
            found.append(_reason(unreadable, name, "unreadable number"))
        elif name == rules.time or name.endswith("_time"):
            kind = "date" if name == rules.time else "timestamp"
            unreadable = ~blank & F.col(name).try_cast(kind).isNull()
            found.append(_reason(unreadable, name, "unreadable time"))
        if name in required:
            found.append(_reason(~unreadable & ~present(typed, name), name, "missing"))
        if name in rules.limits:
            found.append(_reason(~F.expr(rules.limits[name]), name, "out of range"))
    reasons = F.array_compact(F.array(*found)).cast(REASONS)
    hit = F.exists("reasons", lambda r: r["field"].isin(*required)) if required else F.lit(False)
    return typed.select(F.col("value").alias("line"), reasons.alias("reasons")).withColumn(
        "rejected", F.coalesce(hit, F.lit(False))
    )


def _reason(condition: Column, name: str | None, text: str) -> Column:
    return F.when(condition, F.struct(F.lit(name).cast("string").alias("field"), F.lit(text).alias("reason")))


@dataclass(frozen=True)
class Profile:
    rows: int
    damaged: int
    rejected: int


def quarantine(
    spark: SparkSession,
    raw_root: str,
    tables: Mapping[str, tuple[T.StructType, Rules]],
    path: str,
    dt: str,
) -> dict[str, Profile]:
    """Replace the day's damaged lines of all tables (table_name, line, reasons, rejected) and count lines
    per table on the way: one job that reads each table once and moves damaged lines only."""
    checked = [
        outcomes(raw_lines(spark, f"{raw_root}/{name}", dt), schema, rules).select(F.lit(name).alias("table_name"), "*")
        for name, (schema, rules) in tables.items()
    ]
    counts = Observation()
    metrics = []
    for name in tables:
        here = F.col("table_name") == name
        metrics += [
            count_if(here).alias(f"{name}:rows"),
            count_if(here & (F.size("reasons") > 0)).alias(f"{name}:damaged"),
            count_if(here & F.col("rejected")).alias(f"{name}:rejected"),
        ]
    watched = reduce(DataFrame.unionByName, checked).observe(counts, *metrics)
    write_partition(watched.where(F.size("reasons") > 0), path, dt)
    seen = counts.get
    return {n: Profile(seen[f"{n}:rows"], seen[f"{n}:damaged"], seen[f"{n}:rejected"]) for n in tables}


def rejected_by_reason(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """dt, table_name, field, reason: lines with that reason, and how many of them are rejected. A line
    with several reasons counts under each."""
    lines = read_table(spark, path, first, last)
    each = lines.select("dt", "table_name", F.explode("reasons").alias("r"), "rejected").select("dt", "table_name", "r.*", "rejected")
    return each.groupBy("dt", "table_name", "field", "reason").agg(
        F.count(F.lit(1)).alias("line_count"), count_if("rejected").alias("rejected_count")
    )
