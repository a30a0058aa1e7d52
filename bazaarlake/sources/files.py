"""Text, ORC and CSV tables in daily partitions, and the ingest into them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.functions.common import shift

# The NULL marker of the text tables, the word other exports print, the separator.
NULL_MARKER = "\\N"
NULL_WORD = "NULL"
SEPARATOR = "\t"


def created_on(df: DataFrame, dt: str, column: str = "create_time") -> DataFrame:
    """Rows created on dt, as a half-open range that is pushed to the source."""
    return df.where(created_between(column, dt))


def created_between(column: str, dt: str) -> Column:
    return (F.col(column) >= dt) & (F.col(column) < shift(dt, 1))


class IngestError(RuntimeError):
    """The raw folder does not hold what the source delivered."""


# The characters that cannot stand in a text table, and how they are written.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


def _escaped(value: Column) -> Column:
    for plain, written in ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(written))
    return value


def _unescaped(value: Column) -> Column:
    """Escaped backslashes first: the text between them holds whole escapes only."""
    backslash, written = ESCAPES[0]

    def rest(part: Column) -> Column:
        for plain, escape in ESCAPES[1:]:
            part = F.replace(part, F.lit(escape), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(value, "\\\\\\\\"), rest), backslash)


def ingest(df: DataFrame, table_path: str, dt: str, compression: str = "none") -> int:
    """write_raw, then compare rows and fields of the folder with what was delivered. The
    source is read once: its rows are counted while they pass."""
    delivered = Observation()
    write_raw(df.observe(delivered, F.count(F.lit(1)).alias("n")), table_path, dt, compression)
    rows = delivered.get["n"]
    fields = F.size(F.split("value", SEPARATOR))
    stored, other = (
        df.sparkSession.read.text(f"{table_path}/dt={dt}")
        .agg(F.count(F.lit(1)), F.coalesce(F.sum((fields != len(df.columns)).cast("int")), F.lit(0)))
        .first()
    )
    if stored != rows or other:
        raise IngestError(
            f"{table_path}/dt={dt}: {rows} rows delivered, {stored} stored, {other} of another width"
        )
    return rows


def write_raw(df: DataFrame, table_path: str, dt: str, compression: str = "none") -> None:
    """Ingest: tab-separated text into the table's dt folder; a rerun replaces it. Tabs,
    line breaks and backslashes in a value are escaped, NULL is the marker."""
    fields = [F.coalesce(_escaped(F.col(c).cast("string")), F.lit(NULL_MARKER)) for c in df.columns]
    (
        df.select(F.concat_ws(SEPARATOR, *fields).alias("value"))
        .write.mode("overwrite")
        .option("compression", compression)
        .text(f"{table_path}/dt={dt}")
    )


def raw_lines(spark: SparkSession, table_path: str, dt: str | None = None) -> DataFrame:
    """value, dt: the lines of a text table, with dt only that folder is read."""
    if dt is None:
        return spark.read.option("basePath", table_path).text(table_path)
    return spark.read.text(f"{table_path}/dt={dt}").withColumn("dt", F.lit(dt))


def raw_parts() -> Column:
    return F.split("value", SEPARATOR, -1)


def raw_fields(schema: T.StructType) -> list[Column]:
    """The typed fields of a line in column value; the word a plain export prints for NULL is NULL."""
    fields = []
    for i, field in enumerate(schema.fields):
        written = F.get(raw_parts(), F.lit(i))
        value = F.when(written != NULL_MARKER, _unescaped(written))
        text = isinstance(field.dataType, T.StringType)
        typed = F.nullif(value, F.lit(NULL_WORD)) if text else value.try_cast(field.dataType)
        fields.append(typed.alias(field.name))
    return fields


def read_raw(
    spark: SparkSession, table_path: str, schema: T.StructType, dt: str | None = None
) -> DataFrame:
    """Text table with a declared schema; NULL is \\N, or the word a plain export
    prints. Fields a line does not have, and values that are none of their type, are NULL;
    sources.quarantine tells which. With dt only that folder is read."""
    lines = raw_lines(spark, table_path, dt)
    return lines.select(*raw_fields(schema), *(["dt"] if "dt" in lines.columns else []))


def write_partition(df: DataFrame, table_path: str, dt: str, fmt: str = "orc") -> None:
    """Replace one dt of a columnar table. Writing to the partition's own folder
    leaves the others alone whatever the session's overwrite mode."""
    (
        df.drop("dt")
        .write.mode("overwrite")
        .format(fmt)
        .option("compression", "snappy")
        .save(f"{table_path}/dt={dt}")
    )


def append_partition(df: DataFrame, table_path: str, dt: str, fmt: str = "orc") -> None:
    """Add rows to one dt of a columnar table, which df may read."""
    df.write.mode("append").format(fmt).option("compression", "snappy").save(f"{table_path}/dt={dt}")


def write_partitions(df: DataFrame, table_path: str, fmt: str = "orc") -> None:
    """Replace the dt partitions df has rows for, and no others. Rows are shuffled by
    dt and a few salts so that one large day is not one writing task."""
    salted = df.repartition(F.col("dt"), F.pmod(F.hash(*[c for c in df.columns if c != "dt"]), F.lit(32)))
    (
        salted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("dt")
        .format(fmt)
        .save(table_path)
    )


def read_table(
    spark: SparkSession,
    table_path: str,
    first: str | None = None,
    last: str | None = None,
    fmt: str = "orc",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Columnar table, optionally from dt `first` to `last`; the bounds are strings,
    so they prune partitions without a cast."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema.add("dt", "string") if "dt" not in schema.names else schema)
    table = reader.load(table_path).withColumn("dt", F.col("dt").cast("string"))
    if first is not None:
        table = table.where(F.col("dt") >= first)
    if last is not None:
        table = table.where(F.col("dt") <= last)
    return table


def read_partition(spark: SparkSession, table_path: str, dt: str, fmt: str = "orc") -> DataFrame:
    """One day of a columnar table."""
    return spark.read.format(fmt).load(f"{table_path}/dt={dt}").withColumn("dt", F.lit(dt))


def attach_partitions(spark: SparkSession, table: str) -> None:
    """Register the dt folders of an external catalog table that it does not know yet."""
    spark.catalog.recoverPartitions(table)


def read_clickstream(spark: SparkSession, path: str) -> DataFrame:
    """Raw log lines with an increasing line_id. Read as text: a damaged line has
    another number of fields, which a CSV reader would pad or cut."""
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("line_id"), F.col("value").alias("line")
    )


PRODUCT_SCHEMA = "product string, name string, price int, category string"


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product lookup: product,name,price,category without a header."""
    return spark.read.schema(PRODUCT_SCHEMA).csv(path)


def write_lines(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Cleaned log rows back to comma-separated text."""
    df.select(F.concat_ws(",", *columns).alias("value")).write.mode("overwrite").text(path)
